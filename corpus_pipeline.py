"""From raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last return
the columns of documents. Null and empty texts are documents like any other: the
classifier judges them, all empty ones are one group, and they have no benchmark
passage. Empty tables give empty results. Rows that repeat an id with the same text
are one document after the exact stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, exact_dedup, quality, simhash
from tidemark.llm.common import ready, written
from tidemark.llm.queries import vocabulary

_ID, _SHA = "__tidemark_id", "__tidemark_sha"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _only(docs: DataFrame, sha, chosen: DataFrame, repeated: bool) -> DataFrame:
    """Rows of ``docs`` whose id and text digest are in ``chosen``; one of each if some repeat."""
    rows = docs.withColumn(_SHA, sha)
    chosen = chosen.toDF(_ID, _SHA)
    kept = rows.join(chosen, rows["doc_id"].eqNullSafe(chosen[_ID]) & (rows[_SHA] == chosen[_SHA]), "left_semi")
    return (kept.dropDuplicates(["doc_id", _SHA]) if repeated else kept).drop(_SHA)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    ready(spark)
    return quality.accepted(docs, _table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    ready(spark)
    found = written(exact_dedup.exact_duplicates(docs), "exact")
    again = not found.where(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).isEmpty()
    text = exact_dedup.normalised(F.coalesce(F.col("text"), F.lit("")))
    return _only(docs, F.sha2(text.cast("binary"), 256), found.where("kept").select("doc_id", "text_sha256"), again)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the smallest id (null last), then the smallest digest."""
    ready(spark)
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    keyed = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), sha.alias("sha")).alias("doc_id"), "text")
    found = written(simhash.near_duplicates(keyed), "near")
    first = found.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").count()
    again = not first.where("count > 1").isEmpty()
    return _only(docs, sha, first.select("doc_id.id", "doc_id.sha"), again)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    ready(spark)
    return decontaminate.uncontaminated(docs, _table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of ids and decoded text."""
    ready(spark)
    return bpe.encode_documents(docs, vocabulary(), full=True).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding", encoding_stage),
]

#: The stages learn, search and encode, which SQL cannot express; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each result is a table in the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
