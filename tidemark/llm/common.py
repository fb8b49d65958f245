"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir, configure

#: Fixed value: the white space of the contracts, as a Java pattern.
SPACE = r"[\x20\x09-\x0D]+"

#: Rows of one Arrow batch: long texts must fit a worker's memory.
BATCH_ROWS = 500


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of these operators."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` only (null text: empty), so that other columns cannot clash."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )


def fold(column: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id falls in fold 0 of the empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def drawn(rows: DataFrame, count: int, sample: int, *columns: str) -> DataFrame:
    """About ``sample`` of ``count`` rows, all if there are fewer, picked by a hash of the columns.

    No rows are sorted or gathered for it, and a retried task picks the same ones.
    """
    draw = F.pmod(F.xxhash64(*columns), F.lit(1_000_003)) / 1_000_003.0
    return rows.where(draw < F.lit(min(1.0, sample / max(1, count)))) if count > sample else rows


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A batch's texts as UTF-8."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def batches_of(rows: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[list[pa.RecordBatch]]:
    """Batches gathered until their texts reach ``limit`` bytes."""
    held, size = [], 0
    for batch in rows:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held
