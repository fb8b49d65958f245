"""Target tables as parquet generations of key buckets.

Rows lie in buckets by the hash of their key. A merge reads and rewrites only the
buckets its batch touches, and then writes a small commit record that names, for
every bucket, the generation that holds it; readers follow the newest record. A run
that dies between the two leaves nothing behind that a reader can see. Generations
that no kept record names are removed.

A record carries, per flow, the streaming query and the last batch it applied: a batch
that is delivered again is skipped, while a query with a new checkpoint, whose
batches count from 0 again, is merged like any other changes.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"
_COMMIT = "record string"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path itself."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, sorted; none if it is missing."""
    fs, place = _files(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(place)) if fs.exists(place) else []


@dataclass
class Commit:
    """What one record says."""

    generation: int = 0
    flows: dict[str, list] = field(default_factory=dict)  # flow: query, last batch
    parts: dict[str, int] = field(default_factory=dict)  # bucket: generation
    buckets: int = 0
    schema: str = ""


class Target:
    """A keyed target (merged) at ``path``.

    ``buckets`` and ``keys`` are fixed by the first commit; without keys there is one
    bucket. ``keep`` commits stay readable.
    """

    def __init__(
        self, spark: SparkSession, path: str, cluster_by: Sequence[str] = (), keys: Sequence[str] = (), buckets: int = 16, keep: int = 3
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.cluster_by, self.keys = list(cluster_by), list(keys)
        self.buckets, self.keep = buckets, keep

    def head(self) -> Commit:
        done = [n for n in folder_names(self.spark, f"{self.path}/commits") if folder_names(self.spark, f"{self.path}/commits/{n}")]
        for name in reversed(done):
            row = self.spark.read.schema(_COMMIT).json(f"{self.path}/commits/{name}").first()
            if row:
                return Commit(**json.loads(row["record"]))
        return Commit()

    def data_path(self, generation: int) -> str:
        return f"{self.path}/gen={generation:08d}"

    def exists(self) -> bool:
        return self.head().generation > 0

    def state(self, empty: DataFrame | None = None) -> DataFrame:
        head = self.head()
        if head.generation == 0:
            if empty is None:
                raise ValueError(f"no generation at {self.path}")
            return empty
        return self._read(head, sorted(head.parts))

    def _read(self, head: Commit, buckets: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(head.schema))
        paths = [f"{self.data_path(head.parts[b])}/{BUCKET}={b}" for b in buckets if b in head.parts]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def bucket_of(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int") if self.keys else F.lit(0)

    def apply(
        self,
        flow: str,
        batch_id: int,
        build: Callable[[DataFrame | None], DataFrame],
        changes: DataFrame | None = None,
        query: str = "",
    ) -> bool:
        """Commit ``build(current rows)`` unless this query's batch was applied before.

        With ``changes`` only the buckets of their keys are read and rewritten;
        ``build`` sees those rows alone. Without, it sees and replaces everything.
        """
        head = self.head()
        last = head.flows.get(flow)
        if last and last[0] == query and last[1] >= batch_id:
            return False
        buckets = head.buckets or self.buckets
        if changes is not None and self.keys:
            touched = {str(r[0]) for r in changes.select(self.bucket_of(buckets)).distinct().collect()}
        else:
            touched = set(head.parts)
            changes = None
        current = self._read(head, sorted(touched)) if head.generation else None
        rows, place = build(current), self.data_path(head.generation + 1)
        if changes is not None and head.generation and _moved(T.StructType.fromJson(json.loads(head.schema)), rows.schema):
            # a column changed its type: buckets written before would not be readable beside the new ones
            touched, changes = set(head.parts), None
            rows = build(self._read(head, sorted(touched)))
        write_clustered(rows.withColumn(BUCKET, self.bucket_of(buckets)), place, [BUCKET], self.cluster_by)
        written = {n.split("=")[1] for n in folder_names(self.spark, place) if n.startswith(f"{BUCKET}=")}
        kept = {b: g for b, g in head.parts.items() if changes is not None and b not in touched}
        commit = Commit(
            head.generation + 1, head.flows | {flow: [query, batch_id]}, kept | dict.fromkeys(written, head.generation + 1),
            buckets, rows.schema.json(),
        )
        if self.head().generation != head.generation:
            raise RuntimeError(f"another writer committed to {self.path}")
        record = self.spark.createDataFrame([(json.dumps(vars(commit), sort_keys=True),)], _COMMIT).coalesce(1)
        record.write.mode("overwrite").json(f"{self.path}/commits/{commit.generation:08d}")
        self._prune()
        return True

    def _prune(self) -> None:
        """Remove commits beyond the newest ``keep`` and the buckets none of the kept ones names."""
        names = folder_names(self.spark, f"{self.path}/commits")
        gone, kept = names[: -self.keep], names[-self.keep :]
        if not gone:
            return
        used: dict[int, set[str]] = {}
        for name in kept:
            row = self.spark.read.schema(_COMMIT).json(f"{self.path}/commits/{name}").first()
            for bucket, generation in (json.loads(row["record"])["parts"] if row else {}).items():
                used.setdefault(generation, set()).add(f"{BUCKET}={bucket}")
        for name in gone:
            self._delete(f"{self.path}/commits/{name}")
        newest = int(names[-1])
        for folder in folder_names(self.spark, self.path):
            generation = int(folder.split("=")[1]) if folder.startswith("gen=") else newest + 1
            if generation > newest:
                continue
            if generation not in used:
                self._delete(f"{self.path}/{folder}")
                continue
            for part in folder_names(self.spark, f"{self.path}/{folder}"):
                if part.startswith(BUCKET) and part not in used[generation]:
                    self._delete(f"{self.path}/{folder}/{part}")

    def _delete(self, path: str) -> None:
        fs, place = _files(self.spark, path)
        fs.delete(place, True)


def _moved(old: T.StructType, new: T.StructType) -> bool:
    """Whether a column that both have changed its type."""
    known = {f.name: f.dataType for f in old}
    return any(f.name in known and known[f.name].simpleString() != f.dataType.simpleString() for f in new)


def write_clustered(df: DataFrame, path: str, parts: Sequence[str], cluster_by: Sequence[str] = ()) -> None:
    """Write parquet in folders by ``parts``, sorted by the cluster columns, so that scans skip row groups.

    Rows are dealt out by the parts and large ones are split by size, so neither a
    large bucket nor a frequent cluster value ends in one task.
    """
    dealt = df.hint("rebalance", *parts).sortWithinPartitions(*parts, *cluster_by)
    dealt.write.mode("overwrite").partitionBy(*parts).parquet(path)


def create_target(
    spark: SparkSession, path: str, schema: T.StructType, cluster_by: Sequence[str] = (), keys: Sequence[str] = ()
) -> Target:
    """A target with the cluster and key columns checked against its schema."""
    unknown = [c for c in (*cluster_by, *keys) if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"cluster columns {unknown} are not in the schema")
    return Target(spark, path, cluster_by, keys)


class AppendTarget:
    """An append-only target; each batch of a streaming query has its own folder, so a repeated one replaces itself.

    A query with a new checkpoint would deliver the same files again under another
    id. It is refused, unless ``other_queries`` says that its data is new.
    """

    def __init__(self, spark: SparkSession, path: str, other_queries: bool = False) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.other_queries = other_queries

    def append(self, df: DataFrame, flow: str, batch_id: int, query: str = "") -> None:
        own = f"_query={query or 'none'}"
        known = [n for n in folder_names(self.spark, f"{self.path}/_flow={flow}") if n != own]
        if known and not self.other_queries:
            raise ValueError(f"{self.path} holds batches of another query of flow {flow!r}: its checkpoint is gone or another one is used")
        df.write.mode("overwrite").parquet(f"{self.path}/_flow={flow}/{own}/_batch={batch_id}")

    def read(self) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(self.path).drop("_flow", "_query", "_batch")


def sink_append(df: DataFrame, target: str) -> None:
    """Plain batch append."""
    df.write.mode("append").parquet(target)
