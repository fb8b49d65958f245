"""Snapshots compared by a tree of digests, so that only what differs is read and joined.

A snapshot's rows lie in leaves by the first hex digits of the key's hash. A digest is
the row count and two sums of row hashes: sums don't depend on the order of rows, combine
on the map side, and a bucket's digest is the sum of its leaves'. Comparing a new snapshot
with a stored one takes one pass over the new one for its digests; then buckets are
compared, then the leaves of unequal buckets, and only rows of unequal leaves, of either
side, meet in a join. Replacing a snapshot rewrites only those leaves.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import apply as A
from tidemark.plans.commits import CommitLog, Run, Snapshot
from tidemark.plans.evolution import Field, as_columns, evolved, from_stored, stored_schema
from tidemark.plans.logtable import key_hash
from tidemark.plans.target import _files

LEAF = "_leaf"
_SUMS = ("n", "one", "two")


def row_sums(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Count of rows and two independent sums of their hashes, exact for any number of rows."""
    total = lambda seed: F.sum(A.payload_hash(df, columns, seed).cast("decimal(38,0)"))
    return [F.count("*").alias("n"), total(None).alias("one"), total(1).alias("two")]


def leaf_digests(df: DataFrame, keys: Sequence[str], depth: int) -> DataFrame:
    """``_leaf`` and its digest, for every leaf that has rows."""
    return df.groupBy(F.substring(key_hash(keys), 1, depth).alias(LEAF)).agg(*row_sums(df, df.columns))


def unequal(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """Names whose digests differ or that only one side has."""
    other = new.select(F.col(name).alias("_name"), *[F.col(s).alias(f"_{s}") for s in _SUMS])
    met = old.join(other, F.col(name) == F.col("_name"), "full_outer")
    same = F.lit(True)
    for s in _SUMS:
        same = same & F.col(s).eqNullSafe(F.col(f"_{s}"))
    return met.where(~same).select(F.coalesce(name, "_name").alias(name))


@dataclass
class Compared:
    """What a comparison had to look at."""

    leaves: list[str]  # unequal ones
    stored_leaves: int
    read_bytes: int  # of the stored snapshot
    stored_bytes: int


class DigestTarget:
    """A keyed snapshot at ``path`` with its digests; ``16 ** depth`` leaves, in ``16 ** (depth // 2)`` buckets.

    Keys are unique within a snapshot. ``keys`` and ``depth`` are fixed by the first one.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), depth: int = 2) -> None:
        self.spark, self.path, self.log = spark, path.rstrip("/"), CommitLog(spark, path.rstrip("/"))
        known = self.log.load().settings
        self.keys, self.depth = list(known.get("keys", keys)), known.get("depth", depth)
        if not self.keys:
            raise ValueError(f"{path} needs keys")

    def state(self) -> DataFrame:
        state = self.log.load()
        return self._scan(state, list(state.runs))

    def _scan(self, state: Snapshot, paths: Sequence[str]) -> DataFrame:
        fields = [Field.of(f) for f in state.columns[-1]] if state.columns else []
        out = self.spark.createDataFrame([], T.StructType([T.StructField(f.name, f.type) for f in fields]))
        for number in sorted({state.runs[p].columns for p in paths}):
            have = [Field.of(f) for f in state.columns[number]]
            some = [f"{self.path}/{p}" for p in paths if state.runs[p].columns == number]
            rows = self.spark.read.schema(stored_schema(have)).parquet(*some).select(*from_stored(have, fields))
            out = out.unionByName(rows)
        return out

    def _digests(self, state: Snapshot) -> DataFrame:
        path = state.settings.get("digest")
        if path is None:
            return self.spark.createDataFrame([], f"{LEAF} string, n long, one decimal(38,0), two decimal(38,0)")
        return self.spark.read.parquet(f"{self.path}/{path}")

    def _fields(self, state: Snapshot, snap: DataFrame) -> list[Field]:
        """The columns of the new snapshot: ids of known names stay, wider where rows that stay need it."""
        known = [Field.of(f) for f in state.columns[-1]] if state.columns else []
        names = set(snap.columns)
        return [f for f in evolved(known, snap.schema, self.keys, state.next_id) if f.name in names]

    def compare(self, snap: DataFrame) -> Compared:
        """Which leaves of the stored snapshot a new one differs in."""
        state = self.log.load()
        return self._compare(state, self._digested(state, snap)[1])

    def _digested(self, state: Snapshot, snap: DataFrame) -> tuple[DataFrame, DataFrame, str]:
        """The snapshot as the target's columns, and its digests, written to a folder."""
        rows = snap.select(*as_columns(snap, self._fields(state, snap)))
        path = f"digest/{uuid.uuid4().hex}"
        leaf_digests(rows, self.keys, self.depth).coalesce(1).write.parquet(f"{self.path}/{path}")
        return rows, self.spark.read.parquet(f"{self.path}/{path}"), path

    def _compare(self, state: Snapshot, new: DataFrame) -> Compared:
        old, top = self._digests(state), max(1, self.depth // 2)
        bucket = F.substring(LEAF, 1, top).alias("bucket")
        sums = lambda d: d.groupBy(bucket).agg(*[F.sum(s).alias(s) for s in _SUMS])
        buckets = [r["bucket"] for r in unequal(sums(old), sums(new), "bucket").collect()]
        inside = lambda d: d.where(F.substring(LEAF, 1, top).isin(buckets))
        leaves = sorted(r[LEAF] for r in unequal(inside(old), inside(new), LEAF).collect()) if buckets else []
        chosen = set(leaves)
        read = sum(r.bytes for r in state.runs.values() if r.node in chosen)
        return Compared(leaves, len(state.runs), read, sum(r.bytes for r in state.runs.values()))

    def changes(self, snap: DataFrame) -> DataFrame:
        """Rows that a new snapshot inserts, updates or deletes, like ``apply.snapshot_changes`` of all rows."""
        state = self.log.load()
        rows, digests, path = self._digested(state, snap)
        leaves = self._compare(state, digests).leaves
        self._delete(path)
        return self._changes(state, rows, leaves)

    def _changes(self, state: Snapshot, rows: DataFrame, leaves: Sequence[str]) -> DataFrame:
        chosen = set(leaves)
        old = self._scan(state, [p for p, r in state.runs.items() if r.node in chosen])
        known = {f.name: f.dataType for f in old.schema}
        old = old.select(*[(F.col(f"`{f.name}`") if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema])
        return A.snapshot_changes(old, self._inside(rows, leaves), self.keys)

    def _inside(self, rows: DataFrame, leaves: Sequence[str]) -> DataFrame:
        return rows.where(F.substring(key_hash(self.keys), 1, self.depth).isin(list(leaves)))

    def replace(self, snap: DataFrame) -> Compared:
        """Make a snapshot the content; only leaves that differ are written. The snapshot is read twice."""
        found: list[Compared] = []

        def attempt(state: Snapshot) -> dict:
            fields = self._fields(state, snap)
            rows, digests, digest = self._digested(state, snap)
            compared = self._compare(state, digests)
            lists, last = [f.as_list() for f in fields], state.columns[-1] if state.columns else None
            if last is not None and {f[0]: f[2] for f in last} != {f[0]: f[2] for f in lists}:
                # types or columns moved: rows that hash alike may still be stored in another form
                compared.leaves = sorted({r.node for r in state.runs.values()} | {r[LEAF] for r in digests.select(LEAF).collect()})
            number = len(state.columns) - (1 if last == lists else 0)
            chosen, folder = set(compared.leaves), f"data/{uuid.uuid4().hex}"
            add = self._write(self._inside(rows, compared.leaves), fields, folder, number) if chosen else []
            change = {"kind": "replace", "add": add, "remove": [p for p, r in state.runs.items() if r.node in chosen]}
            change["settings"] = {"keys": self.keys, "depth": self.depth, "digest": digest}
            if number == len(state.columns):
                change |= {"columns": lists, "next_id": 1 + max(state.next_id - 1, *[f.id for f in fields])}
            found[:] = [compared]
            return change

        self.log.retry(attempt)
        return found[0]

    def _write(self, rows: DataFrame, fields: Sequence[Field], folder: str, number: int) -> list[dict]:
        dealt = rows.withColumn(LEAF, F.substring(key_hash(self.keys), 1, self.depth)).hint("rebalance", LEAF)
        stored = dealt.select(*[F.col(f"`{f.name}`").alias(f.stored) for f in fields], LEAF)
        stored.write.partitionBy(LEAF).parquet(f"{self.path}/{folder}")
        counts = self.spark.read.schema(f"{LEAF} string").parquet(f"{self.path}/{folder}").groupBy(LEAF).count().collect()
        runs = []
        for r in counts:
            path = f"{folder}/{LEAF}={r[LEAF]}"
            fs, place = _files(self.spark, f"{self.path}/{path}")
            runs.append(vars(Run(path, r[LEAF], number, r["count"], fs.getContentSummary(place).getLength(), True)))
        return runs

    def _delete(self, path: str) -> None:
        fs, place = _files(self.spark, f"{self.path}/{path}")
        fs.delete(place, True)
