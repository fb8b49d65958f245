"""Log-structured target tables: batches are appended, merged when read, and compacted by level.

A batch of changes is reduced to one row per key and written as one small run; nothing
that is there is rewritten. Readers merge runs: the highest sequence of a key wins, a
tombstone hides it. Runs lie in a tree of nodes over the bits of the key's hash. Once
the root has gathered ``fanout`` runs they are merged and, if the tree has grown below
it, handed down to its 16 children, and so on; so a row is rewritten once per level, not
once per batch. A leaf holds a base run with everything older. One that outgrows
``split_bytes`` is split into 16 leaves, so buckets grow in number with the table, not
in size.

Base runs are laid out along a Z-order curve over the cluster columns, with an index of
the files' bounds; a filtered read opens only files that may match. Newer runs are small
and always read, since they may overrule any base row.

Columns have ids (``evolution``), versions are commits (``commits``), and every kept
version stays readable. With ``feed`` each commit also writes the rows it inserted,
updated and deleted, with their values before and after.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import apply as A
from tidemark.plans import curve
from tidemark.plans.commits import CommitLog, Run, Snapshot
from tidemark.plans.evolution import Field, as_columns, conform, evolved, from_stored, keeps_order, stored_schema
from tidemark.plans.target import _files, folder_names

ROOT = "r"
#: Node of a row below the root: one hex digit of the key's hash per level.
LEVELS = 12
NODE = "_node"
TIE = "_tie"
PLACE = "_place_among_runs"
CHANGE, VERSION = "_change", "_version"
#: Added rows smaller than this are probed by reads, larger ones are merged by key.
PROBE_BYTES = 256 << 20
#: Leaves that a lookup of keys reads one by one; beyond it reads all.
LOOKUP_NODES = 256
#: Seconds after which a folder that no record names is taken for left over.
LEFT_OVER = 86_400


def key_struct(keys: Sequence[str]) -> Column:
    """The keys as one value, which is never null and equal where null keys meet."""
    return F.struct(*[F.col(f"`{k}`") for k in keys])


def key_hash(keys: Sequence[str]) -> Column:
    """16 hex digits that stay the same when a key column becomes wider or text."""
    return F.lower(F.lpad(F.hex(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys])), 16, "0"))


def node_at(depth: int, keys: Sequence[str]) -> Column:
    return F.concat(F.lit(ROOT), F.substring(key_hash(keys), 1, depth)) if depth else F.lit(ROOT)


class LogTarget:
    """A keyed table at ``path`` that grows by change batches.

    ``scd=1`` keeps the newest row of each key, ``scd=2`` the history of each key. The keys,
    the sequence columns, ``scd``, ``cluster_by`` and ``feed`` are fixed by the first commit; a
    table that is opened again takes them from there. ``keep`` versions stay readable,
    the change rows of ``keep_feed`` versions are kept.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str] = (), seq: Sequence[str] = (), scd: int = 1, cluster_by: Sequence[str] = (),
        fanout: int = 8, split_bytes: int = 512 << 20, file_rows: int = 1_000_000, keep: int = 10, feed: bool = False, keep_feed: int = 100,
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, self.path)
        known = self.log.load().settings
        self.keys, self.seq = list(known.get("keys", keys)), list(known.get("seq", seq))
        self.scd, self.cluster_by = known.get("scd", scd), list(known.get("cluster_by", cluster_by))[:10]
        if not self.keys or not self.seq:
            raise ValueError(f"{path} needs keys and sequence columns")
        self.fanout, self.split_bytes, self.file_rows = fanout, split_bytes, file_rows
        self.feed, self.keep, self.keep_feed = known.get("feed", feed), keep, keep_feed

    # what a version holds

    def exists(self) -> bool:
        return self.log.load().version > 0

    def fields(self, state: Snapshot) -> list[Field]:
        return [Field.of(f) for f in state.columns[-1]] if state.columns else []

    def _own(self, fields: Sequence[Field]) -> list[T.StructField]:
        """Columns beside the table's own in the files."""
        out = [T.StructField(A.DELETED, T.BooleanType()), T.StructField(TIE, T.LongType())]
        if self.scd == 2:
            kind = next(f.type for f in fields if f.name == self.seq[0])
            out += [T.StructField(A.UNCHANGED, T.BooleanType()), T.StructField(A.FROM, kind), T.StructField(A.TO, kind)]
        return out

    def _scan(self, state: Snapshot, runs: Sequence[Run], files: Sequence[str] | None = None) -> DataFrame:
        """Rows of the runs as the version's columns; with ``files`` only those of their files."""
        fields = self.fields(state)
        out: DataFrame | None = None
        for number in sorted({r.columns for r in runs}):
            have = [Field.of(f) for f in state.columns[number]]
            same = [r for r in runs if r.columns == number]
            paths = [f"{self.path}/{p}" for p in (_under(files, same) if files is not None else [r.path for r in same])]
            if not paths:
                continue
            rows = self.spark.read.schema(stored_schema(have, self._own(have))).parquet(*paths)
            own = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self._own(fields)]
            rows = rows.select(*from_stored(have, fields), *own)
            out = rows if out is None else out.unionByName(rows)
        return out if out is not None else self.spark.createDataFrame([], self._schema(fields))

    def _schema(self, fields: Sequence[Field]) -> T.StructType:
        return T.StructType([*[T.StructField(f.name, f.type) for f in fields], *self._own(fields)])

    def _identity(self) -> list[str]:
        return self.keys if self.scd == 1 else [*self.keys, *[s for s in self.seq if s not in self.keys]]

    def _rank(self) -> Column:
        return F.struct(*[F.col(f"`{s}`") for s in self.seq], F.col(A.DELETED), F.col(TIE))

    def _tie(self, rows: DataFrame, fields: Sequence[Field]) -> Column:
        payload = [f.name for f in fields if f.name not in self.keys]
        return A.payload_hash(rows, payload) if payload else F.lit(0).cast("long")

    def _newest(self, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """One row per key (and sequence, of a history), combined on the map side."""
        same = key_struct(by or self._identity()).alias("_k")
        best = rows.groupBy(same).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), self._rank()).alias("_r"))
        return best.select("_r.*")

    def _newest_of_runs(self, rows: DataFrame) -> DataFrame:
        """One row per key of several runs. Each holds a key once, so nothing combines on the map side; columns nobody reads are not shuffled."""
        keys = [F.col(f"`{k}`") for k in self._identity()]
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(self._rank().desc()))
        return rows.repartition(*keys).withColumn(PLACE, place).where(F.col(PLACE) == 1).drop(PLACE)

    # reading

    def state(self, version: int | None = None) -> DataFrame:
        """All rows of a version, tombstones included, in the form that ``apply`` works on."""
        return self._state(self._known(version))

    def _known(self, version: int | None) -> Snapshot:
        state = self.log.load(version)
        if not state.columns:
            raise ValueError(f"nothing was committed to {self.path}")
        return state

    def _state(self, state: Snapshot, ranges: Sequence[curve.Range] = (), nodes: set[str] | None = None) -> DataFrame:
        runs = [r for r in state.runs.values() if nodes is None or _related(r.node, nodes)]
        base, added = [r for r in runs if r.base], [r for r in runs if not r.base]
        files = self._files_for(state, base, ranges) if ranges and base and (self.scd == 1 or not added) else None
        rows = self._scan(state, base, files)
        if added and not base and self.scd == 1:
            rows = self._newest_of_runs(self._scan(state, added))
        elif added:
            newer = self._newest(self._scan(state, added))
            if self.scd == 2:
                return self._history(rows if base else None, newer)
            if sum(r.bytes for r in added) > PROBE_BYTES and files is None:
                rows = self._newest(rows.unionByName(newer))
            else:
                rows = self._probed(rows, self._scan(state, base), newer)
        return rows.drop(TIE)

    def _history(self, base: DataFrame | None, newer: DataFrame) -> DataFrame:
        changes = newer.drop(TIE, A.UNCHANGED, A.FROM, A.TO)
        if base is None:
            return A.scd2_state(changes, self.keys, self.seq)
        return A.apply_changes_scd2(base.drop(TIE), changes, self.keys, self.seq)

    def _probed(self, rows: DataFrame, everything: DataFrame, newer: DataFrame) -> DataFrame:
        """Base rows that no newer row overrules, and the newer rows that no base row overrules.

        ``rows`` may lack base rows that a filter skips, so what a newer row has to beat is
        looked up in ``everything``, of which only keys and ranks are read.
        """
        ranked = lambda df, name: df.select(key_struct(self.keys).alias("_k"), self._rank().alias(name))
        met = ranked(everything, "_theirs").join(ranked(newer, "_mine"), "_k")
        beaten = met.where(F.col("_theirs") >= F.col("_mine")).select("_k")
        keyed = newer.withColumn("_k", key_struct(self.keys))
        live = keyed.join(beaten, "_k", "left_anti")
        kept = rows.withColumn("_k", key_struct(self.keys)).join(live.select("_k"), "_k", "left_anti")
        return kept.drop("_k").unionByName(live.drop("_k"))

    def read(self, *ranges: curve.Range, version: int | None = None) -> DataFrame:
        """What users see: current rows, or the history with its validity; only rows within the ranges."""
        rows = self._state(self._known(version), ranges)
        rows = A.current_rows(rows) if self.scd == 1 else A.history_rows(rows)
        return rows.where(curve.in_ranges(ranges, rows.schema)) if ranges else rows

    def _files_for(self, state: Snapshot, base: Sequence[Run], ranges: Sequence[curve.Range]) -> list[str]:
        """Base files that may hold rows within the ranges, by the indexes of the folders they were written to."""
        fields = {f.name: f for f in self.fields(state)}
        unknown = [r[0] for r in ranges if r[0] not in fields]
        if unknown:
            raise ValueError(f"no columns {unknown} in {self.path}")
        nodes: dict[str, list[Run]] = {}
        for r in base:
            nodes.setdefault(r.path.rsplit("/", 1)[0], []).append(r)
        out: list[str] = []
        for number in sorted({r.columns for r in base}):
            have = {f.id: f for f in (Field.of(f) for f in state.columns[number])}
            usable = {
                name: have[f.id] for name, f in fields.items() if name in self._clustered(state, number) and keeps_order(have[f.id].type, f.type)
            }
            folders = [p for p, runs in nodes.items() if runs[0].columns == number]
            index = self.spark.read.parquet(*[f"{self.path}/{_index_of(p)}" for p in folders])
            asked = [(usable[n].stored, low, high) for n, low, high in ranges if n in usable]
            kinds = {usable[n].stored: fields[n].type for n, _, _ in ranges if n in usable}
            found = index.where(curve.may_hold(asked, kinds)).select("file_path", NODE).collect()
            out += _under(["/".join(r["file_path"].rsplit("/", 4)[1:]) for r in found], [r for p in folders for r in nodes[p]])
        return out

    def _clustered(self, state: Snapshot, number: int) -> list[str]:
        """Names, in force now, of the columns that an index of a column list has bounds of."""
        ids = state.settings.get("cluster_ids", [])
        have = {f[0] for f in state.columns[number]}
        return [f.name for f in self.fields(state) if f.id in ids and f.id in have]

    def files(self, *ranges: curve.Range, version: int | None = None) -> tuple[int, int]:
        """How many base files a read within the ranges opens, and how many there are."""
        state = self.log.load(version)
        base = [r for r in state.runs.values() if r.base]
        count = lambda r: len(self._files_for(state, base, r)) if base else 0
        return count(ranges), count(())

    # writing

    def apply(self, changes: DataFrame, flow: str = "batch", batch_id: int | None = None, query: str = "", compact: bool = True) -> bool:
        """Append a batch; False if this query's batch was applied before.

        Change rows carry ``_deleted`` or are upserts. New columns join the table, types
        widen as needed. The batch is read once.
        """
        changes = A.as_changes(changes)
        missing = [c for c in (*self.keys, *self.seq) if c not in changes.columns]
        if missing:
            raise ValueError(f"the batch lacks {missing}")
        written: dict[str, Any] = {}

        def attempt(state: Snapshot) -> dict | None:
            last = state.flows.get(flow)
            written["done"] = False
            if batch_id is not None and last and last[0] == query and last[1] >= batch_id:
                return None
            fields = evolved(self.fields(state), changes.drop(A.DELETED).schema, self._identity(), state.next_id)
            lists = [f.as_list() for f in fields]
            if written.get("lists") != lists:
                written.update(lists=lists, runs=self._append(changes, fields))
            number = len(state.columns) - (1 if state.columns and state.columns[-1] == lists else 0)
            change = {"add": [vars(Run(**{**r, "columns": number})) for r in written["runs"]], "kind": "apply"}
            change["flows"] = {flow: [query, batch_id if batch_id is not None else (last[1] + 1 if last else 0)]}
            if number == len(state.columns):
                change |= {"columns": lists, "next_id": 1 + max(state.next_id - 1, *[f.id for f in fields])}
            if not state.settings:
                at = {f.name: f.id for f in fields}
                unknown = [c for c in self.cluster_by if c not in at]
                if unknown:
                    raise ValueError(f"cluster columns {unknown} are not in the batch")
                change["settings"] = {
                    "keys": self.keys, "seq": self.seq, "scd": self.scd, "cluster_by": self.cluster_by, "feed": self.feed,
                    "cluster_ids": [at[c] for c in self.cluster_by],
                }
            if self.feed:
                change["feed"] = [self._write_feed(state, fields, change["add"], lists, number), number]
                change["feeds_gone"] = [[v, f[0]] for v, f in state.feeds.items() if int(v) <= state.version + 1 - self.keep_feed]
            written["done"] = True
            return change

        self.log.retry(attempt)
        if not written.get("done"):
            return False
        if compact:
            self.compact()
        return True

    def _append(self, changes: DataFrame, fields: Sequence[Field]) -> list[dict]:
        """Write a batch as one run at the root; an empty batch writes none."""
        rows = changes.select(*as_columns(changes, fields), A.DELETED)
        rows = rows.withColumn(TIE, self._tie(rows, fields))
        if self.scd == 2:
            kind = next(f.type for f in fields if f.name == self.seq[0])
            rows = rows.withColumns({A.UNCHANGED: F.lit(None).cast("boolean"), A.FROM: F.lit(None).cast(kind), A.TO: F.lit(None).cast(kind)})
        path = f"data/{uuid.uuid4().hex}"
        self._store(self._newest(rows), fields).write.parquet(f"{self.path}/{path}/{NODE}={ROOT}")
        count = self.spark.read.schema(stored_schema(fields)).parquet(f"{self.path}/{path}/{NODE}={ROOT}").count()
        if not count:
            self._delete(path)
            return []
        return [vars(Run(f"{path}/{NODE}={ROOT}", ROOT, 0, count, self._bytes(f"{path}/{NODE}={ROOT}")))]

    def _store(self, rows: DataFrame, fields: Sequence[Field]) -> DataFrame:
        """Rows under the stored names of their columns."""
        own = [f.name for f in self._own(fields)]
        return rows.select(*[F.col(f"`{f.name}`").alias(f.stored) for f in fields], *own, *([NODE] if NODE in rows.columns else []))

    def rename(self, old: str, new: str) -> None:
        """Rename a column; files stay as they are."""
        self._alter(lambda fields: [Field(f.id, new if f.name == old else f.name, f.type) for f in fields], old, new)

    def drop(self, name: str) -> None:
        """Drop a column; one that is added again under its name starts empty."""
        self._alter(lambda fields: [f for f in fields if f.name != name], name, None)

    def _alter(self, change: Callable[[list[Field]], list[Field]], old: str, new: str | None) -> None:
        def attempt(state: Snapshot) -> dict:
            fields = self.fields(state)
            names = [f.name for f in fields]
            if old not in names or new in names:
                raise ValueError(f"cannot change column {old!r} of {names} to {new!r}")
            if new is None and old in (*self._identity(), *self.cluster_by):
                raise ValueError(f"{old} is a key, sequence or cluster column")
            swap = lambda names: [new if n == old else n for n in names]
            settings = state.settings | {k: swap(state.settings[k]) for k in ("keys", "seq", "cluster_by")}
            return {"kind": "alter", "columns": [f.as_list() for f in change(fields)], "settings": settings}

        settings = self.log.retry(attempt).settings
        self.keys, self.seq, self.cluster_by = settings["keys"], settings["seq"], settings["cluster_by"]

    # compaction

    def compact(self, full: bool = False) -> int:
        """Merge runs level by level, from the root down, where a node has gathered enough; with ``full`` all of them.

        Returns the number of nodes that were rewritten.
        """
        done = depth = 0
        while (found := self._compact_level(depth, full)) is not None:
            done, depth = done + found, depth + 1
        if done:
            self.vacuum()
        return done

    def _compact_level(self, depth: int, full: bool) -> int | None:
        """Nodes rewritten at a depth; None below the deepest one."""
        state = self.log.load()
        if depth >= max((len(r.node) for r in state.runs.values()), default=0):
            return None
        at: dict[str, list[Run]] = {}
        for r in state.runs.values():
            if len(r.node) == depth + 1:
                at.setdefault(r.node, []).append(r)
        plans: dict[str, list[str]] = {"down": [], "split": [], "leaf": [], "added": []}
        for node, runs in at.items():
            added = [r for r in runs if not r.base]
            size, base = sum(r.bytes for r in added), sum(r.bytes for r in runs if r.base)
            if not added or not (full or len(added) >= self.fanout):
                continue
            if node in state.inner:
                plans["down"].append(node)
            elif size + base > self.split_bytes and depth < LEVELS:
                plans["split"].append(node)
            elif full or base < 4 * size:
                plans["leaf"].append(node)
            else:
                plans["added"].append(node)
        done = 0
        for kind, nodes in plans.items():
            if nodes:
                done += self._rewrite(kind, depth, sorted(nodes))
        return done

    def _rewrite(self, kind: str, depth: int, nodes: list[str]) -> int:
        """One job over all nodes of a level that need the same: merged rows, written to where they belong.

        ``down``: to the children; ``split``: to new children; ``leaf``: into a new base; ``added``: newer runs into one.
        """
        state = self.log.load()
        fields, chosen = self.fields(state), set(nodes)
        runs = [r for r in state.runs.values() if r.node in chosen and (kind != "added" or not r.base)]
        base, added = [r for r in runs if r.base], [r for r in runs if not r.base]
        below, whole = depth + (kind in ("down", "split")), kind in ("leaf", "split")
        if whole and self.scd == 2:
            rows = self._history(self._scan(state, base) if base else None, self._newest(self._scan(state, added)))
            rows = rows.withColumn(TIE, self._tie(rows, fields))
        else:
            rows = self._newest(self._scan(state, runs))
        folder = f"data/{uuid.uuid4().hex}"
        rows = rows.withColumn(NODE, node_at(below, self.keys))
        written = self._write_nodes(state, rows, fields, folder, runs, whole)
        number = len(state.columns) - 1
        add = [vars(Run(f"{folder}/{NODE}={n}", n, number, c, b, whole)) for n, c, b in written]

        def attempt(now: Snapshot) -> dict | None:
            if any(r.path not in now.runs for r in runs):
                return None  # another compaction took them
            change = {"kind": "compact", "add": add, "remove": [r.path for r in runs]}
            return change | ({"split": nodes} if kind == "split" else {})

        self.log.retry(attempt)
        return len(nodes)

    def _write_nodes(self, state: Snapshot, rows: DataFrame, fields: Sequence[Field], folder: str, runs: Sequence[Run], index: bool) -> list[tuple]:
        """Files by node, along the curve if they are to be a base; node, rows and bytes of each."""
        place = f"{self.path}/{folder}"
        clustered = [f for f in fields if f.id in state.settings.get("cluster_ids", [])]
        if index and clustered:
            names = [f.name for f in clustered]
            count = sum(r.rows for r in runs)
            cuts = curve.cut_points(self._scan(state, runs), names, count)
            parts = max(1, -(-count // self.file_rows))
            rows = rows.withColumn("_z", curve.place_on_curve(rows, cuts))
            rows = rows.repartitionByRange(parts, NODE, "_z", *names).sortWithinPartitions(NODE, "_z", *names)
        else:
            rows = rows.hint("rebalance", NODE).sortWithinPartitions(NODE)
        self._store(rows, fields).write.partitionBy(NODE).parquet(place)
        schema = stored_schema(fields, [*self._own(fields), T.StructField(NODE, T.StringType())])
        files = self.spark.read.schema(schema).parquet(place)
        listed = curve.file_index(files, [f.stored for f in clustered], NODE)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{_index_of(folder)}")
        found = self.spark.read.parquet(f"{self.path}/{_index_of(folder)}").groupBy(NODE).agg(F.sum("rows").alias("rows")).collect()
        return [(r[NODE], r["rows"], self._bytes(f"{folder}/{NODE}={r[NODE]}")) for r in found]

    # change feed

    def _write_feed(self, state: Snapshot, fields: Sequence[Field], add: list[dict], lists: list, number: int) -> str:
        """Rows that a commit inserts, updates or deletes, seen against the version before it."""
        folder = f"feed/{uuid.uuid4().hex}"
        # the batch and the state before it, both as the columns after it
        seen = Snapshot(state.version, dict(state.runs), state.inner, {}, [*state.columns, *([lists] if number == len(state.columns) else [])])
        batch = self._newest(self._scan(seen, [Run(**r) for r in add]), self.keys)
        old = self._lookup(seen, batch)
        values, key = F.struct(*[F.col(f"`{f.name}`") for f in fields]), key_struct(self.keys).alias("_k")
        was = old.select(key, values.alias("before"), self._rank().alias("_old"), F.col(A.DELETED).alias("_gone"))
        now = batch.select(key, values.alias("after"), self._rank().alias("_new"), F.col(A.DELETED).alias("_goes"))
        there = F.col("_old").isNotNull() & ~F.col("_gone")
        change = F.when(F.col("_goes") & there, "delete").when(~F.col("_goes"), F.when(there, "update").otherwise("insert"))
        met = now.join(was, "_k", "left").where(F.col("_old").isNull() | (F.col("_new") > F.col("_old")))
        shown = met.select(
            F.col("_k").alias("key"), change.alias(CHANGE), F.when(there, F.col("before")).alias("before"),
            F.when(~F.col("_goes"), F.col("after")).alias("after"),
        )
        shown.where(F.col(CHANGE).isNotNull()).write.parquet(f"{self.path}/{folder}")
        return folder

    def _lookup(self, state: Snapshot, keys: DataFrame) -> DataFrame:
        """Newest rows of some keys, tombstones included, read from the nodes they lie in."""
        nodes = None
        depth = max((len(r.node) - 1 for r in state.runs.values()), default=0)
        if depth:
            found = keys.select(node_at(depth, self.keys).alias("n")).distinct().limit(LOOKUP_NODES + 1).collect()
            nodes = {r["n"] for r in found} if len(found) <= LOOKUP_NODES else None
        runs = [r for r in state.runs.values() if nodes is None or _related(r.node, nodes)]
        wanted = keys.select(key_struct(self.keys).alias("_k")).distinct()
        rows = self._scan(state, runs).withColumn("_k", key_struct(self.keys)).join(wanted, "_k", "left_semi").drop("_k")
        return self._newest(rows, self.keys)

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """Inserts, updates and deletes of the versions in ``(since, until]``: key, ``before``, ``after``, change and version."""
        state = self.log.load()
        until = state.version if until is None else until
        if not self.feed:
            raise ValueError(f"{self.path} keeps no change rows")
        if since < state.feed_gone:
            raise ValueError(f"change rows up to version {state.feed_gone} are not kept")
        fields = self.fields(state)
        out: DataFrame | None = None
        for version, (folder, number) in sorted((int(v), f) for v, f in state.feeds.items()):
            if since < version <= until:
                rows = self.spark.read.parquet(f"{self.path}/{folder}").withColumn(VERSION, F.lit(version))
                rows = self._renamed(rows, [Field.of(f) for f in state.columns[number]], fields)
                out = rows if out is None else out.unionByName(rows)
        if out is not None:
            return out
        shape = T.StructType([T.StructField(f.name, f.type) for f in fields])
        keys = T.StructType([T.StructField(k, next((f.type for f in fields if f.name == k), T.StringType())) for k in self.keys])
        kinds = [("key", keys), (CHANGE, T.StringType()), ("before", shape), ("after", shape), (VERSION, T.IntegerType())]
        return self.spark.createDataFrame([], T.StructType([T.StructField(n, k) for n, k in kinds]))

    def _renamed(self, rows: DataFrame, had: Sequence[Field], fields: Sequence[Field]) -> DataFrame:
        """Change rows as today's columns."""
        old = {f.id: f for f in had}

        def shaped(c: str, wanted: Sequence[Field]) -> Column:
            parts = [
                (conform(F.col(c).getField(old[f.id].name), old[f.id].type, f.type) if f.id in old else F.lit(None).cast(f.type)).alias(f.name)
                for f in wanted
            ]
            return F.when(F.col(c).isNotNull(), F.struct(*parts)).alias(c)

        keys = [f for f in fields if f.name in self.keys]
        keys.sort(key=lambda f: self.keys.index(f.name))
        return rows.select(shaped("key", keys), CHANGE, shaped("before", fields), shaped("after", fields), VERSION)

    # housekeeping

    def vacuum(self) -> None:
        """Remove what no kept version needs: the newest ``keep`` ones and those a record of the log still builds on."""
        versions = self.log.versions()
        if len(versions) <= self.keep:
            return
        kept = versions[-self.keep :]
        self.log.raise_floor(kept[0])
        needed: set[str] = set()
        state = self.log.load(kept[0])
        needed |= set(state.runs)
        for v in kept[1:]:
            record = self.log._read(v) or {}
            needed |= {r["path"] for r in record.get("add", [])}
        tops = {p.split("/")[1] for p in needed}
        named = set(tops)
        for gone in versions[: -self.keep]:
            record = self.log._read(gone) or {}
            named |= {r["path"].split("/")[1] for r in record.get("add", [])}
            for _, folder in record.get("feeds_gone", []):
                self._delete(folder)
            for path in (*record.get("remove", []), *[r["path"] for r in record.get("add", [])]):
                if path not in needed:
                    self._delete(path)
                    if path.split("/")[1] not in tops:
                        self._delete("/".join(path.split("/")[:2]))
                        self._delete(_index_of("/".join(path.split("/")[:2])))
        # folders of writers that died, or that lost against another one
        for name in folder_names(self.spark, f"{self.path}/data"):
            if name not in named and self._age(f"data/{name}") > LEFT_OVER:
                self._delete(f"data/{name}")
                self._delete(f"index/{name}")
        self.log.forget(kept[0])

    def _age(self, path: str) -> float:
        fs, place = _files(self.spark, f"{self.path}/{path}")
        return time.time() - fs.getFileStatus(place).getModificationTime() / 1000

    def _bytes(self, path: str) -> int:
        fs, place = _files(self.spark, f"{self.path}/{path}")
        return fs.getContentSummary(place).getLength() if fs.exists(place) else 0

    def _delete(self, path: str) -> None:
        fs, place = _files(self.spark, f"{self.path}/{path}")
        if fs.exists(place):
            fs.delete(place, True)


def replayed(feed: DataFrame) -> DataFrame:
    """The table that a feed leaves: the last change of each key, unless it is a delete."""
    last = feed.groupBy("key").agg(F.max_by(F.struct(CHANGE, "after"), F.col(VERSION)).alias("_r"))
    return last.where(F.col(f"_r.{CHANGE}") != "delete").select("_r.after.*")


def _index_of(folder: str) -> str:
    return folder.replace("data/", "index/", 1)


def _related(node: str, nodes: set[str]) -> bool:
    """Whether a node lies on the path to one of the nodes or below it."""
    return any(n.startswith(node) or node.startswith(n) for n in nodes)


def _under(files: Sequence[str], runs: Sequence[Run]) -> list[str]:
    """The files, named from the table's folder on, that belong to the runs."""
    paths = {r.path for r in runs}
    return [f for f in files if f.rsplit("/", 1)[0] in paths]
