"""SimHash near-duplicates: fingerprints linked at a small Hamming distance.

Shards. A vantage-point tree prunes a branch when the distances of two points to
its vantage differ by more than the radius. On whole fingerprints that bound
prunes little, as distances to any vantage lie close together; so the bits are
cut into blocks and the tree's upper levels run on the blocks a pair must share.
Two fingerprints that differ in at most ``r`` of ``b > r`` blocks agree wholly in
``b - r`` of them: there their distance is zero, the radius is zero, and no
border overlaps. Each fingerprint is sent to one shard per choice of ``b - r``
blocks. Within a shard a vantage-point tree over all 64 bits finds the pairs
with the triangle bound, and distances are compared exactly.

A shard that outgrows one task is cut into pieces and each two pieces meet in a
task of their own. A task returns the links of a spanning forest, never all
pairs of a group; components are the same.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed_texts, texts, written

#: Fixed value: the seed of the shingle hash.
SEED = 42
#: Fingerprints of one piece of a shard; two pieces meet in a task.
PIECE = 4096
#: Fingerprints a shard should hold on average; more blocks are taken beyond it.
SHARD = 4096
#: Pairs compared at once without a further vantage point.
LEAF_PAIRS = 1 << 20


def fingerprint(text: bytes, width: int = 4) -> int:
    """64-bit fingerprint; a bit is set where over half of the shingle hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total, n = np.zeros(64, np.int64), len(words) - width + 1
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
    hashes = map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED))
    for at in range(0, n, 65536):
        some = np.fromiter(itertools.islice(hashes, 65536), "<u8", min(65536, n - at))
        # a byte per bit; eight bytes are added as one number, which holds for 255 rows
        bits = np.zeros((-(-len(some) // 255) * 255, 8), np.uint64)
        bits[: len(some)] = np.unpackbits(some.view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
        total += bits.reshape(-1, 255, 8).sum(1).view(np.uint8).sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """``doc_id, fp`` (signed 64 bits) of every row. Null and wordless texts give zero."""

    def run(rows):
        for batch in rows:
            found = np.array([fingerprint(t, width) for t in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])

    rows = keyed_texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def _roots(n: int) -> np.ndarray:
    return np.arange(n)


def _join(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Union of each pair; the smaller index is the root."""
    while len(left):
        a, b = parent[left], parent[right]
        far = a != b
        left, right, a, b = left[far], right[far], a[far], b[far]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def vantage_links(values: np.ndarray, radius: int, left: np.ndarray | None = None, right: np.ndarray | None = None) -> np.ndarray:
    """Root index of each fingerprint after linking all pairs within ``radius``.

    ``left`` and ``right`` (indexes) limit the pairs to one from each. A node takes
    a vantage point, sorts both sides by their distance to it, and only bands whose
    distances differ by at most ``radius`` go on; small nodes compare all their pairs.
    """
    parent = _roots(len(values))
    everything = np.arange(len(values))
    own = left is None
    todo = [(everything if own else left, everything if own else right, 0)]
    while todo:
        a, b, depth = todo.pop()
        if len(a) * len(b) <= LEAF_PAIRS or depth >= 6:
            step = max(1, LEAF_PAIRS // max(1, len(b)))
            for at in range(0, len(a), step):
                near = np.bitwise_count(values[a[at : at + step], None] ^ values[b][None, :]) <= radius
                i, j = np.nonzero(near)
                _join(parent, a[at : at + step][i], b[j])
            continue
        vantage = values[a[(depth * 7919) % len(a)]] ^ np.uint64((0x9E3779B97F4A7C15 * depth) % (1 << 64))
        da, db = np.bitwise_count(values[a] ^ vantage), np.bitwise_count(values[b] ^ vantage)
        for d in np.unique(da):
            apart = db.astype(np.int16) - int(d)
            # with one set on both sides the band above is enough
            mine, theirs = a[da == d], b[(apart <= radius) & (apart >= (0 if own and not depth else -radius))]
            if len(theirs):
                todo.append((mine, theirs, depth + 1))
    return parent


def _blocks(count: int, radius: int) -> list[list[tuple[int, int]]]:
    """(shift, width) of the blocks of each choice of agreeing blocks, by the number of fingerprints."""
    for blocks in range(radius + 1, 64):
        agree = blocks - radius
        cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
        parts = [(cuts[k], cuts[k + 1] - cuts[k]) for k in range(blocks)]
        choices = [list(c) for c in itertools.combinations(parts, agree)]
        if count / 2 ** min(sum(w for _, w in c) for c in choices) <= SHARD or blocks >= radius + 4:
            return choices
    return [[(0, 0)]]


def near_links(prints: DataFrame, radius: int, count: int) -> DataFrame:
    """``fp, root``: a spanning forest of the links between distinct fingerprints."""
    key = lambda parts: F.concat_ws(
        ":", *[F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1 if w < 64 else -1)).cast("string") for s, w in parts]
    )
    shards = prints.select("fp", F.posexplode(F.array(*[key(c) for c in _blocks(count, radius)])).alias("tree", "shard"))
    # only shards beyond one piece, a small table of its own: no shard has to gather in one task for it
    sizes = shards.groupBy("tree", "shard").count().where(F.col("count") > PIECE)
    large = written(sizes.select("tree", "shard", F.ceil(F.col("count") / PIECE).cast("int").alias("pieces")), "large_shards")
    placed = shards.join(large, ["tree", "shard"], "left").withColumn("pieces", F.coalesce("pieces", F.lit(1))).withColumn(
        "piece", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    )
    # a piece meets every other piece of its shard once; the first two also compare within
    met = placed.select(
        "fp", "tree", "shard", "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other")
    ).select(
        "fp", "piece", "tree", "shard", F.least("piece", "other").alias("low"), F.greatest("piece", "other").alias("high")
    )

    keys = ["tree", "shard", "low", "high"]

    def links(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for meeting in _meetings(rows, keys):
            if len(meeting) < 2:
                continue
            values, piece = meeting["fp"].to_numpy().view(np.uint64), meeting["piece"].to_numpy()
            order = np.argsort(values)
            values, piece, low, high = values[order], piece[order], meeting["low"].iloc[0], meeting["high"].iloc[0]
            if low == high:
                root = vantage_links(values, radius)
            else:
                root = vantage_links(values, radius, np.flatnonzero(piece == low), np.flatnonzero(piece == high))
            moved = root != np.arange(len(values))
            if moved.any():
                yield pd.DataFrame({"fp": values[moved].view(np.int64), "root": values[root[moved]].view(np.int64)})

    # one task works through many small meetings; the sort keeps the rows of a meeting together
    dealt = met.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(links, "fp long, root long").distinct()


def _meetings(rows: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The sorted rows cut where a key changes; only the open meeting is held."""
    rest: list[pd.DataFrame] = []
    for frame in rows:
        if not len(frame):
            continue
        if rest and any(frame[k].iloc[0] != rest[-1][k].iloc[-1] for k in keys):
            yield pd.concat(rest)
            rest = []
        changed = np.zeros(len(frame) - 1, bool)
        for k in keys:
            column = frame[k].to_numpy()
            changed |= column[1:] != column[:-1]
        at = [0, *(np.flatnonzero(changed) + 1).tolist()]
        for start, end in zip(at, at[1:]):
            part = frame.iloc[start:end]
            yield pd.concat([*rest, part]) if rest else part
            rest = []
        rest.append(frame.iloc[at[-1] :])
    if rest:
        yield pd.concat(rest)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that has a link, by large-star and small-star rounds.

    Each round is two aggregates and two joins on written tables; the loop ends
    when every component is a star.
    """
    edges = written(links.select(F.greatest("fp", "root").alias("u"), F.least("fp", "root").alias("v")).distinct(), "edges")
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # tables of their own, so that the joins on a hub's key can be split
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
        joined = large.join(low, "u")
        small = (
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct()
        )
        small = written(small, "small")
        # stars: no root has a root, and each node has one
        inner = small.join(small.select(F.col("u").alias("v")), "v", "left_semi")
        if inner.isEmpty() and small.count() == small.select("u").distinct().count():
            return small.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = small


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4
) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``radius``
    bits. Null, empty and wordless texts have fingerprint zero and are linked like
    any other; repeated rows share a component. A null id counts as the largest.
    """
    prints = written(fingerprints(docs, id_col, text_col, width), "prints")
    own = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "own")
    links = near_links(own.select("fp"), radius, own.count())
    grouped = written(
        own.join(components(links), own.fp == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")),
        "grouped",
    )
    least = written(grouped.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    classes = grouped.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
