"""Benchmark decontamination by suffix arrays over shards of the documents.

Each task builds word-level suffix arrays over its own documents, a bounded
number of words at a time, and binary-searches every benchmark window (a test
suffix up to the window's length) in them. Where windows of an item occur, the
longest verbatim match of the item is worked out with its place in both texts.

The benchmark is cut by Spark into blocks of bounded bytes, by a hash of its
rows. The driver passes on one block of raw rows at a time, tasks make its
windows, and a pass over the documents searches that block alone; so no process
ever holds more than one, however large the benchmark is. A benchmark of one
block takes one pass and shuffles nothing; of several, only the hits and the
ids and digests of the documents meet.

Only words of the benchmark get a number. A run of such words that is shorter
than the shortest window cannot hold one, so its suffixes are left out of the
array; this prunes nearly all text and loses nothing.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, keyed_texts, texts, written

#: Consecutive words of a window.
WINDOW = 10
#: Bytes of text of one suffix array.
SHARD_BYTES = 12_000_000
#: Benchmark bytes of one block (expected): under 100 MB with its windows.
BLOCK_BYTES = 8_000_000

#: Fixed value: words are runs of 0-9, a-z (A-Z lower-cased) and everything beyond ASCII.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text."""
    return text.translate(_TABLE).split()


@dataclass
class Block:
    """Windows of some benchmark items: per length the distinct windows and the items of each."""

    vocab: dict[bytes, int]
    items: list[str]
    texts: list[list[np.ndarray]]  # numbered words of the rows of each item
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # length: words, item starts, items

    @property
    def shortest(self) -> int:
        return min(self.windows, default=0)


def make_block(rows: list[tuple[str, bytes]], window: int) -> Block:
    """Number the words of some items and gather their windows."""
    vocab: dict[bytes, int] = {}
    found: dict[int, dict[tuple[int, ...], set[int]]] = {}
    names: dict[str, int] = {}
    held: list[list[np.ndarray]] = []
    for name, text in rows:
        ids = [vocab.setdefault(w, len(vocab) + 1) for w in words_of(text)]
        if not ids:
            continue
        item, size = names.setdefault(name, len(names)), min(window, len(ids))
        if item == len(held):
            held.append([])
        held[item].append(np.array(ids, np.int64))
        for at in range(len(ids) - size + 1):
            found.setdefault(size, {}).setdefault(tuple(ids[at : at + size]), set()).add(item)
    windows = {}
    for size, each in found.items():
        counts = np.cumsum([0, *(len(v) for v in each.values())])
        windows[size] = (np.array(list(each), np.int64), counts, np.array([i for v in each.values() for i in sorted(v)], np.int64))
    return Block(vocab, list(names), held, windows)


def suffix_array(ids: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of their suffixes up to ``depth`` words; a zero ends a suffix.

    Prefix doubling: ranks of 1, 2, 4, ... words, until all differ, nothing changes
    or the depth is reached.
    """
    rank = np.zeros(len(ids) + 1, np.int64)
    rank[:-1] = ids
    classes, width = -1, 1
    while width < depth:
        after = np.minimum(starts + width, len(ids))
        pair = rank[starts] * (int(rank.max()) + 1) + rank[after]
        distinct, dense = np.unique(pair, return_inverse=True)
        # the starts hold whole runs: any other place ends a suffix
        fresh = np.zeros_like(rank)
        fresh[starts] = dense + 1
        rank, width = fresh, width * 2
        if len(distinct) == classes or len(distinct) == len(starts):
            break
        classes = len(distinct)
    return starts[np.argsort(rank[starts], kind="stable")]


def search(ids: np.ndarray, array: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last position (exclusive) of each window's occurrences in a suffix array."""
    size = windows.shape[1]
    padded = np.concatenate([ids, np.zeros(size, ids.dtype)])
    reach = np.arange(size)
    bounds = []
    for beyond in (False, True):
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(array), np.int64)
        while (open_ := low < high).any():
            mid = (low + high) // 2
            apart = padded[array[np.minimum(mid, len(array) - 1)][:, None] + reach] - windows
            first = apart[np.arange(len(windows)), np.argmax(apart != 0, axis=1)]
            less = first <= 0 if beyond else first < 0
            low, high = np.where(open_ & less, mid + 1, low), np.where(open_ & ~less, mid, high)
        bounds.append(low)
    return bounds[0], bounds[1]


def _hits(docs: list[list[bytes]], block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, document, word, window) arrays of every occurrence in the documents."""
    get = block.vocab.get
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    ids = np.zeros(int(sizes.sum()) + len(docs), np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    for at, words in zip(starts.tolist(), docs):
        ids[at : at + len(words)] = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
    known = ids > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= block.shortest
    begin, length = begin[long], (end - begin)[long]
    if not len(begin):
        return
    places = np.repeat(begin - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
    array = suffix_array(ids, places, max(block.windows))
    for size, (windows, _, _) in block.windows.items():
        low, high = search(ids, array, windows)
        times = high - low
        at = array[np.repeat(low - np.cumsum(times) + times, times) + np.arange(int(times.sum()))]
        doc = np.searchsorted(starts, at, side="right") - 1
        yield size, doc, at - starts[doc], np.repeat(np.arange(len(windows)), times)


def longest_match(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Words, place in the item and place in the text of the longest run both share; the first one in the text, then in the item."""
    best, ending = (0, 0, 0), np.zeros(len(text) + 1, np.int64)
    for at, word in enumerate(item.tolist()):
        ending[1:] = np.where(text == word, ending[:-1] + 1, 0)
        size = int(ending.max())
        if size >= best[0]:
            start = int(ending.argmax()) - size
            if size > best[0] or start < best[2]:
                best = size, at + 1 - size, start
    return best


@dataclass
class Found:
    """What a document shares with the benchmark."""

    items: list[str]
    spans: list[tuple[int, int]]  # stretches of hit words
    matches: list[tuple[str, int, int, int]]  # item, its word, the document's word, words: the longest of each item

    @property
    def hit(self) -> int:
        return sum(b - a for a, b in self.spans)


def contamination(docs: list[list[bytes]], block: Block) -> list[Found]:
    """What each document shares with the items of a block."""
    out = [Found([], [], []) for _ in docs]
    if not block.windows:
        return out
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    marks = np.zeros(int(starts[-1]) + 1, np.int64)
    items: dict[int, set[int]] = {}
    for size, doc, word, window in _hits(docs, block):
        np.add.at(marks, starts[doc] + word, 1)
        np.add.at(marks, starts[doc] + word + size, -1)
        _, firsts, owners = block.windows[size]
        pairs = np.unique(doc * len(firsts) + window)
        for d, w in zip((pairs // len(firsts)).tolist(), (pairs % len(firsts)).tolist()):
            items.setdefault(d, set()).update(owners[firsts[w] : firsts[w + 1]].tolist())
    hit = np.cumsum(marks) > 0
    for d, own in items.items():
        inside = hit[starts[d] : starts[d + 1] - 1]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))).tolist()
        spans = list(zip(edge[::2], edge[1::2]))
        ids = np.zeros(len(inside), np.int64)
        ids[inside] = [block.vocab.get(docs[d][i], 0) for i in np.flatnonzero(inside).tolist()]
        # a match of a window or more lies within a stretch, and a zero ends it
        near = np.concatenate([np.append(ids[a:b], 0) for a, b in spans])
        place = np.concatenate([np.arange(a, b + 1) for a, b in spans])
        matches = []
        for i in sorted(own, key=lambda i: block.items[i]):
            best = max((longest_match(near, t) for t in block.texts[i]), key=lambda m: (m[0], -m[2], -m[1]))
            matches.append((block.items[i], best[1], int(place[best[2]]), best[0]))
        out[d] = Found([m[0] for m in matches], spans, matches)
    return out


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, bytes]]]:
    """Distinct raw rows of the benchmark, one block at a time."""
    rows = keyed_texts(benchmark, id_col, text_col).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0]
    if size is None:
        return
    blocks = -(-size // BLOCK_BYTES)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    if blocks > 1:
        rows = written(rows, "benchmark")
    for number in range(blocks):
        part = rows.where(F.col("block") == number).select("item", "text").toArrow()
        yield list(zip(part["item"].to_pylist(), [t.encode() for t in part["text"].to_pylist()]))


_FOUND = "spans array<struct<start:long,end:long>>, matches array<struct<item_id:string,item_start:long,doc_start:long,words:long>>"


def _searched(rows: DataFrame, items: list[tuple[str, bytes]], window: int) -> DataFrame:
    """``doc_id, sha, n_words, spans, matches`` of every row for one block."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    several = "sha" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = make_block(shared.value, window)
        for held in batches_of(batches, SHARD_BYTES):
            words = [words_of(t) for b in held for t in texts(b)]
            found = contamination(words, block)
            whole = lambda name, held=held: pa.concat_arrays([b.column(name) for b in held])
            spans = [[{"start": a, "end": b} for a, b in f.spans] for f in found]
            matches = [[dict(zip(("item_id", "item_start", "doc_start", "words"), m)) for m in f.matches] for f in found]
            pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            match = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("words", pa.int64())]))
            columns = {"doc_id": whole("doc_id"), **({"sha": whole("sha")} if several else {})}
            columns |= {"n_words": pa.array([len(w) for w in words], pa.int64()), "spans": pa.array(spans, pair), "matches": pa.array(matches, match)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {'sha binary, ' if several else ''}n_words long, {_FOUND}")


def _merged(spans: Column) -> Column:
    """Stretches of hit words of several blocks as one list without overlaps."""

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (x["start"] <= F.try_element_at(done, F.lit(-1))["end"]), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.expr("cast(array() as array<struct<start:long,end:long>>)"), step)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, item_ids, spans, matches, longest, contaminated``.

    ``spans`` are the stretches of hit words as ``start:end``, of one item or of several
    that lie next to each other; ``matches`` has, for each item with a window in the
    document, the longest run of words both share and where it starts in the item and in
    the document (the first in the document, then in the item, of equally long ones);
    ``longest`` is the longest of them. Null and empty texts have no words. Items without
    words match nothing; a null item id reads as the empty string; rows that repeat an
    item id are one item. An empty benchmark leaves every document clean, an empty table
    has no rows; repeated rows and null ids are rows; other columns may have any name;
    texts may be of any length.
    """
    rows, searched = keyed_texts(docs, id_col, text_col), []
    blocks = benchmark_blocks(benchmark, item_col, item_text_col)
    first = next(blocks, [])
    second = next(blocks, None)
    if second is None:
        found = _searched(rows, first, window)
    else:
        rows = rows.withColumn("sha", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
        for block in itertools.chain([first, second], blocks):
            hits = _searched(rows, block, window)
            if not searched:  # of every document, the hits of the first block
                searched.append(written(hits, "searched"))
            else:
                searched.append(written(hits.where(F.size("spans") > 0), "searched"))
        found = _together(searched)
    item_ids = F.transform("matches", lambda m: m["item_id"])
    return found.select(
        "doc_id", "n_words", F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]), F.lit(0)).alias("n_hit"),
        F.size("matches").cast("long").alias("n_items"), item_ids.alias("item_ids"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"),
        "matches", F.coalesce(F.array_max(F.transform("matches", lambda m: m["words"])), F.lit(0)).alias("longest"), (F.size("matches") > 0).alias("contaminated"),
    )


def _together(searched: list[DataFrame]) -> DataFrame:
    """Hits of all blocks per document: rows with the same id and text have the same ones."""
    keys = F.struct("doc_id", "sha")
    more = searched[1].select(keys.alias("_k"), "spans", "matches").distinct()
    for part in searched[2:]:
        more = more.unionByName(part.select(keys.alias("_k"), "spans", "matches").distinct())
    grouped = written(more.groupBy("_k").agg(F.flatten(F.collect_list("spans")).alias("_s"), F.flatten(F.collect_list("matches")).alias("_m")), "grouped")
    met = searched[0].withColumn("_k", keys).join(grouped, "_k", "left")
    none = lambda c, like: F.coalesce(c, F.array().cast(like))
    kinds = {f.name: f.dataType for f in searched[0].schema}
    spans = F.concat("spans", none(F.col("_s"), kinds["spans"]))
    # an item whose rows lie in several blocks has a match of each: the longest, first one stays
    order = lambda m: F.struct(
        m["item_id"].alias("a"), (-m["words"]).alias("b"), m["doc_start"].alias("c"), m["item_start"].alias("d"), m.alias("m")
    )
    best = F.array_sort(F.transform(F.concat("matches", none(F.col("_m"), kinds["matches"])), order))

    def first(done: Column, x: Column) -> Column:
        known = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["item_id"] == x["m"]["item_id"])
        return F.when(known, done).otherwise(F.concat(done, F.array(x["m"])))

    firsts = F.aggregate(best, F.array().cast(kinds["matches"]), first)
    return met.select("doc_id", "n_words", _merged(spans).alias("spans"), firsts.alias("matches"))


def uncontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window occurs. Nothing is shuffled; beyond one block, each
    block's survivors are written before the next one is searched."""
    for number, items in enumerate(benchmark_blocks(benchmark, item_col, item_text_col)):
        docs = _clean(written(docs, "clean") if number else docs, items, text_col, window)
    return docs


def _clean(docs: DataFrame, items: list[tuple[str, bytes]], text_col: str, window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = make_block(shared.value, window)
        for held in batches_of(rows, SHARD_BYTES, text_col):
            found = contamination([words_of(t or b"") for b in held for t in texts(b, text_col)], block)
            at = 0
            for batch in held:
                yield batch.filter(pa.array([not f.items for f in found[at : at + batch.num_rows]], pa.bool_()))
                at += batch.num_rows

    return docs.mapInArrow(run, docs.schema)
