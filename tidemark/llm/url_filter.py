"""URL filters by Bloom filter cascades: exact membership of listed keys without a join.

A cascade is built over the complete universe of keys that the corpus can ask for. Its
first level is a Bloom filter of the listed keys; the second encodes the keys of the
universe that the first one lets through wrongly, the third the listed keys that the
second one catches, and so on, until a level makes no mistake. Every key of the
universe is then answered exactly. Every level hashes the key's text anew, so no two
keys can agree on all of them.

Rules are pairs of host and path: a rule fits its host and all subdomains if the url's
path starts with the rule's. A url therefore asks for one key per shape (length of
host, length of path) that occurs in the rules. Urls that no rule fits are judged by
a second list, of exact urls.

Filters are collected and broadcast, never keys. What one pass broadcasts is at most
``PASS_BYTES``: a list is cut by key hash into shards of at most ``SHARD_KEYS`` keys,
each with a cascade of its own, and passes over the narrow written rows follow one
another until every shard was asked.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Bytes of filters that one pass broadcasts.
PASS_BYTES = 64 << 20
#: Listed keys of one shard. A level takes at most 45 bits a key, so the first one takes 22 MB at most.
SHARD_KEYS = 4_000_000
#: Wrong answers of the levels behind the first.
LATER = 1 / 64

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = re.compile(rb"://([^/?#]*)([^?#]*)")

Level = tuple[int, int, int, np.ndarray]  # seed, hashes, bits, words


def split_url(url: bytes | None) -> tuple[bytes, bytes]:
    """Host in lower case and path; both empty without ``://``."""
    found = _URL.search(url) if url else None
    return (found[1].lower(), found[2]) if found else (b"", b"")


def rule_keys(host: bytes, path: bytes, shapes: Sequence[tuple[int, int]]) -> list[bytes]:
    """Keys of the rules that could fit, in the order of the shapes."""
    out = []
    for h, p in shapes:
        if h <= len(host) and p <= len(path) and (h == len(host) or host[len(host) - h - 1 : len(host) - h] == b"."):
            out.append(host[len(host) - h :] + path[:p])
    return out


def _places(keys: Sequence[bytes], seed: int, hashes: int, bits: int) -> np.ndarray:
    """Bit numbers, one row per key."""
    first = np.fromiter((xxhash.xxh64_intdigest(k, 2 * seed) for k in keys), np.uint64, len(keys))
    step = np.fromiter((xxhash.xxh64_intdigest(k, 2 * seed + 1) for k in keys), np.uint64, len(keys)) | np.uint64(1)
    return (first[:, None] + step[:, None] * np.arange(hashes, dtype=np.uint64)) % np.uint64(bits)


def passes(level: Level, keys: Sequence[bytes]) -> np.ndarray:
    """Whether a Bloom filter lets each key through."""
    seed, hashes, bits, words = level
    if not len(keys):
        return np.zeros(0, bool)
    at = _places(keys, seed, hashes, bits)
    return ((words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(1)


def members(levels: Sequence[Level], keys: Sequence[bytes]) -> np.ndarray:
    """Exact membership of keys of the universe: the first level that stops a key decides."""
    out = np.zeros(len(keys), bool)
    open_, rest = np.arange(len(keys)), list(keys)
    for number, level in enumerate(levels):
        through = passes(level, rest)
        out[open_[~through]] = number % 2 == 1
        open_, rest = open_[through], [k for k, t in zip(rest, through) if t]
    out[open_] = len(levels) % 2 == 1
    return out


def _encode(keys: DataFrame, count: int, wrong: float, seed: int) -> Level:
    """A Bloom filter of the keys, built in tasks: words are combined before and after the shuffle."""
    hashes = min(31, max(1, round(-math.log2(wrong))))
    bits = -(-math.ceil(count * hashes / math.log(2)) // 64) * 64

    def words(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = np.sort(_places(batch.column("key").to_pylist(), seed, hashes, bits).ravel())
            if not len(at):
                continue
            word, start = np.unique(at >> np.uint64(6), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), start)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(value.view(np.int64))], ["word", "bits"])

    table = keys.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    filled = np.zeros(bits // 64, np.uint64)
    filled[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return seed, hashes, bits, filled


def _let_through(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield batch.filter(pa.array(passes(shared.value, batch.column("key").to_pylist()), pa.bool_()))

    return keys.mapInArrow(run, "key binary")


def build_cascade(listed: DataFrame, universe: DataFrame, name: str = "cascade") -> list[Level]:
    """Levels for ``listed`` over ``universe``, two tables of distinct keys (``key`` binary).

    Listed keys outside the universe are allowed. The first level's share of wrong
    answers follows the sizes of both, so that about as many false positives as
    listed keys remain.
    """
    count, size = listed.count(), universe.count()
    levels: list[Level] = []
    inside, outside = listed, universe
    while count:
        wrong = LATER if levels else min(0.5, math.sqrt(0.5) * count / max(1, size))
        levels.append(_encode(inside, count, wrong, len(levels)))
        caught = _let_through(outside, levels[-1])
        if len(levels) == 1:
            caught = caught.join(listed, "key", "left_anti")
        inside, outside = written(caught, f"{name}_{len(levels)}"), inside
        count = inside.count()
    return levels


def _shards(listed: DataFrame, universe: DataFrame, name: str) -> list[list[Level]]:
    """Cascades of the shards of a list; shard ``i`` of ``n`` holds the keys whose hash is ``i`` modulo ``n``."""
    listed = written(listed.distinct(), f"{name}_listed")
    parts = max(1, -(-listed.count() // SHARD_KEYS))
    if parts == 1:
        return [build_cascade(listed, universe, name)]
    own = lambda df, i: df.where(F.pmod(F.crc32("key"), F.lit(parts)) == i)
    return [build_cascade(own(listed, i), own(universe, i), f"{name}_{i}") for i in range(parts)]


def _universe(urls: DataFrame, shapes: Sequence[tuple[int, int]]) -> DataFrame:
    """Every key the urls can ask for: ``exact`` or of a rule."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keys: dict[tuple[bool, bytes], None] = {}
            for url in batch.column("url").cast(pa.binary()).to_pylist():
                host, path = split_url(url)
                keys[True, host + path] = None
                keys.update(((False, k), None) for k in rule_keys(host, path, shapes))
            yield pa.RecordBatch.from_arrays(
                [pa.array([e for e, _ in keys], pa.bool_()), pa.array([k for _, k in keys], pa.binary())], ["exact", "key"]
            )

    return urls.select("url").mapInArrow(run, "exact boolean, key binary").distinct()


def _ask(rows: DataFrame, filters: list[tuple[str, int, int, list[Level]]], shapes: Sequence[tuple[int, int]]) -> DataFrame:
    """One pass: keys found in these filters (list, shard, shards, levels) are added to what is known of each row."""
    shared = rows.sparkSession.sparkContext.broadcast(filters)

    def found(keys: list[bytes], kind: str) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        for name, shard, shards, levels in shared.value:
            if name == kind:
                mine = np.fromiter((shards == 1 or zlib.crc32(k) % shards == shard for k in keys), bool, len(keys))
                at = np.flatnonzero(mine)
                out[at] |= members(levels, [keys[i] for i in at])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch.column("url").cast(pa.binary()).to_pylist()]
            keys = [rule_keys(h, p, shapes) for h, p in parts]
            owner = [i for i, own in enumerate(keys) for _ in own]
            flat = [k for own in keys for k in own]
            exact = [h + p for h, p in parts]
            allow, block, listed = found(flat, "allow"), found(flat, "block"), found(exact, "listed")
            # rank of the best rule so far: keys come in the order of precedence, so the first one found wins
            place = batch.column("place").to_pylist()
            rule = batch.column("rule").cast(pa.binary()).to_pylist()
            verdict = batch.column("ruled").to_pylist()
            start = np.cumsum([0, *map(len, keys)])
            for n in np.flatnonzero(allow | block):
                i, rank = owner[n], int(n - start[owner[n]])
                if place[i] is None or rank < place[i]:
                    place[i], rule[i], verdict[i] = rank, flat[n], "block" if block[n] else "allow"
                elif rank == place[i] and block[n]:
                    verdict[i] = "block"
            known = np.array(batch.column("listed").to_pylist(), bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("url"), pa.array(place, pa.int32()), pa.array(rule, pa.binary()),
                    pa.array(verdict, pa.string()), pa.array(known | listed, pa.bool_()),
                ],
                ["id", "url", "place", "rule", "ruled", "listed"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, url binary, place int, rule binary, ruled string, listed boolean")


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, ``host``, ``path``, ``rule`` (key of the rule that decides) and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block), ``listed`` a ``key`` (host and path as text) of
    each blocked url. The longest rule that fits decides; of equally long ones that with the longer host; a key that is
    both allowed and blocked is blocked. Without a rule a url is blocked if it is listed and allowed otherwise.

    A null url and one without ``://`` have an empty host and path, which only rules with both empty fit. Null ids and
    repeated rows are rows like any other; other columns are left out and may have any name; rules and keys that are
    null are no rules. Empty tables give no rows, empty lists let everything pass. Long urls cost one key per shape.
    """
    keyed = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("binary").alias("url"))
    rules = rules.select("host", "path", "verdict").dropna().select(
        F.translate("host", _UPPER, _UPPER.lower()).cast("binary").alias("h"), F.col("path").cast("binary").alias("p"), "verdict"
    )
    found = rules.select(F.length("h").alias("h"), F.length("p").alias("p")).distinct().collect()
    shapes = sorted(((r["h"], r["p"]) for r in found), key=lambda s: (-s[0] - s[1], -s[0]))
    universe = written(_universe(keyed, shapes), "universe")
    asked, urls = universe.where("not exact").select("key"), universe.where("exact").select("key")
    lists = {
        verdict: (rules.where(F.col("verdict") == verdict).select(F.concat("h", "p").alias("key")), asked)
        for verdict in ("allow", "block")
    }
    lists["listed"] = (listed.select(F.col("key").cast("binary").alias("key")).dropna(), urls)
    filters = [
        (name, i, len(cascades), levels)
        for name, (keys, over) in lists.items()
        for cascades in [_shards(keys, over, name)]
        for i, levels in enumerate(cascades)
    ]
    rows = keyed.select(
        "id", "url", F.lit(None).cast("int").alias("place"), F.lit(None).cast("binary").alias("rule"),
        F.lit(None).cast("string").alias("ruled"), F.lit(False).alias("listed"),
    )
    for number, group in enumerate(_passes(filters)):
        rows = _ask(written(rows, f"pass_{number}") if number else rows, group, shapes)
    host, path = url_parts(F.col("url"))
    return rows.select(
        F.col("id").alias(id_col), host.alias("host"), path.alias("path"), F.col("rule").cast("string").alias("rule"),
        F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url column, as ``split_url`` gives them."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, "://([^/?#]*)", 1), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(text, "://[^/?#]*([^?#]*)", 1)


def _passes(filters: list) -> list[list]:
    """Filters grouped so that a group's bytes stay within a pass; a single shard always fits."""
    groups: list[list] = [[]]
    held = 0
    for entry in filters:
        size = sum(level[3].nbytes for level in entry[3])
        if held + size > PASS_BYTES and groups[-1]:
            groups.append([])
            held = 0
        groups[-1].append(entry)
        held += size
    return groups
