"""URL filters, conversation repair and embedding whitening against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.oracle import compare
from tidemark.llm import queries, turns, url_filter, whitening

# url filter


def test_url_query(spark, sf_dir, duck):
    assert not compare(queries.QUERIES["op11_url_filter"](spark, sf_dir), duck, queries.ORACLES["op11_url_filter"])


def _judge(url, rules, listed):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("#")[0].split("?")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[3], max(fits)[4]
    return host, path, None, "block" if host + path in listed else "allow"


ODD_URLS = [
    None, "", "://", "no scheme", "http://", "http://COM/", "http://example.com", "http://example.com?x=/en/", "http://Www.Example.COM/en/1#a://b/c",
    "http://xexample.com/en/", "http://example.com./en/", "x://a.net/es/?q", "x://net/es/", "x://.net/fr/a", "a://b://c/d", "x://é.net/fr/É", "x://a.b/\nen/",
    "http://" + "a." * 3000 + "com/" + "p" * 5000, "x://listed.org/a?b", "x://listed.org/a/", "x://both.org/x", "x://both.org/x",
]
ODD_RULES = [*queries.URL_RULES, ("both.org", "/x", "allow"), ("both.org", "/x", "block"), ("org", "", "allow"), ("Org", "/a/", "block"), ("é.net", "/fr/", "allow")]


@pytest.mark.parametrize("small", [False, True])
def test_odd_urls(spark, monkeypatch, small):
    if small:  # many shards, each a pass of its own
        monkeypatch.setattr(url_filter, "SHARD_KEYS", 1)
        monkeypatch.setattr(url_filter, "PASS_BYTES", 1)
    pages = spark.createDataFrame([(i if i != 3 else None, u, u, "z") for i, u in enumerate(ODD_URLS)], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame([*ODD_RULES, (None, "/", "allow"), ("com", None, "block")], "host string, path string, verdict string")
    listed = spark.createDataFrame([("listed.org/a",), ("gone.org/",), (None,), ("listed.org/a",)], "key string")
    found = rows(url_filter.filter_urls(pages, rules, listed))
    lower = [(h.lower(), p, v) for h, p, v in ODD_RULES]
    assert found == sorted([(i if i != 3 else None, *_judge(u, lower, {"listed.org/a"})) for i, u in enumerate(ODD_URLS)], key=repr)


def test_empty_lists_and_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    keys = spark.createDataFrame([], "key string")
    assert rows(url_filter.filter_urls(pages, none, keys)) == [(1, "a.com", "/x", None, "allow")]
    assert rows(url_filter.filter_urls(pages.limit(0), none, keys)) == []


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "LATER", 0.5)
    universe = spark.range(20000).select(F.concat(F.lit("k"), "id").cast("binary").alias("key"))
    listed = spark.range(7000).select(F.concat(F.lit("k"), F.col("id") * 4).cast("binary").alias("key"))
    levels = url_filter.build_cascade(listed, universe)
    assert len(levels) > 4
    keys = [f"k{i}".encode() for i in range(20000)]
    assert url_filter.members(levels, keys).tolist() == [i % 4 == 0 for i in range(20000)]
    assert url_filter.members([], keys[:3]).tolist() == [False] * 3


# conversation repair


@lru_cache(None)
def _least(codes: str) -> tuple[int, str]:
    """Cheapest cost and least audit by a walk over turn and state of the grammar."""
    after = {"S": "a", "A": "a", "U": "a", "a": "U"}

    @lru_cache(None)
    def go(i, state, inserts):
        ways = [(0, "")] if i == len(codes) and state in "SU" else []
        if inserts < 3:
            cost, rest = go(i, after[state], inserts + 1)
            ways.append((cost + 2, "I" + rest))
        if i < len(codes):
            cost, rest = go(i + 1, state, 0)
            ways.append((cost + 3, "D" + rest))
            if codes[i] != "-":
                kind, extra, due = codes[i].lower(), int(codes[i].isupper()), "a" if state == "a" else "u"
                cost, rest = go(i + 1, after[state], 0)
                ways.append((cost + extra + 2 * (kind != due), ("K" if kind == due else "R") + rest))
                if state == "S" and kind == "s":
                    cost, rest = go(i + 1, "A", 0)
                    ways.append((cost + extra, "K" + rest))
        return min(ways, default=(10**9, ""))

    for i in range(len(codes), -1, -1):  # from the end, so that no call goes deep
        for state in "SAUa":
            go(i, state, 0)
    return go(0, "S", 0)


def test_repair_is_cheapest_and_least():
    for n in range(4):
        for codes in map("".join, itertools.product("uasoUAS-", repeat=n)):
            assert turns.repair(codes) == _least(codes), codes
    draw = random.Random(5)
    for _ in range(400):
        letters = draw.choice(["uasoUASO-", "ua", "uaUA", "uuas-", "s", "sU", "uauauauas-A"])
        codes = "".join(draw.choice(letters) for _ in range(draw.randint(0, 40)))
        assert turns.repair(codes, draw.choice([1, 2, 3, 7, 256])) == _least(codes), codes


def test_long_conversations_are_cut_into_blocks():
    draw = random.Random(6)
    codes = "s" + "".join("ua"[i % 2] if draw.random() < 0.8 else draw.choice("-uaUAo") for i in range(700))
    assert turns.repair(codes) == turns.repair(codes, 701) == _least(codes)
    assert turns.repair("u" * 5000)[0] == 5000


def _conversations(data):
    """The contract, step by step, of (conv_id, turn, role, text) rows."""
    white = set(" \t\n\x0b\x0c\r")
    text_of = lambda v: " " if v is None else str(v)
    out = {}
    for conv, turn, role, text in data:
        held = out.setdefault(conv, [])
        fate = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        role, text = text_of(role), text_of(text)
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        held += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    result = []
    for conv, held in out.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, codes, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in held:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            solid = [c for c in text if c not in white]
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            codes += "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        known = [t for t, *_ in held if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(held, held[1:])]
        cost, audit = _least(codes)
        size, place, lines, left = len(audit) - audit.count("D"), 0, [], iter(held)
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter == "D":
                continue
            due = ("user", "assistant")[(place - size % 2) % 2]
            lines.append(f"{due}:" if letter == "I" else f"{row[1] if letter == 'K' else due}:{row[2]}")
            place += 1
        assert next(left, None) is None
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        result.append((conv, gaps, *counts.values(), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha))
    return sorted(result, key=repr)


def test_conversations_of_the_table(spark, sf_dir):
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(queries.QUERIES["op12_turns"](spark, sf_dir)) == _conversations(data)


def test_odd_conversations(spark):
    draw = random.Random(7)
    texts = [None, "", " ", "\n", "Same.", "Same", "x" * 100000 + "!", "é?  \t", "one. two", "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "USER"]
    data = [(draw.choice([None, 1, 2, 3, 4]), draw.choice([None, *range(-3, 60)]), draw.choice(roles), draw.choice(texts)) for _ in range(400)]
    data += [(9, t, ("user", "assistant")[t % 2], "Fine.") for t in range(700)] + [(10, 7, "user", "Again.")] * 3
    data += [(c, 0, "system", "Lone.") for c in range(20, 80)]
    frame = spark.createDataFrame([(*r, "k", 1) for r in data], "conv_id long, turn long, role string, text string, key string, copies int")
    assert rows(turns.repair_conversations(frame.repartition(5))) == _conversations(data)
    assert turns.repair_conversations(frame.limit(0)).collect() == []


def test_undamaged_conversations_stay(spark):
    frame = spark.createDataFrame([("c", 1, "system", "S."), ("c", 2, "user", "Q?"), ("c", 3, "assistant", "A.")], "conv_id string, turn int, role string, text string")
    sha = hashlib.sha256(b"system:S.\nuser:Q?\nassistant:A.").hexdigest()
    assert rows(turns.repair_conversations(frame, damage=False)) == [("c", 0, 0, 0, 0, 0, 0, "KKK", sha)]


# embedding whitening


def _whitened(data, top=8):
    """Expected rows by exact integers and a dense solver; signs are left to the caller."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in data]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    keep = [k for k in np.argsort(-values)[:top] if values[k] > 1e-9 * values.max()]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return n, deviation, centred @ vectors[:, keep] / np.sqrt(values[keep]), values[keep] / np.trace(covariance)


def _same(found, data):
    n, deviation, white, explained = _whitened(data)
    count = white.shape[1]
    at = {i: k for k, (i, _) in enumerate(data)}
    assert len(found) == len(data) * count and {r["n"] for r in found} == {n}
    assert all(r["deviation"] == deviation[at[r["vec_id"]]] for r in found)
    mine = np.zeros_like(white)
    for r in found:
        mine[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert math.isclose(r["explained"], explained[r["component"] - 1], rel_tol=1e-9)
        assert r["identity_error"] <= 1e-9
    sign = np.sign((mine * white).sum(0))
    assert np.abs(mine * sign - white).max() < 1e-6


def test_whitening_of_the_table(spark, sf_dir):
    data = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    _same(queries.QUERIES["op13_whitening"](spark, sf_dir).collect(), data)


def test_odd_vectors(spark):
    draw = np.random.default_rng(3)
    good = [(i, (draw.standard_normal(3) * [1, 5, 0.2] + [3, 0, -900]).tolist()) for i in range(50)]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [1.0, float("nan"), 2.0]), (93, [float("inf"), 0.0, 0.0]), (94, []), (95, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 5, 0.5) for i, v in good + bad], "vec_id long, embedding array<double>, v int, n double")
    found = whitening.whiten(frame.repartition(7)).collect()
    assert {r["component"] for r in found} == {1, 2, 3}
    _same(found, good)
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(frame.limit(0)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0])], schema)).collect() == []
    twice = spark.createDataFrame([(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [0.0, 2.0])], schema)
    assert [(r["vec_id"], r["component"], r["n"], round(abs(r["whitened"]), 6)) for r in whitening.whiten(twice).orderBy("vec_id").collect()] == [
        (None, 1, 3, 1.414214), (1, 1, 3, 0.707107), (1, 1, 3, 0.707107)
    ]


def test_sums_stay_exact_beyond_a_long(spark):
    frame = spark.createDataFrame([(1, [1e18, 1.0]), (2, [-1e18, 2.0]), (3, [5e17, 4.0])], "vec_id long, embedding array<double>")
    found = whitening.whiten(frame, top=1).collect()
    assert len(found) == 3 and all(r["deviation"] is None for r in found)
    assert whitening.exact_sums(whitening.usable(frame), 2)[0] == sum(math.floor(1024 * int(c)) + 100000 for c in (10**18, -(10**18), 5 * 10**17))


def test_contour_finds_every_component():
    draw = np.random.default_rng(4)
    for size, top in ((1, 8), (6, 8), (64, 8), (40, 3)):
        a = draw.standard_normal((200, size)) * 10.0 ** np.linspace(-2, 2, size)
        matrix = a.T @ a / 200
        values, vectors = whitening.components_of(matrix, top)
        expected = np.linalg.eigvalsh(matrix)[::-1][:top]
        assert np.allclose(values, expected, rtol=1e-10) and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-10)
    values, vectors = whitening.components_of(np.diag([5.0] * 10 + [1.0, 0.0]), 8)
    assert np.allclose(values, 5) and np.allclose(vectors.T @ vectors, np.eye(8))
    for _ in range(50):
        a = draw.standard_normal((9, 9))
        assert whitening.inertia_above(a + a.T, 0.3) == (np.linalg.eigvalsh(a + a.T) > 0.3).sum()
