"""Language-model scores by a log-bilinear model trained with noise-contrastive estimation.

Every word belongs to a unit: frequent words are units of their own, all others
share the unit of their ending. The model predicts a token's unit from the two
units before it, ``softmax(Q (c1 * R[u1] + c2 * R[u2]) + b)``, and a word within
a shared unit by its count. Both parts are normalised, so probabilities of all
tokens sum to one.

Counts come from all training texts. Training starts on the driver from a
bounded sample; then every task goes over all training texts of its partition by
noise-contrastive estimation, and the weights of the tasks are averaged. Scoring
computes a context's normaliser once, by a batched matrix product over all units.
Counts of frequent words (a bounded number) go to the tasks; those of the rest are
joined by Spark.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, drawn, fold, keyed_texts, texts, written

#: Frequent words with a unit of their own, shared units, size of an embedding.
UNITS, SHARED, SIZE = 1024, 512, 24
#: Frequent words whose counts go to every task, and the longest such word in bytes: at most 8 MB.
HEAD, HEAD_BYTES = 131_072, 48
#: Distinct words a counting task holds before it hands them on.
HELD_WORDS = 300_000
#: Documents (expected number) and rounds of the start on the driver.
START_DOCS, START_ROUNDS = 2_000, 2
#: Noise words of a batch, tokens of a batch, and parts in which weights travel.
NOISE, BATCH, PARTS = 64, 4096, 16


def shared_unit(word: bytes) -> int:
    """The unit of an infrequent word: by its last two bytes and whether it is long."""
    return UNITS + 1 + (word[-1] * 31 + word[-2:][0] * 7 + (len(word) > 7)) % SHARED


#: Unit of the end of a text; the start of a text is a context only.
END, STARTS, ALL = UNITS, UNITS + 1 + SHARED, UNITS + 1 + SHARED


@dataclass
class Weights:
    """Context and target embeddings, the two context weights and the biases."""

    context: np.ndarray  # ALL + 1 (start) x SIZE
    target: np.ndarray  # ALL x SIZE
    mix: np.ndarray  # 2 x SIZE
    bias: np.ndarray  # ALL

    def flat(self) -> np.ndarray:
        return np.concatenate([self.context.ravel(), self.target.ravel(), self.mix.ravel(), self.bias]).astype(np.float32)

    @staticmethod
    def of(flat: np.ndarray) -> Weights:
        a, b, c = (ALL + 1) * SIZE, (2 * ALL + 1) * SIZE, (2 * ALL + 3) * SIZE
        return Weights(
            flat[:a].reshape(-1, SIZE).copy(), flat[a:b].reshape(-1, SIZE).copy(), flat[b:c].reshape(2, SIZE).copy(), flat[c:].copy()
        )

    @staticmethod
    def fresh(noise: np.ndarray) -> Weights:
        rng = np.random.default_rng(5)
        draw = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
        return Weights(draw(ALL + 1, SIZE), draw(ALL, SIZE), np.ones((2, SIZE), np.float32), np.log(noise).astype(np.float32))


def contexts(units: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Targets of several texts and the one and two units before each."""
    if not units:
        return (np.zeros(0, np.int64),) * 3
    pad = np.full(2, STARTS, np.int64)
    line = np.concatenate([x for u in units for x in (pad, u)])
    keep = np.ones(len(line), bool)
    at = np.cumsum([0, *(len(u) + 2 for u in units[:-1])])
    keep[at] = keep[at + 1] = False
    places = np.flatnonzero(keep)
    return line[places], line[places - 1], line[places - 2]


@dataclass
class Trainer:
    """Noise-contrastive estimation by Adagrad over batches of tokens."""

    weights: Weights
    noise: np.ndarray  # probability of each unit
    rate: float
    seed: int
    tokens: int = 0
    rows: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.rng = np.random.default_rng(self.seed)
        self.steps = np.cumsum(self.noise)
        self.level = np.log(NOISE * self.noise).astype(np.float32)
        for name in ("context", "target", "mix", "bias"):
            self.rows[name] = np.full_like(getattr(self.weights, name), 1.0)

    def _move(self, name: str, at: np.ndarray, slope: np.ndarray) -> None:
        """Add up the slopes of equal rows, then take an Adagrad step."""
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        total, rows = np.add.reduceat(slope[order], first, axis=0), at[first]
        seen = self.rows[name]
        seen[rows] += total * total
        getattr(self.weights, name)[rows] -= self.rate * total / np.sqrt(seen[rows])

    def step(self, want: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        w = self.weights
        c1, c2 = w.context[one], w.context[two]
        h = c1 * w.mix[0] + c2 * w.mix[1]
        drawn = np.minimum(np.searchsorted(self.steps, self.rng.random(NOISE)), len(self.noise) - 1)
        own, other = w.target[want], w.target[drawn]
        g = 1 / (1 + np.exp(-np.clip((h * own).sum(1) + w.bias[want] - self.level[want], -30, 30))) - 1
        n = 1 / (1 + np.exp(-np.clip(h @ other.T + w.bias[drawn] - self.level[drawn], -30, 30)))
        back = g[:, None] * own + n @ other
        mix = np.stack([(back * c1).sum(0), (back * c2).sum(0)])
        self._move("target", np.concatenate([want, drawn]), np.concatenate([g[:, None] * h, n.T @ h]))
        self._move("bias", np.concatenate([want, drawn]), np.concatenate([g, n.sum(0)]))
        self._move("context", np.concatenate([one, two]), np.concatenate([back * w.mix[0], back * w.mix[1]]))
        self._move("mix", np.arange(2), mix)
        self.tokens += len(want)

    def learn(self, units: list[np.ndarray]) -> None:
        want, one, two = contexts(units)
        for at in range(0, len(want), BATCH):
            self.step(want[at : at + BATCH], one[at : at + BATCH], two[at : at + BATCH])


class Normaliser:
    """log sum over all units for each context, worked out once."""

    def __init__(self, weights: Weights) -> None:
        self.weights = weights
        self.known = np.full((ALL + 1) * (ALL + 1), np.nan, np.float32)

    def log_probs(self, want: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural log of each unit's probability after its context."""
        w, key = self.weights, one * (ALL + 1) + two
        new = np.unique(key[np.isnan(self.known[key])])
        for at in range(0, len(new), 2048):
            some = new[at : at + 2048]
            h = w.context[some // (ALL + 1)] * w.mix[0] + w.context[some % (ALL + 1)] * w.mix[1]
            logits = h @ w.target.T + w.bias
            top = logits.max(1)
            self.known[some] = np.log(np.exp(logits - top[:, None]).sum(1)) + top
        out = np.empty(len(want))
        for at in range(0, len(want), 65536):
            cut = slice(at, at + 65536)
            h = w.context[one[cut]] * w.mix[0] + w.context[two[cut]] * w.mix[1]
            out[cut] = (h * w.target[want[cut]]).sum(1) + w.bias[want[cut]] - self.known[key[cut]]
        return out


def word_counts(rows: DataFrame) -> DataFrame:
    """``word binary, n`` over all rows' texts. Tasks count first, so a frequent word is one row per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in texts(batch):
                for word in text.lower().split():
                    held[word] = held.get(word, 0) + 1
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return rows.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Tables:
    """What every task needs: bounded tables of the frequent words and of the units."""

    place: dict[bytes, int]  # frequent word: its place
    counts: np.ndarray  # of the frequent words
    tokens: int
    distinct: int
    ends: int
    shared: np.ndarray  # tokens + distinct words + 1 of each shared unit

    def __post_init__(self) -> None:
        words = list(self.place)
        own = [i if i < UNITS else shared_unit(w) for i, w in enumerate(words)]
        self.unit = np.array(own, np.int64)
        self.log_count = np.log10(self.counts + 1.0)
        self.inside = np.zeros(ALL)
        self.inside[UNITS + 1 :] = np.log10(self.shared)
        # what a frequent word adds to the probability of its unit
        self.part = np.where(self.unit > UNITS, self.log_count - self.inside[self.unit], 0.0)
        self.base = float(np.log10(self.tokens + self.distinct + 1))

    def noise(self) -> np.ndarray:
        n = np.ones(ALL)
        np.add.at(n, self.unit[:UNITS], self.counts[:UNITS])
        n[END] += self.ends
        n[UNITS + 1 :] += self.shared
        return n / n.sum()

    def units(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Units of a text with its end, places of its frequent words (-1: none), and its other words."""
        get = self.place.get
        at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        rest = [words[i] for i in np.flatnonzero(at < 0).tolist()]
        units = np.empty(len(words) + 1, np.int64)
        units[-1] = END
        units[:-1] = self.unit[at] if len(self.unit) else 0
        units[:-1][at < 0] = [shared_unit(w) for w in rest]
        return units, at, rest


def _tables(counts: DataFrame, documents: int) -> Tables:
    size = F.length("word")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    short, step = counts.where(size <= HEAD_BYTES), F.floor(F.log2("n") * 8)
    # words by eighths of an octave of their count: all above one step are frequent, HEAD at most
    steps = sorted(short.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("v")).collect(), key=lambda r: -r.s)
    least, room = None, HEAD
    for r in steps:
        room -= r.v
        if room < 0:
            break
        least = r.s
    top = short.where(step >= least).collect() if least is not None else []
    top.sort(key=lambda r: (-r.n, bytes(r.word)))
    place = {bytes(r.word): i for i, r in enumerate(top)}
    last = lambda k: F.conv(F.hex(F.substring("word", k, 1)), 16, 10).cast("int")
    ending = F.pmod(last(-1) * 31 + F.when(size > 1, last(-2)).otherwise(last(-1)) * 7 + (size > 7).cast("int"), F.lit(SHARED))
    shared = np.ones(SHARED)
    for r in counts.groupBy(ending.alias("k")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        shared[r.k] += r.n + r.v
    for i, r in enumerate(top[:UNITS]):  # these have units of their own
        shared[shared_unit(bytes(r.word)) - UNITS - 1] -= r.n + 1
    return Tables(
        place, np.array([r.n for r in top], float), int(total.n) + documents, int(total.v) + (documents > 0), documents, shared
    )


def _refine(rows: DataFrame, tables, start, rate: float) -> np.ndarray | None:
    """Weights after every task went over its texts once, averaged by tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = tables.value, TaskContext.get().partitionId()
        trainer = Trainer(Weights.of(start.value), known.noise(), rate, part)
        for held in batches_of(batches, 4_000_000):
            trainer.learn([known.units(t.lower().split())[0] for b in held for t in texts(b)])
        if trainer.tokens:
            flat = np.array_split(trainer.weights.flat(), PARTS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * PARTS, pa.int64()), pa.array(range(PARTS), pa.int32()),
                    pa.array([float(trainer.tokens)] * PARTS), pa.array(flat, pa.list_(pa.float32())),
                ],
                ["task", "part", "tokens", "w"],
            )

    def mean(group):
        weight = group["tokens"].to_numpy()
        group = group.iloc[:1].assign(w=[np.average(np.stack(group["w"].to_list()), axis=0, weights=weight)], tokens=weight.sum())
        return group[["task", "part", "tokens", "w"]]

    schema = "task long, part int, tokens double, w array<float>"
    sums = rows.select("text").mapInArrow(run, schema).withColumn("task", F.expr("task div 64"))
    # groups of at most 64 tasks, then one weight vector of each group
    once = sums.groupBy("part", "task").applyInPandas(mean, schema)
    got = once.groupBy("part").applyInPandas(mean, schema).collect()
    return np.concatenate([np.array(r.w, np.float32) for r in sorted(got, key=lambda r: r.part)]) if got else None


_NORMALISERS: dict[str, Normaliser] = {}


def _normaliser(tag: str, weights) -> Normaliser:
    """The worker's normaliser of this model; contexts it has worked out serve later tasks."""
    if tag not in _NORMALISERS:
        _NORMALISERS.clear()
        _NORMALISERS[tag] = Normaliser(Weights.of(weights.value))
    return _NORMALISERS[tag]


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from the rows outside fold 2 of 7. Null and empty texts have
    one token, their end. Repeated rows count each time they occur. Without any
    training row no word is known and all units are equally likely at first.
    """
    rows = keyed_texts(docs, id_col, text_col).withColumn("held_out", fold(F.col("doc_id"), 7) == 2)
    training = rows.where(~F.col("held_out"))
    counts = written(word_counts(training), "counts")
    tables = _tables(counts, training.count())
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(tables)

    some_rows = drawn(training, tables.ends, START_DOCS, "doc_id", "text")
    weights = Weights.fresh(tables.noise())
    units: list[np.ndarray] = []

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [shared.value.units(t.lower().split())[0].astype(np.int16).tobytes() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], ["units"])

    for r in sorted(bytes(x.units) for x in some_rows.select("text").mapInArrow(sampled, "units binary").collect()):
        units.append(np.frombuffer(r, np.int16).astype(np.int64))
    trainer = Trainer(weights, tables.noise(), 0.1, 1)
    for _ in range(START_ROUNDS):
        order = trainer.rng.permutation(len(units))
        for at in range(0, len(order), 64):
            trainer.learn([units[i] for i in order[at : at + 64]])
    start = context.broadcast(weights.flat())
    refined = _refine(training, shared, start, 0.05)
    final, tag = context.broadcast(start.value if refined is None else refined), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = shared.value, TaskContext.get().partitionId() << 33
        normaliser = _normaliser(tag, final)
        for batch in batches:
            found = [known.units(t.lower().split()) for t in texts(batch)]
            logs = normaliser.log_probs(*contexts([u for u, _, _ in found])) / np.log(10)
            ends = np.cumsum([len(u) for u, _, _ in found])
            out = {"row": [], "n_tokens": [], "n_known": [], "base": [], "model": [], "words": [], "times": []}
            for (u, at, rest), end in zip(found, ends.tolist()):
                often, tail = at[at >= 0], {}
                for w in rest:
                    tail[w] = tail.get(w, 0) + 1
                out["row"].append(row)
                row += 1
                out["n_tokens"].append(len(u))
                out["n_known"].append(len(often) + (known.ends > 0))
                # the end counts like any token; what other words add comes by the join
                out["base"].append(float(known.log_count[often].sum() + np.log10(known.ends + 1.0) - known.base * len(u)))
                inside = known.inside[u[:-1][at < 0]].sum() if rest else 0.0
                out["model"].append(float(logs[end - len(u) : end].sum() + known.part[often].sum() - inside))
                out["words"].append(list(tail))
                out["times"].append(list(tail.values()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *(pa.array(v, k) for v, k in zip(out.values(), kinds))],
                ["doc_id", "held_out", *out],
            )

    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, row long, n_tokens long, n_known long, "
        "base double, model double, words array<binary>, times array<bigint>"
    )
    scored = written(rows.mapInArrow(run, schema), "scored")
    rest = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", "x.words", "x.times")
    seen = rest.join(counts.select(F.col("word").alias("words"), "n"), "words")
    tail = seen.groupBy("row").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs")
    )
    more = F.coalesce("logs", F.lit(0.0))
    return scored.drop("words", "times").join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(tables.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
