"""Document quality by Bradley-Terry ranking.

A document's score is a linear function of features of its whole text. The
weights come from preference pairs: a document labelled good should beat one
labelled bad, and the logistic loss of the difference of their scores is made
small. The line between good and bad is a quantile of the training scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drawn, fold, keyed_texts, texts

#: Labelled rows that are learned from (expected number): picked by a hash of the id.
SAMPLE = 20_000
#: Preference pairs of one pass, and passes.
PAIRS, PASSES = 50_000, 30
#: A document counts as good from this score on.
CUT = 0.3

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_MARKS = {c: ord(c) for c in ".,!?*#$%&|@=<>_{}\"'():;/-+"}


def features(text: bytes) -> list[float]:
    """Shape of a text: shares of kinds of bytes, word and line statistics, repetition."""
    codes = np.frombuffer(text, np.uint8)
    n = len(codes)
    counts = np.bincount(codes, minlength=256) if n else np.zeros(256, np.int64)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    w, distinct, low = len(words), len(set(words)), len(set(text.lower().split()))
    share = lambda mask: float(counts[mask].sum()) / max(1, n)
    lengths = np.fromiter(map(len, words), np.int64, w) if w else np.zeros(1)
    loud = sum(map(bytes.isupper, words))
    odd = n - counts[_LETTER].sum() - counts[_DIGIT].sum() - counts[_BLANK].sum()
    halves = len({tuple(words[k : k + 3]) for k in range(0, w - 2, 3)}) if w >= 3 else 0
    return [
        np.log1p(n),
        np.log1p(w),
        share(_LETTER), share(_UPPER), share(_DIGIT), share(_BLANK),
        float(odd) / max(1, n),
        float(odd) / max(1, w),
        float(lengths.mean()), float(lengths.std()), np.log1p(float(lengths.max())),
        distinct / max(1, w), low / max(1, w),
        np.log1p(w) * distinct / max(1, w),
        loud / max(1, w),
        len(set(lines)) / max(1, len(lines)),
        w / max(1, len(lines)),
        np.log1p(len(lines)),
        halves / max(1, w // 3),
        float(w == 0), float(w < 5), float(w < 20),
        *(float(counts[c]) / max(1, w) for c in _MARKS.values()),
        *(float(counts[c] > 0) for c in _MARKS.values()),
    ]


@dataclass
class Ranking:
    """Weights over standardised features, and the line to a score of 0 to 1."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    shift: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(rows) + self.shift, -40, 40)))


def learn(rows: np.ndarray, good: np.ndarray, cut: float = CUT, seed: int = 7) -> Ranking:
    """Bradley-Terry weights from pairs of a good and a bad row, then the score line.

    The cut in raw scores is the quantile of the training scores at which most rows
    fall on their own side; the score is ``cut`` there. With one class only, every
    score is 1 for good, 0 for bad and ``cut`` without any row.
    """
    width = rows.shape[1]
    if not len(rows) or good.all() or not good.any():
        level = np.log(cut / (1 - cut)) if not len(rows) else 40.0 if good.all() else -40.0
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0, level)
    mean, scale = rows.mean(0), rows.std(0) + 1e-6
    x = np.clip((rows - mean) / scale, -8, 8)
    best, worst = np.flatnonzero(good), np.flatnonzero(~good)
    rng = np.random.default_rng(seed)
    weights, first, second = np.zeros(width), np.zeros(width), np.zeros(width)
    for step in range(1, PASSES * 10 + 1):
        d = x[rng.choice(best, PAIRS // 10)] - x[rng.choice(worst, PAIRS // 10)]
        gain = 1 / (1 + np.exp(np.clip(d @ weights, -40, 40)))
        slope = -(gain @ d) / len(d) + 1e-3 * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weights -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    raw = x @ weights
    levels = np.quantile(raw, np.linspace(0, 1, 401))
    right = [np.mean((raw >= v) == good) for v in levels]
    line = levels[int(np.argmax(right))]
    below = raw[raw < line]
    line = (line + below.max()) / 2 if len(below) else line
    spread = float(raw[good].mean() - raw[~good].mean())
    steep = 4 / max(spread, 1e-6)
    return Ranking(mean, scale, weights, steep, float(np.log(cut / (1 - cut)) - steep * line))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Ranking:
    """Learn from the labelled documents outside fold 0.

    About ``SAMPLE`` labelled ids are used, picked by hash; only their features
    come to the driver. An id that is labelled several times counts as good if
    most of its labels are 1; null ids and labels are left out.
    """
    usable = (
        labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .where((F.col("doc_id").isNotNull()) & F.col("quality").isNotNull() & (fold(F.col("doc_id"), 5) != 0))
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    )
    chosen = drawn(usable, usable.count(), SAMPLE, "doc_id")
    # bounded by SAMPLE ids
    rows = keyed_texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("good", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(found, pa.list_(pa.float64()))], ["good", "x"])

    got = rows.mapInArrow(run, "good boolean, x array<double>").collect()
    got = sorted((bool(r.good), tuple(r.x)) for r in got)
    x = np.array([r[1] for r in got], float).reshape(len(got), len(features(b"")))
    return learn(x, np.array([r[0] for r in got], bool))


def score(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``; null text reads as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = model.scores(np.array([features(t) for t in texts(batch)], float))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= CUT).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    rows = keyed_texts(docs, id_col, text_col).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from ``labels`` and score every document by its text alone.

    Without usable labels every score is the cut and every document stays.
    """
    return score(docs, train(docs, labels, id_col, text_col), id_col, text_col)


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least the cut. Nothing is shuffled."""
    model = train(docs, labels, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = model.scores(np.array([features(t or b"") for t in texts(batch, text_col)], float))
                yield batch.filter(pa.array(found >= CUT))

    return docs.mapInArrow(run, docs.schema)
