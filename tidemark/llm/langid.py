"""Language identification by a byte convolutional network.

A text is cut into windows of fixed length that cover it wholly. Bytes are
embedded; filters of several widths run over a window; the largest answer of
each filter is kept, and a softmax turns them into language probabilities. The
windows of a text are averaged by their letters. Everything is numpy; Spark deals out the
texts, and only sampled windows come to the driver for training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, keyed_texts, texts

#: Bytes of a window, filter widths, filters of each width, size of a byte's embedding.
WINDOW, WIDTHS, FILTERS, EMBEDDING = 192, (2, 3, 4), 6, 8
#: Documents per language to learn from (expected number), and windows of each of them.
SAMPLE, SAMPLE_WINDOWS = 700, 3
#: Label of a text without a letter.
UNDETERMINED = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LOWER[[*range(0x09, 0x0E)]] = 0x20
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]] = True


def windows(text: bytes) -> np.ndarray:
    """All windows of a text, the last one filled up with zeros."""
    codes = _LOWER[np.frombuffer(text, np.uint8)]
    rows = -(-len(codes) // WINDOW)
    out = np.zeros((rows, WINDOW), np.uint8)
    out.reshape(-1)[: len(codes)] = codes
    return out


@dataclass
class ByteNet:
    """Weights: byte embeddings, filters per width, and the softmax layer."""

    langs: list[str]
    embed: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # width x EMBEDDING x FILTERS
    bias: np.ndarray
    out: np.ndarray  # filters x langs
    out_bias: np.ndarray

    def filtered(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Per width, the answer of each filter at each place of each window."""
        for width, f in zip(WIDTHS, self.filters):
            span, total = WINDOW - width + 1, None
            for k in range(width):
                # a filter's part at one place depends on one byte: a table of 256 rows
                part = (self.embed @ f[k]).astype(np.float32)[x[:, k : k + span]]
                total = part if total is None else np.add(total, part, out=total)
            yield total

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of each filter in each window, and where it is."""
        each = [(t.argmax(1), t) for t in self.filtered(x)]
        best = [np.take_along_axis(t, at[:, None, :], 1)[:, 0] for at, t in each]
        return np.concatenate(best, 1) + self.bias, np.concatenate([at for at, _ in each], 1)

    def answers(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities of each window."""
        if not self.langs:
            return np.zeros((len(x), 0), np.float32)
        done = [np.zeros((0, len(self.langs)), np.float32)]
        for at in range(0, len(x), 64):  # a piece stays in the cache
            largest = np.concatenate([t.max(1) for t in self.filtered(x[at : at + 64])], 1)
            hidden = np.maximum(largest + self.bias, 0)
            logits = hidden @ self.out + self.out_bias
            e = np.exp(logits - logits.max(1, keepdims=True))
            done.append(e / e.sum(1, keepdims=True))
        return np.concatenate(done)


def learn(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = 6, batch: int = 128, seed: int = 3) -> ByteNet:
    """Cross-entropy by Adam over the sampled windows; the same rows give the same net."""
    rng = np.random.default_rng(seed)
    cells = FILTERS * len(WIDTHS)
    net = ByteNet(
        langs, rng.normal(0, 0.5, (256, EMBEDDING)), [rng.normal(0, 0.3, (w, EMBEDDING, FILTERS)) for w in WIDTHS],
        np.zeros(cells), rng.normal(0, 0.3, (cells, len(langs))), np.zeros(len(langs)),
    )
    params = [net.embed, *net.filters, net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs if len(x) and len(langs) > 1 else 0):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows, want = x[order[at : at + batch]], y[order[at : at + batch]]
            raw, where = net.pooled(rows)
            hidden = np.maximum(raw, 0)
            logits = hidden @ net.out + net.out_bias
            e = np.exp(logits - logits.max(1, keepdims=True))
            d = e / e.sum(1, keepdims=True)
            d[np.arange(len(want)), want] -= 1
            d /= len(want)
            back = (d @ net.out.T) * (raw > 0)
            slopes = [np.zeros_like(net.embed)]
            for j, width in enumerate(WIDTHS):
                cols = slice(j * FILTERS, (j + 1) * FILTERS)
                slope = np.zeros_like(net.filters[j])
                for k in range(width):
                    # only the place of the largest answer passes a slope on
                    seen = np.take_along_axis(rows, where[:, cols] + k, 1)
                    slope[k] = np.einsum("nf,nfe->ef", back[:, cols], net.embed[seen])
                    np.add.at(slopes[0], seen, back[:, cols][:, :, None] * net.filters[j][k].T[None])
                slopes.append(slope)
            slopes += [back.sum(0), hidden.T @ d, d.sum(0)]
            step += 1
            for p, g, a, b in zip(params, slopes, first, second):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= 0.01 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    net.out, net.out_bias, net.bias = (p.astype(np.float32) for p in (net.out, net.out_bias, net.bias))
    return net


def identify(found: list[bytes], net: ByteNet) -> tuple[list[str], list[float]]:
    """Language and score of each text, over all of its windows."""
    langs, scores = [UNDETERMINED] * len(found), [0.0] * len(found)
    at = 0
    while at < len(found):
        # some texts at a time, by size
        end, size = at, 0
        while end < len(found) and (end == at or size < 4_000_000):
            size += len(found[end])
            end += 1
        parts = [windows(t) for t in found[at:end]]
        x = np.concatenate(parts)
        given = net.answers(x) * (1e-3 + _LETTER[x].sum(1, keepdims=True, dtype=np.float32))
        ends = np.cumsum([len(p) for p in parts])
        for k, (t, p) in enumerate(zip(found[at:end], parts)):
            if any(map(str.isalpha, t.decode())) and net.langs:
                total = given[ends[k] - len(p) : ends[k]].sum(0, dtype=np.float64)
                best = int(np.argmax(total))
                langs[at + k], scores[at + k] = net.langs[best], float(min(1.0, total[best] / total.sum()))
        at = end
    return langs, scores


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteNet:
    """Learn from the labelled documents outside fold 0.

    A hash of the id picks about ``SAMPLE`` documents of each language and each gives
    ``SAMPLE_WINDOWS`` windows spread over its whole text: the driver holds that many
    windows per language, whatever the input. Null languages and texts are left out.
    """
    known = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    )
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), 5) != 0))
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return learn(np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), [])
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, SAMPLE / sizes[k]))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    chosen = known.where(draw < share[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, lang = [], []
            for label, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                every = windows(text)
                picked = np.unique(np.linspace(0, len(every) - 1, SAMPLE_WINDOWS).astype(int)) if len(every) else []
                out += [every[k].tobytes() for k in picked]
                lang += [label] * len(picked)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(out, pa.binary())], ["lang", "x"])

    got = sorted((r.lang, bytes(r.x)) for r in chosen.mapInArrow(run, "lang string, x binary").collect())
    x = np.frombuffer(b"".join(b for _, b in got), np.uint8).reshape(-1, WINDOW)
    place = {k: i for i, k in enumerate(langs)}
    return learn(x, np.array([place[k] for k, _ in got], np.int64), langs)


def predict(docs: DataFrame, net: ByteNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = identify(texts(batch), net)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = keyed_texts(docs, id_col, text_col).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from ``lang_col`` and predict the language of every whole text.

    A null text or one without a letter is ``und`` with score 0; so is every text
    when nothing is labelled. With one language all others get it. Equal
    probabilities go to the language that sorts first.
    """
    return predict(docs, train(docs, id_col, text_col, lang_col), id_col, text_col)
