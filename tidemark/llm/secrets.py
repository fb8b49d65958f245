"""Secret scans: fixed patterns, and character Markov models for what they miss.

Two first-order Markov models over characters are learned, one from random
strings (the values the patterns found) and one from ordinary words of the same
texts. A long run of token characters is reported when its log-likelihood under
the first exceeds that under the second by a margin. All steps are Spark SQL
functions, aggregates, windows and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import drawn, keyed_texts, written

#: The patterns of the base rule, as listed; the second number is the group whose length counts.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
#: Base kinds in the order of the digest: pattern, group that is measured, its least length.
BASE = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32))

#: Characters of the models; any other is one more.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: A run that may be a secret: this many token characters.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: An ordinary word of the training sample: too short to be such a run.
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9_]{4,19}+(?![A-Za-z0-9+/_=-])"
#: Documents and found values the models are fitted on at most (expected numbers): picked by a hash of id and text.
SAMPLE_DOCS, SAMPLE_VALUES = 5_000, 20_000
#: Log-likelihood ratio (nats) per character pair, and in all, from which a run is a secret.
MARGIN_EACH, MARGIN_ALL = 0.5, 10.0
#: Counts that a character's own share weighs beside those of its pairs.
BACKOFF = 10.0


def _found(text: Column, pattern: str, group: int) -> Column:
    """Gaps before the matches of a text, their lengths, and the measured group's text."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(matches, lambda x: F.length(x)).alias("size"),
        (matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias("value"),
    )
    none = F.expr("cast(array() as array<struct<gap:int,size:int,value:string>>)")
    return F.when(F.regexp_like(text, F.lit(pattern)), parts).otherwise(none)


def _spans(found: DataFrame) -> DataFrame:
    """``row, kind, place, start, stop, value``: offsets are running sums of gaps and lengths in a text."""
    kinds = [*(k for k, *_ in BASE), "markov"]
    each = found.select(
        "row", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(i).alias("place"), F.col(k).alias("found")) for i, k in enumerate(kinds)])).alias("k")
    ).where(F.size("k.found") > 0)
    rows = each.select("row", "k.kind", "k.place", F.posexplode("k.found").alias("at", "x"))
    before = Window.partitionBy("row", "kind").orderBy("at")
    stop = F.sum(F.coalesce("x.gap", F.lit(0)) + F.coalesce("x.size", F.lit(0))).over(before)
    return rows.select(
        "row", "kind", "place", (stop - F.coalesce("x.size", F.lit(0))).alias("start"), stop.alias("stop"), F.col("x.value").alias("value")
    ).where("value is not null")


def _free(runs: DataFrame, base: DataFrame) -> DataFrame:
    """Runs that overlap no base span of their text: both are ordered by their start, and the
    largest end of the base spans that begin before a run's end is looked at."""
    both = runs.select("row", "start", "stop", "value", F.lit(1).alias("late"), F.col("stop").alias("edge")).unionByName(
        base.select("row", "start", "stop", "value", F.lit(0).alias("late"), (F.col("start") + 1).alias("edge"))
    )
    upto = Window.partitionBy("row").orderBy("edge", "late").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("late") == 0, F.col("stop"))).over(upto)
    return both.withColumn("reach", reach).where("late = 1 and coalesce(reach, 0) <= start").select("row", "start", "stop", "value")


def _pairs(values: DataFrame) -> DataFrame:
    """``id, a, b`` for each pair of neighbouring characters of ``v``, which is cut into characters once."""
    cut = F.split("v", "")
    pair = F.arrays_zip(cut.alias("a"), F.slice(cut, 2, F.length("v")).alias("b"))
    each = values.where(F.length("v") >= 2).select("id", F.explode(pair).alias("p")).where("p.b is not null")
    return each.select("id", F.expr(f"instr('{ALPHABET}', p.a)").alias("a"), F.expr(f"instr('{ALPHABET}', p.b)").alias("b"))


def train(random: DataFrame, ordinary: DataFrame) -> DataFrame:
    """``a, b, ratio`` for every pair of characters: log of its probability under both models.

    ``random`` and ``ordinary`` have a column ``v``. A pair's share among its first
    character's pairs is smoothed by the second character's own share, and that by
    half a count. The table has at most
    ``(len(ALPHABET) + 1) ** 2`` rows.
    """
    size = len(ALPHABET) + 1
    every = random.sparkSession.range(size * size).select(
        F.expr(f"cast(id div {size} as int)").alias("a"), F.expr(f"cast(id % {size} as int)").alias("b")
    )
    counts = _pairs(random.select(F.lit(1).alias("id"), "v")).unionByName(_pairs(ordinary.select(F.lit(0).alias("id"), "v")))
    seen = counts.groupBy("a", "b").agg(F.sum("id").cast("double").alias("r"), F.sum(1 - F.col("id")).cast("double").alias("o"))
    count = lambda k: F.coalesce(F.col(k), F.lit(0.0))
    after, of, all_ = Window.partitionBy("a"), Window.partitionBy("b"), F.lit(0.5 * size)

    def share(k: str) -> Column:
        alone = (F.sum(count(k)).over(of) + 0.5) / (F.col(f"n{k}") + all_)
        return (count(k) + BACKOFF * alone) / (F.sum(count(k)).over(after) + BACKOFF)

    total = seen.agg(F.coalesce(F.sum("r"), F.lit(0.0)).alias("nr"), F.coalesce(F.sum("o"), F.lit(0.0)).alias("no")).first()
    paired = every.join(seen, ["a", "b"], "left").withColumns({"nr": F.lit(total.nr), "no": F.lit(total.no)})
    return paired.select("a", "b", F.ln(share("r") / share("o")).alias("ratio"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans``.

    Offsets are code points, the end exclusive; a span covers the whole match. Base
    matches are leftmost and do not overlap within a kind; the models add runs that
    touch no base span. Null and empty texts have no spans, and the digest of the
    empty string. Repeated rows give equal results, other columns are left out and may
    have any name, and an empty table gives no rows. Without any base match nothing
    is learned and nothing added; else the models are fitted on about ``SAMPLE_DOCS``
    documents and ``SAMPLE_VALUES`` found values, and applied to every run of every
    text. The work grows in proportion to a text's length, also within one run.
    """
    rows = keyed_texts(docs, id_col, text_col)
    text = F.col("text")
    found = written(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id",
            *[_found(text, pattern, group).alias(kind) for kind, pattern, group, _ in BASE],
            _found(text, RUN, 0).alias("markov"),
        ),
        "found",
    )
    spans = written(_spans(found), "spans")
    long = F.lit(False)
    for kind, _, _, least in BASE:
        long |= (F.col("kind") == kind) & (F.length("value") >= least)
    base = spans.where(long)

    values = base.select(F.col("value").alias("v")).distinct()
    values = drawn(values, values.count(), SAMPLE_VALUES, "v")
    chosen = drawn(rows, found.count(), SAMPLE_DOCS, "doc_id", "text")
    plain = text
    for _, pattern, _, _ in BASE:
        plain = F.regexp_replace(plain, pattern, " ")
    words = chosen.select(F.explode(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))).alias("v")).distinct()
    # without values there is nothing to compare with
    model = written(train(values, words) if not values.isEmpty() else train(values, values), "model")

    runs = spans.where("kind = 'markov'")
    free = _free(runs, base)
    ratios = _pairs(free.select(F.struct("row", "start", "stop").alias("id"), F.col("value").alias("v"))).join(model, ["a", "b"])
    likely = ratios.groupBy("id").agg(F.sum("ratio").alias("all"), F.avg("ratio").alias("each")).where(
        (F.col("all") >= MARGIN_ALL) & (F.col("each") >= MARGIN_EACH)
    )
    added = likely.select(
        "id.row", F.lit("markov").alias("kind"), F.lit(len(BASE)).alias("place"), "id.start", "id.stop"
    )
    every = base.select("row", "kind", "place", "start", "stop").unionByName(added)
    entry = F.struct("start", "place", F.concat_ws(":", "kind", "start", "stop").alias("span"))
    joined = lambda c: F.concat_ws(",", F.transform(F.array_sort(c), lambda x: x["span"]))
    per_row = every.groupBy("row").agg(
        *[F.sum((F.col("kind") == k).cast("long")).alias(f"n_{k}") for k in [*(k for k, *_ in BASE), "markov"]],
        joined(F.collect_list(F.when(F.col("kind") != "markov", entry))).alias("base"),
        joined(F.collect_list(entry)).alias("spans"),
    )
    zero = F.lit(0).cast("long")
    return found.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in [*(k for k, *_ in BASE), "markov"]],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
