"""The contract queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, exact_dedup, html_text, langid, licenses, lm, quality, secrets, simhash, turns, url_filter, whitening
from tidemark.llm.common import ready


def vocabulary() -> str:
    """Path of the tokenizer definition the encoding query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence of every document, laid out as files of its source.

    Each tenth document is a licence file: in turn of its own folder, of the folder above and
    of the source.
    """
    docs = _table(spark, folder, "documents")
    outer, inner = F.expr("doc_id div 1000").cast("string"), F.expr("doc_id div 100 % 10").cast("string")
    given, up = F.col("doc_id") % 10 == 0, F.expr("doc_id div 10 % 3")
    path = F.concat_ws(
        "/", "source", F.when(~given | (up < 2), outer), F.when(~given | (up < 1), inner),
        F.when(given, F.concat(F.lit("LICENSE."), F.col("doc_id").cast("string"))).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))),
    )
    return licenses.license_scan(docs.select(path.alias("path"), "text"))


def op2_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log-bilinear score of every document."""
    return lm.lm_scores(_table(spark, folder, "documents"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Exact duplicates of every document."""
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.encode_documents(_table(spark, folder, "documents"), vocabulary())


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    return langid.languages(_table(spark, folder, "documents"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document."""
    found = decontaminate.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated", "spans", "longest",
    )


def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.main_text(_table(spark, folder, "pages"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.secret_spans(_table(spark, folder, "documents"))


#: The rules of the url filter's contract.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Pages that name a host of this farm are listed.
SPAM_HOST = "spam-farm."


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's url; where no rule fits, urls of pages that name a spam farm are blocked."""
    pages = _table(spark, folder, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    host, path = url_filter.url_parts(F.col("url"))
    listed = pages.where(F.contains("html", F.lit(SPAM_HOST))).select(F.concat(host, path).alias("key")).where("key <> ''")
    return url_filter.filter_urls(pages, rules, listed)


def op12_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Repair of every damaged conversation."""
    return turns.repair_conversations(_table(spark, folder, "conversations"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Eight whitened components of every embedding."""
    return whitening.whiten(_table(spark, folder, "embeddings"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_licenses, op2_lm_scores, op3_quality, op4_exact_dedup, op5_bpe, op6_language, op7_decontaminate, op8_main_text,
        op9_simhash, op10_secrets, op11_url_filter, op12_turns, op13_whitening, pipeline,
    )
}

_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

_quoted = lambda x: "'" + x.replace("'", "''") + "'"
_TEMPLATES = ", ".join(f"({i}, {_quoted(n)}, {_quoted(x)})" for i, (n, x) in enumerate(licenses.TEMPLATES))

ORACLES: dict[str, str] = {
    "op1_licenses": rf"""
        WITH t(id, license, text) AS (VALUES {_TEMPLATES}),
        f AS (
            SELECT source || CASE WHEN doc_id % 10 = 0 AND doc_id // 10 % 3 = 2 THEN '' ELSE '/' || (doc_id // 1000) END
                   || CASE WHEN doc_id % 10 = 0 AND doc_id // 10 % 3 > 0 THEN '' ELSE '/' || (doc_id // 100 % 10) END || '/' || CASE WHEN doc_id % 10 = 0 THEN 'LICENSE.' || doc_id ELSE doc_id || '.txt' END AS path, lower(coalesce(text, '')) AS low
            FROM documents
        ),
        files AS (
            SELECT path, low, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir,
                   regexp_matches(regexp_extract(path, '([^/]*)$', 1), '(?i)^(licen[sc]e|copying|unlicense)([.\-_].*)?$') AS lic
            FROM f
        ),
        tw AS (SELECT id, license, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM t),
        df AS (
            SELECT w, count(*) AS n FROM (SELECT DISTINCT path, unnest(regexp_extract_all(low, '[a-z0-9]+')) AS w FROM f) GROUP BY w
        ),
        idf AS (
            SELECT w, ln((1 + (SELECT count(*) FROM f)) / (1 + coalesce(n, 0))) + 1 AS idf
            FROM (SELECT w FROM df UNION SELECT w FROM tw) LEFT JOIN df USING (w)
        ),
        tv AS (
            SELECT id, license, w, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS wt
            FROM (SELECT id, license, w, count(*) * any_value(idf) AS v FROM tw JOIN idf USING (w) GROUP BY id, license, w)
        ),
        units AS (
            SELECT path, row_number() OVER () AS u, x FROM (
                SELECT path, unnest(string_split(low, chr(10))) AS x FROM files
                UNION ALL SELECT path, x FROM (SELECT path, unnest(string_split_regex(low, '\n[\x20\x09\x0D]*\n')) AS x FROM files)
                          WHERE contains(x, chr(10))
                UNION ALL SELECT path, low FROM files WHERE lic)
        ),
        terms AS (
            SELECT path, u, w, count(*) * any_value(idf) AS v
            FROM (SELECT path, u, unnest(regexp_extract_all(x, '[a-z0-9]+')) AS w FROM units) JOIN idf USING (w) GROUP BY path, u, w
        ),
        norms AS (SELECT path, u, sqrt(sum(v * v)) AS n FROM terms GROUP BY path, u),
        scores AS (
            SELECT path, license, round(sum(v * wt) / any_value(n), 9) AS s
            FROM terms JOIN tv USING (w) JOIN norms USING (path, u) GROUP BY path, u, id, license
        ),
        own AS (
            SELECT path, license, s FROM scores WHERE s >= {licenses.CUT}
            QUALIFY row_number() OVER (PARTITION BY path ORDER BY s DESC, license) = 1
        ),
        homes AS (
            SELECT dir, license, s FROM files JOIN own USING (path) WHERE lic
            QUALIFY row_number() OVER (PARTITION BY dir ORDER BY s DESC, license, path) = 1
        ),
        near AS (
            SELECT a.path, h.dir AS home, h.license, h.s FROM files a JOIN homes h ON a.dir = h.dir OR starts_with(a.dir, h.dir || '/')
            WHERE a.path NOT IN (SELECT path FROM own)
            QUALIFY row_number() OVER (PARTITION BY a.path ORDER BY length(h.dir) DESC) = 1
        )
        SELECT files.path, coalesce(own.license, near.license) AS license, round(coalesce(own.s, near.s), 6) AS score,
               CASE WHEN own.path IS NOT NULL THEN 'own' WHEN near.path IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
               near.home AS source_dir
        FROM files LEFT JOIN own USING (path) LEFT JOIN near USING (path)""",
    "op4_exact_dedup": r"""
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM (
            SELECT doc_id, sha256(norm) AS text_sha256, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
                   count(*) OVER (PARTITION BY norm) AS group_size
            FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        )""",
    "op7_decontaminate": f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, row_number() OVER () AS k, {_WORDS} AS w FROM benchmark),
        win AS (
            SELECT item_id, k, n, i AS p, array_to_string(w[i:i + n - 1], ' ') AS s
            FROM (SELECT item_id, k, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
                  FROM b WHERE len(w) > 0)
        ),
        places AS (
            SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
        ),
        met AS (SELECT r, n, i, item_id, k, p FROM places JOIN win USING (n, s)),
        along AS (SELECT r, k, i - p AS d, i - row_number() OVER (PARTITION BY r, k, i - p ORDER BY i) AS g, any_value(n) OVER (PARTITION BY k) AS n FROM met),
        best AS (SELECT r, max(c) AS longest FROM (SELECT r, count(*) + any_value(n) - 1 AS c FROM along GROUP BY r, k, d, g) GROUP BY r),
        hits AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + n)) AS p FROM met)),
        runs AS (
            SELECT r, min(p) - 1 AS a, max(p) AS z
            FROM (SELECT r, p, p - row_number() OVER (PARTITION BY r ORDER BY p) AS g FROM hits) GROUP BY r, g
        ),
        spans AS (
            SELECT r, sum(z - a)::BIGINT AS n_hit,
                   string_agg(a || ':' || z, ',' ORDER BY a) AS spans
            FROM runs GROUP BY r
        ),
        items AS (
            SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM met) GROUP BY r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
               coalesce(spans, '') AS spans, coalesce(longest, 0) AS longest
        FROM d LEFT JOIN spans USING (r) LEFT JOIN items USING (r) LEFT JOIN best USING (r)""",
    "op11_url_filter": f"""
        WITH u AS (
            SELECT page_id, html,
                   translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
            FROM pages
        ),
        rules(h, p, v) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
        fits AS (
            SELECT DISTINCT host, path, h || p AS rule, v FROM (SELECT DISTINCT host, path FROM u), rules
            WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
            QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC) = 1
        ),
        listed AS (SELECT DISTINCT host || path AS key FROM u WHERE contains(html, '{SPAM_HOST}') AND host || path <> '')
        SELECT page_id, host, path, rule, coalesce(v, CASE WHEN key IS NULL THEN 'allow' ELSE 'block' END) AS verdict
        FROM u LEFT JOIN fits USING (host, path) LEFT JOIN listed ON key = host || path""",
}
