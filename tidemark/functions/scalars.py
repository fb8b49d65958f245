"""Scalar functions as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a boolean in source data.
TRUE_WORDS = ("true", "t", "yes", "y", "1")
FALSE_WORDS = ("false", "f", "no", "n", "0")

# Metric types delivered as whole numbers and as floats.
INTEGER_METRICS = ("TYPE_INTEGER", "TYPE_MILLISECONDS")
FLOAT_METRICS = (
    "TYPE_FLOAT",
    "TYPE_CURRENCY",
    "TYPE_SECONDS",
    "TYPE_MINUTES",
    "TYPE_HOURS",
    "TYPE_FEET",
    "TYPE_MILES",
    "TYPE_METERS",
    "TYPE_KILOMETERS",
    "TYPE_STANDARD",
)

# What counts as an email address and what takes its place.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
EMAIL_PLACEHOLDER = "redacted@example.com"
SECRET_PLACEHOLDER = "***REDACTED***"
# Header names whose value never leaves the source, of requests and of responses.
REQUEST_HEADERS = ("authorization", "proxy-authorization", "cookie", "set-cookie", "x-api-key")
RESPONSE_HEADERS = (
    "set-cookie", "x-oauth-scopes", "x-accepted-oauth-scopes", "github-authentication-token-expiration", "x-github-token",
)
SECRET_HEADERS = tuple(dict.fromkeys(REQUEST_HEADERS + RESPONSE_HEADERS))
_ISO_TEXT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def _interval(seconds: int | Column) -> Column:
    secs = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def epoch_ms_to_ts(c: Column) -> Column:
    """Epoch milliseconds (number or text) to timestamp; garbage is null."""
    return F.timestamp_millis(c.cast("string").try_cast("bigint"))


def odata_date(c: Column) -> Column:
    """``/Date(ms)/`` or ``/Date(ms+off)/`` to ISO seconds in UTC, other text unchanged."""
    ms = F.regexp_extract(c, r"^/Date\((-?\d+)([+-]\d{4})?\)/", 1)
    ts = F.timestamp_millis(F.nullif(ms, F.lit("")).try_cast("bigint"))
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), c)


def yyyymmdd(c: Column) -> Column:
    """Eight digits to ISO date text; anything else is null."""
    dashed = F.regexp_replace(c, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.when(c.rlike(r"^\d{8}$"), F.date_format(dashed.try_cast("date"), "yyyy-MM-dd"))


def shift_day(c: Column, days: int, floor: str = "1900-01-01") -> Column:
    """ISO date text moved by ``days``, never below ``floor``."""
    day = c.try_cast("date")
    moved = F.greatest(F.date_add(day, days), F.lit(floor).cast("date"))
    return F.date_format(F.when(day.isNotNull(), moved), "yyyy-MM-dd")


def parse_ts_any(c: Column) -> Column:
    """ISO text with or without zone, or a bare date, as an instant; else null."""
    return F.when(c.rlike(_ISO_TEXT), F.translate(c, ",", ".").try_cast("timestamp"))


def relative_time(c: Column, now: Column) -> Column:
    """``*``, ``*-10m``, ``*-2h``, ``*-7d`` or ISO text; anything else is ``now``."""
    text = F.trim(c)
    amount = F.regexp_extract(text, r"^\*-(\d+)([mhd])$", 1).try_cast("int")
    unit = F.regexp_extract(text, r"^\*-(\d+)([mhd])$", 2)
    scale = F.when(unit == "m", 60).when(unit == "h", 3600).when(unit == "d", 86400)
    return F.coalesce(now - _interval(amount * scale), parse_ts_any(text), now)


def apply_lookback(c: Column, seconds: int) -> Column:
    return c - _interval(seconds)


def window_end(since: Column, seconds: int, cap: Column) -> Column:
    return F.least(since + _interval(seconds), cap)


def time_range(
    stored: Column,
    option: Column,
    now: Column,
    lookback_seconds: int,
    window_seconds: int = 0,
) -> tuple[Column, Column]:
    """Read range: stored offset, else the option, else look back from ``now``.

    Both ends are capped at ``now``; a window bounds the length of the range.
    """
    start = F.least(F.coalesce(stored, option, now - _interval(lookback_seconds)), now)
    if window_seconds > 0:
        return start, F.least(start + _interval(window_seconds), now)
    return start, now


def as_bool(c: Column, default: bool | None = None) -> Column:
    """Known spellings of a boolean; any other text is the default."""
    word = F.lower(F.trim(c.cast("string")))
    return (
        F.when(word.isin(*TRUE_WORDS), F.lit(True))
        .when(word.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(default))
    )


def try_double(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def try_long(c: Column) -> Column:
    """Whole numbers only: text with a decimal point is null."""
    return F.trim(c.cast("string")).try_cast("bigint")


def metric_value(value: Column, kind: Column) -> tuple[Column, Column, Column]:
    """A reported metric by its declared type: (integer, float, text), one of them set."""
    given = F.nullif(value, F.lit(""))
    whole = F.when(kind.isin(*INTEGER_METRICS), try_long(given))
    real = F.when(kind.isin(*FLOAT_METRICS), try_double(given))
    text = F.when(kind.isNull() | ~kind.isin(*INTEGER_METRICS, *FLOAT_METRICS), given)
    return whole, real, text


#: Where a word begins inside a name: a capital after a small letter or digit, or the last capital of several before a small letter.
WORD_START = r"(?<=[a-z0-9])(?=[A-Z])|(?<=.)(?=[A-Z][a-z])"


def snake_case(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, WORD_START, "_"))


def sanitize_name(c: Column, index: Column) -> Column:
    kept = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"[^a-zA-Z0-9]+", "_")
    bare = F.regexp_replace(kept, r"^_+|_+$", "")
    return F.when(bare == "", F.concat(F.lit("_col"), index.cast("string"))).otherwise(bare)


def redact_email(c: Column, placeholder: str = EMAIL_PLACEHOLDER) -> Column:
    return F.regexp_replace(c, EMAIL, placeholder)


def redact_secret(name: Column, value: Column, placeholder: str = SECRET_PLACEHOLDER) -> Column:
    return F.when(F.lower(name).isin(*SECRET_HEADERS), F.lit(placeholder)).otherwise(value)


def decode_binary(c: Column) -> Column:
    """Text to bytes: base64 if its letters form whole groups, else hex, else UTF-8."""
    letters = F.regexp_replace(c, r"[^A-Za-z0-9+/=]", "")
    bare = F.rtrim(letters, F.lit("="))
    whole = (
        (F.pmod(F.length(letters), F.lit(4)) == 0)
        & (F.length(letters) - F.length(bare) <= 2)
        & ~F.contains(bare, F.lit("="))
    )
    packed = F.regexp_replace(c, r"\s", "")
    hexed = F.when((F.length(packed) > 0) & (F.pmod(F.length(packed), F.lit(2)) == 0), F.unhex(packed))
    return F.when(whole, F.unbase64(letters)).otherwise(F.coalesce(hexed, F.encode(c, "UTF-8")))


def csv_list(c: Column) -> Column:
    """Comma text to trimmed, non-empty items."""
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


def text_list(c: Column) -> Column:
    """A JSON array of text, or plain text as a one-item array."""
    parsed = F.from_json(c, "array<string>")
    plain = F.when(F.trim(c) == "", F.array().cast("array<string>")).otherwise(F.array(F.trim(c)))
    listed = F.when(F.trim(c).startswith("["), F.coalesce(parsed, plain)).otherwise(plain)
    return F.when(c.isNotNull(), listed)


def person_name(c: Column) -> Column:
    """First non-empty of the three writings of a person name struct."""
    parts = [F.nullif(c[p], F.lit("")) for p in ("Alphabetic", "Ideographic", "Phonetic")]
    return F.coalesce(*parts)


def valid_uid(c: Column) -> Column:
    return c.rlike(r"^[0-9.]+$") & ~F.contains(c, F.lit(".."))


def record_fingerprint(*cols: Column) -> Column:
    """SHA-256 over the text of the columns; null and empty text stay apart."""
    marked = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~")) for c in cols]
    return F.sha2(F.concat_ws("\u001f", *marked), 256)


def json_or_null(c: Column) -> Column:
    return F.to_json(c)


def preview(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def safe_path(c: Column, *keys: str, kind: str = "string") -> Column:
    """Value at a path of a JSON text column; null where any step is missing."""
    path = "$" + "".join(f"[{k}]" if k.isdigit() else f".{k}" for k in keys)
    if kind == "string":
        return F.get_json_object(c, path)
    return F.get_json_object(c, path).try_cast(kind)
