"""Typed projection of raw values.

Raw data arrives as text (or JSON text for nested values).  Each target type
has one native expression; a value that does not fit becomes null and is
either reported in an error column or raised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S

ERRORS = "_coerce_errors"
# Accepted date layouts besides ISO, each with its ISO rewriting.
DATE_LAYOUTS = (
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$2-$1"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3"),
)
TIMESTAMP_LAYOUT = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2}) (\d{1,2}:\d{1,2}:\d{1,2})$"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_COMPLEX = (T.StructType, T.ArrayType, T.MapType)


def _text_to_long(c: Column) -> Column:
    # text without a point must be a plain integer; with a point it is truncated
    text = F.trim(c)
    return F.when(F.contains(text, F.lit(".")), text.try_cast("double").try_cast("bigint")).otherwise(
        text.try_cast("bigint")
    )


def to_boolean(c: Column) -> Column:
    """Known spellings first, then truthiness: any other non-empty text is true."""
    word = F.lower(c.cast("string"))
    return (
        F.when(word.isin(*S.TRUE_WORDS), F.lit(True))
        .when(word.isin(*S.FALSE_WORDS), F.lit(False))
        .when(word.isNotNull(), F.length(word) > 0)
    )


def to_date(c: Column) -> Column:
    """Known layouts by rewriting to ISO: nothing is parsed by trial and error."""
    text = c
    for layout, iso in DATE_LAYOUTS:
        text = F.regexp_replace(text, layout, iso)
    day = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))
    return F.coalesce(day, S.parse_ts_any(c).cast("date"))


def to_timestamp(c: Column) -> Column:
    other = F.when(c.rlike(TIMESTAMP_LAYOUT), F.regexp_replace(c, TIMESTAMP_LAYOUT, "$1-$2-$3 $4").try_cast("timestamp"))
    return F.coalesce(S.parse_ts_any(c), other)


def coerce_scalar(c: Column, source: T.DataType, target: T.DataType) -> Column:
    if source == target:
        return c
    if isinstance(target, T.StringType):
        return F.to_json(c) if isinstance(source, _COMPLEX) else c.cast("string")
    if isinstance(target, (T.IntegerType, T.LongType)):
        if isinstance(source, _NUMERIC):
            return c.try_cast(target)
        return _text_to_long(c.cast("string")).try_cast(target)
    if isinstance(target, (T.FloatType, T.DoubleType, T.DecimalType)):
        return c.try_cast(target)
    if isinstance(target, T.BooleanType):
        return c != 0 if isinstance(source, _NUMERIC) else to_boolean(c)
    if isinstance(target, T.DateType):
        return to_date(c) if isinstance(source, T.StringType) else c.cast("date")
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(source, _NUMERIC):
            return F.timestamp_micros((c * 1000000).cast("bigint")).cast(target)
        return (to_timestamp(c) if isinstance(source, T.StringType) else c).cast(target)
    if isinstance(target, T.BinaryType):
        return S.decode_binary(c) if isinstance(source, T.StringType) else F.encode(c.cast("string"), "UTF-8")
    if isinstance(target, T.VariantType):
        return F.try_parse_json(c) if isinstance(source, T.StringType) else F.to_variant_object(c)
    raise TypeError(f"no coercion to {target.simpleString()}")


def coerce_value(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Convert ``c`` to ``target``, opening JSON text one level at a time."""
    if not isinstance(target, _COMPLEX):
        return coerce_scalar(c, source, target)
    text = T.StringType()
    if isinstance(target, T.StructType):
        parsed = isinstance(source, T.StructType)
        kinds = {f.name: f.dataType for f in source} if parsed else {f.name: text for f in target}

        def build(raw: Column) -> Column:
            fields, missing, empty = [], F.lit(False), F.lit(True)
            for f in target:
                known = f.name in kinds
                value = coerce_value(raw[f.name], kinds[f.name], f.dataType) if known else F.lit(None).cast(f.dataType)
                fields.append(value.alias(f.name))
                if not f.nullable:
                    missing = missing | (raw[f.name].isNull() if known else F.lit(True))
                if known:
                    empty = empty & raw[f.name].isNull()
            # a required field must be there, and a struct without values is no record
            return F.when(raw.isNotNull() & ~missing & (~empty if parsed else F.lit(True)), F.struct(*fields))

        if parsed:
            return build(c)
        opened = F.from_json(c, T.StructType([T.StructField(f.name, text) for f in target]))
        # bound once as a lambda variable, so the text is parsed once for all fields
        once = F.get(F.transform(F.array(opened), build), F.lit(0))
        return F.when(~c.rlike(r"^\s*\{\s*\}\s*$"), once)
    if isinstance(target, T.ArrayType):
        if isinstance(source, T.ArrayType):
            return F.transform(c, lambda x: coerce_value(x, source.elementType, target.elementType))
        if isinstance(source, T.StringType):
            listed = F.transform(
                F.from_json(c, T.ArrayType(text)), lambda x: coerce_value(x, text, target.elementType)
            )
            if not target.containsNull:
                return F.when(F.trim(c).startswith("["), listed)
            single = F.array(coerce_value(c, text, target.elementType))
            return F.when(F.trim(c).startswith("["), listed).when(c.isNotNull(), single)
        single = F.array(coerce_value(c, source, target.elementType))
        return F.when(c.isNotNull(), single) if target.containsNull else F.lit(None).cast(target)
    pairs = c if isinstance(source, T.MapType) else F.from_json(c, T.MapType(text, text))
    key_kind = source.keyType if isinstance(source, T.MapType) else text
    value_kind = source.valueType if isinstance(source, T.MapType) else text
    return F.map_from_entries(
        F.transform(
            F.map_entries(pairs),
            lambda e: F.struct(
                coerce_value(e["key"], key_kind, target.keyType).alias("key"),
                coerce_value(e["value"], value_kind, target.valueType).alias("value"),
            ),
        )
    )


def coerce(df: DataFrame, schema: T.StructType, mode: str = "permissive") -> DataFrame:
    """Project ``df`` onto ``schema``.

    ``strict`` fails on the first value that does not fit; ``permissive`` sets
    it to null and lists the column names in ``_coerce_errors``.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"unknown mode {mode!r}")
    have = {f.name: f.dataType for f in df.schema}
    values, given = [], []
    for field in schema:
        if field.name in have:
            values.append(coerce_value(F.col(field.name), have[field.name], field.dataType).alias(field.name))
            given.append(F.col(field.name).isNotNull().alias(f"_given_{field.name}"))
        elif field.nullable:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"required column {field.name} is missing")
    typed = df.select(*values, *given)
    names = [f for f in schema if f.name in have]
    failed = {}
    for f in names:
        value, had = F.col(f.name), F.col(f"_given_{f.name}")
        failed[f.name] = value.isNull() & had if f.nullable else value.isNull()
    if mode == "permissive":
        bad = [F.when(failed[f.name], F.lit(f.name)) for f in names]
        errors = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
        return typed.select(*[F.col(f.name) for f in schema], errors.alias(ERRORS))
    out = []
    for f in schema:
        value = F.col(f.name)
        if f.name in failed:
            problem = F.raise_error(F.lit(f"{f.name}: value does not fit {f.dataType.simpleString()}"))
            value = F.when(failed[f.name], problem.cast(f.dataType)).otherwise(value)
        out.append(value.alias(f.name))
    return typed.select(*out)


# Source type names and the Spark type each stands for.
TYPE_NAMES = {
    "string": T.StringType(),
    "text": T.StringType(),
    "enum": T.StringType(),
    "int": T.LongType(),
    "integer": T.LongType(),
    "long": T.LongType(),
    "number": T.DoubleType(),
    "double": T.DoubleType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "geopoint": T.StructType(
        [T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())]
    ),
}


def decimal_of(precision: int | None, scale: int | None) -> T.DecimalType:
    p = min(precision or 38, 38)
    return T.DecimalType(p, min(18 if scale is None else scale, p))


def schema_from_descriptors(rows: list[dict]) -> T.StructType:
    """Field descriptors ``(name, type, nullable, precision, scale, repeated)`` to a schema.

    An unknown type is read as text.
    """
    fields = []
    for row in rows:
        name = str(row.get("type") or "string").lower()
        kind = decimal_of(row.get("precision"), row.get("scale")) if name == "decimal" else TYPE_NAMES.get(name, T.StringType())
        if row.get("repeated"):
            kind = T.ArrayType(kind)
        fields.append(T.StructField(row["name"], kind, bool(row.get("nullable", True))))
    return T.StructType(fields)
