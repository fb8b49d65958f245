"""Test data made inside Spark."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _noise(seed: int, name: str) -> Column:
    return F.xxhash64(F.col("_n"), F.lit(seed), F.lit(name))


def _value(kind: T.DataType, name: str, seed: int) -> Column:
    h = _noise(seed, name)
    if isinstance(kind, T.StringType):
        return F.concat(F.lit(f"{name}_"), F.hex(h))
    if isinstance(kind, T.BooleanType):
        return F.pmod(h, F.lit(2)) == 0
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.pmod(h, F.lit(100)).cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (F.pmod(h, F.lit(1000000)) / 1000).cast(kind)
    if isinstance(kind, T.DecimalType):
        room = 10 ** max(kind.precision - kind.scale, 0)
        return F.pmod(h, F.lit(min(room, 10**6))).cast(kind)
    if isinstance(kind, T.DateType):
        return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(h, F.lit(365)).cast("int"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_seconds(F.lit(1704067200) + F.pmod(h, F.lit(31536000))).cast(kind)
    if isinstance(kind, T.BinaryType):
        return F.encode(F.hex(h), "UTF-8")
    if isinstance(kind, T.VariantType):
        return F.parse_json(F.concat(F.lit('{"n":'), F.pmod(h, F.lit(100)).cast("string"), F.lit("}")))
    if isinstance(kind, T.StructType):
        return F.struct(*[_value(f.dataType, f"{name}.{f.name}", seed).alias(f.name) for f in kind])
    if isinstance(kind, T.ArrayType):
        return F.array(*[_value(kind.elementType, f"{name}[{i}]", seed) for i in range(2)])
    if isinstance(kind, T.MapType):
        return F.create_map(_value(kind.keyType, f"{name}.k", seed), _value(kind.valueType, f"{name}.v", seed))
    raise TypeError(f"no test value for {kind.simpleString()}")


def synth_from_schema(
    spark: SparkSession, schema: T.StructType, n: int, keys: Sequence[str] = (), cursor: str | None = None, seed: int = 0
) -> DataFrame:
    """``n`` rows of any schema: unique keys, rising cursor, the same for the same seed."""
    rows = spark.range(n).withColumnRenamed("id", "_n")
    cols = []
    for f in schema:
        kind = f.dataType
        if f.name in keys:
            text = F.concat(F.lit(f"{f.name}_"), F.col("_n").cast("string"))
            value = text if isinstance(kind, T.StringType) else F.col("_n").cast(kind)
        elif f.name == cursor:
            if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
                value = F.timestamp_seconds(F.lit(1704067200) + F.col("_n") * 60).cast(kind)
            elif isinstance(kind, T.DateType):
                value = F.date_add(F.lit("2024-01-01").cast("date"), F.col("_n").cast("int"))
            elif isinstance(kind, T.StringType):
                at = F.timestamp_seconds(F.lit(1704067200) + F.col("_n") * 60)
                value = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
            else:
                value = F.col("_n").cast(kind)
        else:
            value = _value(kind, f.name, seed)
        cols.append(value.alias(f.name))
    return rows.select(*cols)


def _varied(c: Column, kind: T.DataType, h: Column) -> Column:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return (c + F.pmod(h, F.lit(100))).cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (c * (1 + F.pmod(h, F.lit(100)) / 1000)).cast(kind)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return (c + F.make_dt_interval(secs=F.pmod(h, F.lit(86400)).cast("decimal(18,6)"))).cast(kind)
    if isinstance(kind, T.DateType):
        return F.date_add(c, F.pmod(h, F.lit(30)).cast("int"))
    if isinstance(kind, T.StringType):
        digest = F.sha2(F.concat_ws(":", c, h.cast("string")), 256)
        uuid = F.regexp_replace(F.substring(digest, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
        at = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}T"), c).try_cast("timestamp")
        moved = F.date_format(
            at + F.make_dt_interval(secs=F.pmod(h, F.lit(86400)).cast("decimal(18,6)")), "yyyy-MM-dd'T'HH:mm:ss'Z'"
        )
        return (
            F.when(c.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), uuid)
            .when(at.isNotNull(), moved)
            .when(c.rlike("^[0-9a-f]{16,64}$"), F.substring(F.concat(digest, digest), F.lit(1), F.length(c)))
            .otherwise(F.concat_ws("_", c, F.hex(F.pmod(h, F.lit(1 << 20)))))
        )
    return c


def synth_expand(sample: DataFrame, copies: int, seed: int = 0) -> DataFrame:
    """Each sample row ``copies`` times; only columns that vary in the sample are varied.

    The first copy is the row itself.
    """
    varying = sample.agg(*[(F.count_distinct(F.to_json(F.struct(F.col(c)))) > 1).alias(c) for c in sample.columns]).first()
    grown = sample.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    cols = []
    for f in sample.schema:
        c = F.col(f.name)
        if varying[f.name]:
            h = F.xxhash64(F.lit(seed), F.lit(f.name), F.to_json(F.struct(c)), F.col("_copy"))
            c = F.when(F.col("_copy") == 0, c).otherwise(_varied(c, f.dataType, h))
        cols.append(c.alias(f.name))
    return grown.select(*cols)


def inject_future(df: DataFrame, cursor: str, tie: str, n: int, now: Any) -> DataFrame:
    """Add ``n`` clones of the newest row dated one hour apart after ``now``.

    Does nothing if the data already reaches past ``now``.
    """
    kind = df.schema[cursor].dataType
    at = F.lit(now).cast(kind)
    newest = df.orderBy(F.col(cursor).desc(), F.col(tie).desc()).limit(1).where(F.col(cursor) <= at)
    clones = newest.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(n))))
    clones = clones.withColumn(cursor, (at + F.make_dt_interval(hours=F.col("_i"))).cast(kind))
    return df.unionByName(clones.select(*df.columns))


def sample_head(df: DataFrame, n: int, order: Sequence[str] = (), lists: Sequence[str] = (), items: int = 3) -> DataFrame:
    """A small sample for fixtures: ``n`` rows, list columns cut to ``items``."""
    out = df.orderBy(*order).limit(n) if order else df.limit(n)
    return out.withColumns({c: F.slice(c, 1, items) for c in lists}) if lists else out


def inject_nulls(df: DataFrame, rate: float, keep: Sequence[str], by: Sequence[str], seed: int = 0) -> DataFrame:
    """Null out ``rate`` of the values of every column not in ``keep``.

    Whether a value goes depends on the row's ``by`` columns only, so a retried
    task gives the same rows.
    """
    mark = round(rate * 10000)
    cols = []
    for f in df.schema:
        c = F.col(f.name)
        if f.name not in keep:
            drop = F.pmod(F.xxhash64(F.lit(seed), F.lit(f.name), *by), F.lit(10000)) < mark
            c = F.when(~drop, c)
        cols.append(c.alias(f.name))
    return df.select(*cols)
