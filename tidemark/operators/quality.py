"""Data and schema checks as aggregations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import blocks as B
from tidemark.plans.apply import same_key

INGESTION_TYPES = ("snapshot", "cdc", "cdc_with_deletes", "append")


def check_schema(columns: DataFrame) -> DataFrame:
    """Problems in a columns table (tableName, version, name, type).

    Duplicate names, tables without columns (a null name) and columns that
    differ between versions, as (tableName, problem, name).
    """
    named = columns.where(F.col("name").isNotNull())
    twice = (
        named.groupBy("tableName", "version", "name").agg(F.count("*").alias("n")).where("n > 1")
        .select("tableName", F.lit("duplicate").alias("problem"), "name").distinct()
    )
    empty = (
        columns.groupBy("tableName").agg(F.count("name").alias("n")).where("n = 0")
        .select("tableName", F.lit("empty").alias("problem"), F.lit(None).cast("string").alias("name"))
    )
    versions = named.groupBy(F.col("tableName").alias("_t")).agg(F.count_distinct("version").alias("versions"))
    seen = named.groupBy("tableName", "name").agg(
        F.count_distinct("version").alias("in_versions"), F.count_distinct("type").alias("types")
    )
    drift = (
        seen.join(versions, F.col("tableName") == F.col("_t"))
        .where((F.col("in_versions") < F.col("versions")) | (F.col("types") > 1))
        .select("tableName", F.lit("unstable").alias("problem"), "name")
    )
    return twice.unionByName(empty).unionByName(drift)


def check_metadata(cat: DataFrame, columns: DataFrame) -> DataFrame:
    """Problems in table metadata, as (tableName, problem, name)."""
    known = columns.select("tableName", "name").distinct()
    kind = F.coalesce(F.col("ingestion_type"), F.lit("cdc"))
    wrong = cat.where(~kind.isin(*INGESTION_TYPES)).select(
        "tableName", F.lit("invalid type").alias("problem"), F.col("ingestion_type").alias("name")
    )
    keyless = cat.where((kind != "append") & (F.coalesce(F.size("primary_keys"), F.lit(0)) <= 0)).select(
        "tableName", F.lit("missing keys").alias("problem"), F.lit(None).cast("string").alias("name")
    )
    keys = cat.select("tableName", F.explode("primary_keys").alias("path"))
    keys = keys.select("tableName", F.split("path", r"\.")[0].alias("name"))
    lost = keys.join(known, ["tableName", "name"], "left_anti").select(
        "tableName", F.lit("key not a column").alias("problem"), "name"
    )
    cursors = cat.where(F.col("cursor_field").isNotNull()).select(
        "tableName", F.split("cursor_field", r"\.")[0].alias("name")
    )
    adrift = cursors.join(known, ["tableName", "name"], "left_anti").select(
        "tableName", F.lit("cursor not a column").alias("problem"), "name"
    )
    return reduce(DataFrame.unionByName, [wrong, keyless, lost, adrift])


def column_population(df: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """Filled count per column in one pass; ``never_filled`` unless allowed to be."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    long = counts.unpivot(["_rows"], df.columns, "column_name", "filled")
    return long.select(
        "column_name",
        "filled",
        ((F.col("filled") == 0) & (F.col("_rows") > 0) & ~F.col("column_name").isin(*allowed) if allowed
         else (F.col("filled") == 0) & (F.col("_rows") > 0)).alias("never_filled"),
    )


def check_records(df: DataFrame, keys: Sequence[str], cursor: str | None, required: Sequence[str] = ()) -> DataFrame:
    """Violations per rule in one pass, as (rule, violations)."""
    any_null = lambda cols: reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols], F.lit(False))
    all_null = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in df.columns], F.lit(True))
    rules: dict[str, Column] = {
        "null_key": any_null(keys),
        "null_cursor": F.col(cursor).isNull() if cursor else F.lit(False),
        "empty_row": all_null,
        "required_null": any_null(required),
    }
    counted = df.agg(*[F.count_if(c).alias(r) for r, c in rules.items()])
    return counted.unpivot([], list(rules), "rule", "violations")


_HELD = "array<struct<path:string,v:variant>>"


def _fields(held: Column) -> Column:
    """The fields one level below some values, each with its path; array items share the path of the array."""

    def opened(x: Column) -> Column:
        items = F.coalesce(F.try_variant_get(x["v"], "$", "array<variant>"), F.array(x["v"]))
        entries = F.transform(items, lambda v: F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")))
        return F.transform(
            F.flatten(F.filter(entries, lambda e: e.isNotNull())),
            lambda e: F.struct(F.concat_ws(".", x["path"], e["key"]).alias("path"), e["value"].alias("v")),
        )

    return F.flatten(F.transform(held, opened))


def nested_paths(df: DataFrame, raw: str) -> DataFrame:
    """Every field path in JSON records and how often it occurs, at any depth.

    Objects are opened level by level within their record, which is parsed once; array
    items share the path of the array. A record has no more levels than opening braces,
    so a deep one costs its own depth only and nothing is written in between. Paths are
    counted with map-side combine. Records are dealt out first, since few bytes of a file
    can hold many of them.
    """
    whole = F.array(F.struct(F.lit(None).cast("string").alias("path"), F.try_parse_json(F.col(raw)).alias("v")))
    start = F.struct(F.array().cast("array<string>").alias("found"), whole.cast(_HELD).alias("held"))

    def level(at: Column, _: Column) -> Column:
        # an array of one, so that the fields are opened once
        step = F.transform(
            F.array(_fields(at["held"])),
            lambda fields: F.struct(F.concat(at["found"], F.transform(fields, lambda x: x["path"])).alias("found"), fields.cast(_HELD).alias("held")),
        )
        return F.when(F.size(at["held"]) == 0, at).otherwise(step[0])

    braces = F.length(raw) - F.length(F.replace(F.col(raw), F.lit("{"), F.lit("")))
    levels = F.when(braces > 0, F.sequence(F.lit(1), braces))
    dealt = df.select(raw).repartition(B.default_blocks(df.sparkSession))
    paths = dealt.select(F.explode(F.aggregate(levels, start, level, lambda at: at["found"])).alias("path"))
    return paths.groupBy("path").agg(F.count("*").alias("records"))


def declared_paths(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """Every path of a schema with its type; map and array contents belong to their path."""
    out: list[tuple[str, str]] = []
    for f in schema:
        path, kind = f"{prefix}{f.name}", f.dataType
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        out.append((path, f.dataType.simpleString() if not isinstance(kind, T.StructType) else "struct"))
        if isinstance(kind, T.StructType):
            out += declared_paths(kind, f"{path}.")
    return out


def schema_drift(df: DataFrame, raw: str, schema: T.StructType) -> DataFrame:
    """Paths present in the data, declared in the schema, or both.

    A path inside a declared map or text column counts as ``covered``.
    """
    spark = df.sparkSession
    declared = spark.createDataFrame(declared_paths(schema), "path string, type string")
    seen = nested_paths(df, raw).select("path", "records")
    joined = seen.join(declared.withColumnRenamed("path", "_p"), F.col("path") == F.col("_p"), "full_outer").select(
        F.coalesce("path", "_p").alias("path"), "records", "type"
    )
    open_types = [p for p, t in declared_paths(schema) if t != "struct"]
    covered = F.lit(False)
    for p in open_types:
        covered = covered | F.col("path").startswith(f"{p}.")
    return joined.select(
        "path",
        F.when(F.col("records").isNull(), "missing_in_data")
        .when(F.col("type").isNotNull(), "declared")
        .when(covered, "covered")
        .otherwise("undeclared")
        .alias("status"),
        F.coalesce("records", F.lit(0)).alias("records"),
    )


def shape_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns of two tables side by side with their filled counts.

    ``status`` is ``same``, ``type_changed``, ``only_a`` or ``only_b``.  Nested
    fields are told apart by path; counts are for top-level columns.
    """
    spark = a.sparkSession

    def profile(df: DataFrame, mark: str) -> DataFrame:
        paths = spark.createDataFrame(declared_paths(df.schema), f"path string, type_{mark} string")
        filled = column_population(df).select(F.col("column_name").alias("path"), F.col("filled").alias(f"filled_{mark}"))
        return paths.join(filled, "path", "left")

    joined = profile(a, "a").join(profile(b, "b"), "path", "full_outer")
    return joined.select(
        "path", "type_a", "type_b", "filled_a", "filled_b",
        F.when(F.col("type_a").isNull(), "only_b")
        .when(F.col("type_b").isNull(), "only_a")
        .when(F.col("type_a") == F.col("type_b"), "same")
        .otherwise("type_changed")
        .alias("status"),
    )


def value_shape_diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns of two versions of a table: filled counts on both sides and rows that differ."""
    cols = [c for c in a.columns if c in b.columns and c not in keys]
    left = a.select(*keys, F.struct(*cols).alias("_a"))
    right = b.select(*keys, F.struct(*cols).alias("_b"))
    joined = left.join(right, list(keys), "inner")
    counted = joined.agg(*[F.count_if(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}"))).alias(c) for c in cols])
    return counted.unpivot([], cols, "column_name", "changed_rows")


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def check_partitions(plan: DataFrame, since: str = "since", until: str = "until", entity: str | None = None) -> DataFrame:
    """Whether planned windows ``(since, until]`` are disjoint and cover their range without gaps.

    Each start is compared with the furthest end before it, per entity if one is
    named, else over the whole plan; contained, crossing and repeated windows count
    as overlapping. ``backwards`` windows (not of positive length) count only there.
    The plan runs in blocks of start times, so a long one is not sorted in one task.
    """
    by = [entity] if entity else []
    good = plan.where(F.col(since) < F.col(until)).select(*by, F.col(since).alias("_s"), F.col(until).alias("_u"))
    cuts = B.order_cuts(good, "_s")
    blocked = good.withColumn(B.BLOCK, F.coalesce(B.block_of(B.comparable(good, "_s"), cuts), F.lit(0)))
    before = Window.unboundedPreceding, -1
    inside = Window.partitionBy(*by, B.BLOCK).orderBy("_s", "_u").rowsBetween(*before)
    ends = blocked.groupBy(*by, B.BLOCK).agg(F.max("_u").alias("_end"))
    ends = ends.withColumn("_ahead", F.max("_end").over(Window.partitionBy(*by).orderBy(B.BLOCK).rowsBetween(*before)))
    side = ends.select(*[F.col(k).alias(f"_k_{k}") for k in [*by, B.BLOCK]], "_ahead")
    seen = blocked.withColumn("_far", F.max("_u").over(inside)).join(side, same_key([*by, B.BLOCK]), "left")
    far = F.greatest("_far", "_ahead")
    counted = seen.groupBy(*by).agg(
        F.count_if(F.col("_s") < far).alias("overlapping"),
        F.count_if(F.col("_s") > far).alias("gaps"),
        F.min("_s").alias("covers_from"),
        F.max("_u").alias("covers_to"),
    )
    wrong = plan.where(F.col(since) >= F.col(until)).groupBy(*by).agg(F.count("*").alias("backwards"))
    if not entity:
        return counted.withColumn("backwards", wrong.scalar())
    wrong = wrong.withColumnRenamed(entity, f"_k_{entity}")
    return counted.join(wrong, same_key(by), "full_outer").select(
        F.coalesce(F.col(entity), F.col(f"_k_{entity}")).alias(entity),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("overlapping", "gaps")], "covers_from", "covers_to",
        F.coalesce("backwards", F.lit(0)).alias("backwards"),
    )


def endpoint_coverage(log: DataFrame, url: str, method: str) -> DataFrame:
    """Hits per address (without query) and method, most hit first."""
    path = F.regexp_replace(F.col(url), r"[?#].*$", "")
    return (
        log.groupBy(path.alias("endpoint"), F.upper(F.col(method)).alias("method"))
        .agg(F.count("*").alias("hits"))
        .orderBy(F.desc("hits"), "endpoint", "method")
    )


def check_visible_after_change(
    after: DataFrame, tombstones: DataFrame, written: DataFrame, deleted: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Written keys missing from the next increment and deleted keys without tombstone; empty is good."""
    lost = written.select(*keys).join(after.select(*keys), list(keys), "left_anti")
    alive = deleted.select(*keys).join(tombstones.select(*keys), list(keys), "left_anti")
    return lost.withColumn("problem", F.lit("written key not read")).unionByName(
        alive.withColumn("problem", F.lit("deleted key without tombstone"))
    )
