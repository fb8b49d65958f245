"""Queries over table metadata held as a DataFrame.

A catalog frame has ``namespace array<string>``, ``tableName``,
``primary_keys array<string>``, ``cursor_field``, ``ingestion_type`` and
``size_bytes``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Standard key names of object metadata and where they come from.
STANDARD_KEYS = {
    "name": "tableName",
    "primary_keys": "primary_keys",
    "cursor_field": "cursor_field",
    "ingestion_type": "ingestion_type",
    "size_bytes": "size_bytes",
}
# Cursor columns, best first.
CURSOR_CANDIDATES = ("lastModifiedDateTime", "lastModifiedDate", "lastModifiedOn")


def table_metadata(cat: DataFrame, names: Sequence[str], configs: dict[str, dict] | None = None) -> DataFrame:
    """Metadata of the named tables in the caller's order; a table's own options win."""
    spark = cat.sparkSession
    configs = configs or {}
    asked = spark.createDataFrame(
        [(i, n, configs.get(n, {}).get("cursor_field"), configs.get(n, {}).get("ingestion_type")) for i, n in enumerate(names)],
        "pos int, _name string, _cursor string, _type string",
    )
    return (
        asked.join(cat, F.col("_name") == F.col("tableName"), "left")
        .orderBy("pos")
        .select(
            F.col("_name").alias("tableName"),
            "primary_keys",
            F.coalesce("_cursor", "cursor_field").alias("cursor_field"),
            F.coalesce("_type", "ingestion_type").alias("ingestion_type"),
        )
    )


def child_namespaces(cat: DataFrame, prefix: Sequence[str] = ()) -> DataFrame:
    """Immediate children of a namespace, sorted."""
    n = len(prefix)
    inside = F.size("namespace") > n
    if n:
        inside = inside & (F.slice("namespace", 1, n) == F.array(*[F.lit(p) for p in prefix]))
    return cat.where(inside).select(F.slice("namespace", 1, n + 1).alias("namespace")).distinct().orderBy("namespace")


def tables_in_namespace(cat: DataFrame, ns: Sequence[str] = (), flat: bool = False) -> DataFrame:
    """Tables directly in a namespace, sorted; a flat source has only the root."""
    if flat and ns:
        raise ValueError("a flat source has no namespaces")
    if flat:
        return cat.select(F.array().cast("array<string>").alias("namespace"), "tableName").orderBy("tableName")
    want = F.array(*[F.lit(p) for p in ns]) if ns else F.array().cast("array<string>")
    return cat.where(F.col("namespace") == want).select("namespace", "tableName").orderBy("tableName")


def list_objects(cat: DataFrame, path: Sequence[str] | None = None, search: str | None = None, flat: bool = False) -> DataFrame:
    """Objects below a path whose name matches a regex; a flat source has nothing off the root."""
    out = cat
    if path:
        if flat:
            return cat.where(F.lit(False))
        out = out.where(F.slice("namespace", 1, len(path)) == F.array(*[F.lit(p) for p in path]))
    if search:
        out = out.where(F.col("tableName").rlike(search))
    return out.orderBy("namespace", "tableName")


def object_metadata(cat: DataFrame, name: str | None = None, key: str | None = None) -> DataFrame:
    """Metadata of objects as (tableName, key, value) rows, null values left out."""
    out = cat if name is None else cat.where(F.col("tableName") == name)

    def text(column: str) -> Column:
        kind = cat.schema[column].dataType.typeName()
        return F.to_json(F.col(column)) if kind in ("array", "struct", "map") else F.col(column).cast("string")

    wide = out.select("tableName", *[text(c).alias(k) for k, c in STANDARD_KEYS.items()])
    rows = wide.unpivot(["tableName"], list(STANDARD_KEYS), "key", "value").where(F.col("value").isNotNull())
    return rows if key is None else rows.where(F.lower("key") == key.lower())


def preview(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def links_table(df: DataFrame, entity: Column, key: str, links: str) -> DataFrame:
    """A links map as (entity_type, id, rel, href) rows; links without target are dropped."""
    rows = df.where(F.col(key).isNotNull()).select(
        entity.alias("entity_type"), F.col(key).alias("id"), F.explode(links).alias("rel", "href")
    )
    return rows.where(F.col("href").isNotNull())


def infer_ingestion_type(
    columns: DataFrame, overrides: dict[str, str] | None = None, candidates: Sequence[str] = CURSOR_CANDIDATES
) -> DataFrame:
    """Ingestion type per table from its columns (tableName, name).

    An override wins; else a table with a cursor candidate is ``cdc``, the
    first candidate in the list being its cursor; else ``snapshot``.
    """
    place = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("name"))
    best = columns.groupBy("tableName").agg(
        F.min_by(F.when(place > 0, F.col("name")), F.when(place > 0, place)).alias("cursor_field")
    )
    kind = F.when(F.col("cursor_field").isNotNull(), "cdc").otherwise("snapshot")
    for name, value in (overrides or {}).items():
        kind = F.when(F.col("tableName") == name, value).otherwise(kind)
    return best.withColumn("ingestion_type", kind)
