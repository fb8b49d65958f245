"""One-to-many reshaping."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def explode_children(df: DataFrame, path: str, parent_cols: dict[str, str], child: str = "child") -> DataFrame:
    """Child rows with renamed parent columns; parents without children vanish."""
    return df.select(*[F.col(c).alias(n) for c, n in parent_cols.items()], F.explode(path).alias(child)).select(
        *parent_cols.values(), f"{child}.*"
    )


def explode_filtered(
    df: DataFrame, path: str, keep: Callable[[Column], Column], parent_cols: Sequence[str]
) -> DataFrame:
    """Chosen child entries as rows; a child field wins over the parent field of that name."""
    fields = df.schema[path].dataType.elementType.fieldNames()
    rows = df.select(*parent_cols, F.explode(F.filter(F.col(path), keep)).alias("_child"))
    out = []
    for name in [*parent_cols, *[f for f in fields if f not in parent_cols]]:
        if name in fields and name in parent_cols:
            out.append(F.coalesce(F.col(f"_child.{name}"), F.col(name)).alias(name))
        else:
            out.append(F.col(f"_child.{name}" if name in fields else name).alias(name))
    return rows.select(*out)


def explode_two_level(df: DataFrame, outer: str, inner: str, ids: dict[str, str], outer_id: str, outer_name: str) -> DataFrame:
    """Outer entries, then their inner entries, keeping both ids."""
    first = df.select(*[F.col(c).alias(n) for c, n in ids.items()], F.explode(outer).alias("_outer"))
    return first.select(
        *ids.values(), F.col(f"_outer.{outer_id}").alias(outer_name), F.explode(f"_outer.{inner}").alias("_inner")
    ).select(*ids.values(), outer_name, "_inner.*")


def explode_envelope_dates(df: DataFrame, entries: str, records: str, keep: dict[str, str]) -> DataFrame:
    """``(user, date, records[])`` envelopes to a row per record."""
    outer = df.select(F.explode(entries).alias("_entry"))
    return outer.select(
        *[F.col(f"_entry.{c}").alias(n) for c, n in keep.items()], F.explode(f"_entry.{records}").alias("_record")
    ).select(*keep.values(), "_record.*")


def explode_parts(c: Column, mapping: dict[str, str]) -> Column:
    """Array of structs with renamed fields."""
    return F.transform(c, lambda x: F.struct(*[x[a].alias(b) for a, b in mapping.items()]))


def explode_map(df: DataFrame, column: str, keep: Sequence[str], key: str = "key", value: str = "value") -> DataFrame:
    return df.select(*keep, F.explode(column).alias(key, value))


def reshape_records(
    df: DataFrame, dims: Sequence[str], metrics: dict[str, str], dim_values: str, metric_values: str
) -> DataFrame:
    """Positional value arrays to named columns.

    ``metrics`` maps each metric to its declared type; a short array leaves the
    trailing columns null; an 8-digit ``date`` becomes an ISO date.
    """
    keep = [c for c in df.columns if c not in (dim_values, metric_values)]
    out: list[Column] = [F.col(c) for c in keep]
    for i, name in enumerate(dims):
        value = F.get(F.col(dim_values), F.lit(i))
        if name in ("date", "firstSessionDate"):
            value = F.coalesce(S.yyyymmdd(value), value)
        out.append(value.alias(name))
    for i, (name, kind) in enumerate(metrics.items()):
        whole, real, text = S.metric_value(F.get(F.col(metric_values), F.lit(i)), F.lit(kind))
        value = whole if kind in S.INTEGER_METRICS else real if kind in S.FLOAT_METRICS else text
        out.append(value.alias(name))
    return df.select(*out)


def bundle_entries(df: DataFrame, raw: str, resource: str = "resource") -> DataFrame:
    """Resources of a bundle page as JSON text rows; a page of another type is an error."""
    kind = F.get_json_object(raw, "$.resourceType")
    checked = F.when(kind == "Bundle", F.col(raw)).otherwise(
        F.raise_error(F.concat(F.lit("expected a Bundle, got "), F.coalesce(kind, F.lit("nothing")))).cast("string")
    )
    page = F.from_json(checked, "struct<entry:array<struct<resource:string>>>")
    rows = df.select(*[c for c in df.columns if c != raw], F.explode(page["entry"]).alias("_entry"))
    return rows.select(
        *[c for c in rows.columns if c != "_entry"], F.col("_entry.resource").alias(resource)
    ).where(F.col(resource).isNotNull() & (F.col(resource) != "{}"))


def explode_structs(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, F.explode(column).alias(column))


def nth_component(c: Column, n: int, path: str) -> Column:
    """A nested field of the n-th array element (from 0); null beyond the end."""
    value = F.get(c, F.lit(n))
    for part in path.split("."):
        value = value[part]
    return value


def variant_path(c: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(c, path, kind)
