"""Declared predicates as native filters."""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPERATORS = ("eq", "ne", "gt", "gte", "lt", "lte", "in")


def _type_at(schema: T.StructType, path: str) -> T.DataType:
    kind: T.DataType = schema
    for part in path.split("."):
        kind = kind[part].dataType
    return kind


def _literal(raw: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.lit(raw.lower() in ("true", "1", "yes"))
    return F.lit(raw).try_cast(kind)


def apply_filters(df: DataFrame, specs: list[tuple[str, str, str]], params: dict[str, str]) -> DataFrame:
    """Filter by every ``(name, path, op)`` whose name is in ``params``.

    A missing value passes only ``ne``; ``in`` compares text with a comma list.
    """
    for name, path, op in specs:
        if op not in OPERATORS:
            raise ValueError(f"unknown operator {op!r}")
        if name not in params:
            continue
        c, raw = F.col(path), params[name]
        if op == "in":
            df = df.where(c.cast("string").isin(*[v.strip() for v in raw.split(",")]))
            continue
        value = _literal(raw, _type_at(df.schema, path))
        if op == "ne":
            df = df.where(c.isNull() | (c != value))
        elif op == "eq":
            df = df.where(c == value)
        elif op == "gt":
            df = df.where(c > value)
        elif op == "gte":
            df = df.where(c >= value)
        elif op == "lt":
            df = df.where(c < value)
        else:
            df = df.where(c <= value)
    return df


def filter_exact(df: DataFrame, allowed: list[str], **options: Any) -> DataFrame:
    """Equality on optional columns; an option the table does not offer is an error."""
    unknown = set(options) - set(allowed)
    if unknown:
        raise ValueError(f"unknown options {sorted(unknown)}")
    for name, value in options.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def filter_search(df: DataFrame, column: str, pattern: str | None) -> DataFrame:
    return df.where(F.col(column).rlike(pattern)) if pattern else df


def filter_name_wildcard(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Name filter with ``*`` and ``?``, any letter case."""
    like = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return df.where(F.col(column).ilike(like.replace("*", "%").replace("?", "_")))


def report_condition(spec: str | dict, names: dict[str, Column]) -> Column:
    """A report filter object as a Column over ``names`` (dimension or metric columns)."""
    tree = json.loads(spec) if isinstance(spec, str) else spec
    if not isinstance(tree, dict) or len(tree) != 1:
        raise ValueError("a filter object holds exactly one of filter, andGroup, orGroup, notExpression")
    kind, body = next(iter(tree.items()))
    if kind in ("andGroup", "orGroup"):
        parts = [report_condition(e, names) for e in body["expressions"]]
        if not parts:
            raise ValueError("empty filter group")
        return reduce(lambda a, b: (a & b) if kind == "andGroup" else (a | b), parts)
    if kind == "notExpression":
        return ~report_condition(body, names)
    if kind != "filter":
        raise ValueError(f"unknown filter {kind!r}")
    name = body.get("fieldName")
    if name not in names:
        raise ValueError(f"filter on a field that is not in the report: {name!r}")
    return _leaf(names[name], body)


def _leaf(c: Column, body: dict) -> Column:
    if "stringFilter" in body:
        rule = body["stringFilter"]
        match, value = rule.get("matchType", "EXACT"), rule["value"]
        text, mark = c.cast("string"), F.lit(value)
        if not rule.get("caseSensitive", False):
            text, mark = F.lower(text), F.lower(mark)
        if match == "EXACT":
            return text == mark
        if match == "BEGINS_WITH":
            return text.startswith(mark)
        if match == "ENDS_WITH":
            return text.endswith(mark)
        if match == "CONTAINS":
            return F.contains(text, mark)
        if match == "FULL_REGEXP":
            return c.cast("string").rlike(f"^(?:{value})$")
        if match == "PARTIAL_REGEXP":
            return c.cast("string").rlike(value)
        raise ValueError(f"unknown match type {match!r}")
    if "inListFilter" in body:
        rule = body["inListFilter"]
        if rule.get("caseSensitive", False):
            return c.cast("string").isin(*rule["values"])
        return F.lower(c.cast("string")).isin(*[v.lower() for v in rule["values"]])
    if "numericFilter" in body:
        rule = body["numericFilter"]
        value = F.lit(_number(rule["value"]))
        compare = {
            "EQUAL": c == value,
            "LESS_THAN": c < value,
            "LESS_THAN_OR_EQUAL": c <= value,
            "GREATER_THAN": c > value,
            "GREATER_THAN_OR_EQUAL": c >= value,
        }
        return compare[rule["operation"]]
    if "betweenFilter" in body:
        rule = body["betweenFilter"]
        return c.between(_number(rule["fromValue"]), _number(rule["toValue"]))
    raise ValueError("malformed filter object")


def _number(value: dict) -> float:
    return float(value["int64Value"]) if "int64Value" in value else float(value["doubleValue"])


def report_filter(df: DataFrame, spec: str | dict) -> DataFrame:
    return df.where(report_condition(spec, {c: F.col(c) for c in df.columns}))


def strictly_after(df: DataFrame, cursor: str, since: Any) -> DataFrame:
    return df.where(F.col(cursor) > F.lit(since).cast(df.schema[cursor].dataType))


def half_open(df: DataFrame, cursor: str, since: Any, until: Any) -> DataFrame:
    """``(since, until]``; no lower bound on the first window (``since`` is None)."""
    kind = df.schema[cursor].dataType
    out = df.where(F.col(cursor) <= F.lit(until).cast(kind))
    return out if since is None else out.where(F.col(cursor) > F.lit(since).cast(kind))


def inclusive_days(df: DataFrame, cursor: str, start: str, end: str, last: bool = True) -> DataFrame:
    """Whole days ``start .. end``; a window that is not the last stops one day earlier.

    The day bounds become instants, so the range still reaches the scan.
    """
    kind = df.schema[cursor].dataType
    low = F.lit(start).cast("date").cast(kind)
    stop = F.date_add(F.lit(end).cast("date"), 1 if last else 0).cast(kind)
    return df.where((F.col(cursor) >= low) & (F.col(cursor) < stop))


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def null_cursor_policy(df: DataFrame, cursor: str, since: Any, policy: str) -> DataFrame:
    """Rows after ``since``; rows without a cursor are kept or dropped as told."""
    newer = F.col(cursor) > F.lit(since).cast(df.schema[cursor].dataType)
    if policy == "keep":
        return df.where(newer | F.col(cursor).isNull())
    if policy == "drop":
        return df.where(newer)
    raise ValueError(f"unknown policy {policy!r}")


def overlapping(df: DataFrame, start: str, end: str, low: Any, high: Any) -> DataFrame:
    """Intervals that touch ``[low, high]``; an open end reaches forever."""
    kind = df.schema[start].dataType
    lo, hi = F.lit(low).cast(kind), F.lit(high).cast(kind)
    return df.where((F.col(start) <= hi) & (F.col(end).isNull() | (F.col(end) >= lo)))


def effective_time_filter(df: DataFrame, preferred: str, fallback: str, since: Any) -> DataFrame:
    return df.where(F.coalesce(F.col(preferred), F.col(fallback)) > F.lit(since))


def multi_level_filters(
    levels: list[tuple[DataFrame, dict[str, Any], list[str]]], links: list[tuple[str, str]], reserved: tuple = ()
) -> DataFrame:
    """Filter each level of a hierarchy; a child stays only under a kept parent.

    ``levels`` are ``(frame, equality filters, allowed names)`` from the top,
    ``links[i]`` names the key of level i and the reference to it in level i+1.
    """
    kept: DataFrame | None = None
    for i, (df, filters, allowed) in enumerate(levels):
        clash = set(filters) & set(reserved)
        if clash:
            raise ValueError(f"reserved filter names {sorted(clash)}")
        df = filter_exact(df, allowed, **filters)
        if kept is not None:
            key, ref = links[i - 1]
            parents = kept.select(F.col(key).alias(ref))
            df = df.join(parents, ref, "left_semi")
        kept = df
    return kept


def exclude_archived(df: DataFrame, archived: Column, status: str = "all") -> DataFrame:
    """All rows by default, or only those not archived."""
    if status == "all":
        return df
    if status == "active":
        return df.where(~F.coalesce(archived, F.lit(False)))
    raise ValueError(f"unknown status {status!r}")


# Quality flags and what a missing flag means.
QUALITY_DEFAULTS = {"good": True, "questionable": False, "substituted": False}


def quality_filter(df: DataFrame, **wanted: bool | None) -> DataFrame:
    """Points whose quality flags equal the wanted ones; None leaves a flag open."""
    for flag, value in wanted.items():
        if flag not in QUALITY_DEFAULTS:
            raise ValueError(f"unknown flag {flag!r}")
        if value is not None and flag in df.columns:
            df = df.where(F.coalesce(F.col(flag), F.lit(QUALITY_DEFAULTS[flag])) == F.lit(value))
    return df
