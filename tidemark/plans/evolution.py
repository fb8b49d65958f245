"""Columns by id, so that old files stay readable as a table's columns change.

A table's columns are a list of ids with names and types. Files hold a column under its id,
with the type it had when they were written, so a rename touches no file and a file
without a column reads as null. Types only widen; a batch whose type fits neither way
makes the column text, and one that cannot be text is refused before anything is written.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_NESTED = (T.StructType, T.ArrayType, T.MapType)


@dataclass(frozen=True)
class Field:
    """A column of a table; its id never changes and is never used again."""

    id: int
    name: str
    type: T.DataType

    @property
    def stored(self) -> str:
        return f"c{self.id}"

    def as_list(self) -> list:
        return [self.id, self.name, json.loads(self.type.json())]

    @staticmethod
    def of(item: Sequence) -> Field:
        return Field(item[0], item[1], T._parse_datatype_json_value(item[2]))


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text for scalars that have none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name: f for f in b}
        fields = [T.StructField(f.name, common_type(f.dataType, other[f.name].dataType) if f.name in other else f.dataType) for f in a]
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in b if f.name not in a.fieldNames()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        if a.keyType != b.keyType:
            raise TypeError(f"map keys of {a.simpleString()} and {b.simpleString()} differ")
        return T.MapType(a.keyType, common_type(a.valueType, b.valueType))
    if isinstance(a, _NESTED) or isinstance(b, _NESTED) or isinstance(a, T.BinaryType) or isinstance(b, T.BinaryType):
        raise TypeError(f"{a.simpleString()} and {b.simpleString()} have no common type")
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max((a, b), key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {T.FloatType, T.DoubleType} or kinds <= {T.DoubleType, T.FloatType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if kinds <= {*_WHOLE, T.DecimalType}:
        return _decimal(a, b)
    if kinds == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def _decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    sizes = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
    whole, scale = 0, 0
    for t in (a, b):
        digits, behind = (t.precision, t.scale) if isinstance(t, T.DecimalType) else (sizes[type(t)], 0)
        whole, scale = max(whole, digits - behind), max(scale, behind)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()


def conform(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column of one type as a wider one; struct fields are met by name."""
    if have == want:
        return column
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        known = {f.name: f.dataType for f in have}
        parts = [
            (conform(column.getField(f.name), known[f.name], f.dataType) if f.name in known else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(column, lambda c: conform(c, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(column, lambda _, v: conform(v, have.valueType, want.valueType))
    return column.cast(want)


def keeps_order(have: T.DataType, want: T.DataType) -> bool:
    """Whether values compare the same way before and after widening, so that old bounds still hold."""
    return have == want or (type(have) in _WHOLE and type(want) in _WHOLE)


def evolved(fields: Sequence[Field], batch: T.StructType, fixed: Sequence[str] = (), next_id: int = 1) -> list[Field]:
    """The columns after a batch: wider where it needs them to be, new ones at the end.

    A column that the batch lacks stays. ``fixed`` names key columns: their text must
    tell the same values apart as before, so they may become wider integers or text.
    """
    out = list(fields)
    at = {f.name: i for i, f in enumerate(out)}
    for f in batch:
        if f.name not in at:
            out.append(Field(next_id, f.name, f.dataType if not isinstance(f.dataType, T.NullType) else T.StringType()))
            next_id += 1
            continue
        old = out[at[f.name]]
        wide = common_type(old.type, f.dataType)
        if f.name in fixed and wide != old.type and not _stable_text(old.type, wide):
            raise TypeError(f"key column {f.name} cannot become {wide.simpleString()}")
        if f.name in fixed and wide != f.dataType and not _stable_text(f.dataType, wide):
            raise TypeError(f"key column {f.name} cannot take {f.dataType.simpleString()}")
        out[at[f.name]] = replace(old, type=wide)
    return out


def _stable_text(have: T.DataType, want: T.DataType) -> bool:
    return type(have) in _WHOLE and (type(want) in _WHOLE or isinstance(want, T.StringType))


def as_columns(df: DataFrame, fields: Sequence[Field], stored: bool = False) -> list[Column]:
    """Select list that gives a batch a table's columns, under their names or as they are stored."""
    known = {f.name: f.dataType for f in df.schema}
    return [
        (conform(F.col(f"`{f.name}`"), known[f.name], f.type) if f.name in known else F.lit(None).cast(f.type)).alias(
            f.stored if stored else f.name
        )
        for f in fields
    ]


def from_stored(have: Sequence[Field], want: Sequence[Field]) -> list[Column]:
    """Select list that reads files written under ``have`` as the columns ``want``."""
    old = {f.id: f for f in have}
    return [
        (conform(F.col(f.stored), old[f.id].type, f.type) if f.id in old else F.lit(None).cast(f.type)).alias(f.name) for f in want
    ]


def stored_schema(fields: Sequence[Field], extra: Sequence[T.StructField] = ()) -> T.StructType:
    return T.StructType([*[T.StructField(f.stored, f.type) for f in fields], *extra])
