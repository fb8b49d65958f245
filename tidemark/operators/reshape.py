"""Projections and reshaping of nested records."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.functions.coercion import coerce_value



def conform_struct(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in order: missing nullable ones null, extra ones dropped.

    A required column that is absent fails at once, a null in one fails the row.
    """
    out = []
    for f in schema:
        if f.name in df.columns:
            value = F.col(f.name).cast(f.dataType)
            if not f.nullable:
                value = F.coalesce(value, F.raise_error(F.lit(f"{f.name} must not be null")).cast(f.dataType))
        elif f.nullable:
            value = F.lit(None).cast(f.dataType)
        else:
            raise ValueError(f"required column {f.name} is missing")
        out.append(value.alias(f.name))
    return df.select(*out)


def wrap_array(c: Column, source: T.DataType | None = None) -> Column:
    """A scalar as a one-item array; an array stays; null stays null."""
    if isinstance(source, T.ArrayType):
        return c
    if isinstance(source, T.VariantType):
        return F.coalesce(
            F.try_variant_get(c, "$", "array<string>"),
            F.when(c.isNotNull(), F.array(F.try_variant_get(c, "$", "string"))),
        )
    return F.when(c.isNotNull(), F.array(c))


def string_list(raw: Column) -> Column:
    """JSON text holding a list or a scalar, as a list of text."""
    return F.when(F.trim(raw).startswith("["), F.from_json(raw, "array<string>")).when(
        raw.isNotNull(), F.array(raw)
    )


def flatten_envelope(
    df: DataFrame,
    raw: str,
    fields: dict[str, tuple[str, str]],
    by_kind: dict[str, dict[str, tuple[str, str]]] | None = None,
    kind_path: str = "kind",
) -> DataFrame:
    """Flat columns out of nested JSON text.

    ``fields`` maps an output name to ``(path, how)``; ``how`` is ``text``,
    ``long``, ``double``, ``list`` or ``json``; several paths separated by
    ``|`` are tried in order.  ``by_kind`` adds columns that are filled only
    where the kind contains the given text.
    """
    by_kind = by_kind or {}
    specs = [*fields.values(), *[spec for extra in by_kind.values() for spec in extra.values()]]
    paths = {kind_path, *[p for spec in specs for p in spec[0].split("|")]}
    tree: dict = {}
    for path in sorted(paths):
        at = tree
        for step in path.split("."):
            at = at.setdefault(step, {})

    def ddl(node: dict) -> str:
        return "struct<" + ",".join(f"`{k}`:{ddl(v) if v else 'string'}" for k, v in node.items()) + ">"

    def found(path: str) -> Column:
        # an object asked for as a whole and in parts is read a second time
        if any(p.startswith(f"{path}.") for p in paths):
            return F.get_json_object(F.col(raw), f"$.{path}")
        value = F.col("_doc")
        for step in path.split("."):
            value = value[step]
        return value

    kind = found(kind_path)

    def build(spec: tuple[str, str]) -> Column:
        options = [found(p) for p in spec[0].split("|")]
        how = spec[1]
        value = F.coalesce(*[F.nullif(v, F.lit("")) for v in options]) if len(options) > 1 else options[0]
        if how == "long":
            return S.try_long(value)
        if how == "double":
            return S.try_double(value)
        if how == "list":
            return string_list(value)
        if how in ("text", "json"):
            return value
        raise ValueError(f"unknown field form {how!r}")

    out = [F.col(c) for c in df.columns if c != raw]
    out += [build(spec).alias(name) for name, spec in fields.items()]
    for mark, extra in by_kind.items():
        out += [F.when(F.contains(kind, F.lit(mark)), build(spec)).alias(n) for n, spec in extra.items()]
    return df.withColumn("_doc", F.from_json(F.col(raw), ddl(tree))).select(*out)


def rename_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select dotted source paths under new names; a path that is not there becomes null."""
    return df.select(
        *[(F.col(p) if has_path(df.schema, p) else F.lit(None).cast("string")).alias(n) for p, n in mapping.items()]
    )


def has_path(schema: T.DataType, path: str) -> bool:
    kind: T.DataType = schema
    for part in path.split("."):
        if isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
            return False
        kind = kind[part].dataType
    return True


def snake_name(name: str) -> str:
    return re.sub(S.WORD_START, "_", name).lower()


def _renamed(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(snake_name(f.name), _renamed(f.dataType), f.nullable) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_renamed(kind.elementType), kind.containsNull)
    return kind


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Snake-case names, inside structs and arrays of structs too."""
    return df.select(*[F.col(f"`{f.name}`").cast(_renamed(f.dataType)).alias(snake_name(f.name)) for f in df.schema])


def sanitized_names(raw: Sequence[str | None]) -> list[str]:
    """Column names of letters, digits and single underscores, made unique by position."""
    names: list[str] = []
    for i, text in enumerate(raw):
        name = re.sub(r"[^a-zA-Z0-9]+", "_", (text or "").strip()).strip("_") or f"_col{i}"
        names.append(f"{name}_{i}" if name.lower() in {n.lower() for n in names} else name)
    return names


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitized_names(df.columns))


def json_stringify(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.to_json(F.col(c)) for c in cols})


def split_properties(df: DataFrame, props: str, standard: Sequence[str], out: str = "properties") -> DataFrame:
    """Known keys of a JSON object as struct fields, the rest as ``custom_properties``."""
    pairs = F.from_json(F.col(props), "map<string,string>")
    known = [F.try_element_at(F.col("_pairs"), F.lit(k)).alias(k) for k in standard]
    rest = F.map_filter(F.col("_pairs"), lambda k, v: ~k.isin(*standard)) if standard else F.col("_pairs")
    return df.withColumn("_pairs", pairs).withColumn(out, F.struct(*known, rest.alias("custom_properties"))).drop("_pairs")


def _blank(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.nullif(c, F.lit(""))
    if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.StringType):
        return F.transform_values(c, lambda k, v: F.nullif(v, F.lit("")))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_blank(c[f.name], f.dataType).alias(f.name) for f in kind]))
    return c


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty text to null, inside maps and structs too."""
    return df.select(*[_blank(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])


def _all_null(c: Column, kind: T.StructType) -> Column:
    tests = [
        _all_null(c[f.name], f.dataType) if isinstance(f.dataType, T.StructType) else c[f.name].isNull() for f in kind
    ]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def _drop_empty(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        inner = F.struct(*[_drop_empty(c[f.name], f.dataType).alias(f.name) for f in kind])
        return F.when(c.isNotNull() & ~_all_null(c, kind), inner)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return F.transform(c, lambda x: _drop_empty(x, kind.elementType))
    return c


def empty_struct_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Structs without any value to null, at every level."""
    return df.withColumns({c: _drop_empty(F.col(c), df.schema[c].dataType) for c in cols})


def coalesce_paths(df: DataFrame, out: str, raw: str, paths: Sequence[str]) -> DataFrame:
    """First value present at one of several paths of JSON text."""
    return df.withColumn(out, F.coalesce(*[F.get_json_object(F.col(raw), f"$.{p}") for p in paths]))


def _without_metadata(c: Column, kind: T.StructType) -> Column:
    kept = []
    for f in kind:
        if f.name.startswith("__"):
            continue
        if isinstance(f.dataType, T.StructType):
            names = f.dataType.fieldNames()
            if "__deferred" in names:
                continue
            if "__metadata" in names:
                kept.append(F.when(c[f.name].isNotNull(), _without_metadata(c[f.name], f.dataType)).alias(f.name))
                continue
        kept.append(c[f.name].alias(f.name))
    return F.struct(*kept)


def drop_metadata_keys(df: DataFrame) -> DataFrame:
    """Without ``__*`` fields and deferred links, inside expanded entities too."""
    row = F.struct(*df.columns)
    return df.select(_without_metadata(row, df.schema).alias("r")).select("r.*")


def with_context(df: DataFrame, **values: Any) -> DataFrame:
    """Stamp constant context columns (owner, shop, connection, ingestion time)."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})


def associations(c: Column, kind: T.DataType) -> Column:
    """Ids of an association list, given as ``{results: [{id}]}``, ``[{id}]`` or ``[id]``."""
    if isinstance(kind, T.StructType):
        c, kind = c["results"], kind["results"].dataType
    if isinstance(kind.elementType, T.StructType):
        ids = F.transform(c, lambda x: F.coalesce(x["id"].cast("string"), F.lit("")))
    else:
        ids = F.transform(c, lambda x: x.cast("string"))
    return F.coalesce(ids, F.array().cast("array<string>"))


# Response metadata that may sit among the answers.
RESPONSE_FIELDS = (
    "responseId",
    "recordedDate",
    "startDate",
    "endDate",
    "status",
    "ipAddress",
    "progress",
    "duration",
    "finished",
    "distributionChannel",
    "userLanguage",
    "locationLatitude",
    "locationLongitude",
)
ANSWER_META = (*RESPONSE_FIELDS, "surveyId", "_recordId")
ANSWER = "struct<choiceText:string,choiceId:string,textEntry:string>"


def question_values(c: Column) -> Column:
    """JSON text of a values map to ``map<question, answer struct>`` without metadata keys.

    A bare value becomes the text entry; a map with no question left is null.
    """
    pairs = F.map_filter(F.from_json(c, "map<string,string>"), lambda k, v: ~k.isin(*ANSWER_META))
    answer = lambda v: F.when(F.trim(v).startswith("{"), F.from_json(v, ANSWER)).otherwise(
        F.struct(
            F.lit(None).cast("string").alias("choiceText"),
            F.lit(None).cast("string").alias("choiceId"),
            v.alias("textEntry"),
        )
    )
    out = F.transform_values(pairs, lambda k, v: answer(v))
    return F.when(F.size(out) > 0, out)


def response_fields(df: DataFrame, raw: str, values: str = "values") -> DataFrame:
    """Simple response fields: top level first, then the values map; record id as a last resort."""

    def pick(name: str) -> Column:
        inner = F.get_json_object(raw, f"$.{values}.{name}")
        entry = F.when(
            F.trim(inner).startswith("{"), F.get_json_object(raw, f"$.{values}.{name}.textEntry")
        ).otherwise(inner)
        return F.coalesce(F.get_json_object(raw, f"$.{name}"), entry)

    picked = {snake_name(n): pick(n) for n in RESPONSE_FIELDS}
    picked["response_id"] = F.coalesce(F.nullif(picked["response_id"], F.lit("")), pick("_recordId"))
    return df.withColumns(picked)


def hybrid_record(df: DataFrame, typed: dict[str, Column], raw: str, extension_path: str = "extension") -> DataFrame:
    """Typed columns next to the full record and its extension part as JSON text."""
    cols = [c.alias(n) for n, c in typed.items()]
    return df.select(*cols, F.col(raw).alias("raw_json"), F.get_json_object(raw, f"$.{extension_path}").alias("extension"))


def extension_lookup(c: Column, url: str, by: str = "url") -> Column:
    """First array element whose key field equals ``url``."""
    return F.get(F.filter(c, lambda x: x[by] == url), F.lit(0))


def tag_extract(df: DataFrame, raw: str, tag_map: dict[str, tuple[str, str]]) -> DataFrame:
    """Columns out of JSON keyed by hex tag, by value representation.

    ``tag_map`` maps a tag to ``(name, form)``; ``form`` is ``text``, ``list``,
    ``long``, ``double`` or ``name``.  A bad number or missing value is null.
    """

    # one parse per record: only the tags' values, whatever the letter case of the tag
    keyed = df.withColumn("_tags", F.from_json(F.col(raw), "map<string,struct<Value:array<string>>>"))
    out = [F.col(c) for c in df.columns if c != raw]
    for tag, (name, form) in tag_map.items():
        spellings = [F.try_element_at("_tags", F.lit(w)) for w in dict.fromkeys((tag.upper(), tag.lower()))]
        values = F.coalesce(*spellings)["Value"]
        one = F.get(values, F.lit(0))
        if form == "list":
            col = F.when(F.size(values) > 0, values)
        elif form == "long":
            col = S.try_long(one)
        elif form == "double":
            col = S.try_double(one)
        elif form == "name":
            writings = F.from_json(one, "struct<Alphabetic:string,Ideographic:string,Phonetic:string>")
            col = F.when(F.trim(one).startswith("{"), S.person_name(writings)).otherwise(one)
        else:
            col = one
        out.append(col.alias(name))
    return keyed.select(*out)


STREAM_SET = (
    "struct<Items:array<struct<WebId:string,Items:array<struct<Timestamp:string,Value:string,Good:string,"
    "Questionable:string,Substituted:string,Annotated:string,UnitsAbbreviation:string>>>>>"
)


def recorded_values(df: DataFrame, raw: str) -> DataFrame:
    """Stream-set JSON to one row per recorded value; rows without a time are dropped."""
    streams = df.select(F.explode(F.from_json(F.col(raw), STREAM_SET)["Items"]).alias("s"))
    items = streams.where(F.col("s.WebId").isNotNull()).select(
        F.col("s.WebId").alias("tag_webid"), F.explode("s.Items").alias("i")
    )
    return items.where(F.col("i.Timestamp").isNotNull()).select(
        "tag_webid",
        S.parse_ts_any(F.col("i.Timestamp")).alias("timestamp"),
        S.try_double(F.col("i.Value")).alias("value"),
        S.as_bool(F.col("i.Good"), True).alias("good"),
        S.as_bool(F.col("i.Questionable"), False).alias("questionable"),
        S.as_bool(F.col("i.Substituted"), False).alias("substituted"),
        S.as_bool(F.col("i.Annotated"), False).alias("annotated"),
        F.coalesce(F.col("i.UnitsAbbreviation"), F.lit("")).alias("units"),
    )


def map_all_to_string(c: Column) -> Column:
    return F.transform_values(c, lambda k, v: F.coalesce(v.cast("string"), F.lit("")))


def get_path(df: DataFrame, path: str, out: str) -> DataFrame:
    """Dotted access; null where the schema has no such field."""
    value = F.col(path) if has_path(df.schema, path) else F.lit(None).cast("string")
    return df.withColumn(out, value)


def set_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    """Write a dotted field, creating the structs in between."""
    head, *rest = path.split(".")
    if not rest:
        return df.withColumn(head, value)

    def put(parts: list[str], kind: T.DataType | None, at: Column | None) -> Column:
        name, *more = parts
        old = kind if isinstance(kind, T.StructType) else T.StructType()
        fields = []
        for f in old:
            if f.name != name:
                fields.append(at[f.name].alias(f.name))
        inner_kind = old[name].dataType if name in old.fieldNames() else None
        inner_at = at[name] if inner_kind is not None else None
        new = put(more, inner_kind, inner_at) if more else value
        return F.struct(*fields, new.alias(name))

    kind = df.schema[head].dataType if head in df.columns else None
    return df.withColumn(head, put(rest, kind, F.col(head) if kind is not None else None))


def hoist(df: DataFrame, source: str, out: str, prefix: str = "", parts: Sequence[str] = ()) -> DataFrame:
    """Lift a nested field and build a derived text of it."""
    value = F.col(source).cast("string")
    if parts:
        value = F.concat_ws("/", *[F.col(p).cast("string") for p in parts], value)
    return df.withColumn(out, F.concat(F.lit(prefix), value))


def survey_definition(df: DataFrame, raw: str, simple: Sequence[str], blocks: Sequence[str], cursor: str, since: Any) -> DataFrame:
    """Simple fields kept, nested blocks as JSON text, unchanged definitions skipped."""
    out = [F.get_json_object(raw, f"$.{n}").alias(snake_name(n)) for n in simple]
    out += [F.get_json_object(raw, f"$.{n}").alias(snake_name(n)) for n in blocks]
    changed = df.select(*out)
    if since is None:
        return changed
    at = S.parse_ts_any(F.col(snake_name(cursor)))
    return changed.where(at.isNull() | (at > F.lit(since).cast("timestamp")))


def select_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """A caller-chosen column list; nested paths allowed, unknown ones rejected."""
    unknown = [f for f in fields if not has_path(df.schema, f)]
    if unknown:
        raise ValueError(f"unknown fields {unknown}")
    return df.select(*[F.col(f).alias(f.replace(".", "_")) for f in fields])


def typed_from_json(df: DataFrame, raw: str, schema: T.StructType) -> DataFrame:
    """Typed columns of a JSON record by the coercion rules."""
    record = coerce_value(F.col(raw), T.StringType(), schema)
    return df.select(record.alias("r")).select("r.*")
