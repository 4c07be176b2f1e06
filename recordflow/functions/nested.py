"""Nested values: maps, records, arrays, semi-structured text, and schema-driven conversion."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.functions import casts
from recordflow.functions.timestamps import DEFAULT_TIMESTAMP_PATTERN, cast_date, cast_timestamp, is_blank


def to_byte_array(c: Column, data_type: T.DataType, charset: str = "UTF-8") -> Column:
    """Text or binary as an array of signed bytes; arrays pass through."""
    if isinstance(data_type, T.ArrayType):
        return c
    raw = c if isinstance(data_type, T.BinaryType) else F.encode(c, charset)
    h = F.hex(raw)
    at = lambda i: F.conv(F.substring(h, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
    signed = lambda i: F.when(at(i) > 127, at(i) - 256).otherwise(at(i)).cast("tinyint")
    cells = F.transform(F.sequence(F.lit(0), F.octet_length(raw) - 1), signed)
    return F.when(F.octet_length(raw) == 0, F.array().cast("array<tinyint>")).otherwise(cells)


def json_to_array(c: Column, element: str = "string") -> Column:
    return F.from_json(c, f"array<{element}>")


def to_map(c: Column, data_type: T.DataType, value_type: str = "string") -> Column:
    """Struct or map as a map with text keys."""
    if isinstance(data_type, T.MapType):
        return F.map_from_entries(
            F.transform(F.map_entries(c), lambda e: F.struct(e["key"].cast("string"), e["value"].cast(value_type)))
        )
    cells = []
    for f in data_type.fields:
        cells += [F.lit(f.name), c.getField(f.name).cast(value_type)]
    return F.when(c.isNotNull(), F.create_map(*cells))


def deep_to_map(c: Column, data_type: T.DataType) -> Column:
    """Struct to map all the way down; scalars and mixed values are kept as JSON text."""
    if not isinstance(data_type, T.StructType):
        return c.cast("string")
    cells = []
    for f in data_type.fields:
        v = c.getField(f.name)
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        cells += [F.lit(f.name), F.to_json(v) if nested else v.cast("string")]
    return F.when(c.isNotNull(), F.create_map(*cells))


def to_record(c: Column, schema: T.StructType) -> Column:
    """Text map to a struct by schema: unknown keys are dropped, values cast, missing ones null."""
    fields = [conform(F.try_element_at(c, F.lit(f.name)), T.StringType(), f.dataType).alias(f.name) for f in schema.fields]
    return F.when(c.isNotNull(), F.struct(*fields))


def record_compatible(c: Column, data_type: T.StructType, schema: T.StructType, strict: bool = False) -> Column:
    """True where a nested record fits ``schema``: required fields present, text values convertible."""
    known = {f.name: f for f in data_type.fields}
    if strict and set(known) - {f.name for f in schema.fields}:
        return F.lit(False)
    ok = c.isNotNull()
    for f in schema.fields:
        if f.name not in known:
            ok = ok & F.lit(f.nullable)
            continue
        v, have = c.getField(f.name), known[f.name].dataType
        if isinstance(f.dataType, T.StructType):
            fits = record_compatible(v, have, f.dataType, strict)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(have, T.ArrayType):
            element = f.dataType.elementType
            fits = F.forall(v, lambda x: x.isNull() | _fits(x, have.elementType, element))
        else:
            fits = _fits(v, have, f.dataType)
        ok = ok & F.when(v.isNull(), F.lit(f.nullable)).otherwise(fits)
    return F.coalesce(ok, F.lit(False))


def _fits(v: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(have, T.StringType):
        return casts.is_compatible(v, want.simpleString())
    return v.try_cast(want).isNotNull()


# ---------------------------------------------------------------- inference
_TYPE_WORD = re.compile(r"(`(?:[^`]|``)*`)|(?:^|(?<=: )|(?<=ARRAY<))(OBJECT|VOID|VARIANT)(?![\w$])")


def infer_nested_schema(df: DataFrame, column: str) -> str:
    """DDL type of a JSON text column, merged over all rows (one aggregate, one value to the driver)."""
    row = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column))).alias("s")).first()
    return variant_schema_to_ddl(row["s"])


def variant_schema_to_ddl(text: str) -> str:
    """``OBJECT<k: BIGINT>`` as ``struct<`k`:BIGINT>``; VOID and mixed types become text.

    Only type words are replaced: those at the start, after a field's colon or
    inside ``ARRAY<``; quoted names are passed over.
    """
    words = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}
    return _TYPE_WORD.sub(lambda m: m[1] or words[m[2]], text)


def expand_nested(df: DataFrame, column: str, ddl: str | None = None, prefix: str | None = None) -> DataFrame:
    """Typed columns ``<prefix>_<field>`` in place of a JSON text column."""
    ddl = ddl or infer_nested_schema(df, column)
    if not ddl.upper().startswith(("STRUCT<", "ARRAY<", "MAP<")):
        return df  # no row holds an object or a list: it stays text
    prefix = column if prefix is None else prefix
    parsed = df.withColumn(column, F.from_json(column, ddl))
    dt = parsed.schema[column].dataType
    if not isinstance(dt, T.StructType):
        return parsed
    cells = [F.col(column).getField(f.name).alias(f"{prefix}_{f.name}") for f in dt.fields]
    return parsed.select(*[F.col(c) for c in parsed.columns if c != column], *cells)


# --------------------------------------------------------- schema conversion
def conform(c: Column, have: T.DataType, want: T.DataType, pattern: str = DEFAULT_TIMESTAMP_PATTERN,
            hours: int = 0, symbols: list[str] | None = None) -> Column:
    """Convert a value to ``want``, descending into structs, arrays and maps.

    Text goes through the guarded casts, decimals round half-up, timestamps
    use the pattern and the hour shift at every depth.
    """
    if isinstance(want, T.StructType):
        if isinstance(have, T.MapType):
            return F.when(c.isNotNull(), F.struct(*[
                conform(F.try_element_at(c, F.lit(f.name)), have.valueType, f.dataType, pattern, hours).alias(f.name)
                for f in want.fields
            ]))
        known = {f.name: f.dataType for f in have.fields}
        cells = []
        for f in want.fields:
            if f.name in known:
                v = conform(c.getField(f.name), known[f.name], f.dataType, pattern, hours,
                            (f.metadata or {}).get("symbols"))
            else:
                v = F.lit(None).cast(f.dataType)
            cells.append(_with_default(v, f).alias(f.name))
        return F.when(c.isNotNull(), F.struct(*cells))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(c, lambda x: conform(x, have.elementType, want.elementType, pattern, hours))
    if isinstance(want, T.MapType):
        if isinstance(have, T.StructType):
            return to_map(c, have, want.valueType.simpleString())
        if isinstance(have, T.MapType):
            return F.transform_values(c, lambda k, v: conform(v, have.valueType, want.valueType, pattern, hours))
    if symbols:
        return casts.to_enum(c.cast("string"), symbols)
    if isinstance(want, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(have, T.StringType):
            return cast_timestamp(c, pattern, hours).cast(want)
        from recordflow.functions.timestamps import add_hours, from_epoch_millis

        base = from_epoch_millis(c.cast("bigint")) if isinstance(have, T.NumericType) else c.cast("timestamp_ntz")
        return add_hours(base, hours).cast(want)
    if isinstance(want, T.DateType) and isinstance(have, T.StringType):
        return cast_date(c)
    if isinstance(want, (T.VarcharType, T.CharType)):
        return casts.to_varchar(casts.to_text(c, have), want.length)
    if isinstance(want, T.BinaryType):
        return c if isinstance(have, T.BinaryType) else F.encode(c.cast("string"), "UTF-8")
    if isinstance(want, T.StringType):
        return casts.to_text(c, have)
    if isinstance(have, T.StringType):
        return casts.caster(want.simpleString())(c)
    if isinstance(want, T.DecimalType) and isinstance(have, (T.DoubleType, T.FloatType)):
        # through the decimal text of the number, not its binary expansion
        return c.cast("string").try_cast(want)
    return c.try_cast(want)


def _with_default(value: Column, field: T.StructField) -> Column:
    default = (field.metadata or {}).get("default")
    return value if default is None else F.coalesce(value, F.lit(default).cast(field.dataType))


# ------------------------------------------------- conversion that keeps its errors
def _let(value: Column, body) -> Column:
    """``body`` over a value that is evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _text_of(c: Column, have: T.DataType) -> Column:
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(c)
    return F.hex(c) if isinstance(have, T.BinaryType) else c.cast("string")


def _checked(value: Column, rejects: Column) -> Column:
    return F.struct(value.alias("value"), rejects.cast(casts.REJECT_TYPE).alias("rejects"))


def _entry(path: Column, text: Column, reason: str) -> Column:
    return F.array(F.struct(path.alias("column"), text.alias("value"), F.lit(reason).alias("reason")))


def _merged(parts: list[tuple[str, Column]], whole) -> Column:
    """Checked parts to one checked value: ``whole`` builds it from the parts' values, rejects are put together."""
    if not parts:
        return _checked(whole({}), F.array())
    places = [f"p{i}" for i in range(len(parts))]
    bound = F.struct(*[c.alias(p) for p, (_, c) in zip(places, parts)])
    return _let(bound, lambda b: _checked(
        whole({n: b[p]["value"] for p, (n, _) in zip(places, parts)}), F.concat(*[b[p]["rejects"] for p in places])
    ))


def conform_checked(c: Column, have: T.DataType, want: T.DataType, path: Column, pattern: str = DEFAULT_TIMESTAMP_PATTERN,
                    hours: int = 0, symbols: list[str] | None = None) -> Column:
    """:func:`conform` as a struct of the ``value`` and its ``rejects``, at every depth.

    An entry names the path of the bad value (``s.n``, ``a[3].n``, ``m['key']``),
    its text and the reason.  A bad part is null in the value, the parts beside it
    stay.  Blank text for a timestamp or date is null and no error.  A part that
    must not be null and is missing is an error; a default stands in for a missing
    part, not for a bad one.
    """
    nothing = _checked(F.lit(None).cast(want), F.array())
    deeper = lambda v, old, new, at, marks=None: conform_checked(v, old, new, at, pattern, hours, marks)
    known = {f.name: f.dataType for f in have.fields} if isinstance(have, T.StructType) else {}
    if isinstance(want, T.StructType) and isinstance(have, (T.StructType, T.MapType)):
        parts = []
        for f in want.fields:
            at = F.concat(path, F.lit(f".{f.name}"))
            if isinstance(have, T.MapType):
                part = deeper(F.try_element_at(c, F.lit(f.name).cast(have.keyType)), have.valueType, f.dataType, at, (f.metadata or {}).get("symbols"))
            elif f.name in known:
                part = deeper(c.getField(f.name), known[f.name], f.dataType, at, (f.metadata or {}).get("symbols"))
            else:
                part = _checked(F.lit(None).cast(f.dataType), F.array())
            parts.append((f.name, _completed(part, f, at)))
        made = _merged(parts, lambda values: F.struct(*[values[f.name].alias(f.name) for f in want.fields]).cast(_loose(want)))
        return F.when(c.isNotNull(), made).otherwise(_checked(F.lit(None).cast(_loose(want)), F.array()))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        at = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        each = F.transform(c, lambda x, i: deeper(x, have.elementType, want.elementType, at(i)))
        return F.when(c.isNotNull(), _let(each, lambda e: _checked(
            F.transform(e, lambda x: x["value"]), F.flatten(F.transform(e, lambda x: x["rejects"]))
        ))).otherwise(_checked(F.lit(None).cast(T.ArrayType(_loose(want.elementType))), F.array()))
    if isinstance(want, T.MapType) and isinstance(have, (T.StructType, T.MapType)):
        at = lambda k: F.concat(path, F.lit("['"), k.cast("string"), F.lit("']"))
        if isinstance(have, T.StructType):
            parts = [(n, deeper(c.getField(n), t, want.valueType, at(F.lit(n)))) for n, t in known.items()]
            made = _merged(parts, lambda values: F.map_from_arrays(
                F.array(*[F.lit(n) for n in values]).cast(T.ArrayType(want.keyType)), F.array(*values.values())))
        else:
            each = F.transform(F.map_entries(c), lambda e: F.struct(
                e["key"].cast(want.keyType).alias("key"), deeper(e["value"], have.valueType, want.valueType, at(e["key"])).alias("part")))
            made = _let(each, lambda e: _checked(
                F.map_from_entries(F.transform(e, lambda x: F.struct(x["key"], x["part"]["value"]))),
                F.flatten(F.transform(e, lambda x: x["part"]["rejects"]))))
        return F.when(c.isNotNull(), made).otherwise(_checked(F.lit(None).cast(T.MapType(want.keyType, _loose(want.valueType))), F.array()))
    nested = (T.StructType, T.ArrayType, T.MapType)
    reason = f"not a valid {want.simpleString()}"
    if isinstance(want, nested) or isinstance(have, nested) and not isinstance(want, T.StringType):
        return F.when(c.isNotNull(), _checked(F.lit(None).cast(want), _entry(path, _text_of(c, have), reason))).otherwise(nothing)
    text_time = isinstance(have, T.StringType) and isinstance(want, (T.TimestampType, T.TimestampNTZType, T.DateType))
    blank = is_blank(c) if text_time else F.lit(False)
    value = conform(c, have, want, pattern, hours, symbols)
    return _let(value, lambda v: _checked(
        v, F.when(c.isNotNull() & v.isNull() & ~blank, _entry(path, _text_of(c, have), reason)).otherwise(F.array().cast(casts.REJECT_TYPE))
    ))


def _loose(data_type: T.DataType) -> T.DataType:
    """The type with nulls allowed at every depth, as rejected parts are null."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType), True, f.metadata) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_loose(data_type.elementType))
    if isinstance(data_type, T.MapType):
        return T.MapType(data_type.keyType, _loose(data_type.valueType))
    return data_type


def _completed(part: Column, field: T.StructField, path: Column) -> Column:
    """A checked part with its default where it is missing, and an error where it must not be."""
    default = (field.metadata or {}).get("default")
    if default is None and field.nullable:
        return part
    missing = lambda p: p["value"].isNull() & (F.size(p["rejects"]) == 0)
    if default is not None:
        return _let(part, lambda p: _checked(F.when(missing(p), F.lit(default).cast(field.dataType)).otherwise(p["value"]), p["rejects"]))
    absent = _entry(path, F.lit(None).cast("string"), "must not be null")
    return _let(part, lambda p: _checked(p["value"], F.when(missing(p), absent.cast(casts.REJECT_TYPE)).otherwise(p["rejects"])))


CHECKED = "_checked_"


def conform_to_schema(df: DataFrame, schema: T.StructType, patterns: dict[str, str] | None = None,
                      hours: int = 0) -> DataFrame:
    """Whole table to a target schema, plus ``_rejects`` with every bad value at any depth.

    Extra columns are dropped, missing ones null or default; each column is
    converted once.  ``casts.split_rejects`` parts accepted rows from rejected ones.
    """
    patterns = patterns or {}
    have = {f.name: f.dataType for f in df.schema.fields}
    made = {}
    for f in schema.fields:
        if f.name in have:
            part = conform_checked(F.col(f"`{f.name}`"), have[f.name], f.dataType, F.lit(f.name),
                                   patterns.get(f.name, DEFAULT_TIMESTAMP_PATTERN), hours, (f.metadata or {}).get("symbols"))
        else:
            part = _checked(F.lit(None).cast(f.dataType), F.array())
        made[CHECKED + f.name] = _completed(part, f, F.lit(f.name))
    once = casts.evaluate_once(df, made)
    part = lambda f: F.col(f"`{CHECKED}{f.name}`")
    found = [part(f)["rejects"] for f in schema.fields]
    if casts.REJECTS in df.columns:
        found.insert(0, F.col(casts.REJECTS))
    return once.select(*[part(f)["value"].alias(f.name, metadata=f.metadata or {}) for f in schema.fields],
                       casts.collect_rejects(found).alias(casts.REJECTS))


def to_record_checked(c: Column, schema: T.StructType, name: str) -> Column:
    """:func:`to_record` as a struct of the ``value`` and its ``rejects``."""
    return conform_checked(c, T.MapType(T.StringType(), T.StringType()), schema, F.lit(name))
