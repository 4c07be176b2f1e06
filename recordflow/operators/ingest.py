"""Input rows to typed rows of a target table, with every reason a row cannot be written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from recordflow.functions import timestamps as ts
from recordflow.functions.casts import VALUE, evaluate_once, reject_entry, replace_checked
from recordflow.functions.nested import CHECKED, conform, conform_checked
from recordflow.operators.schema import lowercase_names

TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
NESTED = (T.StructType, T.ArrayType, T.MapType)


def _pattern(field: T.StructField, source: T.StructField, patterns: dict[str, str], default: str | None) -> str:
    own = patterns.get(source.name) or default or (source.metadata or {}).get("format")
    if own:
        return own
    return ts.DEFAULT_DATE_PATTERN if isinstance(field.dataType, T.DateType) else ts.DEFAULT_TIMESTAMP_PATTERN


def to_target_rows(df: DataFrame, target: T.StructType, keys: list[str] = (), patterns: dict[str, str] | None = None,
                   default_pattern: str | None = None, hours: int = 0, lowercase: bool = False,
                   order: list[str] = (), converters: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Columns of the target, converted to its types, plus the ``order`` columns and ``_rejects``.

    Input columns the target lacks are dropped and target columns the input
    lacks are left out.  A value that does not convert is rejected, inside records,
    lists and maps as well, and so is a null in a key or a column that must not be
    null.  Timestamps are parsed by the column's pattern and shifted by whole
    hours; dates are not shifted.  ``converters`` are applied to their input
    columns first.
    """
    patterns = patterns or {}
    if converters:
        df = df.withColumns({n: convert(F.col(f"`{n}`")) for n, convert in converters.items()})
    sources = list(df.schema.fields)
    if lowercase:
        df = lowercase_names(df)
    by_name = {f.name: (f, s) for f, s in zip(df.schema.fields, sources)}
    shared = [f for f in target.fields if f.name in by_name]
    extra = [c for c in order if c not in {f.name for f in shared}]
    made, entries, nested = {}, [], {}
    for field in shared:
        name, c = field.name, F.col(f"`{field.name}`")
        have, source = by_name[name]
        want, text = field.dataType, isinstance(have.dataType, T.StringType)
        if have.dataType != want or isinstance(want, TIMES) and hours:
            pattern = _pattern(field, source, patterns, default_pattern)
            if isinstance(want, NESTED):
                nested[CHECKED + name] = conform_checked(c, have.dataType, want, F.lit(name), pattern, hours)
                made[name] = F.col(f"`{CHECKED}{name}`")["value"]
                entries.append(F.col(f"`{CHECKED}{name}`")["rejects"])
            elif isinstance(want, T.DateType) and text:
                made[name] = ts.cast_date(c, pattern)
            else:
                made[name] = conform(c, have.dataType, want, pattern, 0 if isinstance(want, T.DateType) else hours)
            blank = ts.is_blank(c) if text and isinstance(want, TIMES) else F.lit(isinstance(want, NESTED))
            bad = c.isNotNull() & F.col(f"`{VALUE}{name}`").isNull() & ~blank
            entries.append(reject_entry(name, c, bad, f"not a valid {want.simpleString()}"))
        if name in keys or not field.nullable:
            # a blank timestamp is null as well
            value = F.col(f"`{VALUE}{name}`") if name in made and isinstance(want, TIMES) else c
            missing = value.isNull() & (c.isNull() | (ts.is_blank(c) if text else F.lit(False)))
            entries.append(reject_entry(name, c, missing, "must not be null"))
    picked = df.select(*[F.col(f"`{f.name}`") for f in shared], *[F.col(f"`{c}`") for c in extra])
    done = replace_checked(evaluate_once(picked, nested), made, entries)
    return done.drop(*nested)
