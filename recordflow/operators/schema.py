"""Column names, schema widening, drift and defaults: plan-time work that ends in one ``select``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

ALIASES, DEFAULT = "aliases", "default"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# --------------------------------------------------------------------- names
def lowercase_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def match_name(name: str) -> str:
    """Comparison form of a column name: upper-case without underscores."""
    return name.upper().replace("_", "")


def translate_names(df: DataFrame, target_columns: list[str], unmatched: str = "ignore") -> DataFrame:
    """Rename to the target's spelling; unmatched input columns are dropped or refused."""
    wanted = {match_name(t): t for t in target_columns}
    missing = [c for c in df.columns if match_name(c) not in wanted]
    if missing and unmatched == "fail":
        raise ValueError(f"columns not in the target: {missing}")
    picked = [_c(c).alias(wanted[match_name(c)]) for c in df.columns if match_name(c) in wanted]
    if not picked:
        raise ValueError("no input column matches the target")
    return df.select(*picked)


def plain_name(name: str) -> str:
    """ASCII letters, digits and underscores only; a leading digit gets an underscore in front."""
    out = re.sub(r"[^A-Za-z0-9_]", "_", name)
    return "_" + out if out[:1].isdigit() else out


def valid_field_name(name: str) -> str:
    """Unicode letters and digits allowed; a bad first character is replaced; empty gets a fixed name."""
    if not name:
        return "UNNAMED_FIELD"
    first = name[0] if name[0] == "_" or name[0].isalpha() else "_"
    return first + "".join(ch if ch == "_" or ch.isalnum() else "_" for ch in name[1:])


def normalize_names(df: DataFrame, variant: str = "ascii") -> DataFrame:
    """Rename columns; the ``unicode`` variant keeps the old name as an alias in the metadata."""
    if variant == "ascii":
        return df.toDF(*[plain_name(c) for c in df.columns])
    out = []
    for f in df.schema.fields:
        new, meta = valid_field_name(f.name), dict(f.metadata or {})
        if new != f.name:
            meta[ALIASES] = [*meta.get(ALIASES, []), f.name]
        out.append(_c(f.name).alias(new, metadata=meta))
    return df.select(*out)


def _aliases(field: T.StructField) -> list[str]:
    return list((field.metadata or {}).get(ALIASES, []))


def find_column(df: DataFrame, wanted: T.StructField) -> str | None:
    """Input column for a target field: by name, by the input's aliases, by the target's aliases."""
    if wanted.name in df.columns:
        return wanted.name
    for f in df.schema.fields:
        if wanted.name in _aliases(f):
            return f.name
    for alias in _aliases(wanted):
        if alias in df.columns:
            return alias
        for f in df.schema.fields:
            if alias in _aliases(f):
                return f.name
    return None


def alias_lookup(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One column per target field, found by name or alias; absent ones are null."""
    cells = []
    for f in schema.fields:
        found = find_column(df, f)
        cells.append((_c(found) if found else F.lit(None).cast(f.dataType)).alias(f.name, metadata=f.metadata or {}))
    return df.select(*cells)


def default_fill(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Null or absent fields get the schema's default, converted to the field type."""
    cells = [_c(c) for c in df.columns if c not in schema.fieldNames()]
    for f in schema.fields:
        value = _c(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)
        default = (f.metadata or {}).get(DEFAULT)
        if default is not None:
            value = F.coalesce(value, F.lit(default).cast(f.dataType))
        cells.append(value.alias(f.name))
    return df.select(*cells)


def nested_record_extract(df: DataFrame, path: str) -> DataFrame:
    """Replace each row by the record, or the records of the array, at ``path``."""
    try:
        dt = df.select(F.col(path).alias("x")).schema["x"].dataType
    except Exception as e:
        raise ValueError(f"path {path!r} is not in the input") from e
    if isinstance(dt, T.StructType):
        return df.select(F.col(path).alias("x")).select("x.*")
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        return df.select(F.inline(F.col(path)))
    raise ValueError(f"{path!r} holds {dt.simpleString()}, not records")


# ------------------------------------------------------------------ widening
_INTS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both, or None when only a union of the two would.

    Whole numbers widen among themselves and yield to float, double and
    decimal in that order; two decimals take the larger precision and scale.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _INTS and b in _INTS:
        return max(a, b, key=_INTS.index)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return T.DecimalType(max(a.precision, b.precision), max(a.scale, b.scale))
    numbers = (*[type(t) for t in _INTS], T.FloatType, T.DoubleType, T.DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        rank = lambda t: 0 if t in _INTS else [T.FloatType, T.DoubleType, T.DecimalType].index(type(t)) + 1
        return max(a, b, key=rank)
    texts = (T.StringType, T.CharType, T.VarcharType)
    if isinstance(a, texts) and isinstance(b, texts):
        return T.StringType()
    return None


def _meta(a: T.StructField, b: T.StructField) -> dict:
    meta = dict(b.metadata or {})
    meta.update(a.metadata or {})
    names = list(dict.fromkeys([*_aliases(a), *_aliases(b), *([b.name] if b.name != a.name else [])]))
    if names:
        meta[ALIASES] = names
    return meta


def merge_schemas(a: T.StructType, b: T.StructType, mixed: str = "string") -> tuple[T.StructType, dict[str, str]]:
    """(merged schema, name in ``b`` -> name in the result); nullable if either side is or lacks the field."""
    fields, renames, used = [], {}, set()
    for fa in a.fields:
        match = next((f for f in b.fields if f.name == fa.name), None) or next(
            (f for f in b.fields if f.name not in used and (f.name in _aliases(fa) or fa.name in _aliases(f)
                                                             or set(_aliases(fa)) & set(_aliases(f)))), None)
        if match is None:
            fields.append(T.StructField(fa.name, fa.dataType, True, fa.metadata))
            continue
        used.add(match.name)
        renames[match.name] = fa.name
        wide = wider_type(fa.dataType, match.dataType)
        if wide is None:
            wide = T.VariantType() if mixed == "variant" else T.StringType()
        fields.append(T.StructField(fa.name, wide, fa.nullable or match.nullable, _meta(fa, match)))
    for fb in b.fields:
        if fb.name not in used:
            renames[fb.name] = fb.name
            fields.append(T.StructField(fb.name, fb.dataType, True, fb.metadata))
    return T.StructType(fields), renames


def _widen(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return c
    if isinstance(want, T.DecimalType) and isinstance(have, (T.FloatType, T.DoubleType)):
        return c.cast("string").cast(want)
    return c.cast(want)


def union_widened(a: DataFrame, b: DataFrame, mixed: str = "string") -> DataFrame:
    """UNION ALL of two tables with different schemas; a value that does not fit its wider type is an error."""
    schema, renames = merge_schemas(a.schema, b.schema, mixed)
    back = {v: k for k, v in renames.items()}

    def side(df: DataFrame, names: dict[str, str]) -> DataFrame:
        have = {f.name: f.dataType for f in df.schema.fields}
        cells = []
        for f in schema.fields:
            n = names.get(f.name)
            value = _widen(_c(n), have[n], f.dataType) if n in have else F.lit(None).cast(f.dataType)
            cells.append(value.alias(f.name, metadata=f.metadata or {}))
        return df.select(*cells)

    return side(a, {n: n for n in a.columns}).unionAll(side(b, back))


# --------------------------------------------------------------------- drift
def missing_columns(target: T.StructType, incoming: T.StructType, lowercase: bool = False) -> list[T.StructField]:
    have = set(target.fieldNames())
    fields = [T.StructField(f.name.lower() if lowercase else f.name, f.dataType, True) for f in incoming.fields]
    return [f for f in fields if f.name not in have]


def schema_drift_add_columns(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """The target with each incoming column it lacks added as a null column of that type."""
    extra = missing_columns(target.schema, incoming.schema)
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])


def add_columns_ddl(table: str, target: T.StructType, incoming: T.StructType) -> str | None:
    """``ALTER TABLE`` text for a catalog table, or None when nothing is missing."""
    extra = missing_columns(target, incoming)
    if not extra:
        return None
    return f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in extra)})"


def check_columns(incoming: list[str], target: list[str], required: list[str] = (), extra: str = "ignore",
                  missing: str = "fail") -> list[str]:
    """Columns to write: extra input columns are ignored or refused, missing required ones ignored, warned or refused."""
    wanted = {match_name(t): t for t in target}
    kept = [c for c in incoming if match_name(c) in wanted]
    unknown = [c for c in incoming if match_name(c) not in wanted]
    if unknown and extra == "fail":
        raise ValueError(f"columns not in the target: {unknown}")
    if not kept:
        raise ValueError("no input column matches the target")
    absent = [r for r in required if match_name(r) not in {match_name(c) for c in kept}]
    if absent and missing == "fail":
        raise ValueError(f"required columns missing from the input: {absent}")
    if absent and missing == "warn":
        import warnings

        warnings.warn(f"required columns missing from the input: {absent}", stacklevel=2)
    return kept
