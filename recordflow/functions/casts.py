"""Typed conversion of text and numbers, as Column expressions.

Every ``to_*`` builder returns null where the value cannot be converted, so
one expression serves three uses:

* strict: :func:`convert` collects a reject entry for each value that is
  present but not convertible;
* soft: :func:`soft_columns` keeps the original text beside the typed value;
* test: :func:`is_compatible` answers without converting.

Spark's own string casts trim and accept more than we want (``' 12 '``,
``'yes'``), so each builder guards the text with a pattern before ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# --- fixed values: accepted text grammars ---------------------------------
INTEGER_PATTERN = r"\A[+-]?[0-9]+\z"
DECIMAL_PATTERN = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
# conversion accepts surrounding blanks and a type suffix ...
DOUBLE_PATTERN = (
    r"\A[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)\z"
)
# ... while the compatibility test accepts the bare number only
BARE_DOUBLE_PATTERN = (
    r"\A[+-]?(Infinity|NaN|[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?)\z"
)
# a sign is only allowed on plain decimals, not on exponent or leading-dot forms
BARE_DECIMAL_PATTERN = (
    r"\A([+-]?[0-9]+(\.[0-9]*)?|[0-9]+(\.[0-9]*)?[eE][+-]?[0-9]+|\.[0-9]+([eE][+-]?[0-9]+)?)\z"
)
UUID_PATTERN = r"\A[0-9a-fA-F]{1,8}(-[0-9a-fA-F]{1,4}){3}-[0-9a-fA-F]{1,12}\z"

# whitespace and control characters stripped from both ends before parsing
BLANKS = "".join(chr(i) for i in range(33))

REJECTS = "_rejects"
REJECT_TYPE = T.ArrayType(
    T.StructType([
        T.StructField("column", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType()),
    ])
)


def strip_blanks(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def guarded(text: Column, pattern: str, value: Column) -> Column:
    return F.when(text.rlike(pattern), value)


# ---------------------------------------------------------------- from text
def to_boolean(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def to_integer(text: Column, type_name: str = "int") -> Column:
    """``tinyint``, ``smallint``, ``int`` or ``bigint`` from text, range-checked."""
    return guarded(text, INTEGER_PATTERN, text.try_cast(type_name))


def to_bigint_unbounded(text: Column) -> Column:
    """Whole number of up to 38 digits; longer ones stay text (null here)."""
    return guarded(text, INTEGER_PATTERN, text.try_cast("decimal(38,0)"))


def to_double(text: Column, type_name: str = "double") -> Column:
    t = strip_blanks(text)
    return guarded(t, DOUBLE_PATTERN, t.try_cast(type_name))


def to_float(text: Column) -> Column:
    return to_double(text, "float")


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    """Rounded half-up to ``scale``; null when the digits do not fit."""
    return guarded(text, DECIMAL_PATTERN, text.try_cast(f"decimal({precision},{scale})"))


def to_char(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.substring(text, 1, 1))


def to_enum(text: Column, symbols: list[str]) -> Column:
    return F.when(text.isin(symbols), text)


def to_varchar(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def to_uuid(text: Column) -> Column:
    """Canonical lower-case UUID; short groups are left-padded with zeros."""
    parts = F.split(text, "-")
    widths = (8, 4, 4, 4, 12)
    padded = [F.lpad(F.get(parts, F.lit(i)), w, "0") for i, w in enumerate(widths)]
    return guarded(text, UUID_PATTERN, F.lower(F.concat_ws("-", *padded)))


def uuid_from_bytes(b: Column) -> Column:
    """UUID text from the first sixteen bytes; null when there are fewer."""
    h = F.lower(F.hex(b))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.when(F.octet_length(b) >= 16, F.concat_ws("-", *[F.substring(h, s, n) for s, n in cuts]))


def uuid_to_bytes(text: Column) -> Column:
    return F.unhex(F.replace(to_uuid(text), F.lit("-"), F.lit("")))


def to_binary(text: Column, charset: str = "UTF-8") -> Column:
    return F.encode(text, charset)


def binary_decode(text: Column, encoding: str = "ascii") -> Column:
    """Bytes from text written as plain ascii, hex or base64."""
    if encoding in ("", "ascii"):
        # characters outside ASCII become '?'
        return F.encode(F.regexp_replace(text, r"[^\x00-\x7F]", "?"), "US-ASCII")
    if encoding == "hex":
        return F.when(
            (F.length(text) % 2 == 0) & text.rlike(r"\A[0-9a-fA-F]*\z"), F.unhex(text)
        )
    if encoding == "base64":
        return F.try_to_binary(text, F.lit("base64"))
    raise ValueError(f"unknown binary encoding {encoding!r}")


# -------------------------------------------------------------- from numbers
def wrap_integer(number: Column, bits: int) -> Column:
    """Keep the low ``bits`` (8 or 16) of a whole number as a signed value."""
    type_name = {8: "tinyint", 16: "smallint"}[bits]
    half, full = 1 << (bits - 1), 1 << bits
    low = number.cast("bigint").bitwiseAND(F.lit(full - 1))
    return F.when(low >= half, low - F.lit(full)).otherwise(low).cast(type_name)


def int_from_number(number: Column) -> Column:
    """Truncate to a whole number; null when it leaves the 32-bit range."""
    return number.try_cast("bigint").try_cast("int")


def decimal_from_bytes(b: Column, scale: int) -> Column:
    """Unscaled big-endian two's-complement bytes to a decimal; null beyond 38 digits.

    Bytes in front of the last sixteen must repeat the sign.  High and low
    half are read as integers, and the point is set in the digits, so nothing
    is rounded.
    """
    h = F.hex(b)
    width = F.octet_length(b)
    sign = F.when(F.conv(F.substring(h, 1, 1), 16, 10).cast("int") >= 8, "F").otherwise("0")
    full = F.concat(F.repeat(sign, F.greatest(32 - 2 * width, F.lit(0))), h)
    size = F.length(full)
    extends = F.substring(full, F.lit(1), size - 32) == F.repeat(sign, size - 32)
    last = F.substring(full, size - 31, F.lit(32))
    high = F.conv(F.substring(last, 1, 16), 16, -10).try_cast("decimal(38,0)")
    low = F.conv(F.substring(last, 17, 16), 16, 10).try_cast("decimal(38,0)")
    unscaled = F.try_add(F.try_multiply(high, F.lit(str(1 << 64)).cast("decimal(20,0)")), low).cast("string")
    digits = F.lpad(F.ltrim(unscaled, F.lit("-")), F.greatest(F.length(F.ltrim(unscaled, F.lit("-"))), F.lit(scale + 1)), "0")
    whole, point = F.length(digits) - scale, F.lit("." if scale else "")
    text = F.concat(
        F.when(unscaled.startswith("-"), "-").otherwise(""), F.substring(digits, F.lit(1), whole), point,
        F.substring(digits, whole + 1, F.lit(scale)),
    )
    same_sign = F.substring(last, 1, 1).isin([*"89ABCDEF"]) == (sign == "F")
    return F.when((width > 0) & extends & same_sign, text.try_cast(f"decimal(38,{scale})"))


# ------------------------------------------------------------ text from values
def to_text(c: Column, data_type: T.DataType, pattern: str | None = None, charset: str = "UTF-8") -> Column:
    """Text form of a value: dates by pattern (epoch millis without one), bytes decoded."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        if pattern:
            return F.date_format(c, pattern)
        if isinstance(data_type, T.TimestampType):
            return F.unix_millis(c).cast("string")
        from recordflow.functions.timestamps import to_micros

        return F.floor(to_micros(c).cast("decimal(20,0)") / 1000).cast("bigint").cast("string")
    if isinstance(data_type, T.BinaryType):
        return F.decode(c, charset)
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.ByteType):
        # an array of bytes is text in disguise; an empty one is empty text
        digits = F.transform(c, lambda b: F.lpad(F.hex(b.cast("int").bitwiseAND(255).cast("bigint")), 2, "0"))
        return F.decode(F.unhex(F.array_join(digits, "")), charset)
    if isinstance(data_type, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: x.cast("string")), ", ", "null"), F.lit("]"))
    return c.cast("string")


# -------------------------------------------------------------------- by name
def caster(type_name: str):
    """The text builder for a Spark type name such as ``int`` or ``decimal(9,2)``."""
    name = type_name.strip().lower()
    if name in ("boolean", "bool"):
        return to_boolean
    if name in ("tinyint", "byte"):
        return lambda c: to_integer(c, "tinyint")
    if name in ("smallint", "short"):
        return lambda c: to_integer(c, "smallint")
    if name in ("int", "integer"):
        return lambda c: to_integer(c, "int")
    if name in ("bigint", "long"):
        return lambda c: to_integer(c, "bigint")
    if name in ("float", "real"):
        return to_float
    if name == "double":
        return to_double
    if name in ("decimal(38,0)",):
        return to_bigint_unbounded
    if name.startswith("decimal("):
        p, s = (int(x) for x in name[8:-1].split(","))
        return lambda c: to_decimal(c, p, s)
    if name.startswith("varchar("):
        n = int(name[8:-1])
        return lambda c: to_varchar(c, n)
    if name == "char":
        return to_char
    if name == "uuid":
        return to_uuid
    if name == "binary":
        return to_binary
    if name == "string":
        return lambda c: c
    raise ValueError(f"no text conversion to {type_name!r}")


# ------------------------------------------------------------ strict and soft
def reject_entry(column: str, value: Column, bad: Column, reason: str) -> Column:
    """An array of one ``(column, value, reason)`` entry where ``bad`` holds, else an empty one."""
    entry = F.struct(
        F.lit(column).alias("column"), value.cast("string").alias("value"), F.lit(reason).alias("reason")
    )
    return F.when(bad, F.array(entry).cast(REJECT_TYPE)).otherwise(F.array().cast(REJECT_TYPE))


def collect_rejects(entries: list[Column]) -> Column:
    """All entries of a row; plain concatenation, so the projection stays in generated code."""
    return F.concat(*entries) if entries else F.array().cast(REJECT_TYPE)


def evaluate_once(df: DataFrame, made: dict[str, Column]) -> DataFrame:
    """Add columns whose expressions are evaluated exactly once per row.

    They come out of a one-row ``inline``: what reads them later (a reject
    test, a filter) uses the result, where a plain projection would have its
    expressions copied into every filter pushed below it.
    """
    if not made:
        return df
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


VALUE = "_value_"


def replace_checked(df: DataFrame, made: dict[str, Column], entries: list[Column]) -> DataFrame:
    """Replace columns by converted ones and extend ``_rejects``.

    ``entries`` may refer to the original column by its name and to the
    converted one by ``_value_<name>``.
    """
    once = evaluate_once(df, {VALUE + n: c for n, c in made.items()})
    found = collect_rejects(entries)
    if REJECTS in df.columns:
        found = F.concat(F.col(REJECTS), found)
    out = [F.col(f"`{VALUE}{c}`").alias(c) if c in made else F.col(f"`{c}`") for c in df.columns if c != REJECTS]
    return once.select(*out, found.alias(REJECTS))


def convert(df: DataFrame, types: dict[str, str], required: tuple[str, ...] = ()) -> DataFrame:
    """Cast text columns by name in one projection and add ``_rejects``.

    A present value that does not convert, and a null in a ``required``
    column, each add a ``(column, value, reason)`` entry.  Rejects found by an
    earlier call are kept.
    """
    entries, made = [], {}
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name in types:
            made[name] = caster(types[name])(c)
            bad = c.isNotNull() & F.col(f"`{VALUE}{name}`").isNull()
            entries.append(reject_entry(name, c, bad, f"not a valid {types[name]}"))
        if name in required:
            entries.append(reject_entry(name, c, c.isNull(), "must not be null"))
    return replace_checked(df, made, entries)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``_rejects``, rejected rows with it)."""
    bad = F.size(REJECTS) > 0
    return df.filter(~bad).drop(REJECTS), df.filter(bad)


def soft_columns(text: Column, type_name: str, name: str) -> list[Column]:
    """Typed value plus ``<name>_text``, which holds the text that did not convert."""
    v = caster(type_name)(text)
    return [v.alias(name), F.when(v.isNull(), text).alias(f"{name}_text")]


# --------------------------------------------------------------------- tests
def is_compatible(text: Column, type_name: str, pattern: str | None = None,
                  symbols: list[str] | None = None) -> Column:
    """True where the text could become ``type_name``; null counts as not compatible."""
    from recordflow.functions.timestamps import parse_timestamp, parse_date, parse_time

    name = type_name.lower()
    if name == "boolean":
        ok = to_boolean(text).isNotNull()
    elif name in ("tinyint", "smallint", "int", "bigint"):
        ok = to_integer(text, name).isNotNull()
    elif name == "decimal(38,0)":
        ok = text.rlike(INTEGER_PATTERN)
    elif name in ("float", "double"):
        ok = text.rlike(BARE_DOUBLE_PATTERN)
    elif name.startswith("decimal"):
        ok = text.rlike(BARE_DECIMAL_PATTERN)
    elif name == "char":
        ok = F.length(text) > 0
    elif name == "string":
        ok = text.isNotNull()
    elif name == "enum":
        ok = text.isin(symbols or [])
    elif name in ("date", "time", "timestamp"):
        if pattern is None:
            ok = text.rlike(r"\A[0-9]+\z")
        else:
            parse = {"date": parse_date, "time": parse_time, "timestamp": parse_timestamp}[name]
            ok = parse(text, pattern).isNotNull()
    else:
        raise ValueError(f"no compatibility test for {type_name!r}")
    return F.coalesce(ok, F.lit(False))


# whole numbers up to these limits are exact in a float and in a double
FLOAT_EXACT = 2 ** 24
DOUBLE_EXACT = 2 ** 53
FLOAT_MAX = 3.4028234663852886e38


def fits_exactly(number: Column, target: str, *factors: Column | int) -> Column:
    """Whole number, times any ``factors``, fits the significand of ``float``/``double`` without loss.

    The limit is divided instead of the number multiplied, so no product can overflow.
    """
    limit = {"float": FLOAT_EXACT, "double": DOUBLE_EXACT}[target]
    room, zero, known = F.lit(limit).cast("bigint"), F.lit(False), number.isNotNull()
    for f in factors:
        f = (f if isinstance(f, Column) else F.lit(f)).cast("bigint")
        room = F.call_function("div", room, F.nullif(f, F.lit(0).cast("bigint")))
        zero, known = zero | (f == 0), known & f.isNotNull()
    if not factors:
        return number.between(-limit, limit)
    room = F.abs(room)
    # a zero factor leaves no quotient; its product is zero, unless a part is null
    return F.when(zero & known, F.lit(True)).otherwise(number.between(-room, room))


def within_float_range(number: Column) -> Column:
    return number.between(-FLOAT_MAX, FLOAT_MAX) & ~F.isnan(number)


# order in which a union tries its members for a text value (simplest first)
UNION_ORDER = (
    "boolean", "tinyint", "smallint", "int", "bigint", "decimal(38,0)", "float", "double",
    "decimal(38,18)", "timestamp", "date", "time", "char", "enum", "string",
)


def choose_type(text: Column, members: list[str], patterns: dict[str, str] | None = None,
                symbols: list[str] | None = None) -> Column:
    """Name of the first compatible member of a union, simplest type first; null if none."""
    patterns = patterns or {}
    tag = F.when(text.isNull(), F.lit(None))
    for m in sorted(members, key=UNION_ORDER.index):
        tag = tag.when(is_compatible(text, m, patterns.get(m), symbols), F.lit(m))
    return tag


def choose_variant(text: Column, members: list[str]) -> Column:
    """The text as a VARIANT holding a value of the chosen member's type."""
    value = F.when(text.isNull(), F.lit(None).cast("variant"))
    for m in sorted(members, key=UNION_ORDER.index):
        typed = text if m in ("string", "enum", "char") else caster(m)(text)
        value = value.when(is_compatible(text, m), typed.cast("variant"))
    return value
