"""Small value rules: quoting, null markers, SQL literals, readable sizes and durations."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T


def unquote(c: Column) -> Column:
    """Strip one pair of outer double quotes from text longer than one character."""
    quoted = (F.length(c) > 1) & c.startswith('"') & c.endswith('"')
    return F.when(quoted, F.substring(c, F.lit(2), F.length(c) - 2)).otherwise(c)


def empty_to_null(c: Column, keep_quotes: bool = False) -> Column:
    """Null where nothing is left after unquoting; with ``keep_quotes`` the text is tested as it is."""
    t = c if keep_quotes else unquote(c)
    return F.when(F.length(t) > 0, t)


def null_marker(c: Column, marker: str, quoted: Column | None = None) -> Column:
    """Marker text to null; a cell flagged as quoted keeps the marker as text."""
    is_null = c == marker
    if quoted is not None:
        is_null = is_null & ~quoted
    return F.when(~is_null, c)


def sql_literal(c: Column, data_type: T.DataType) -> Column:
    """A value as an SQL literal: ``NULL``, a bare number, or text with quotes doubled."""
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        text = c.cast("string")
    else:
        value = F.decode(c, "UTF-8") if isinstance(data_type, T.BinaryType) else c.cast("string")
        text = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
    return F.coalesce(text, F.lit("NULL"))


def split_statements(script: Column) -> Column:
    r"""Array of trimmed statements, split on ``;`` unless written ``\;``."""
    parts = F.split(script, r"(?<!\\);")
    clean = F.transform(parts, lambda s: F.btrim(F.replace(s, F.lit("\\;"), F.lit(";")), F.lit(_BLANKS)))
    return F.filter(clean, lambda s: F.length(s) > 0)


_BLANKS = "".join(chr(i) for i in range(33))

# fixed values: unit names for hours, minutes and seconds
DURATION_UNITS = ("시간", "분", "초")


def format_duration(millis: Column, units: tuple[str, str, str] = DURATION_UNITS) -> Column:
    """Milliseconds as hours, minutes, seconds; zero hours and minutes are left out."""
    total = F.floor(millis / 1000)
    hours = (total - F.pmod(total, F.lit(3600))) / 3600
    minutes = (F.pmod(total, F.lit(3600)) - F.pmod(total, F.lit(60))) / 60
    part = lambda n, unit: F.concat(n.cast("bigint").cast("string"), F.lit(unit))
    return F.concat_ws(
        " ",
        F.when(hours != 0, part(hours, units[0])),
        F.when(minutes != 0, part(minutes, units[1])),
        part(F.pmod(total, F.lit(60)), units[2]),
    )


# fixed values: binary unit steps
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")


def format_data_size(size: Column) -> Column:
    """Bytes as text in the largest fitting unit, at most two decimals (``1.5 KB``)."""
    text = None
    for i in range(len(SIZE_UNITS) - 1, 0, -1):
        scaled = size.cast("double") / float(1024 ** i)
        number = F.call_function("format_number", scaled, F.lit("#,##0.##"))
        label = F.concat(number, F.lit(" " + SIZE_UNITS[i]))
        # a unit is used once the size is larger than it
        text = F.when(size > 1024 ** i, label) if text is None else text.when(size > 1024 ** i, label)
    return text.otherwise(F.concat(F.call_function("format_number", size.cast("bigint"), F.lit("#,##0")), F.lit(" bytes")))


_SIZE = r"\A\s*([0-9]+(?:\.[0-9]+)?)\s*(B|KB|MB|GB|TB)\s*\z"


def parse_data_size(text: Column) -> Column:
    """``100 MB`` to bytes; null when it is not a size."""
    up = F.upper(text)
    number = F.regexp_extract(up, _SIZE, 1).try_cast("double")
    factor = F.element_at(
        F.create_map(*[F.lit(v) for i, u in enumerate(SIZE_UNITS) for v in (u, float(1024 ** i))]),
        F.when(up.rlike(_SIZE), F.regexp_extract(up, _SIZE, 2)),
    )
    return F.when(up.rlike(_SIZE), F.floor(number * factor))


def data_size_bytes(text: str) -> int | None:
    """The same for a plain argument: whole bytes, or None when it is not a size."""
    m = re.fullmatch(r"\s*([0-9]+(?:\.[0-9]+)?)\s*(B|KB|MB|GB|TB)\s*", text.upper())
    return int(float(m.group(1)) * 1024 ** SIZE_UNITS.index(m.group(2))) if m else None
