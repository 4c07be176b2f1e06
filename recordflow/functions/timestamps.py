"""Timestamp, date and time parsing with one pattern per column, and hour shifts.

A pattern made of numeric fields becomes a length-exact regular expression
plus an ISO text that Spark casts natively.  That keeps the whole parse in
generated code, demands exactly as many fraction digits as the pattern has,
and accepts patterns without separators (``yyyyMMddHHmmssSSS``).  Patterns with
month or zone names fall back to ``try_to_timestamp``.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.functions.casts import VALUE, reject_entry, replace_checked, strip_blanks

# --- fixed values ----------------------------------------------------------
DEFAULT_TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
DEFAULT_DATE_PATTERN = "yyyy-MM-dd"
DEFAULT_TIME_PATTERN = "HH:mm:ss"

NAMED_FORMATS = {
    "BASIC_ISO_DATE": "yyyyMMdd",
    "ISO_LOCAL_DATE": "yyyy-MM-dd",
    "ISO_OFFSET_DATE": "yyyy-MM-ddXXX",
    "ISO_DATE": "yyyy-MM-dd[XXX]",
    "ISO_LOCAL_TIME": "HH:mm[:ss[.SSSSSSSSS]]",
    "ISO_OFFSET_TIME": "HH:mm[:ss[.SSSSSSSSS]]XXX",
    "ISO_TIME": "HH:mm[:ss[.SSSSSSSSS]][XXX]",
    "ISO_LOCAL_DATE_TIME": "yyyy-MM-dd'T'HH:mm[:ss[.SSSSSSSSS]]",
    "ISO_OFFSET_DATE_TIME": "yyyy-MM-dd'T'HH:mm[:ss[.SSSSSSSSS]]XXX",
    "ISO_ZONED_DATE_TIME": "yyyy-MM-dd'T'HH:mm[:ss[.SSSSSSSSS]]XXX['['VV']']",
    "ISO_DATE_TIME": "yyyy-MM-dd'T'HH:mm[:ss[.SSSSSSSSS]][XXX]",
    "ISO_ORDINAL_DATE": "yyyy-DDD",
    "ISO_WEEK_DATE": "YYYY-'W'ww-e",
    "ISO_INSTANT": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]'Z'",
    "RFC_1123_DATE_TIME": "EEE, d MMM yyyy HH:mm:ss Z",
}

DATE_FIELDS = set("yuMd")
TIME_FIELDS = set("HmsS")
# letters that have no meaning in a parse here
UNSUPPORTED = set("YWwecqQLDAnNp")


@dataclass(frozen=True)
class _Part:
    kind: str          # a pattern letter, or "text" for a literal
    width: int
    text: str = ""


def split_pattern(pattern: str) -> list[_Part]:
    """Pattern letters and literals in order; raises on an unterminated quote."""
    parts: list[_Part] = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "'":
            end = pattern.find("'", i + 1)
            if end < 0:
                raise ValueError(f"unterminated quote in pattern {pattern!r}")
            parts.append(_Part("text", 0, pattern[i + 1:end] or "'"))
            i = end + 1
        elif ch.isalpha():
            j = i
            while j < len(pattern) and pattern[j] == ch:
                j += 1
            parts.append(_Part(ch, j - i))
            i = j
        else:
            parts.append(_Part("text", 0, ch))
            i += 1
    return parts


def check_pattern(pattern: str) -> str:
    """Fail when the plan is built, not per row."""
    if not pattern or not pattern.strip():
        raise ValueError("empty timestamp pattern")
    for p in split_pattern(pattern):
        if p.kind in UNSUPPORTED:
            raise ValueError(f"pattern letter {p.kind!r} in {pattern!r} is not supported")
        if p.kind != "text" and p.kind not in DATE_FIELDS | TIME_FIELDS | set("ahkKEXxZzOVG"):
            raise ValueError(f"unknown pattern letter {p.kind!r} in {pattern!r}")
    return pattern


def _numeric_regex(parts: list[_Part]) -> str | None:
    """One group per field, or None where the pattern is not purely numeric."""
    out = []
    for p in parts:
        if p.kind == "text":
            if p.text in "[]{}#":
                return None
            out.append(re.escape(p.text))
        elif p.kind == "S":
            out.append(f"([0-9]{{{p.width}}})")
        elif p.kind in "yu":
            out.append({2: "([0-9]{2})", 4: "([0-9]{4})"}.get(p.width, ""))
        elif p.kind in "MdHms" and p.width <= 2:
            out.append("([0-9]{2})" if p.width == 2 else "([0-9]{1,2})")
        else:
            return None
        if not out[-1]:
            return None
    return r"\A" + "".join(out) + r"\z"


def _iso_parse(text: Column, pattern: str, need_time: bool, need_date: bool) -> Column | None:
    """NTZ timestamp of a purely numeric pattern; None where that is not possible."""
    parts = split_pattern(pattern)
    regex = _numeric_regex(parts)
    fields = [p for p in parts if p.kind != "text"]
    at = {p.kind.replace("u", "y"): f"${i + 1}" for i, p in enumerate(fields)}
    if regex is None or len(at) != len(fields):
        return None
    have_date = {"y", "M", "d"} <= set(at)
    if need_date and not have_date or need_time and "H" not in at:
        # the text cannot hold what is asked for, so nothing ever parses
        return F.lit(None).cast("timestamp_ntz")

    century = "20" if any(p.kind in "yu" and p.width == 2 for p in fields) else ""
    year, month, day = (century + at["y"], at["M"], at["d"]) if have_date else ("1970", "01", "01")
    time = f" {at.get('H', '00')}:{at.get('m', '00')}:{at.get('s', '00')}"
    if "S" in at:
        time += "." + at["S"]
    iso = F.regexp_replace(text, regex, f"{year}-{month}-{day}{time}")
    if re.fullmatch(r"yyyy-MM-dd HH:mm:ss(\.S+)?", pattern):
        iso = text   # already in the order the cast reads
    value = iso.try_cast("timestamp_ntz")
    if have_date:
        # a day past the end of its month (up to 31) means the last day
        number = F.regexp_replace(text, regex, day).try_cast("int")
        first = F.regexp_replace(text, regex, f"{year}-{month}-01{time}").try_cast("timestamp_ntz")
        last = first + F.make_dt_interval(F.dayofmonth(F.last_day(first)) - 1)
        value = F.coalesce(value, F.when(number.between(29, 31), last))
    return F.when(text.rlike(regex), value)


# texts that a numeric field can hold, by its letter and width; a day past the end of its month means the last day
_VALID = {
    ("M", 2): "(?:0[1-9]|1[0-2])", ("M", 1): "(?:0?[1-9]|1[0-2])", ("d", 2): "(?:0[1-9]|[12][0-9]|3[01])",
    ("d", 1): "(?:0?[1-9]|[12][0-9]|3[01])", ("H", 2): "(?:[01][0-9]|2[0-3])", ("H", 1): "(?:[01]?[0-9]|2[0-3])",
    ("m", 2): "[0-5][0-9]", ("m", 1): "[0-5]?[0-9]", ("s", 2): "[0-5][0-9]", ("s", 1): "[0-5]?[0-9]",
}


def _iso_fits(text: Column, pattern: str, need_time: bool, need_date: bool) -> Column | None:
    """Whether :func:`_iso_parse` finds a value, by one regular expression; None where it does not take the pattern."""
    parts = split_pattern(pattern)
    fields = [p for p in parts if p.kind != "text"]
    kinds = {p.kind.replace("u", "y") for p in fields}
    if _numeric_regex(parts) is None or len(kinds) != len(fields):
        return None
    have_date = {"y", "M", "d"} <= kinds
    if need_date and not have_date or need_time and "H" not in kinds:
        return F.lit(False)
    # without a whole date its fields are not looked at
    valid = {k: v for k, v in _VALID.items() if have_date or k[0] in TIME_FIELDS}
    regex = "".join(
        re.escape(p.text) if p.kind == "text" else valid.get((p.kind, p.width), f"[0-9]{{{1 if p.width == 1 else p.width},{max(p.width, 2)}}}" if p.kind in "Md" else f"[0-9]{{{p.width}}}")
        for p in parts
    )
    return text.rlike(rf"\A{regex}\z")


def fits_pattern(text: Column, kind: str, pattern: str) -> Column:
    """Whether ``timestamp``, ``date`` or ``time`` text parses by the pattern, without making the value."""
    check_pattern(pattern)
    fits = _iso_fits(text, pattern, need_time=kind != "date", need_date=kind != "time")
    if fits is None:
        fits = {"timestamp": parse_timestamp, "date": parse_date, "time": parse_time}[kind](text, pattern).isNotNull()
    return fits


def parse_timestamp(text: Column, pattern: str) -> Column:
    """NTZ timestamp where the whole text matches ``pattern``; null otherwise.

    A pattern without an hour field never matches: a timestamp needs a time.
    """
    check_pattern(pattern)
    parsed = _iso_parse(text, pattern, need_time=True, need_date=True)
    if parsed is not None:
        return parsed
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def parse_date(text: Column, pattern: str = DEFAULT_DATE_PATTERN) -> Column:
    check_pattern(pattern)
    parsed = _iso_parse(text, pattern, need_time=False, need_date=True)
    if parsed is None:
        parsed = F.try_to_timestamp(text, F.lit(pattern))
    return parsed.cast("date")


def parse_time(text: Column, pattern: str = DEFAULT_TIME_PATTERN) -> Column:
    """Microseconds since midnight."""
    check_pattern(pattern)
    parsed = _iso_parse(text, pattern, need_time=True, need_date=False)
    if parsed is None:
        parsed = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    return micros_of_day(parsed)


def micros_of_day(ts: Column) -> Column:
    """By the fields of the wall clock, whatever the session's zone."""
    ts = ts.cast("timestamp_ntz")
    minutes = F.hour(ts).cast("bigint") * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def from_epoch_millis(millis: Column) -> Column:
    """NTZ timestamp; null outside the representable range."""
    return from_micros(F.try_multiply(millis, F.lit(1000)))


def _millis_text(text: Column) -> Column:
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("bigint"))


def add_hours(ts: Column, hours: int) -> Column:
    """Shift by whole hours, keeping the fraction."""
    return ts if not hours else ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def cast_timestamp(text: Column, pattern: str = DEFAULT_TIMESTAMP_PATTERN, hours: int = 0) -> Column:
    """Pattern first, then digits as epoch millis; blank and unparsable give null."""
    t = strip_blanks(text)
    return add_hours(F.coalesce(parse_timestamp(t, pattern), from_epoch_millis(_millis_text(t))), hours)


def cast_date(text: Column, pattern: str | None = DEFAULT_DATE_PATTERN) -> Column:
    """By pattern, or digits as epoch millis when there is no pattern; never shifted."""
    t = strip_blanks(text)
    if pattern is None:
        return from_epoch_millis(_millis_text(t)).cast("date")
    return parse_date(t, pattern)


def cast_time(text: Column, pattern: str | None = DEFAULT_TIME_PATTERN) -> Column:
    """Microseconds since midnight, by pattern or from epoch millis."""
    t = strip_blanks(text)
    if pattern is None:
        return micros_of_day(from_epoch_millis(_millis_text(t)))
    return parse_time(t, pattern)


def is_blank(text: Column) -> Column:
    return F.length(strip_blanks(text)) == 0


# --------------------------------------------------------- patterns per column
def patterns_from_spec(spec: str) -> dict[str, str]:
    """``{"formats":[{"column-name","timestamp-pattern","type"}]}`` to {column: pattern}."""
    try:
        formats = json.loads(spec)["formats"]
        out = {f["column-name"]: f.get("timestamp-pattern") for f in formats}
    except (ValueError, KeyError, TypeError) as e:
        raise ValueError(f"not a timestamp format document: {e}") from e
    for p in out.values():
        if p:
            check_pattern(p)
    return {k: p for k, p in out.items() if p}


def pattern_from_props(props: dict[str, str] | None, column: str) -> str:
    """``column.all.pattern`` beats ``column.<name>.pattern`` beats the default."""
    props = props or {}
    return props.get("column.all.pattern") or props.get(f"column.{column}.pattern") or DEFAULT_TIMESTAMP_PATTERN


def parse_timestamp_columns(
    df: DataFrame,
    columns: list[str],
    patterns: dict[str, str] | None = None,
    default_pattern: str | None = None,
    props: dict[str, str] | None = None,
    hours: int = 0,
) -> DataFrame:
    """Parse each text column with its own pattern in one projection; adds ``_rejects``.

    The pattern is the column's own, else the default, else the field's
    ``format`` metadata, else ``yyyy-MM-dd HH:mm:ss``.  With ``props`` the
    schema-property precedence applies instead.
    """
    patterns = patterns or {}
    made, entries = {}, []
    for field in df.schema.fields:
        name = field.name
        c = F.col(f"`{name}`")
        if name not in columns:
            continue
        if props is not None:
            pattern = pattern_from_props(props, name)
        else:
            pattern = (
                patterns.get(name) or default_pattern or (field.metadata or {}).get("format")
                or DEFAULT_TIMESTAMP_PATTERN
            )
        made[name] = cast_timestamp(c, pattern, hours)
        bad = c.isNotNull() & F.col(f"`{VALUE}{name}`").isNull() & ~is_blank(c)
        entries.append(reject_entry(name, c, bad, f"not a timestamp of pattern {pattern}"))
    return replace_checked(df, made, entries)


# ------------------------------------------------------------- named formats
def _iso_time_text(text: Column) -> Column:
    """``HH:mm[:ss[.f{1,9}]]`` to a full ``HH:mm:ss.ffffff``; null when it is not one."""
    regex = r"\A([0-9]{2}:[0-9]{2})(:[0-9]{2})?(\.[0-9]{1,9})?\z"
    sec = F.regexp_extract(text, regex, 2)
    frac = F.regexp_extract(text, regex, 3)
    full = F.concat(
        F.substring(text, 1, 5), F.when(sec == "", ":00").otherwise(sec), F.lit("."),
        F.substring(F.rpad(F.substring(frac, 2, 9), 9, "0"), 1, 6),
    )
    ok = text.rlike(regex) & ~((sec == "") & (frac != ""))
    return F.when(ok, full)


_OFFSET = r"(Z|[+-][0-9]{2}:[0-9]{2}(?::[0-9]{2})?)"


def parse_named(text: Column, name: str) -> Column:
    """Parse by one of the fifteen ISO/RFC format names, or by a plain pattern.

    Date names give DATE, time names give microseconds since midnight, and
    date-time names give the wall clock as an NTZ timestamp (the instant in UTC
    for ``ISO_INSTANT``).
    """
    if name == "BASIC_ISO_DATE":
        return parse_date(F.regexp_extract(text, r"\A([0-9]{8})(Z|[+-][0-9]{2}(:?[0-9]{2}){0,2})?\z", 1), "yyyyMMdd")
    if name in ("ISO_LOCAL_DATE", "ISO_OFFSET_DATE", "ISO_DATE"):
        tail = {"ISO_LOCAL_DATE": "", "ISO_OFFSET_DATE": _OFFSET, "ISO_DATE": _OFFSET + "?"}[name]
        body = F.regexp_extract(text, rf"\A([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}){tail}\z", 1)
        return F.concat(body, F.lit(" 00:00:00")).try_cast("timestamp_ntz").cast("date")
    if name in ("ISO_LOCAL_TIME", "ISO_OFFSET_TIME", "ISO_TIME"):
        tail = {"ISO_LOCAL_TIME": "", "ISO_OFFSET_TIME": _OFFSET, "ISO_TIME": _OFFSET + "?"}[name]
        body = F.regexp_extract(text, rf"\A([0-9:.]+){tail}\z", 1)
        return micros_of_day(F.concat(F.lit("1970-01-01 "), _iso_time_text(body)).try_cast("timestamp_ntz"))
    if name == "ISO_ORDINAL_DATE":
        regex = rf"\A([0-9]{{4}})-([0-9]{{3}}){_OFFSET}?\z"
        year = F.regexp_extract(text, regex, 1)
        day = F.regexp_extract(text, regex, 2).try_cast("int")
        first = F.concat(year, F.lit("-01-01 00:00:00")).try_cast("timestamp_ntz").cast("date")
        value = F.date_add(first, day - 1)
        return F.when(text.rlike(regex) & (day >= 1) & (F.year(value) == F.year(first)), value)
    if name == "ISO_WEEK_DATE":
        regex = rf"\A([0-9]{{4}})-W([0-9]{{2}})-([1-7]){_OFFSET}?\z"
        year = F.regexp_extract(text, regex, 1)
        week = F.regexp_extract(text, regex, 2).try_cast("int")
        dow = F.regexp_extract(text, regex, 3).try_cast("int")
        # week 1 holds January 4th; weeks start on Monday
        jan4 = F.concat(year, F.lit("-01-04 00:00:00")).try_cast("timestamp_ntz").cast("date")
        monday = F.date_sub(jan4, F.weekday(jan4))
        value = F.date_add(monday, (week - 1) * 7 + dow - 1)
        last_week = F.weekofyear(F.concat(year, F.lit("-12-28 00:00:00")).try_cast("timestamp_ntz").cast("date"))
        return F.when(text.rlike(regex) & week.between(1, last_week), value)
    if name in ("ISO_LOCAL_DATE_TIME", "ISO_OFFSET_DATE_TIME", "ISO_ZONED_DATE_TIME", "ISO_DATE_TIME", "ISO_INSTANT"):
        zone = r"(\[[^\]]+\])"
        tail = {
            "ISO_LOCAL_DATE_TIME": "", "ISO_OFFSET_DATE_TIME": _OFFSET, "ISO_ZONED_DATE_TIME": _OFFSET + zone + "?",
            "ISO_DATE_TIME": f"({_OFFSET}{zone}?)?", "ISO_INSTANT": "Z",
        }[name]
        regex = rf"\A([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})[Tt]([0-9:.]+){tail}\z"
        day, time = F.regexp_extract(text, regex, 1), F.regexp_extract(text, regex, 2)
        return F.concat(day, F.lit(" "), _iso_time_text(time)).try_cast("timestamp_ntz")
    if name == "RFC_1123_DATE_TIME":
        # the weekday is optional but must agree when present; seconds are optional
        regex = (
            r"\A(?:(Mon|Tue|Wed|Thu|Fri|Sat|Sun), )?([0-9]{1,2}) "
            r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) ([0-9]{4}) "
            r"([0-9]{2}:[0-9]{2})(:[0-9]{2})? (?:GMT|[+-][0-9]{4})\z"
        )
        group = lambda i: F.regexp_extract(text, regex, i)
        months = F.lit("JanFebMarAprMayJunJulAugSepOctNovDec")
        month = F.lpad(((F.position(group(3), months) + 2) / 3).cast("int").cast("string"), 2, "0")
        sec = F.when(group(6) == "", ":00").otherwise(group(6))
        ts = F.concat(group(4), F.lit("-"), month, F.lit("-"), F.lpad(group(2), 2, "0"), F.lit(" "), group(5), sec)
        value = ts.try_cast("timestamp_ntz")
        agrees = (group(1) == "") | (F.date_format(value, "E") == group(1))
        return F.when(text.rlike(regex) & agrees, value)
    return parse_timestamp(text, name)


# ------------------------------------------------------------------- micros
DAY_MICROS = 86_400_000_000


def to_micros(ts: Column) -> Column:
    """Microseconds of the wall clock since 1970, whatever the session's zone."""
    days = F.datediff(ts.cast("timestamp_ntz").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * DAY_MICROS + micros_of_day(ts)


def from_micros(micros: Column) -> Column:
    """Wall clock (NTZ) so many microseconds after 1970 began, whatever the session's zone."""
    rest = F.pmod(micros, F.lit(DAY_MICROS))
    days = F.call_function("div", micros - rest, F.lit(DAY_MICROS)).cast("int")
    seconds = (rest.cast("decimal(11,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def micros_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS'Z'")


def local_date_to_utc(d: Column, zone: str) -> Column:
    """Instant of local midnight in ``zone`` to the same wall clock in UTC."""
    return F.from_utc_timestamp(d, zone)
