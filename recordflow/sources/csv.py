"""Delimited text in many dialects: scans, schemas, quarantine and writing.

Quoted cells that span lines are put together by :mod:`.records`, which lets
many tasks read one file.  :func:`parse_lines` splits records with one cell per
regular-expression match.  Spark's CSV reader is used where no cell spans lines
and the dialect needs nothing that it cannot express (escapes outside quotes,
kept blank lines, quoted null markers), and for encodings other than UTF-8.

Each file is bound by its own header: files are grouped by it, and the scans of
the groups are put together by name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recordflow.functions import casts
from recordflow.functions.timestamps import cast_date, cast_time, cast_timestamp, fits_pattern
from recordflow.functions.values import empty_to_null, unquote
from recordflow.sources import records

CORRUPT = "_corrupt"
UNKNOWN_FIELD = "unknown_field_index_"

ALL, ALL_NON_NULL, MINIMAL, NON_NUMERIC, NONE = "all", "all_non_null", "minimal", "non_numeric", "none"


@dataclass(frozen=True)
class Dialect:
    sep: str = ","
    quote: str | None = '"'
    escape: str | None = None
    null: str | None = None
    keep_blank_lines: bool = False
    trim: bool = False
    line_sep: str = "\r\n"
    comment: str | None = None
    quote_mode: str | None = None
    blank_header_names: bool = False
    trailing_delimiter: bool = False

    def but(self, **changes) -> "Dialect":
        return replace(self, **changes)


# --- fixed values: presets by name -----------------------------------------
DIALECTS = {
    "default": Dialect(),
    "custom": Dialect(escape="\\", trim=True, line_sep="\n", blank_header_names=True),
    "rfc-4180": Dialect(keep_blank_lines=True),
    "excel": Dialect(keep_blank_lines=True, blank_header_names=True),
    "tdf": Dialect(sep="\t", trim=True),
    "mysql": Dialect(sep="\t", quote=None, escape="\\", null="\\N", keep_blank_lines=True, line_sep="\n",
                     quote_mode=ALL_NON_NULL),
    "informix-unload": Dialect(sep="|", escape="\\", line_sep="\n"),
    "informix-unload-csv": Dialect(line_sep="\n"),
    "mongodb-csv": Dialect(escape='"', quote_mode=MINIMAL),
    "mongodb-tsv": Dialect(sep="\t", escape='"', quote_mode=MINIMAL),
    "oracle": Dialect(escape="\\", null="\\N", keep_blank_lines=True, trim=True, line_sep="\n", quote_mode=MINIMAL),
    "postgresql-csv": Dialect(null="", keep_blank_lines=True, line_sep="\n", quote_mode=ALL_NON_NULL),
    "postgresql-text": Dialect(sep="\t", quote=None, escape="\\", null="\\N", keep_blank_lines=True, line_sep="\n",
                               quote_mode=ALL_NON_NULL),
}


def dialect(name: str | Dialect) -> Dialect:
    if isinstance(name, Dialect):
        return name
    try:
        return DIALECTS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown dialect {name!r}; known: {sorted(DIALECTS)}") from None


def reader_options(d: Dialect, header: bool, encoding: str = "UTF-8", multi_line: bool = True) -> dict:
    """Options of Spark's CSV reader for a quoted dialect."""
    out = {
        "sep": d.sep, "quote": d.quote or "", "escape": d.escape or d.quote or "\\", "header": header,
        "encoding": encoding, "multiLine": multi_line, "mode": "PERMISSIVE", "enforceSchema": True,
        "ignoreLeadingWhiteSpace": d.trim, "ignoreTrailingWhiteSpace": d.trim,
        "maxCharsPerColumn": -1, "columnPruning": False,
    }
    if d.null is not None:
        out["nullValue"] = d.null
    if d.comment:
        out["comment"] = d.comment
    return out


def strict_null(d: Dialect) -> bool:
    """A quoted cell is never null, so a quoted marker or empty cell stays text."""
    return d.quote_mode in (ALL_NON_NULL, NON_NUMERIC)


def _is_utf8(encoding: str) -> bool:
    return encoding.upper() in ("UTF-8", "UTF8")


def _needs_text_path(d: Dialect, multi_line: bool, encoding: str) -> bool:
    """Unquoted dialects, kept blank lines, quoted markers, and cells that span lines."""
    if d.quote is not None and multi_line:
        return _is_utf8(encoding)
    return d.quote is None or d.keep_blank_lines or strict_null(d)


# ----------------------------------------------------------------- text path
def read_lines(spark: SparkSession, path, d: Dialect, encoding: str = "UTF-8", skip_header: bool = False,
               file: str | None = None) -> DataFrame:
    """Column ``line``: BOM removed, comment lines dropped, blank lines kept or dropped by the dialect.

    ``skip_header`` drops the first line with content of every file, and only
    that one; ``file`` names a column for the path of the file, beside ``_size``.
    """
    if not _is_utf8(encoding):
        # the text reader knows UTF-8 only; a CSV scan with a separator that never occurs yields whole lines
        wide = encoding.upper().startswith(("UTF-16", "UTF-32"))   # line ends are not single bytes
        reader = spark.read.options(sep="\x00", quote="", encoding=encoding, maxCharsPerColumn=-1, multiLine=wide)
        lines = reader.schema("value string").csv(path)
    else:
        # lines end in LF, CR or both, whatever the dialect writes
        lines = spark.read.text(path)
    where = [F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")]
    where = where if skip_header else [F.col("_metadata.file_path").alias(file), F.col("_metadata.file_size").alias("_size")] if file else []
    lines = lines.select(records.without_mark("value").alias("line"), *where)
    lines = _with_content(lines, d)
    return lines.mapInArrow(_drop_headers, "line string") if skip_header else lines


def _with_content(lines: DataFrame, d: Dialect) -> DataFrame:
    if not d.keep_blank_lines:
        lines = lines.filter(F.length(F.btrim("line") if d.trim else F.col("line")) > 0)
    if d.comment:
        lines = lines.filter(~F.ltrim("line").startswith(d.comment))
    return lines


def read_records(spark: SparkSession, path, d: Dialect, encoding: str = "UTF-8", skip_header: bool = False,
                 multi_line: bool = True) -> DataFrame:
    """As :func:`read_lines`, but with ``multi_line`` a quoted cell keeps the line ends it holds."""
    if d.quote is None or not multi_line:
        return read_lines(spark, path, d, encoding, skip_header)
    if not _is_utf8(encoding):
        raise ValueError(f"records over several lines are cut in UTF-8 only, not in {encoding}")
    return _with_content(records.quoted_records(spark, path, d.sep, d.quote, d.escape, d.comment, skip_header), d)


def _drop_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive in file order; the first line with content after the start of a file is its header."""
    before, pending = None, False
    for batch in batches:
        line = batch.column("line")
        file, start = batch.column("_file").to_numpy(), batch.column("_start").to_numpy()
        begins = np.ones(len(line), dtype=bool)
        begins[1:] = (file[1:] != file[:-1]) | (start[1:] != start[:-1])
        if len(line) and before == (file[0], start[0]):
            begins[0] = False
        keep = np.ones(len(line), dtype=bool)
        # only the beginnings of files are looked at row by row
        stops = [int(i) for i in np.flatnonzero(begins)]
        for i in ([0] if pending and len(line) and not begins[0] else []) + stops:
            if i in stops:
                pending = start[i] == 0
            while pending and i < len(line):
                keep[i] = False
                pending = not line[i].as_py().strip()
                i += 1
                if i < len(line) and begins[i]:
                    break
        if len(line):
            before = (file[-1], start[-1])
        yield pa.RecordBatch.from_arrays([line.filter(pa.array(keep))], names=["line"])


def _unescape(text: Column, d: Dialect) -> Column:
    """Undo escape sequences; an escaped escape is split off first so that it cannot be read twice."""
    e = d.escape
    if not e:
        return text
    if e == d.quote:
        return F.when(text.contains(e + e), F.replace(text, F.lit(e + e), F.lit(e))).otherwise(text)
    meta = "".join(re.escape(c) for c in {d.sep, d.quote, d.comment} if c)
    # split() would read the literal as a pattern, so it is quoted
    pieces = F.when(text.contains(e + e), F.split(text, re.escape(e + e), -1)).otherwise(F.array(text))

    def replaced(found: str, value: str) -> Callable[[Column], Column]:
        # looking for a sequence costs far less than replacing it
        return lambda p: F.when(p.contains(found), F.replace(p, F.lit(found), F.lit(value))).otherwise(p)

    for letter, value in (("n", "\n"), ("r", "\r"), ("t", "\t"), ("b", "\b"), ("f", "\f")):
        pieces = F.transform(pieces, replaced(e + letter, value))
    pieces = F.transform(pieces, lambda p: F.when(
        p.contains(e), F.regexp_replace(p, f"{re.escape(e)}([{meta}\\r\\n])", "$1")).otherwise(p))
    return F.when(text.contains(e), F.array_join(pieces, e)).otherwise(text)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_cells(line: Column, d: Dialect) -> Column:
    """A line as ``array<struct<value, quoted>>``."""
    s, q = re.escape(d.sep), d.quote and re.escape(d.quote)
    e = re.escape(d.escape) if d.escape and d.escape != d.quote else ""
    # possessive loops: they neither backtrack nor recurse, so a cell may be of any length
    plain = f"[^{s}{e}]*+(?:{e}(?:.|\\z)[^{s}{e}]*+)*+" if e else f"[^{s}]*+"
    cell, whole = f"{s}({plain})", None
    if q:
        pair = f"(?:{q}{q}|{e}.)" if e else f"{q}{q}"
        whole = f"{q}[^{q}{e}]*+(?:{pair}[^{q}{e}]*+)*+{q}"
        blank = "[ ]*+" if d.sep == "\t" else "[ \t]*+"
        cell = f"{s}({blank}{whole}{blank}(?={s}|\\z)|{plain})"
    # a leading separator gives every cell, the first included, one separator to match
    cells = F.regexp_extract_all(F.concat(F.lit(d.sep), line), F.lit(f"(?s){cell}"), F.lit(1))

    def quoted_body(c: Column) -> Column:
        """What a quoted cell holds between its quotes; null where the cell is not quoted."""
        blanks = F.lit(" \t" if d.sep != "\t" else " ")

        def inner(t: Column) -> Column:
            body = F.substring(t, F.lit(2), F.length(t) - 2)
            is_quoted = (F.length(t) > 1) & t.startswith(d.quote) & t.endswith(d.quote)
            return F.when(is_quoted, _bound(body, lambda b: F.when(plain_body(b) | F.concat(F.lit(d.quote), b, F.lit(d.quote)).rlike(f"(?s)\\A{whole}\\z"), b)))

        def plain_body(b: Column) -> Column:
            # without a quote or an escape inside there is nothing to match
            return ~b.contains(d.quote) & ~b.contains(d.escape) if e else ~b.contains(d.quote)

        bare = c.startswith(d.quote) & c.endswith(d.quote)
        return F.when(c.contains(d.quote), _bound(F.when(bare, c).otherwise(F.btrim(c, blanks)), inner))

    def undoubled(b: Column) -> Column:
        if d.escape == d.quote:
            return _unescape(b, d)
        pair = d.quote * 2
        single = F.when(b.contains(pair), F.replace(b, F.lit(pair), F.lit(d.quote))).otherwise(b)
        return _bound(single, lambda x: _unescape(x, d)) if d.escape else single

    def finish(raw: Column, is_quoted: Column) -> Column:
        value = F.btrim(raw, F.lit(casts.BLANKS)) if d.trim else raw
        if d.null is None:
            return F.struct(value.alias("value"), is_quoted.alias("quoted"))
        free = ~is_quoted if strict_null(d) else F.lit(True)
        return _bound(value, lambda v: F.struct(F.when(~((v == d.null) & free), v).alias("value"), is_quoted.alias("quoted")))

    def build(c: Column) -> Column:
        outside = c if d.escape == d.quote else _unescape(c, d)
        if not q:
            return finish(outside, F.lit(False))
        return _bound(quoted_body(c), lambda b: finish(F.when(b.isNotNull(), undoubled(b)).otherwise(outside), b.isNotNull()))

    return F.transform(cells, build)


def parse_lines(lines: DataFrame, d: Dialect) -> DataFrame:
    """Column ``cells`` with the cell values of each line."""
    return lines.select("line", F.transform(parse_cells(F.col("line"), d), lambda c: c["value"]).alias("cells"))


def cells_to_columns(parsed: DataFrame, names: list[str], unknown: str = "drop") -> DataFrame:
    """Cells by position to named text columns.

    Surplus cells are dropped, kept in a map column (``map``), or given their
    own ``unknown_field_index_<i>`` columns (``columns``, one extra pass for the width).
    """
    out = [F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)]
    n = len(names)
    if unknown == "map":
        extra = F.slice("cells", n + 1, F.greatest(F.size("cells") - n, F.lit(0)))
        keys = F.transform(extra, lambda x, i: F.concat(F.lit(UNKNOWN_FIELD), (i + n).cast("string")))
        out.append(F.map_from_arrays(keys, extra).alias("_unknown"))
    elif unknown == "columns":
        width = parsed.agg(F.max(F.size("cells"))).first()[0] or 0
        out += [F.get("cells", F.lit(i)).alias(f"{UNKNOWN_FIELD}{i}") for i in range(n, width)]
    elif unknown != "drop":
        raise ValueError(f"unknown must be drop, map or columns, not {unknown!r}")
    return parsed.select(*out)


# ---------------------------------------------------------------------- header
def check_header(names: list[str], duplicates: str = "allow_all", blank_names: bool = True) -> list[str]:
    """Apply the duplicate-name policy (``allow_all``, ``allow_empty``, ``disallow``)."""
    seen: set[str] = set()
    for n in names:
        blank = not (n or "").strip()
        key = "" if blank else n
        if blank and not blank_names:
            raise ValueError(f"a header name is missing in {names}")
        if key in seen and duplicates != "allow_all" and not (blank and duplicates == "allow_empty"):
            raise ValueError(f"duplicate header name {n!r} in {names}")
        seen.add(key)
    return names


#: Larger than any file, so that a task reads one file.
_NO_SPLIT = 1 << 44
#: Files up to this size are read to their end, which leaves the Python worker for the next task.
_READ_OUT = 1 << 23


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of a file; reading stops there if the file is large."""
    found = False
    for batch in batches:
        if batch.num_rows and not found:
            found = True
            yield batch.slice(0, 1).select(["line", "file"])
            if batch.column("_size")[0].as_py() > _READ_OUT:
                return


def file_headers(spark: SparkSession, path, d: Dialect, encoding: str = "UTF-8") -> list[tuple[list[str], list[str]]]:
    """(names, files) for each different header line, in the order of their first files; files without content have none.

    A task per file reads its beginning.  What comes to the driver is what its
    own listing of the files holds, once.
    """
    probe = spark.newSession()
    own = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.") and spark.conf.isModifiable(k)}
    alone = {"files.maxPartitionBytes": _NO_SPLIT, "files.openCostInBytes": _NO_SPLIT, "execution.arrow.maxRecordsPerBatch": 256}
    for key, value in (own | {f"spark.sql.{k}": str(v) for k, v in alone.items()}).items():
        probe.conf.set(key, value)
    lines = read_lines(probe, path, d.but(keep_blank_lines=False), encoding, file="file")
    first = lines.mapInArrow(_first_lines, "line string, file string")
    names = F.transform(parse_cells(F.col("line"), d), lambda c: F.coalesce(c["value"], F.lit("")))
    # the path comes percent-encoded
    file = F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B")))
    groups = first.select(names.alias("names"), file.alias("file")).groupBy("names").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return sorted(((r["names"], r["files"]) for r in groups.collect()), key=lambda g: g[1][0])


def _as_pattern(file: str) -> str:
    """A path that readers, which take patterns, find as it is."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", file)


def rightmost(names: list[str]) -> dict[str, int]:
    """Position to read for each distinct name: the last one where a name repeats."""
    out: dict[str, int] = {}
    for i, n in enumerate(names):
        out[n or f"{UNKNOWN_FIELD}{i}"] = i
    return out


def shifted(names: list[str]) -> dict[str, int]:
    """The other engine's reading: distinct names take the cells from the left, so values shift."""
    return {n: i for i, n in enumerate(dict.fromkeys(names))}


# ------------------------------------------------------------------------ scans
def csv_scan(
    spark: SparkSession,
    path,
    dialect_name: str | Dialect = "custom",
    names: list[str] | None = None,
    header: str = "names",
    duplicates: str = "allow_all",
    duplicate_values: str = "rightmost",
    encoding: str = "UTF-8",
    multi_line: bool = True,
    unknown: str = "drop",
) -> DataFrame:
    """Delimited files as text columns; empty cells are null.

    ``header``: ``names`` takes the names from the first line of each file,
    ``ignored`` skips that line and binds ``names`` by position, ``none`` treats
    it as data.  Files with different headers are put together by name, with
    nulls for the names a file lacks.
    """
    d = dialect(dialect_name)
    if header not in ("names", "ignored", "none"):
        raise ValueError(f"header must be names, ignored or none, not {header!r}")
    if header != "names":
        if not names:
            raise ValueError("column names are needed unless the header provides them")
        at = {n: i for i, n in enumerate(names)}
        return _scan(spark, path, d, at, len(names), header == "ignored", encoding, multi_line, unknown)
    place = rightmost if duplicate_values == "rightmost" else shifted
    groups = file_headers(spark, path, d, encoding) or [([], [])]
    scans = []
    for found, files in groups:
        at = place(check_header(found, duplicates, d.blank_header_names))
        # with one header for all, the readers list the files themselves
        own = path if len(groups) == 1 else [_as_pattern(f) for f in files]
        scans.append(_scan(spark, own, d, at, len(found), True, encoding, multi_line, unknown))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _scan(spark: SparkSession, path, d: Dialect, at: dict[str, int], width: int, skip_header: bool, encoding: str, multi_line: bool,
          unknown: str) -> DataFrame:
    """Cells to the named columns ``at`` their positions."""
    if _needs_text_path(d, multi_line, encoding) or unknown != "drop":
        parsed = parse_lines(read_records(spark, path, d, encoding, skip_header, multi_line), d)
        if unknown != "drop":
            return cells_to_columns(parsed, list(at), unknown)
        cells = {n: F.get("cells", F.lit(i)) for n, i in at.items()}
    else:
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
        parsed = spark.read.options(**reader_options(d, skip_header, encoding, multi_line)).schema(schema).csv(path)
        cells = {n: F.col(f"c{i}") for n, i in at.items()}
        if d.trim:
            cells = {n: F.btrim(c, F.lit(casts.BLANKS)) for n, c in cells.items()}
            if d.null is not None:
                cells = {n: F.nullif(c, F.lit(d.null)) for n, c in cells.items()}
    if not strict_null(d):
        cells = {n: F.nullif(c, F.lit("")) for n, c in cells.items()}
    return parsed.select(*[c.alias(n) for n, c in cells.items()])


def bind_types(df: DataFrame, types: dict[str, str], keep_unknown: bool = True, trim_quotes: bool = True) -> DataFrame:
    """Text columns to typed ones by name; empty to null, unknown names stay text.

    Outer quotes are stripped first, except from text columns when ``trim_quotes`` is off.
    """
    known = {n: t for n, t in types.items() if n in df.columns}
    cells = []
    for c in df.columns:
        if c in known:
            keep = not trim_quotes and known[c] == "string"
            cells.append(empty_to_null(F.col(f"`{c}`") if keep else unquote(F.col(f"`{c}`")), keep).alias(c))
        elif keep_unknown:
            cells.append(F.col(f"`{c}`"))
    return casts.convert(df.select(*cells), known)


def scan_with_rejects(spark: SparkSession, path, types: dict[str, str], dialect_name: str | Dialect = "custom",
                      header: bool = True, multi_line: bool = True) -> DataFrame:
    """Typed columns plus ``_rejects``: one entry for a wrong number of cells, one per bad value.

    Cells are read as text and converted here, so that every value counts no
    matter which columns a query goes on to use.
    """
    d = dialect(dialect_name)
    names = list(types)
    text = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
    options = {**reader_options(d, header, multi_line=multi_line), "columnNameOfCorruptRecord": CORRUPT}
    scanned = spark.read.options(**options).schema(text).csv(path)
    uneven = casts.reject_entry(CORRUPT, F.col(CORRUPT), F.col(CORRUPT).isNotNull(), "wrong number of cells")
    marked = scanned.select(*names, casts.collect_rejects([uneven]).alias(casts.REJECTS))
    cleaned = marked.select(*[empty_to_null(unquote(F.col(n))).alias(n) for n in names], casts.REJECTS)
    return casts.convert(cleaned, types)


def csv_quarantine(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their reasons) of :func:`scan_with_rejects`."""
    return casts.split_rejects(scanned)


class FieldCountError(ValueError):
    pass


def split_field_count(parsed: DataFrame, expected: int | None) -> tuple[DataFrame, DataFrame]:
    """(rows with the expected number of cells, the others); nothing is checked when it is unset."""
    if expected is None:
        return parsed, parsed.limit(0)
    ok = F.size("cells") == expected
    return parsed.filter(ok), parsed.filter(~ok)


def require_field_count(parsed: DataFrame, expected: int | None) -> DataFrame:
    """All rows, or an error naming the first mismatch."""
    bad = split_field_count(parsed, expected)[1].select(F.size("cells").alias("n")).limit(1).collect()
    if bad:
        raise FieldCountError(f"expected {expected} cells, found {bad[0]['n']}")
    return parsed


# -------------------------------------------------------------------- inference
DEFAULT_FORMATS = {"date": "yyyy-MM-dd", "time": "HH:mm:ss", "timestamp": "yyyy-MM-dd HH:mm:ss"}
# plain numbers only: no plus sign, no exponent, no trailing dot
NUMBER_PATTERN = r"\A-?([0-9]+(\.[0-9]+)?|\.[0-9]+)\z"
# candidates from narrow to wide; the first that fits every value is chosen
CANDIDATES = ("int", "bigint", "double", "boolean", "timestamp", "date", "time")


def narrowest(c: Column, formats: dict[str, str]) -> Column:
    """Name of the narrowest candidate a value fits, ``string`` if none, null for a null."""
    number = F.when(c.contains("."), F.lit("double")).when(c.try_cast("int").isNotNull(), F.lit("int")).when(
        c.try_cast("bigint").isNotNull(), F.lit("bigint")
    ).otherwise(F.lit("string"))
    kind = F.when(c.isNull(), F.lit(None)).when(c.rlike(NUMBER_PATTERN), number)
    kind = kind.when(F.length(c).between(4, 5) & casts.to_boolean(c).isNotNull(), F.lit("boolean"))
    # by pattern only: bare digits are numbers, not epoch millis
    for name in ("timestamp", "date", "time"):
        kind = kind.when(fits_pattern(casts.strip_blanks(c), name, formats[name]), F.lit(name))
    return kind.otherwise(F.lit("string"))


# a candidate also fits the values of the narrower ones
NARROWER = {"bigint": ("int",), "double": ("int", "bigint")}


def column_type_profile(df: DataFrame, columns: list[str] | None = None,
                        formats: dict[str, str] | None = None) -> DataFrame:
    """One row per column: values, fits per candidate type, and the chosen type.

    One pass: each value is classified once, by one expression for all columns,
    and the counts are combined before the shuffle.
    """
    formats = formats or DEFAULT_FORMATS
    columns = columns or df.columns
    cells = F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"`{n}`").alias("v")) for n in columns])
    long = df.select(F.explode(cells).alias("c")).select(
        F.col("c.n").alias("column_name"), F.nullif(unquote(F.col("c.v")), F.lit("")).alias("value")
    )
    counts = long.groupBy("column_name", narrowest(F.col("value"), formats).alias("kind")).agg(F.count("value").alias("n"))
    kind, n = F.col("kind"), F.col("n")
    fits = {t: F.sum(F.when(kind.isin(t, *NARROWER.get(t, ())), n).otherwise(0)) for t in CANDIDATES}
    profile = counts.groupBy("column_name").agg(
        F.sum("n").alias("value_count"), *[c.alias(f"fits_{t}") for t, c in fits.items()]
    )
    chosen = F.when(F.col("value_count") == 0, F.lit("string"))
    for t in CANDIDATES:
        chosen = chosen.when(F.col(f"fits_{t}") == F.col("value_count"), F.lit(t))
    return profile.withColumn("chosen_type", chosen.otherwise("string"))


def csv_infer_schema(df: DataFrame, formats: dict[str, str] | None = None) -> dict[str, str]:
    """{column: type} from every row; an empty table is all text."""
    found = {r["column_name"]: r["chosen_type"] for r in column_type_profile(df, formats=formats).collect()}
    return {c: found.get(c, "string") for c in df.columns}


def apply_inferred(df: DataFrame, types: dict[str, str], formats: dict[str, str] | None = None) -> DataFrame:
    formats = formats or DEFAULT_FORMATS
    cells, text = [], []
    for n in df.columns:
        c, t = F.col(f"`{n}`"), types.get(n, "string")
        # cleaned in a projection below, so that the conversion reads the result each time
        text.append(c if t == "string" else F.nullif(unquote(c), F.lit("")).alias(n))
        if t == "timestamp":
            c = cast_timestamp(c, formats[t])
        elif t == "date":
            c = cast_date(c, formats[t])
        elif t == "time":
            c = cast_time(c, formats[t])
        elif t != "string":
            c = casts.caster(t)(c)
        cells.append(c.alias(n))
    return df.select(*text).select(*cells)


# ------------------------------------------------------------------------ write
def _text_of(name: str, dt: T.DataType, formats: dict[str, str]) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(dt, T.DateType):
        return F.date_format(c, formats["date"])
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, formats["timestamp"])
    return c.cast("string")


def _escaped(text: Column, d: Dialect) -> Column:
    """Escape form: line breaks as letters, the separator and the escape itself preceded by the escape."""
    e = d.escape or "\\"
    out = F.replace(text, F.lit(e), F.lit(e + e))
    out = F.replace(F.replace(out, F.lit("\n"), F.lit(e + "n")), F.lit("\r"), F.lit(e + "r"))
    return F.replace(out, F.lit(d.sep), F.lit(e + d.sep))


def render_cell(text: Column, d: Dialect, mode: str, numeric: bool, first: bool) -> Column:
    null = F.lit(d.null if d.null is not None else "")
    if mode == NONE or d.quote is None:
        return F.coalesce(_escaped(text, d), null)
    q, e = d.quote, d.escape or d.quote
    # looking for a character costs far less than replacing it
    body = F.when(text.contains(e), F.replace(text, F.lit(e), F.lit(e + e))).otherwise(text) if e != q else text
    body = F.when(text.contains(q), F.replace(body, F.lit(q), F.lit(e + q))).otherwise(body)
    quoted = F.concat(F.lit(q), body, F.lit(q))
    if mode == ALL:
        # a null is quoted too: as its marker, or as an empty cell
        return F.coalesce(quoted, F.lit(q + (d.null or "") + q))
    if mode == ALL_NON_NULL:
        return F.coalesce(quoted, null)
    if mode == NON_NUMERIC:
        return F.coalesce(text if numeric else quoted, null)
    if numeric and not set(d.sep + q + (d.escape or "")) & set("0123456789.+-EeNaInfity"):
        return F.coalesce(text, null)   # nothing in a number needs quoting
    # quoted when it starts at or below '#', ends in a blank or control character, or holds a special character
    # one expression: a test per character makes code for many columns too long to be compiled
    special = "|".join(re.escape(c) for c in dict.fromkeys([d.sep, q, e, "\n", "\r"]))
    need = text.rlike(rf"\A[\x00-#]|[\x00-\x20]\z|{special}")
    need = (F.length(text) > 0) & need
    if first:
        need = need | (F.length(text) == 0)
    return F.coalesce(F.when(need, quoted).otherwise(text), null)


def render_lines(df: DataFrame, dialect_name: str | Dialect = "custom", quote_mode: str | None = None,
                 formats: dict[str, str] | None = None) -> Column:
    d = dialect(dialect_name)
    mode = quote_mode or d.quote_mode or MINIMAL
    formats = formats or DEFAULT_FORMATS
    cells = [
        render_cell(_text_of(f.name, f.dataType, formats), d, mode, isinstance(f.dataType, T.NumericType), i == 0)
        for i, f in enumerate(df.schema.fields)
    ]
    line = F.concat_ws(d.sep, *cells)
    return F.concat(line, F.lit(d.sep)) if d.trailing_delimiter else line


def header_line(names: list[str], d: Dialect, mode: str) -> str:
    def cell(n: str, i: int) -> str:
        if mode == NONE or d.quote is None:
            return n
        if mode in (ALL, ALL_NON_NULL, NON_NUMERIC) or re.search(f"[{re.escape(d.sep + d.quote)}\\s]", n) or (not n and i == 0):
            return d.quote + n.replace(d.quote, (d.escape or d.quote) + d.quote) + d.quote
        return n

    return d.sep.join(cell(n, i) for i, n in enumerate(names)) + (d.sep if d.trailing_delimiter else "")


def csv_write(df: DataFrame, path: str, dialect_name: str | Dialect = "custom", header: bool = True,
              quote_mode: str | None = None, formats: dict[str, str] | None = None, mode: str = "errorifexists",
              compression: str | None = None) -> None:
    """Write delimited files; every file starts with the header when there is one.

    Lines are rendered as one expression, and the header is put in front of the
    first row of each task, so there is no separate header file or driver step.
    """
    d = dialect(dialect_name)
    top = header_line(df.columns, d, quote_mode or d.quote_mode or MINIMAL) if header else None
    write_lines(df.select(render_lines(df, d, quote_mode, formats).alias("line")), path, top, d.line_sep, mode, compression)


def write_lines(lines: DataFrame, path: str, top: str | None = None, line_sep: str = "\n", mode: str = "errorifexists",
                compression: str | None = None) -> None:
    """Write column ``line``, with ``top`` as the first line of every file; a table without rows gives a file of it alone."""
    line = F.col("line")
    if top is not None:
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        line = F.when(first, F.concat(F.lit(top + line_sep), line)).otherwise(line)

    def write(rows: DataFrame, how: str) -> None:
        # one file a task, so that the first row of a task is the first of a file
        out = rows.write.mode(how).option("lineSep", line_sep).option("maxRecordsPerFile", 0)
        if compression:
            out = out.option("compression", compression)
        out.text(path)

    write(lines.select(line.alias("value")), mode)
    spark = lines.sparkSession
    if top is not None and spark.read.text(path).isEmpty():
        write(spark.range(1).select(F.lit(top).alias("value")), "append")


def csv_write_extra_fields(df: DataFrame, schema_columns: list[str]) -> DataFrame:
    """Schema columns first (null where absent), then the extra ones."""
    first = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in schema_columns]
    return df.select(*first, *[F.col(f"`{c}`") for c in df.columns if c not in schema_columns])


def with_position(scan: DataFrame, file: str = "_file", block: str = "_block", row: str = "_seq") -> DataFrame:
    """Input position as ordering columns: file, start of the block read, and row number within the task."""
    return scan.select(
        "*", F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias(block),
        F.monotonically_increasing_id().alias(row),
    )
