"""Delimited text: dialects, corners of the format, schema inference, writing."""

import pytest
from pyspark.sql import functions as F

from recordflow.functions import timestamps
from recordflow.sources import csv


def put(tmp_path, name, data):
    f = tmp_path / name
    f.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(f)


def cells(spark, line, d):
    rows = spark.createDataFrame([(line,)], "line string")
    return csv.parse_lines(rows, csv.dialect(d)).first()["cells"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("line, want", [
    ("a,b,c", ["a", "b", "c"]),
    ("", [""]), (",", ["", ""]), ("a,,", ["a", "", ""]),
    ('"a","b,c",d', ["a", "b,c", "d"]),
    ('"say ""hi""",x', ['say "hi"', "x"]),
    (' "padded" ,x', ["padded", "x"]),
    ('"",""', ["", ""]),
    ('a"b,c', ['a"b', "c"]),
    ('"open,x', ['"open', "x"]),
    ("  a , b ", ["  a ", " b "]),
])
def test_rfc_lines(spark, line, want):
    assert cells(spark, line, "rfc-4180") == want


@pytest.mark.parametrize("line, want", [
    (" a , b ", ["a", "b"]), ('" a ",b', ["a", "b"]), (r'"a\"b",c', ['a"b', "c"]), (r"a\,b,c", ["a,b", "c"]),
    (r"x\ny,z", ["x\ny", "z"]), (r"a\\,b", ["a\\", "b"]), (r"a\q,b", [r"a\q", "b"]),
])
def test_custom_lines(spark, line, want):
    assert cells(spark, line, "custom") == want


@pytest.mark.parametrize("run, want", [
    (1, ["a\tb", "c"]), (2, ["a\\", "b", "c"]), (3, ["a\\\tb", "c"]), (4, ["a\\\\", "b", "c"]), (5, ["a\\\\\tb", "c"]),
])
def test_runs_of_escapes_outside_quotes(spark, run, want):
    assert cells(spark, "a" + "\\" * run + "\tb\tc", "mysql") == want


def test_escape_before_a_letter_after_an_escaped_escape(spark):
    assert cells(spark, r"a\\n" + "\t" + r"\n", "mysql") == [r"a\n", "\n"]
    assert cells(spark, "end\\", "mysql") == ["end\\"]


def test_null_markers(spark):
    assert cells(spark, "\\N\tx\tN", "mysql") == [None, "x", "N"]
    # a quoted marker is text where quoting is strict, and null elsewhere
    strict = csv.Dialect(null="NULL", quote_mode=csv.ALL_NON_NULL, keep_blank_lines=True)
    assert cells(spark, 'NULL,"NULL",""', strict) == [None, "NULL", ""]
    assert cells(spark, 'NULL,"NULL"', csv.Dialect(null="NULL")) == [None, None]
    assert cells(spark, ',""', "postgresql-csv") == [None, ""]


def test_very_long_cells(spark):
    long = "x" * 300_000 + '""' + "y" * 300_000
    assert cells(spark, f'"{long}",b', "rfc-4180") == [long.replace('""', '"'), "b"]
    assert cells(spark, ("\\\\" * 100_000) + "\tb", "mysql") == ["\\" * 100_000, "b"]


def test_presets_have_the_known_values():
    assert set(csv.DIALECTS) >= {"custom", "rfc-4180", "excel", "tdf", "mysql", "informix-unload", "informix-unload-csv",
                                 "mongodb-csv", "mongodb-tsv", "oracle", "postgresql-csv", "postgresql-text"}
    assert csv.dialect("TDF").sep == "\t" and csv.dialect("informix-unload").sep == "|"
    assert csv.dialect("mysql").null == "\\N" and csv.dialect("mysql").quote is None
    with pytest.raises(ValueError):
        csv.dialect("lotus")


def test_bom_multi_line_cells_and_crlf(spark, tmp_path):
    path = put(tmp_path, "a.csv", "\ufeffid,text\r\n1,\"two\r\nlines, one cell\"\r\n2,plain\r\n")
    out = csv.csv_scan(spark, path, "informix-unload-csv")
    assert out.columns == ["id", "text"]
    assert [(r["id"], r["text"].replace("\r\n", "\n")) for r in out.orderBy("id").collect()] == [("1", "two\nlines, one cell"), ("2", "plain")]


@pytest.mark.parametrize("encoding, text", [("UTF-16", "é한"), ("ISO-8859-1", "é"), ("windows-949", "한글")])
@pytest.mark.parametrize("kind", ["custom", "mysql"])
def test_charsets(spark, tmp_path, encoding, text, kind):
    sep = csv.dialect(kind).sep
    path = put(tmp_path, "a.csv", f"id{sep}name\n1{sep}{text}\n".encode({"windows-949": "cp949"}.get(encoding, encoding)))
    # charsets beyond the usual ones need Spark's own switch
    spark.conf.set("spark.sql.legacy.javaCharsets", str(encoding == "windows-949").lower())
    try:
        assert csv.csv_scan(spark, path, kind, encoding=encoding).first()["name"] == text
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


BODY = "id,name\n# about\n1,a\n\n2, b \n#x,y\n3,\n"


def test_blank_and_comment_lines(spark, tmp_path):
    path = put(tmp_path, "a.csv", BODY)
    commented = csv.dialect("custom").but(comment="#")
    assert rows_of(csv.csv_scan(spark, path, commented, multi_line=False)) == rows_of(csv.csv_scan(spark, path, commented)) == \
        rows_of(spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "id string, name string"))
    kept = csv.csv_scan(spark, path, csv.dialect("excel").but(comment="#"), multi_line=False)
    assert (None, None) in rows_of(kept) and kept.count() == 4
    # without a comment marker the lines are data
    assert csv.csv_scan(spark, path, "custom").count() == 5


def test_only_the_first_line_of_each_file_is_a_header(spark, tmp_path):
    for i in range(3):
        put(tmp_path, f"{i}.csv", "\n\nid\tname\n" + f"{i}\tx\n" + "id\tname\n" * i)
    out = csv.csv_scan(spark, str(tmp_path), "mysql")
    got = [r["id"] for r in out.collect()]
    assert sorted(g for g in got if g) == ["0", "1", "2", "id", "id", "id"]


def test_headers_are_dropped_across_batches_and_splits(spark, tmp_path):
    for i in range(4):
        put(tmp_path, f"{i}.csv", "k\tv\n" + "".join(f"{i}-{j}\t{j}\n" for j in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        out = csv.csv_scan(spark, str(tmp_path), "mysql")
        assert out.count() == 20000 and out.filter("k = 'k'").count() == 0 and out.select("k").distinct().count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_header_modes(spark, tmp_path):
    path = put(tmp_path, "a.csv", "id,name\n1,a\n")
    assert rows_of(csv.csv_scan(spark, path, names=["x", "y"], header="ignored")) == [("1", "a")]
    assert csv.csv_scan(spark, path, names=["x", "y"], header="none").count() == 2
    with pytest.raises(ValueError):
        csv.csv_scan(spark, path, header="none")
    typed = csv.bind_types(csv.csv_scan(spark, path), {"id": "int"})
    assert dict(typed.dtypes)["id"] == "int" and dict(typed.dtypes)["name"] == "string"


def test_duplicate_and_blank_headers(spark, tmp_path):
    path = put(tmp_path, "a.csv", "a,b,a\n1,2,3\n")
    assert rows_of(csv.csv_scan(spark, path).select("a", "b")) == [("3", "2")]
    assert rows_of(csv.csv_scan(spark, path, duplicate_values="shifted")) == [("1", "2")]
    with pytest.raises(ValueError, match="duplicate"):
        csv.csv_scan(spark, path, duplicates="disallow")
    with pytest.raises(ValueError, match="duplicate"):
        csv.csv_scan(spark, path, duplicates="allow_empty")
    assert csv.check_header(["a", "", " "], "allow_empty") == ["a", "", " "]
    with pytest.raises(ValueError, match="missing"):
        csv.check_header(["a", ""], blank_names=False)
    with pytest.raises(ValueError):
        csv.check_header(["", ""], "disallow")


def test_surplus_cells(spark, tmp_path):
    path = put(tmp_path, "a.csv", "id,name\n1,a,x,y\n2,b\n")
    scan = lambda how: csv.csv_scan(spark, path, names=["id", "name"], header="ignored", unknown=how)
    assert scan("columns").columns == ["id", "name", "unknown_field_index_2", "unknown_field_index_3"]
    maps = {r["id"]: r["_unknown"] for r in scan("map").collect()}
    assert maps == {"1": {"unknown_field_index_2": "x", "unknown_field_index_3": "y"}, "2": {}}
    assert scan("drop").columns == ["id", "name"]


def test_field_count(spark, tmp_path):
    d = csv.dialect("custom")
    lines = csv.read_lines(spark, put(tmp_path, "a.csv", "1,a\n2\n3,c,d\n"), d)
    parsed = csv.parse_lines(lines, d)
    good, bad = csv.split_field_count(parsed, 2)
    assert good.count() == 1 and bad.count() == 2
    # nothing is checked when no count is given
    assert csv.split_field_count(parsed, None)[0].count() == 3
    assert csv.require_field_count(parsed, None).count() == 3
    with pytest.raises(csv.FieldCountError):
        csv.require_field_count(parsed, 2)


def test_quarantine_counts_do_not_depend_on_the_columns_used(spark, tmp_path):
    path = put(tmp_path, "a.csv", "id,n,t\n1,2,a\n2,x,b\n3,4\n5,6,c,d\n")
    good, bad = csv.csv_quarantine(csv.scan_with_rejects(spark, path, {"id": "int", "n": "int", "t": "string"}))
    assert [r["id"] for r in good.select("id").collect()] == [1]
    assert sorted(r["id"] for r in bad.select("id").collect()) == [2, 3, 5]
    assert bad.count() == 3 and good.count() == 1
    reasons = {r["id"]: r["_rejects"][0]["reason"] for r in bad.collect()}
    assert reasons == {2: "not a valid int", 3: "wrong number of cells", 5: "wrong number of cells"}


def test_inference_reads_every_row_and_skips_nulls(spark):
    rows = spark.createDataFrame(
        [("1", "1", None, "2020-01-01", "true", "1.5", "x"), (None, "3000000000", None, "2020-01-02", "FALSE", "2", "1")],
        "a string, b string, c string, d string, e string, f string, g string")
    assert csv.csv_infer_schema(rows) == {"a": "int", "b": "bigint", "c": "string", "d": "date", "e": "boolean", "f": "double", "g": "string"}
    assert csv.csv_infer_schema(rows.limit(0)) == {c: "string" for c in "abcdefg"}
    # plus signs, exponents and numbers too long for a bigint stay text; quotes are looked through
    odd = spark.createDataFrame([("+1", "1e5", "9" * 30, '"7"')], "a string, b string, c string, d string")
    assert csv.csv_infer_schema(odd) == {"a": "string", "b": "string", "c": "string", "d": "int"}


@pytest.mark.parametrize("mode, want", [
    (csv.ALL, '"1","a,b","","2020-01-01"'), (csv.ALL_NON_NULL, '"1","a,b",,"2020-01-01"'), (csv.MINIMAL, '1,"a,b",,2020-01-01'),
    (csv.NON_NUMERIC, '1,"a,b",,"2020-01-01"'), (csv.NONE, r"1,a\,b,,2020-01-01"),
])
def test_quote_modes(spark, mode, want):
    df = spark.sql("SELECT 1 AS a, 'a,b' AS b, CAST(NULL AS STRING) AS c, DATE'2020-01-01' AS d")
    assert df.select(csv.render_lines(df, "default", mode)).first()[0] == want


@pytest.mark.parametrize("text, want", [("#x", '"#x"'), ("x ", '"x "'), ("", '""'), ('a"b', '"a""b"'), ("a\nb", '"a\nb"'), ("plain", "plain")])
def test_minimal_quoting(spark, text, want):
    df = spark.createDataFrame([(text,)], "a string")
    assert df.select(csv.render_lines(df, "default", csv.MINIMAL)).first()[0] == want


def test_written_files(spark, tmp_path):
    df = spark.range(100).select("id", F.concat(F.lit("n,"), "id").alias("na me")).repartition(3)
    csv.csv_write(df, str(tmp_path / "o"), csv.dialect("custom").but(trailing_delimiter=True))
    files = sorted((tmp_path / "o").glob("part-*"))
    assert len(files) == 3 and all(f.read_text().startswith('id,"na me",\n') for f in files)
    assert sum(len(f.read_text().splitlines()) - 1 for f in files) == 100
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        csv.csv_write(df, str(tmp_path / "o"))


def test_date_and_time_formats(spark):
    df = spark.sql("SELECT DATE'2020-01-02' AS d, TIMESTAMP_NTZ'2020-01-02 03:04:05' AS t")
    line = csv.render_lines(df, "default", formats={"date": "dd.MM.yyyy", "time": "HH:mm", "timestamp": "yyyyMMdd'T'HHmm"})
    assert df.select(line).first()[0] == "02.01.2020,20200102T0304"


def test_position_orders_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "1\n2\n3\n")
    out = csv.with_position(spark.read.csv(str(tmp_path / "a.csv"))).orderBy("_file", "_block", "_seq")
    assert [r["_c0"] for r in out.collect()] == ["1", "2", "3"]


def test_header_of_a_table_without_rows(spark, tmp_path):
    df = spark.createDataFrame([], "id int, name string")
    csv.csv_write(df, str(tmp_path / "plain"))
    csv.csv_write(df, str(tmp_path / "packed"), compression="gzip")
    for folder in ("plain", "packed"):
        assert [r.value for r in spark.read.text(str(tmp_path / folder)).collect()] == ["id,name"]


def test_every_file_has_a_header(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 2)
    try:
        csv.csv_write(spark.range(7).coalesce(1), str(tmp_path / "o"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    tops = [p.read_text().splitlines()[0] for p in (tmp_path / "o").glob("part-*")]
    assert tops == ["id"]


def test_a_cell_is_matched_once(spark):
    # whatever a cell's value is used for, its quotes are looked at once, and a doubled quote is undone once
    rows = spark.createDataFrame([('1,"a ""b"" c",x',)], "line string")
    for name in ("mongodb-csv", "postgresql-csv", "rfc-4180"):
        parsed = csv.parse_lines(rows, csv.dialect(name))
        assert parsed.first()["cells"] == ["1", 'a "b" c', "x"]
        plan = parsed._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("rlike(") + plan.count(" rlike ") == 1 and plan.count("trim(") == 1


def test_minimal_quoting_is_one_expression(spark):
    df = spark.createDataFrame([("a", "b")], "a string, b string")
    plan = df.select(csv.render_lines(df, "default", csv.MINIMAL).alias("line"))._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("rlike") == 2 and "ascii(" not in plan
    odd = spark.createDataFrame([(t,) for t in ("$x", "#x", "x\t", "x!", "", None, "a\rb", "é ")], "a string")
    got = [r[0] for r in odd.select(csv.render_lines(odd, "default", csv.MINIMAL)).collect()]
    assert got == ["$x", '"#x"', '"x\t"', "x!", '""', "", '"a\rb"', '"é "']


@pytest.mark.parametrize("pattern", ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "HH:mm:ss", "d.M.yyyy", "H:m", "yyyyMMdd", "MM-dd HH", "dd MMM yyyy"])
def test_fitting_is_parsing(spark, pattern):
    texts = ["2020-02-31 23:59:59", "2021-02-29", "2020-13-01", "2020-00-10", "2020-01-00", "2020-01-32", "24:00:00", "23:59:60", "9:05",
             "23:59:59", "0000-01-01", "31.2.2020", "1.13.2020", "20200230", "99-99 23", "02 Jan 2020", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind, parse in (("timestamp", timestamps.parse_timestamp), ("date", timestamps.parse_date), ("time", timestamps.parse_time)):
        fits = F.coalesce(timestamps.fits_pattern(F.col("t"), kind, pattern), F.lit(False))
        assert rows.filter(fits != parse(F.col("t"), pattern).isNotNull()).count() == 0


def test_inference_makes_no_timestamps(spark):
    # cells are judged by expressions; no value is made to see whether there is one
    rows = spark.createDataFrame([("2020-01-31 10:00:00", "2020-02-31", "25:00:00")], "a string, b string, c string")
    profile = csv.column_type_profile(rows)
    assert "timestamp_ntz" not in profile._jdf.queryExecution().optimizedPlan().toString()
    assert {r["column_name"]: r["chosen_type"] for r in profile.collect()} == {"a": "timestamp", "b": "date", "c": "string"}
