"""Headers bound per file, and records cut at quote states by many tasks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordflow.sources import csv, records


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "512")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("name", ["custom", "excel", "tdf", "mysql"])
def test_each_file_is_bound_by_its_own_header(spark, tmp_path, name, multi_line):
    sep = csv.dialect(name).sep
    write(tmp_path / "t", "a.csv", "id,name\n1,x\n2,y\n".replace(",", sep))
    write(tmp_path / "t", "b+ c[1].csv", "name,id,more\nz,3,m\n".replace(",", sep))
    write(tmp_path / "t", "c.csv", "\n\nid,name\n4,w\n".replace(",", sep))
    path = write(tmp_path / "t", "empty.csv", "")
    scan = csv.csv_scan(spark, path, name, multi_line=multi_line)
    assert scan.columns == ["id", "name", "more"]
    rows = [tuple(r) for r in scan.collect() if r.id is not None]
    assert sorted(rows) == [("1", "x", None), ("2", "y", None), ("3", "z", "m"), ("4", "w", None)]


def test_duplicate_policy_holds_for_every_file(spark, tmp_path):
    write(tmp_path / "t", "a.csv", "id,name\n1,x\n")
    path = write(tmp_path / "t", "b.csv", "id,id\n1,2\n")
    with pytest.raises(ValueError, match="duplicate"):
        csv.csv_scan(spark, path, duplicates="disallow")


def test_one_header_keeps_the_whole_path(spark, tmp_path):
    write(tmp_path / "t", "a.csv", "id,name\n1,x\n")
    path = write(tmp_path / "t", "b.csv", "id,name\n2,y\n")
    assert [names for names, _ in csv.file_headers(spark, path, csv.dialect("custom"))] == [["id", "name"]]
    assert csv.csv_scan(spark, str(tmp_path / "nothing" / "..") + "/t").count() == 2


def cells_of(draw):
    pieces = ["a", "b c", "line\nbreak", "\n\n", 'say ""so""', ",", " ", "é", "\r\n", "1"]
    return "".join(draw.choice(pieces) for _ in range(draw.randrange(6)))


def quoted_text(rows, end, draw):
    lines = []
    for row in rows:
        if row is None:
            lines.append("")
        else:
            lines.append(",".join(f'"{c}"' if set(c) & set(',\n\r" ') or draw.random() < 0.3 else c for c in row))
    return end.join(lines) + end


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("name", ["rfc-4180", "informix-unload-csv"])
@pytest.mark.parametrize("seed", [1, 2])
def test_one_large_file_is_read_by_many_tasks(spark, tmp_path, small_splits, name, end, seed):
    draw = random.Random(seed)
    rows = [[str(i), *(cells_of(draw) for _ in range(2))] if draw.random() < 0.9 else None for i in range(500)]
    rows[40][1:] = ["start " + "\nno end in sight" * 150, "x"] if rows[40] else []
    rows[41] = ["41", "spans, many splits" + "\n, 1," * 600, "y"]
    path = write(tmp_path / "t", "a.csv", quoted_text([["id", "p", "q"], *rows], end, draw))
    scan = csv.csv_scan(spark, path, name)
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 8
    kept = csv.dialect(name).keep_blank_lines
    plain = lambda c: c.replace('""', '"') or None
    expected = sorted(str([plain(c) for c in r]) for r in rows if r)
    found = scan.collect()
    assert sorted(str(list(r)) for r in found if r.id and r.id.strip()) == expected
    assert sum(not (r.id or "").strip() for r in found) == (sum(r is None for r in rows) if kept else 0)


def test_splits_give_what_one_task_gives(spark, tmp_path, small_splits):
    draw = random.Random(4)
    odd = ['"', '""', ',"', '",', "a", "\n", '\n"', '"\n', " ", "\\", '\\"', "#", ","]
    for n, name in enumerate(["rfc-4180", csv.dialect("custom").but(comment="#"), "mongodb-csv"] * 3):
        text = "".join(draw.choice(odd) for _ in range(4000)) + "\n"
        path = write(tmp_path / str(n), "a.csv", text)
        d = csv.dialect(name)
        read = lambda: [r.line for r in csv.read_records(spark, path, d.but(keep_blank_lines=True)).collect()]
        split = sorted(read())
        for k in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.set(f"spark.sql.files.{k}", "128m")
        assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() == 1
        assert sorted(read()) == split
        for k in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.set(f"spark.sql.files.{k}", "512")


def test_states_before_lines_follow_every_line():
    draw = np.random.default_rng(2)
    for _ in range(200):
        out, in_ = draw.integers(0, 2, (2, 12)).astype(np.int8)
        for entry in (0, 1):
            expected = [entry]
            for o, i in zip(out, in_):
                expected.append(int(i if expected[-1] else o))
            assert records.states_before(out, in_, entry).tolist() == expected


def test_states_after_single_lines(spark):
    cases = [
        ("a,b", 0, 1), ('"a,b', 1, 0), ('"a","b', 1, 1), ('"a,b"', 0, 0), ('a"b', 0, 0), ('x",y', 0, 0), ('x","y', 1, 1),
        ('"a""', 1, 0), ('"a""b', 1, 0), ("", 0, 1), ('"', 1, 0), ('a,"', 1, 0), ('"x"y,"z', 1, 1), (' "a', 1, 0), ('a""', 0, 1),
    ]
    frame = spark.createDataFrame([(t,) for t, _, _ in cases], "t string")
    out, in_ = records.states_after(F.col("t"), ",", '"', None)
    found = [(r[0], int(r[1]), int(r[2])) for r in frame.select("t", out, in_).collect()]
    assert found == cases


def test_only_the_lines_of_crossing_records_are_cut_again(spark, tmp_path):
    # short records in front of and behind each long one; splits begin inside and outside quotes
    body = "".join(f'{i},"' + "x\n" * (400 if i % 50 == 0 else 2) + '"\n' for i in range(600))
    (tmp_path / "a.csv").write_text("id,text\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        out = records.quoted_records(spark, str(tmp_path), ",", '"', None, None, True)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "_head" in plan and "_tail" in plan
        assert sorted(r["line"] for r in out.collect()) == sorted(f'{i},"' + "x\n" * (400 if i % 50 == 0 else 2) + '"' for i in range(600))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_invalid_bytes_in_a_record_that_crosses_splits(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbfid,text\n1,"' + b"\xe9x\n" * 900 + b'"\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        out = records.quoted_records(spark, str(tmp_path), ",", '"', None, None, True)
        assert [r["line"] for r in out.collect()] == ['1,"' + "�x\n" * 900 + '"']
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
