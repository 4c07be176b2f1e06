"""Keyed operations against a plain fold over the change rows, with one key holding a third of them."""

import random

import pytest
from pyspark.sql import functions as F

from recordflow.operators import keyed, skew
from recordflow.operators.keyed import DELETE, INSERT, UPDATE, UPSERT

KEYS, ORDER = ["id"], ["seq"]
TARGET = "id bigint, a bigint, b string, keep string"


def make(spark, seed, n=600, ops=(INSERT, UPDATE, UPSERT, DELETE), null_rate=0.2):
    rnd = random.Random(seed)
    target = [(i, i * 10, f"b{i}", f"k{i}") for i in range(0, 30, 2)]
    rows = []
    for seq in range(n):
        key = 4 if rnd.random() < 0.34 else rnd.randrange(30)
        key = None if rnd.random() < 0.01 else key
        a = None if rnd.random() < null_rate else rnd.randrange(1000)
        b = None if rnd.random() < null_rate else f"v{seq}"
        rows.append((seq, key, a, b, rnd.choice(ops)))
    rnd.shuffle(rows)
    return (
        target, rows, spark.createDataFrame(target, TARGET),
        spark.createDataFrame(rows, "seq bigint, id bigint, a bigint, b string, op string"),
    )


def fold(target, rows, ignore_null=False, op=None):
    """(table, rejected seqs) by applying the rows one at a time."""
    state = {r[0]: r for r in target}
    rejected = []
    for seq, key, a, b, row_op in sorted(rows):
        kind = op or row_op
        if key is None:
            rejected.append(seq)
            continue
        old = state.get(key)
        base = kind.replace("_IGNORE", "")
        if base == DELETE:
            if old is None:
                rejected += [seq] if base == kind else []
            state.pop(key, None)
        elif base == INSERT and old is not None or base == UPDATE and old is None:
            rejected += [seq] if base == kind else []
        elif old is None:
            state[key] = (key, a, b, None)
        elif ignore_null:
            state[key] = (key, old[1] if a is None else a, old[2] if b is None else b, old[3])
        else:
            state[key] = (key, a, b, old[3])
    return sorted(state.values()), sorted(rejected)


def table_of(df):
    return sorted(tuple(r) for r in df.select("id", "a", "b", "keep").collect())


def seqs(df):
    return sorted(r["seq"] for r in df.select("seq").collect())


@pytest.mark.parametrize("ignore_null", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_mixed_operations_equal_the_fold(spark, seed, ignore_null):
    target, rows, t, c = make(spark, seed)
    done = keyed.apply_mixed(t, c, KEYS, ORDER, "op", ignore_null)
    want, rejected = fold(target, rows, ignore_null)
    assert table_of(done.table) == want
    assert seqs(done.rejects) == rejected


def test_mixed_with_and_without_the_hot_path(spark):
    _, _, t, c = make(spark, 3)
    ranges = skew.find_ranges(c, KEYS, ORDER)
    assert ranges.hot and ranges.bounds, "the test data has a hot key"
    hot = keyed.apply_mixed(t, c, KEYS, ORDER, "op", ranges=ranges)
    plain = keyed.apply_mixed(t, c, KEYS, ORDER, "op", ranges=skew.Ranges())
    assert table_of(hot.table) == table_of(plain.table)
    assert seqs(hot.rejects) == seqs(plain.rejects)


def test_mixed_with_ignore_variants(spark):
    target, rows, t, c = make(spark, 4, ops=keyed.ALL_OPERATIONS)
    done = keyed.apply_mixed(t, c, KEYS, ORDER, "op")
    want, rejected = fold(target, rows)
    assert table_of(done.table) == want and seqs(done.rejects) == rejected


@pytest.mark.parametrize("hot", [None, skew.NO_HOT])
def test_single_operations_equal_the_fold(spark, hot):
    target, rows, t, c = make(spark, 5)
    c = c.drop("op")
    want, rejected = fold(target, rows, op=INSERT)
    done = keyed.insert(t, c, KEYS, ORDER, hot)
    assert table_of(done.table) == want and seqs(done.rejects) == rejected

    want, rejected = fold(target, rows, op=DELETE)
    done = keyed.delete(t, c, KEYS, ORDER, hot)
    assert table_of(done.table) == want and seqs(done.rejects) == rejected

    want, rejected = fold(target, rows, op=UPDATE)
    done = keyed.update(t, c, KEYS, ORDER, hot=hot)
    assert table_of(done.table) == want and seqs(done.rejects) == rejected


@pytest.mark.parametrize("ignore_null", [False, True])
def test_upsert_equals_a_fold(spark, ignore_null):
    target, rows, t, c = make(spark, 6)
    want, rejected = fold(target, rows, ignore_null, op=UPSERT)
    done = keyed.upsert(t, c.drop("op"), KEYS, ORDER, ignore_null)
    assert table_of(done.table) == want and seqs(done.rejects) == rejected


def test_ignore_forms_skip_silently(spark):
    target, rows, t, c = make(spark, 7)
    assert table_of(keyed.insert_ignore(t, c, KEYS, ORDER)) == fold(target, rows, op="INSERT_IGNORE")[0]
    assert table_of(keyed.update_ignore(t, c, KEYS, ORDER)) == fold(target, rows, op="UPDATE_IGNORE")[0]
    assert table_of(keyed.delete_ignore(t, c, KEYS)) == fold(target, rows, op="DELETE_IGNORE")[0]


def test_composite_keys(spark):
    t = spark.createDataFrame([(1, "x", 5)], "k1 int, k2 string, v int")
    c = spark.createDataFrame([(0, 1, "x", 6), (1, 1, "y", 7), (2, 1, "y", 8)], "seq int, k1 int, k2 string, v int")
    out = keyed.upsert(t, c, ["k1", "k2"], ["seq"]).table
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", 6), (1, "y", 8)]


@pytest.mark.parametrize("n", [0, 1, 50])
@pytest.mark.parametrize("op", [INSERT, UPSERT, UPDATE, DELETE])
def test_record_counts_of_plain_batches(spark, n, op):
    rows = spark.range(n).select(F.col("id").alias("seq"), "id", (F.col("id") + 1000).alias("a"),
                                 F.concat(F.lit("val_"), "id").alias("b"), F.lit(op).alias("op"))
    stored = op in (UPDATE, DELETE)
    t = spark.createDataFrame([(i, 0, "", "") for i in range(n)] if stored else [], TARGET)
    done = keyed.apply_mixed(t, rows, KEYS, ORDER, "op")
    assert done.rejects.count() == 0
    assert done.table.count() == (0 if op == DELETE else n)


def test_partial_failures_by_file(spark):
    # four files of three rows; a blank name stands for a row the target refuses
    names = {"f1": ["a", "b", None], "f2": ["a", None, "c"], "f3": ["a", "b", "c"], "f4": ["a", None, "c"]}
    rows = spark.createDataFrame([(f, i, n) for f, ns in names.items() for i, n in enumerate(ns)], "file string, seq int, name string")
    good, bad = keyed.required_not_null(rows, ["name"])
    assert {r["file"]: r["count"] for r in good.groupBy("file").count().collect()} == {"f1": 2, "f2": 2, "f3": 3, "f4": 2}
    errors = {r["file"]: (r["rejected"], r["reasons"]) for r in keyed.errors_by_file(bad, "file", ["seq"]).collect()}
    assert errors == {f: (1, [("name must not be null", 1)]) for f in ("f1", "f2", "f4")}


def test_every_reason_of_a_file_is_listed(spark):
    rows = spark.createDataFrame([("f", 40 - i, f"reason {i % 15:02d}") for i in range(40)] + [("g", 1, None)], "file string, seq int, _reason string")
    found = {r["file"]: (r["rejected"], r["reasons"]) for r in keyed.errors_by_file(rows, "file", ["seq"]).collect()}
    firsts = {}
    for seq, why in sorted((40 - i, f"reason {i % 15:02d}") for i in range(40)):
        firsts[why] = firsts.get(why, 0) + 1
    assert found == {"f": (40, list(firsts.items())), "g": (1, [(None, 1)])} and len(firsts) == 15


@pytest.mark.parametrize("stored", [True, False])
def test_tied_rows_are_stored_or_rejected(spark, stored):
    """Rows equal in key and order: one applies, each other one is a reject, copies too."""
    target = spark.createDataFrame([(1, 0, "t", "")] if stored else [], TARGET)
    rows = [(1, 0, 5), (1, 0, 6), (1, 0, 6), (1, 0, 5), (1, 1, 7), (2, 3, 8), (2, 3, 8), (2, 3, 8)]
    changes = spark.createDataFrame([(seq, k, a) for k, seq, a in rows], "seq int, id bigint, a bigint").repartition(3)
    for done, applied in ((keyed.insert(target, changes, KEYS, ORDER), 1 if stored else 2), (keyed.delete(target, changes, KEYS, ORDER), int(stored))):
        assert abs(done.table.count() - target.count()) == applied
        assert done.rejects.count() == len(rows) - applied
        assert set(done.rejects.columns) == {"seq", "id", "a", keyed.REASON}
    inserted = keyed.insert(target, changes, KEYS, ORDER)
    kept = {(r["id"], r["a"]) for r in inserted.table.collect() if not (stored and r["id"] == 1)}
    left = sorted((r["id"], r["seq"], r["a"]) for r in inserted.rejects.collect())
    seq = {5: 0, 6: 0, 7: 1, 8: 3}
    assert sorted([*left, *((k, seq[a], a) for k, a in kept)]) == sorted(rows)


def test_all_or_nothing(spark):
    t = spark.createDataFrame([(1, 1, "", "")], TARGET)
    c = spark.createDataFrame([(0, 1, 5), (1, 2, 6)], "seq int, id bigint, a bigint")
    assert keyed.all_or_nothing(keyed.upsert(t, c, KEYS, ORDER)).count() == 2
    with pytest.raises(keyed.RejectedRows, match=keyed.KEY_EXISTS):
        keyed.all_or_nothing(keyed.insert(t, c, KEYS, ORDER))


def test_unknown_and_lower_case_operations(spark):
    rows = spark.createDataFrame([(0, "insert"), (1, None), (2, "MERGE")], "seq int, op string")
    good, bad = keyed.op_from_column(rows, "op")
    assert [r["op"] for r in good.collect()] == ["INSERT"]
    assert sorted(r["seq"] for r in bad.collect()) == [1, 2]


# -------------------------------------------------------------------- spreading
def test_hot_keys_are_found_and_bounded(spark):
    rows = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    hot = skew.find_hot(rows, ["k"])
    want = spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]
    assert hot.hashes == (want,)
    assert not skew.find_hot(spark.range(1000), ["id"])


def test_carry_equals_a_plain_window(spark):
    rnd = random.Random(0)
    rows = [(i, rnd.choice([1, 1, 1, 2, 3, None]), rnd.randrange(50), rnd.choice([None, "x", "y", "z"])) for i in range(2000)]
    df = spark.createDataFrame(rows, "seq int, k int, t int, v string")
    ranges = skew.find_ranges(df, ["k"], ["t", "seq"])
    assert len(ranges.bounds) >= 4
    got = skew.carry_last(df, ["k"], ["t", "seq"], {"p": F.col("v")}, ranges)
    want = skew.carry_last(df, ["k"], ["t", "seq"], {"p": F.col("v")}, skew.Ranges())
    key = lambda d: sorted(((r["seq"], r["p"]) for r in d.collect()))
    assert key(got) == key(want)
    # the hot key really is cut into pieces of a bounded size
    sizes = df.withColumn("c", ranges.chunk(["k"])).filter("c > 0").groupBy("k", "c").count().agg(F.max("count")).first()[0]
    assert sizes < 2000 / 4


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti", "inner"])
def test_salted_lookup_equals_a_join(spark, how):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"))
    table = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([(1, -1)], "k bigint, v bigint"))
    hot = skew.find_hot(rows, ["k"])
    assert hot
    got = skew.salted_lookup(rows, table, ["k"], ["seq"], hot, how)
    want = rows.join(table, ["k"], how)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_insert_and_delete_shuffle_the_changes_once(spark):
    target, _, t, c = make(spark, 5)
    for done in (keyed.insert(t, c, KEYS, ORDER, skew.NO_HOT), keyed.delete(t, c, KEYS, ORDER, skew.NO_HOT)):
        plan = done.rejects._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Window [") == 1 and "WindowGroupLimit" not in plan and "HashAggregate" not in plan
