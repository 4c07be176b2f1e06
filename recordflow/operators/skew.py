"""Keeping one very frequent key from landing in one task.

Hot keys are found with a bounded sketch, and only they are treated
differently: lookups salt them, ordered scans cut them into ranges.  The hot
set and the range bounds only steer how rows are spread; results are the same
for any choice of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# a key is hot when it holds more than one row in HOT_SHARE, so at most HOT_SHARE keys are
HOT_SHARE = 512
# items a sketch tracks: enough to tell one in HOT_SHARE from the sketch's own error
SKETCH_ITEMS = 8192
SKETCH_GROUPS = 64
MIN_HOT_ROWS = 100
MAX_RANGES = 256
SAMPLE_PER_RANGE = 50

CHUNK = "_chunk"
SALT = "_salt"


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def spread(spark: SparkSession) -> int:
    """How many pieces a hot group is cut into."""
    return max(2, min(MAX_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))


@dataclass(frozen=True)
class Hot:
    """Hashes of the hot keys (at most HOT_SHARE) and the rows they hold, by estimate."""

    hashes: tuple[int, ...] = ()
    rows: int = 0

    def __bool__(self) -> bool:
        return bool(self.hashes)

    def test(self, keys: list[str]) -> Column:
        return key_hash(keys).isin(list(self.hashes)) if self.hashes else F.lit(False)


NO_HOT = Hot()


def find_hot(df: DataFrame, keys: list[str], share: int = HOT_SHARE) -> Hot:
    """One pass over the key columns with frequent-items sketches, merged in two steps; rows are not shuffled."""
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g")
    parts = df.select(key_hash(keys).alias("h"), group).groupBy("g").agg(
        F.expr(f"approx_top_k_accumulate(h, {SKETCH_ITEMS})").alias("s"), F.count(F.lit(1)).alias("n")
    )
    # grouped by a constant, so that an empty table gives no row at all
    row = parts.groupBy(F.lit(1)).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {SKETCH_ITEMS}), {share})").alias("top"), F.sum("n").alias("n")
    ).first()
    if row is None:
        return NO_HOT
    # a key of a few rows is never worth splitting, however small the table
    top = [
        (t["item"], t["count"]) for t in (row["top"] or []) if t["count"] * share > row["n"] and t["count"] >= MIN_HOT_ROWS
    ]
    return Hot(tuple(h for h, _ in top), sum(c for _, c in top))


def as_hot(df: DataFrame, keys: list[str], hot: Hot | None) -> Hot:
    return find_hot(df, keys) if hot is None else hot


def key_match(left: str, right: str, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return cond


def _repeated(table: DataFrame, keys: list[str], hot: Hot, first: int, last: int, name: str) -> DataFrame:
    """A table with one row per key, its few hot rows once for each piece number, the others with 0."""
    pieces = F.when(hot.test(keys), F.sequence(F.lit(first), F.lit(last))).otherwise(F.array(F.lit(0)))
    return table.withColumn(name, F.explode(pieces))


def salted(rows: DataFrame, table: DataFrame, keys: list[str], salt_by: list[str],
           hot: Hot) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows, a table that has one row per key, and the columns to join them on, which spread hot keys over many tasks.

    Rows of a hot key get a salt from their ordering columns; the table's few
    hot rows (one per key) are repeated once per salt.  Other keys keep salt 0.
    """
    if not hot:
        return rows, table, list(keys)
    n = spread(rows.sparkSession)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in salt_by]), F.lit(n))
    marked = rows.withColumn(SALT, F.when(hot.test(keys), salt).otherwise(0).cast("int"))
    return marked, _repeated(table, keys, hot, 0, n - 1, SALT), [*keys, SALT]


def salted_lookup(rows: DataFrame, table: DataFrame, keys: list[str], salt_by: list[str], hot: Hot,
                  how: str = "left") -> DataFrame:
    """Join rows to a table that has one row per key, spreading hot keys over many tasks."""
    marked, repeated, by = salted(rows, table, keys, salt_by, hot)
    return marked.join(repeated, by, how).drop(SALT)


@dataclass(frozen=True)
class Ranges:
    """Bounds on the ordering columns that cut hot keys into ranges."""

    hot: Hot = NO_HOT
    order: tuple[str, ...] = ()
    bounds: tuple = field(default=())

    def chunk(self, keys: list[str]) -> Column:
        """0 for ordinary keys, else 1 + the number of bounds at or below the row."""
        if not self.hot or not self.bounds:
            return F.lit(0)
        at = F.struct(*[F.col(f"`{c}`") for c in self.order])
        return F.when(self.hot.test(keys), _position(at, self.bounds, 0, len(self.bounds)) + 1).otherwise(0)


def range_lookup(rows: DataFrame, table: DataFrame, keys: list[str], ranges: Ranges) -> DataFrame:
    """Left join of rows that carry their range (:data:`CHUNK`) to a table with one row per key.

    Joining on the range as well keeps the partitioning the ordered scan has
    already made, so the rows are not shuffled again.
    """
    if not ranges.bounds:
        return rows.join(table, keys, "left")
    repeated = _repeated(table, keys, ranges.hot, 1, len(ranges.bounds) + 1, CHUNK)
    return rows.join(repeated, [*keys, CHUNK], "left")


def _position(at: Column, bounds: tuple, lo: int, hi: int) -> Column:
    """Binary search over literal bounds, as nested conditions."""
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(at < bounds[mid], _position(at, bounds, lo, mid)).otherwise(_position(at, bounds, mid + 1, hi))


def find_ranges(df: DataFrame, keys: list[str], order: list[str], hot: Hot | None = None) -> Ranges:
    """Sample the ordering columns of the hot keys and pick evenly spaced bounds (bounded sample)."""
    hot = as_hot(df, keys, hot)
    if not hot:
        return Ranges()
    n = spread(df.sparkSession)
    want = n * SAMPLE_PER_RANGE
    cols = [F.col(f"`{c}`") for c in order]
    picked = df.filter(hot.test(keys)).select(*cols).na.drop()
    if hot.rows > want:
        picked = picked.sample(fraction=min(1.0, 1.5 * want / hot.rows), seed=7)
    sample = picked.distinct().orderBy(*cols).limit(4 * want).collect()
    if not sample:
        return Ranges()
    types = {f.name: f.dataType for f in df.schema.fields}
    step = max(1, len(sample) // n)
    bounds = tuple(
        F.struct(*[F.lit(r[c]).cast(types[c]).alias(c) for c in order]) for r in sample[step::step][: n - 1]
    )
    return Ranges(hot, tuple(order), bounds)


def carry_last(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column],
               ranges: Ranges | None = None) -> DataFrame:
    """For each row, the last non-null value strictly before it within its key.

    Ordinary keys use one window.  A hot key is scanned range by range, and
    the last value of the earlier ranges (at most hot keys x ranges rows) is
    broadcast back to fill the start of each range; the rows then also have
    their range in :data:`CHUNK`.
    """
    ranges = find_ranges(df, keys, order) if ranges is None else ranges
    by = [F.col(f"`{c}`") for c in order]
    if not ranges.bounds:
        w = Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({n: F.last(v, ignorenulls=True).over(w) for n, v in values.items()})

    cut = df.withColumn(CHUNK, ranges.chunk(keys))
    w = Window.partitionBy(*keys, CHUNK).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumns({n: F.last(v, ignorenulls=True).over(w) for n, v in values.items()})
    at = F.struct(*by)
    tails = (
        cut.filter(F.col(CHUNK) > 0)
        .groupBy(*keys, CHUNK)
        .agg(*[F.max_by(v, F.when(v.isNotNull(), at)).alias(f"_t_{n}") for n, v in values.items()])
    )
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(
        *keys, CHUNK, *[F.last(f"_t_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in values]
    )
    cond = key_match("r", "c", keys) & (F.col(f"r.{CHUNK}") == F.col(f"c.{CHUNK}"))
    joined = local.alias("r").join(F.broadcast(carried).alias("c"), cond, "left")
    out = [F.col(f"r.`{c}`") for c in cut.columns]
    out += [F.coalesce(F.col(f"r.`{n}`"), F.col(f"c._c_{n}")).alias(n) for n in values]
    return joined.select(*out)
