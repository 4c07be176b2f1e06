"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code point order (null last) weigh 5, 2, 1 and so on, and
share ``SHARE`` times all words; a target stops at ``MOST`` times its source,
and the excess is shared anew by weight until none is above.

Copies: in a source, a document of ``size`` words should come
``min(MOST, level * importance)`` times on average, where the importance is
one over the bit length of the size, so that short texts come more often than
long ones, and the level makes the expected words the target.  The whole part
is certain.  The rest is an inclusion probability p: documents are ranked by
``u / (1 - u)`` over ``p / (1 - p)`` and taken in that order until the source's
remaining words are filled (the sample's fixed size counts words, as targets
do); the last document is taken if that comes nearer.

``u`` is a hash of id and text, so reruns agree.  No source is sorted or
gathered: a histogram of ranks finds the bucket that holds the cut, and only
its rows, 1 in ``BUCKETS`` of a source, are ordered.

Edge cases: null and empty texts have no words and are never taken; repeated
rows have one rank and come together or not at all; an empty table, or one
without words, has targets 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.llm.base import WORD, fraction, packed, pick, saved, unpacked
from recordflow.operators.batches import number_rows

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
BUCKETS = 1 << 16
SALTS = 32
#: Most bytes of source names, and sources, that are sent to every task; beyond, a salted join spreads hot sources.
SENT_BYTES, SENT_ROWS = 4 << 20, 50_000
SEED = 1

_KEY = ["no_source", "source_key"]


def _sized(rows: DataFrame) -> DataFrame:
    """Source key, size, importance class and random number of each row of ``rows`` (doc_id, text, source, ...)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return rows.select(
        "*", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source_key"), size.alias("size"),
        fraction(SEED, F.col("doc_id"), F.xxhash64("text")).alias("u"),
    ).withColumn("class", F.length(F.bin("size")))


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (key, source_size) with ``target``. Rounds bring a row of sums each to the driver."""
    numbered = number_rows(sources, _KEY, "place")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    weighed = saved(numbered.withColumn("weight", weight).drop("place"), narrow=True)
    words, weights = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    if not words:
        return weighed.withColumn("target", F.lit(0.0))
    total, level, full = SHARE * words, SHARE * words / weights, -1
    while True:
        above = F.lit(level) * F.col("weight") >= MOST * F.col("source_size")
        sums = weighed.agg(
            F.count_if(above), F.sum(F.when(above, MOST * F.col("source_size")).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
        ).first()
        if sums[0] == full or not sums[2]:
            break
        full, level = sums[0], (total - sums[1]) / sums[2]
    return weighed.withColumn("target", F.least(F.lit(level) * F.col("weight"), (MOST * F.col("source_size")).cast("double")))


def _levels(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with ``level``: a row per source, from one row per source and size class (64 at most)."""
    by_class = sized.filter("size > 0").groupBy(*_KEY, "class").agg(F.sum("size").alias("words")).join(sources, _KEY)
    order = Window.partitionBy(*_KEY).orderBy("class")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum(F.col("words") / F.col("class")).over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.col("target") - MOST * before) / after
    fits = by_class.select(*_KEY, "class", level.alias("level")).filter(F.col("level") / F.col("class") <= MOST * (1 + 1e-12))
    first = fits.groupBy(*_KEY).agg(F.min_by("level", "class").alias("level"))
    return sources.join(first, _KEY, "left").withColumn("level", F.coalesce("level", F.lit(0.0)))


def _with(rows: DataFrame, params: DataFrame) -> DataFrame:
    """``rows`` with the parameters of their source, without gathering a source."""
    count, length = params.agg(F.count(F.lit(1)), F.sum(F.octet_length("source_key"))).first()
    if count <= SENT_ROWS and (length or 0) <= SENT_BYTES:
        return rows.join(F.broadcast(params), _KEY)
    salt = F.floor(F.col("u") * SALTS).cast("int")
    spread = params.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", salt).join(spread, [*_KEY, "salt"]).drop("salt")


def _ranked(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Certain copies, and the rank in [0, 1): odds ratio r as r / (1 + r)."""
    copies = F.least(F.lit(float(MOST)), F.col("level") / F.col("class"))
    joined = _with(rows, params).withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0.0))
    joined = joined.withColumn("whole", F.floor("copies").cast("long")).withColumn("p", F.col("copies") - F.col("whole"))
    odds = F.col("u") * (1 - F.col("p"))
    rank = odds / (odds + (1 - F.col("u")) * F.col("p"))
    joined = joined.withColumn("rank", F.when(F.col("p") > 0, rank))
    bucket = F.least(F.floor(F.col("rank") * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    return joined.withColumn("bucket", F.when(F.col("rank").isNotNull(), bucket))


def plan(sized: DataFrame) -> DataFrame:
    """A row per source: key, source_size, target, level, cut_bucket and cut_rank. ``sized`` is saved."""
    sources = sized.groupBy(*_KEY).agg(F.sum("size").alias("source_size"))
    params = saved(_levels(sized, targets(sources)), narrow=True)
    ranked = _ranked(sized, params)
    certain = ranked.groupBy(*_KEY).agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    params = saved(params.join(certain, _KEY).withColumn("rest", F.col("target") - F.col("certain")), narrow=True)
    histogram = ranked.filter("rank is not null").groupBy(*_KEY, "bucket").agg(F.sum("size").alias("words"))
    order = Window.partitionBy(*_KEY).orderBy("bucket")
    summed = histogram.withColumn("upto", F.sum("words").over(order)).join(params.select(*_KEY, "rest"), _KEY)
    crossing = (
        summed.filter("upto > rest").groupBy(*_KEY)
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("c"))
        .select(*_KEY, F.col("c.bucket").alias("cut_bucket"), F.col("c.before").alias("before"))
    )
    cuts = saved(params.select(*_KEY, "rest").join(crossing, _KEY), narrow=True)
    inside = _with(ranked.select(*_KEY, "u", "bucket", "rank", "size"), cuts).filter("bucket = cut_bucket")
    peers = inside.groupBy(*_KEY, "rank").agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    upto = F.col("before") + F.sum("words").over(Window.partitionBy(*_KEY).orderBy("rank"))
    taken = peers.withColumn("middle", upto - F.col("words") / 2).filter("middle <= rest")
    last = taken.groupBy(*_KEY).agg(F.max("rank").alias("cut_rank"))
    found = params.drop("certain", "rest").join(cuts.select(*_KEY, "cut_bucket"), _KEY, "left").join(last, _KEY, "left")
    return saved(found.fillna({"cut_bucket": BUCKETS, "cut_rank": -1.0}), narrow=True)


def _taken(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and ``times``, the copies that the mix takes."""
    ranked = _ranked(rows, planned)
    chosen = (F.col("bucket") < F.col("cut_bucket")) | ((F.col("bucket") == F.col("cut_bucket")) & (F.col("rank") <= F.col("cut_rank")))
    return ranked.withColumn("times", F.col("whole") + F.coalesce(chosen, F.lit(False)).cast("long"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, source for every row. Texts are read once."""
    sized = saved(_sized(pick(docs, "doc_id", "text", "source")).drop("text"))
    mixed = _taken(sized, plan(sized))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "source")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, all columns, with ``mix_copies`` (1 or 2) and ``mix_target``."""
    sized = saved(_sized(pick(docs, "doc_id", "text", "source")).drop("text"))
    rows = _sized(packed(docs, "doc_id", "text", "source"))
    taken = _taken(rows, plan(sized)).filter(F.col("times") > 0)
    return unpacked(taken, docs, F.col("times").alias("mix_copies"), F.col("target").alias("mix_target"))
