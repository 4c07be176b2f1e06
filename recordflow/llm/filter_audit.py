"""Filter interaction audit: what each filter removes in each order, from counters kept by retraction.

Five filters judge a text; the last, E, fails a text that a smaller id has table-wide,
so its verdict on a document can change as files arrive.  All files of the table
are one stream, read by an available-now trigger in micro-batches.  A state keyed
by text holds the smallest id seen and the documents counted under it.  A document
enters the counters under the mask of filters it fails; when a smaller id of the
same text arrives, the documents counted before are retracted and enter again
with E set.  The counters (a row per part, mask and label flags) are all that the
report needs: it never goes back to the texts.

* Masks and a SHA-256 of the text, which stands for it, are computed where the
  file is read; texts are not shuffled.
* The state is a row per text and micro-batch that met it, in a folder per
  micro-batch: a batch looks up the texts it meets in the earlier folders and adds
  its own.  Looking up scans the earlier rows (some 50 bytes a text); a batch
  holds FILES_PER_CORE files for each core, so there are few.
* Documents of one text are summed before they meet, so a text that holds a third
  of all rows is a row per part.
* A micro-batch that runs again overwrites its own folders and nothing else.

Edge cases: a null text is empty; a null ``lang`` is the part of the empty text; a
null id is smaller than none and has none smaller, so it never fails E; equal ids
with equal texts are both the smallest; repeated label rows say 1 if one of them
does, null labels say nothing; labels of unknown ids are unused; texts are read
whole; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import itertools
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from recordflow.llm.base import pick
from recordflow.operators.batches import shared_dir

FILTERS = "ABCDE"
REPEATED = 1 << 4
MASKS = 1 << len(FILTERS)
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
#: Files of a micro-batch for each core that Spark runs tasks on.
FILES_PER_CORE = 2
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"
#: A document as it is counted: its part, the mask of A to D, and its label flags (1 good, 2 toxic).
COUNTS = "part string, mask int, flags int, change long"
#: What a micro-batch leaves of each text it met.
STATE = "digest binary, part string, mask int, flags int, least long, at_least long, others long"


def failing_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    total, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = [
        total < LEAST_WORDS,
        100 * distinct.cast("long") < LEAST_DISTINCT * total.cast("long"),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MOST_CAPITALS * F.length(text).cast("long"),
        text.rlike(SYMBOLS),
    ]
    bits = [F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, part, mask, flags and the digest of the text, a row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = pick(docs, "doc_id", "text", "lang").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
        failing_mask(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    marks = [F.max(F.when(F.col(name) == 1, value).otherwise(0)) for name, value in (("quality", 1), ("toxic", 2))]
    known = pick(labels, "doc_id", "quality", "toxic").filter("doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("id")
    ).agg((marks[0] + marks[1]).alias("own"))
    return rows.join(known, F.col("doc_id") == F.col("id"), "left").select(
        "digest", "doc_id", "part", "mask", F.coalesce("own", F.lit(0)).alias("flags")
    )


def folded(rows: DataFrame) -> DataFrame:
    """A row per text, part and flags: its least id, the documents of that id (``at_least``) and those of larger ids (``others``).

    Documents are summed by id first, so a text that holds a large share of all
    rows is spread over all tasks, and a row per task is left of it after that.
    """
    kind = ["part", "mask", "flags"]
    # rows without an id share a key for each kind, shorter than any digest, that nothing retracts
    alone = F.unhex(F.sha2(F.concat_ws("|", *kind), 224))
    keyed = rows.select(
        F.when(F.col("doc_id").isNull(), alone).otherwise(F.col("digest")).alias("digest"), *kind,
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
    )
    by_id = keyed.groupBy("digest", *kind, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    whole = by_id.groupBy("digest", *kind).agg(F.min(F.struct("doc_id", "n")).alias("first"), F.sum("n").alias("n"))
    return whole.select(
        "digest", *kind, F.col("first.doc_id").alias("least"), F.col("first.n").alias("at_least"),
        (F.col("n") - F.col("first.n")).alias("others"),
    )


def counter_changes(earlier: DataFrame, now: DataFrame) -> DataFrame:
    """part, mask, flags, change: what the folded rows of a micro-batch change, given those of all earlier ones.

    Documents of this batch enter; documents of earlier batches that stood under
    their text's least id leave their counter for that of repeated ones if the
    batch holds a smaller id.
    """
    touched = earlier.join(now.select("digest").distinct(), "digest", "left_semi")
    rows = touched.withColumn("new", F.lit(False)).unionByName(now.withColumn("new", F.lit(True)))
    of_text = Window.partitionBy("digest")
    rows = rows.withColumns({
        "before": F.min(F.when(~F.col("new"), F.col("least"))).over(of_text), "after": F.min("least").over(of_text),
    })
    first, n = F.col("least") == F.col("after"), F.col("at_least")
    enters = F.when(first, n).otherwise(0), F.when(first, F.col("others")).otherwise(n + F.col("others"))
    retracted = F.when((F.col("least") == F.col("before")) & (F.col("after") < F.col("before")), n).otherwise(0)
    plain = F.when(F.col("new"), enters[0]).otherwise(-retracted)
    repeated = F.when(F.col("new"), enters[1]).otherwise(retracted)
    each = F.explode(F.array(F.struct(F.col("mask"), plain.alias("n")), F.struct((F.col("mask") + REPEATED).alias("mask"), repeated.alias("n"))))
    changed = rows.select("part", "flags", each.alias("to")).filter("to.n <> 0")
    return changed.groupBy("part", F.col("to.mask").alias("mask"), "flags").agg(F.sum("to.n").alias("change"))


def counters(spark: SparkSession, path: str, labels: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """part, mask, flags, n: documents by the filters they fail, once every file of ``path`` has streamed through."""
    base = shared_dir(spark)
    files = files_per_batch or max(1, FILES_PER_CORE * spark.sparkContext.defaultParallelism)
    # as a pattern that only the path itself fits, it may be a folder or a single file
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(pattern)
    spark.createDataFrame([], STATE).write.parquet(f"{base}/state/batch=-1")
    spark.createDataFrame([], COUNTS).write.parquet(f"{base}/changes/batch=-1")

    def step(batch: DataFrame, batch_id: int) -> None:
        folded(batch).write.mode("overwrite").parquet(f"{base}/state/batch={batch_id}")
        state = spark.read.schema(f"{STATE}, batch long").parquet(f"{base}/state")
        changes = counter_changes(
            state.filter(F.col("batch") < batch_id).drop("batch"), state.filter(F.col("batch") == batch_id).drop("batch")
        )
        changes.write.mode("overwrite").parquet(f"{base}/changes/batch={batch_id}")

    run = judged(stream, labels).writeStream.foreachBatch(step).option("checkpointLocation", f"{base}/offsets").trigger(availableNow=True).start()
    run.awaitTermination()
    changes = spark.read.schema(COUNTS).parquet(f"{base}/changes")
    return changes.groupBy("part", "mask", "flags").agg(F.sum("change").alias("n")).filter("n <> 0")


def _steps() -> list[dict]:
    """Each step of each order: its filter's bit and the bits of the filters before it."""
    out = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, 1):
            out.append({"o": "".join(FILTERS[i] for i in order), "s": step, "b": 1 << k, "e": before})
            before |= 1 << k
    return out


def report(counts: DataFrame) -> DataFrame:
    """The audit of every part, order and step from the counters.

    A part is one row of 32 counts each for all, good and toxic documents; the
    600 steps are read off that row.
    """
    wanted = {"n": F.lit(True), "good": F.col("flags").bitwiseAND(1) > 0, "toxic": F.col("flags").bitwiseAND(2) > 0}
    sums = [
        F.array(*[F.coalesce(F.sum(F.when(cond & (F.col("mask") == m), F.col("n"))), F.lit(0)) for m in range(MASKS)]).alias(name)
        for name, cond in wanted.items()
    ]
    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<o string, s int, b int, e int>>")
    rows = counts.groupBy("part").agg(*sums).select("*", F.explode(steps).alias("at"))
    bit, earlier = F.col("at.b"), F.col("at.e")

    def total(name: str, holds) -> Column:
        """Documents of the masks for which ``holds``; a share of each if it gives a number."""
        def one(n: Column, m: Column) -> Column:
            part = holds(m)
            return n * part

        return F.aggregate(F.transform(F.col(name), one), F.lit(0).cast("long"), lambda a, b: a + b)

    def where(cond: Column) -> Column:
        return F.when(cond, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))

    fails = lambda m: m.bitwiseAND(bit) > 0
    removed = lambda m: where(fails(m) & (m.bitwiseAND(earlier) == 0))
    # of the orders, a k-th part has this filter first among the k that a document fails
    orders = F.lit(120).cast("long")
    return rows.select(
        "part", F.col("at.o").alias("filter_order"), F.col("at.s").alias("step"),
        total("n", lambda m: where(m.bitwiseAND(earlier.bitwiseOR(bit)) == 0)).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: where(fails(m) & (m.bitwiseAND(earlier) > 0))).alias("redundant"),
        total("n", lambda m: where(m == bit)).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        total("n", lambda m: F.when(fails(m), (orders / F.bit_count(m)).cast("long")).otherwise(F.lit(0).cast("long"))).alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """The report over all files of the Parquet table at ``path``."""
    return report(counters(spark, path, labels, files_per_batch))
