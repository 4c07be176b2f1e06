"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

A document is the mean of its n-gram indicators: single words and pairs of
words (ASCII lower case), and the shapes of one, two and three words in a row,
where a shape writes letters as X or x, digits as 9 and runs as one character,
and a word equal to the one before it has a shape of its own.  Each n-gram is
hashed to one of ``2**BITS`` weights; a score is a sparse dot product.

Edge cases: null and empty texts have no n-grams and score by the bias alone;
rows of equal text score alike; several labels of one document count as the
lowest, null labels not at all; without labelled rows every score is 0.5; a
document without an id is neither learned from nor held out.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.base import TABLE_SIZE, byte_texts, fraction, output, packed, pick, remainder, row_groups, sums_by, unpacked

BITS = 18
#: Labelled documents that training uses at most (as an expectation over the hash that picks them).
FIT_ROWS = 16_000
SHARDS, EPOCHS = 4, 4
#: Weights times rows are summed as multiples of one over this.
UNIT = 1 << 24
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
#: Factor on the mean of a document's indicators.
SCALE = 20.0
GROUP_WORDS = 1 << 17
_SHAPE = bytes(
    ord("X") if 65 <= b <= 90 else ord("x") if 97 <= b <= 122 or b >= 128 else ord("9") if 48 <= b <= 57 else b
    for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_REPEATED = np.uint64(0x5851F42D4C957F2D)


class Words(dict):
    """Slot of each word seen by a task, with the hashes of the word and of its shape."""

    def __init__(self) -> None:
        self.hashes, self.shapes = array("Q"), array("Q")

    def __missing__(self, word: bytes) -> int:
        self[word] = slot = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word.lower()))
        self.shapes.append(xxhash.xxh64_intdigest(_RUN.sub(rb"\1", word.translate(_SHAPE)), 1))
        return slot


def ngrams(texts: list[bytes], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Weight indices of all texts in a row, and how many each text has."""
    split = [t.split() for t in texts]
    lengths = np.array([len(w) for w in split], np.int64)
    slots = np.fromiter((words[w] for ws in split for w in ws), np.int64, int(lengths.sum()))
    own = np.array(words.hashes, np.uint64)[slots]
    shape = np.array(words.shapes, np.uint64)[slots]
    first = np.zeros(len(slots), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    before = np.roll(slots, 1) == slots
    shape = np.where(before & ~first, _REPEATED, shape)
    with np.errstate(over="ignore"):
        pair = own * np.uint64(31) + np.roll(own, 1)
        two = shape * np.uint64(37) + np.roll(shape, 1) + np.uint64(2)
        three = two * np.uint64(41) + np.roll(shape, 2) + np.uint64(3)
        mixed = np.stack([own, pair, shape, two, three], axis=1)
        mixed = ((mixed ^ (mixed >> np.uint64(29))) * _ODD) >> np.uint64(64 - BITS)
    second = np.roll(first, 1) & ~first
    if len(first):
        second[0] = False
    there = np.ones(mixed.shape, bool)
    there[first, 1] = there[first, 3] = there[first, 4] = there[second, 4] = False
    counts = np.where(lengths > 1, 5 * lengths - 4, 2 * lengths)
    return mixed[there].astype(np.int64), counts


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes], words: Words) -> np.ndarray:
        index, counts = ngrams(texts, words)
        dots = sums_by(self.weights[index].astype(np.float64), counts) / np.maximum(counts, 1) * SCALE
        return 1 / (1 + np.exp(-np.clip(dots + self.bias, -500, 500)))


def _train(rows: list[tuple[int, bytes, int]]) -> tuple[np.ndarray, float]:
    """One pass of updates after another over the rows of a task; the last weight is the bias."""
    words, size = Words(), 1 << BITS
    vectors = []
    for _, text, label in sorted(rows):
        index, _ = ngrams([text], words)
        found, counts = np.unique(index, return_counts=True)
        vectors.append((np.append(found, size), np.append(counts * (SCALE / max(len(index), 1)), 1.0), label))
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for index, values, label in vectors:
            w = weights(index)
            slope = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
            step = (np.sqrt(n[index] + slope * slope) - np.sqrt(n[index])) / ALPHA
            z[index] += slope - step * w
            n[index] += slope * slope
    w = weights(slice(None))
    return w[:-1].astype(np.float32), float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from the labelled documents that ``learn`` (over doc_id) admits.

    A hash of the id picks about ``fit_rows`` of them.  Each of ``SHARDS``
    tasks makes its updates; their weights are averaged.
    """
    spark = docs.sparkSession
    known = (
        pick(labels, "doc_id", "quality").filter(learn & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    share = fit_rows / max(known.count(), 1)
    # about fit_rows narrow rows, whatever the size of the corpus
    chosen = F.broadcast(known.filter(fraction(10, F.col("doc_id")) < share))
    rows = pick(docs, "doc_id", "text").join(chosen, "doc_id")
    schema = pa.schema([("place", pa.int32()), ("part", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("quality").to_pylist()
            # an order that does not follow the ids
            found += [(xxhash.xxh64_intdigest(str(i)), t, int(m > 0)) for i, t, m in zip(ids, byte_texts(batch.column("text")), marks)]
        if found:
            weights, bias = _train(found)
            parts = np.rint(np.concatenate([weights.astype(np.float64), [bias, 1.0]]) * (len(found) * UNIT)).astype(np.int64)
            places = np.flatnonzero(parts)
            yield output({"place": places.astype(np.int32), "part": parts[places]}, schema)

    # summed as integers, so that no order of tasks shows; a row per weight comes to the driver, whatever the number of tasks
    parts = rows.repartition(SHARDS, "doc_id").mapInArrow(run, "place int, part long")
    sums = parts.groupBy("place").agg(F.sum("part").alias("part")).toArrow()
    size = 1 << BITS
    whole = np.zeros(size + 2)  # the weights, the bias, and the rows
    whole[sums.column("place").to_numpy()] = sums.column("part").to_numpy()
    mean = whole / max(whole[-1], 1.0)
    return Model(mean[:size].astype(np.float32), float(mean[size]))


def score_column(docs: DataFrame, model: Model) -> Column:
    """The score of ``text``, in Arrow batches; the other columns stay in the JVM."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words()
        for column in columns:
            texts = byte_texts(column)
            scores = np.empty(len(texts))
            for part in row_groups([len(t) // 6 for t in texts], GROUP_WORDS):
                scores[part] = shared.value.scores(texts[part], words)
                if len(words) > TABLE_SIZE // 2:
                    words = Words()
            yield pa.array(scores)

    return F.arrow_udf(run, "double").asNondeterministic()(F.col("text"))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    scored = pick(docs, "doc_id", "text").select("doc_id", held_out.alias("held_out"), score_column(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``least``; no shuffle."""
    scored = packed(docs, "text").withColumn("score", score_column(docs, model))
    return unpacked(scored.filter(F.col("score") >= least), docs)
