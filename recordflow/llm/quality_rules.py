"""Quality rules: fixed base rules, and an isolation forest on the rules' statistics.

The forest's trees split random samples of documents at random values; a
document that few splits isolate is an anomaly.  Its score is
``2 ** (-mean path length / expected path length)``.  The threshold comes from
the labelled rows that pass the base rules: the score that best tells labels 0
and 1 apart among those that lose at most ``GOOD_LOSS`` of label 1.

Edge cases: null and empty texts have no words and fail the base rules; equal
texts get equal results; without labelled rows of both kinds nothing beyond
the base rules is removed; several labels of a document count as the lowest.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recordflow.llm.base import byte_texts, fraction, pick, saved

LEAST_WORDS, MOST_REPEATED = 50, 50
TREES, SAMPLE, DEPTH = 100, 256, 8
#: Documents that the forest's samples are drawn from at most (as an expectation over the hash that picks them).
FIT_ROWS = TREES * SAMPLE
GOOD_LOSS = 0.005
BINS = 1000
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Rule statistics of the forest, as shares of the text.
SHARES = ["mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share"]


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    slots: dict[bytes, int] = {}
    ids = np.fromiter((slots.setdefault(w, len(slots)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(slots) + ids[1:]
    if len(slots) ** 3 >= 1 << 62:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(slots) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    often = np.zeros(len(windows), bool)
    often[order[1:][same]] = often[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= often
    covered[1:-1] |= often
    covered[2:] |= often
    return int(covered.sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The counts in ``COUNTS`` and the shares in ``SHARES`` of one text."""
    words = text.split()
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    continued = int(seen[128:192].sum())
    spaces = int(seen[list(SPACES)].sum())
    chars = len(text) - continued - spaces
    symbols = int(seen[list(SYMBOLS)].sum())
    lines = Counter(line for line in text.split(b"\n") if line.strip(SPACES))
    dup_lines = sum(lines.values()) - len(lines)
    repeat = repeated_words(words)
    per_char = 1 / max(chars, 1)
    shares = [
        chars / max(len(words), 1), symbols * per_char, dup_lines / max(len(words), 1), repeat / max(len(words), 1),
        int(seen[65:91].sum()) * per_char,
    ]
    return [len(words), chars, symbols, dup_lines, repeat], shares


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, ``base_failed`` and the array ``shares`` of every row."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = [statistics(t) for t in byte_texts(column)]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            arrays = [pa.array(counts[:, i]) for i in range(len(COUNTS))]
            yield pa.StructArray.from_arrays([*arrays, pa.array([s for _, s in found], pa.list_(pa.float64()))], names=[*COUNTS, "shares"])

    kind = "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ", shares: array<double>>"
    found = F.arrow_udf(run, kind).asNondeterministic()(F.col("text")).alias("s")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return pick(docs, "doc_id", "text").select("doc_id", found).select("doc_id", "s.*").withColumn("base_failed", failed)


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` values."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Nodes of all trees as arrays [tree, node]; node k has the children 2k+1 and 2k+2, a leaf has feature -1."""

    feature: np.ndarray
    value: np.ndarray
    length: np.ndarray
    scale: float

    def scores(self, points: np.ndarray) -> np.ndarray:
        total = np.zeros(len(points))
        for feature, value, length in zip(self.feature, self.value, self.length):
            at = np.zeros(len(points), np.int64)
            for _ in range(DEPTH):
                f = feature[at]
                inner = f >= 0
                right = points[np.arange(len(points)), np.maximum(f, 0)] >= value[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            total += length[at]
        return 2.0 ** (-total / max(len(self.feature), 1) / self.scale)


def grow(points: np.ndarray, seed: int = 6) -> Forest:
    """``TREES`` trees on samples of ``points``, a bounded array."""
    random = np.random.default_rng(seed)
    nodes = 2 ** (DEPTH + 1) - 1
    size = min(SAMPLE, len(points))
    feature = np.full((TREES, nodes), -1, np.int64)
    value, length = np.zeros((TREES, nodes)), np.zeros((TREES, nodes))
    for tree in range(TREES):
        todo = [(0, 0, points[random.choice(len(points), size, replace=False)])]
        while todo:
            node, depth, own = todo.pop()
            low, high = (own.min(axis=0), own.max(axis=0)) if len(own) else (np.zeros(1), np.zeros(1))
            spread = np.flatnonzero(high > low)
            if depth == DEPTH or len(own) <= 1 or not len(spread):
                length[tree, node] = depth + expected_path(np.array(len(own)))
                continue
            f = random.choice(spread)
            split = random.uniform(low[f], high[f])
            feature[tree, node], value[tree, node] = f, split
            right = own[:, f] >= split
            todo += [(2 * node + 1, depth + 1, own[~right]), (2 * node + 2, depth + 1, own[right])]
    return Forest(feature, value, length, float(max(expected_path(np.array(size)), 1e-9)))


def judge(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, the counts, base_failed, anomaly, kept for every row.

    Texts are read once; their statistics, a narrow row each, are saved.
    """
    spark = docs.sparkSession
    stats = saved(rule_statistics(docs))
    passed = stats.filter(~F.col("base_failed"))
    share = fit_rows / max(passed.count(), 1)
    spread = F.xxhash64(F.lit(6), "doc_id", "shares")
    # at most about fit_rows rows of a few numbers
    sample = passed.filter(fraction(6, F.col("doc_id"), F.col("shares")) < share).select("shares", spread.alias("h")).collect()
    points = np.array([r.shares for r in sorted(sample, key=lambda r: (r.h, r.shares))], np.float64).reshape(-1, len(SHARES))
    shared = spark.sparkContext.broadcast(grow(points) if len(points) else None)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            rows = np.array(column.flatten(), np.float64).reshape(-1, len(SHARES))
            yield pa.array(shared.value.scores(rows) if shared.value else np.zeros(len(rows)))

    anomaly = F.arrow_udf(run, "double").asNondeterministic()(F.col("shares"))
    scored = saved(stats.withColumn("anomaly", F.round(anomaly, 9)).drop("shares"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= threshold(scored, labels)))


def threshold(scored: DataFrame, labels: DataFrame) -> float:
    """The highest score to keep, from a histogram of the labelled rows: 2 * BINS numbers."""
    marks = pick(labels, "doc_id", "quality").filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = scored.filter(~F.col("base_failed")).select("doc_id", F.ceil(F.col("anomaly") * BINS).cast("int").alias("bin"))
    counts = rows.join(marks, "doc_id").groupBy("bin", (F.col("quality") > 0).alias("good")).count().collect()
    good, bad = np.zeros(BINS + 2), np.zeros(BINS + 2)
    for r in counts:
        (good if r.good else bad)[r.bin] += r["count"]
    if not good.sum() or not bad.sum():
        return math.inf
    lost, caught = 1 - np.cumsum(good) / good.sum(), 1 - np.cumsum(bad) / bad.sum()
    gain = np.where(lost <= GOOD_LOSS, caught - lost, -1)
    return float(len(gain) - 1 - np.argmax(gain[::-1])) / BINS
