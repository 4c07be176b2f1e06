"""Language model: hashed maximum entropy with a class-factored softmax over unigram leaves.

P(token | before) = P(class | before) P(slot | class, before) P(token | leaf).
Before any training class and slot have the shares of their leaves' counts.
The most frequent tokens have a (class, slot) leaf each; all others share the
remaining leaves by a hash of their last three bytes.  Class and slot are
softmaxes over sums of weight rows found by hashing n-gram and skip features:
the word before, the two words before, and the word before that alone.  In a
leaf a token has ``(c + 1) / (N_leaf + V_leaf + 1)``; the last 1 is the share
of tokens never seen (leaves of one token have none), so the model is a
distribution over all tokens.

Counts and weights come from every learned document.  Weights are trained by
one distributed pass of gradient updates: each task makes its own steps from the
weights sent out, and a tree sums the moves of each row, weighed by how often a
task met it.  Scoring runs over sparse batches in numpy.

Words counted at least ``all tokens / HOT`` times, of which there are at most
HOT, are sent to every task; the counts of all others are joined by shuffle.

Edge cases: null and empty texts are one end token; equal texts score alike;
a document without an id is learned from, as its remainder isn't that of the
held-out ones; with nothing to learn from every count is 0 and V is 0.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.base import TABLE_SIZE, byte_texts, output, pick, remainder, row_groups, saved, sums_by

CLASSES, SLOTS, OWN_CLASSES = 32, 32, 8
OWN = OWN_CLASSES * SLOTS
SHARED = (CLASSES - OWN_CLASSES) * SLOTS
ROWS_BITS = (13, 14)
HOT, LONGEST_HOT = 1 << 19, 64
#: Passes over the learned documents, tokens of a step, rate, and the sum of squares each weight starts with, so that
#: rare rows move little.
ROUNDS, STEP, RATE, CAUTION = 1, 8192, 0.5, 4.0
GROUP_WORDS, BLOCK = 1 << 18, 8192
#: Logits are held within this, so that their exponentials are neither 0 nor infinite in floats.
SPAN = 60.0
END, START = b"", np.uint64(0x2545F4914F6CDD1D)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shared_leaf(word: bytes) -> int:
    return OWN + zlib.crc32(word[-3:]) % SHARED


def _shared_leaf(word: Column) -> Column:
    size = F.octet_length(word)
    return F.lit(OWN) + F.crc32(F.when(size <= 3, word).otherwise(F.substring(word, size - 2, F.lit(3)))) % SHARED


def word_counts(rows: DataFrame) -> DataFrame:
    """word (binary; the end token is empty), c: over ``rows`` (text), summed in each task before the shuffle."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for text in texts:
                seen.update(text.lower().split())
                if len(seen) > TABLE_SIZE:
                    yield output({"word": list(seen), "n": list(seen.values())}, schema)
                    seen = Counter()
            seen[END] += len(texts)
        if seen:
            yield output({"word": list(seen), "n": list(seen.values())}, schema)

    return rows.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """What every task knows: counts of hot words, own leaves, and the log10 denominator of each leaf."""

    tokens: int
    distinct: int
    hot: dict[bytes, int]
    own: dict[bytes, int]
    leaf_cost: np.ndarray
    class_prior: np.ndarray  # log share of each class
    slot_prior: np.ndarray  # log share of each slot in its class


def vocabulary(counts: DataFrame) -> Vocabulary:
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # at most HOT words of bounded length have so large a share
    hot = counts.filter((F.col("c") * HOT >= tokens) & (F.octet_length("word") <= LONGEST_HOT)).collect()
    hot.sort(key=lambda r: (-r.c, bytes(r.word)))
    own = {bytes(r.word): i for i, r in enumerate(hot[:OWN])}
    # a row per shared leaf
    rest = counts.filter(~F.col("word").isin([F.lit(w) for w in own])) if own else counts
    cost = np.zeros(OWN + SHARED)
    cost[OWN:] = 1
    for i, r in enumerate(hot[:OWN]):
        cost[i] = r.c + 1
    for r in rest.groupBy(_shared_leaf(F.col("word")).alias("leaf")).agg(F.sum(F.col("c") + 1).alias("mass")).collect():
        cost[r.leaf] += r.mass
    # an own leaf without a word takes no token
    mass = np.maximum(cost, 1e-3).reshape(CLASSES, SLOTS)
    in_class = mass.sum(axis=1)
    priors = np.log(in_class / in_class.sum()).astype(np.float32), np.log(mass / in_class[:, None]).astype(np.float32)
    return Vocabulary(tokens, distinct, {bytes(r.word): r.c for r in hot}, own, np.log10(np.maximum(cost, 1)), *priors)


class Words(dict):
    """Slot of each word met by a task, with its hash, leaf and, if it is hot, log10(c + 1)."""

    def __init__(self, known: Vocabulary) -> None:
        self.known, self.words = known, []
        self.hashes, self.leaves, self.logs = array("Q"), array("i"), array("d")
        self[END]  # slot 0

    def __missing__(self, word: bytes) -> int:
        self[word] = slot = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, 7))
        self.leaves.append(self.known.own[word] if word in self.known.own else shared_leaf(word))
        self.logs.append(math.log10(self.known.hot[word] + 1) if word in self.known.hot else -1.0)
        return slot

    def sequence(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of all tokens of all texts, and the number of tokens of each."""
        split = [t.lower().split() for t in texts]
        counts = np.fromiter((len(w) + 1 for w in split), np.int64, len(split))
        slots = np.zeros(int(counts.sum()), np.int64)
        inner = np.ones(len(slots), bool)
        inner[np.cumsum(counts) - 1] = False
        slots[inner] = np.fromiter((s for w in split for s in map(self.__getitem__, w)), np.int64, int(inner.sum()))
        return slots, counts


def _spread(x: np.ndarray, salt: int, bits: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * _ODD
    x ^= x >> np.uint64(29)
    return ((x * _ODD) >> np.uint64(64 - bits)).astype(np.int64)


def features(hashes: np.ndarray, counts: np.ndarray, classes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Weight rows of each token: for its class, and for its slot given the class."""
    with np.errstate(over="ignore"):
        first = np.zeros(len(hashes), bool)
        first[np.cumsum(counts) - counts] = True
        one = np.where(first, START, np.roll(hashes, 1))
        two = np.where(first, START, np.roll(one, 1))
        of = (classes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        by_class = [_spread(x, s, ROWS_BITS[0]) for s, x in enumerate((one, one * np.uint64(31) + two, two))]
        by_slot = [_spread(x, s, ROWS_BITS[1]) for s, x in enumerate((of, of ^ one, of ^ (two * np.uint64(3))), 3)]
    return by_class, by_slot


@dataclass
class Weights:
    tables: list[np.ndarray]  # of classes and of slots: [row, choice]

    @staticmethod
    def zero() -> Weights:
        return Weights([np.zeros((1 << b, n), np.float32) for b, n in zip(ROWS_BITS, (CLASSES, SLOTS))])

    def logits(self, level: int, rows: list[np.ndarray], prior: np.ndarray) -> np.ndarray:
        table = self.tables[level]
        out = table.take(rows[0], axis=0)
        for r in rows[1:]:
            out += table.take(r, axis=0)
        out += prior
        return np.clip(out, -SPAN, SPAN, out=out)


def row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def log_probabilities(known: Vocabulary, weights: Weights, leaves: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 P(class) P(slot | class) of each token."""
    classes, slots = leaves // SLOTS, leaves % SLOTS
    rows = features(hashes, counts, classes)
    out = np.zeros(len(leaves))
    for start in range(0, len(leaves), BLOCK):
        cut = slice(start, start + BLOCK)
        for level, aim in enumerate((classes[cut], slots[cut])):
            prior = known.slot_prior.take(classes[cut], axis=0) if level else known.class_prior
            z = weights.logits(level, [r[cut] for r in rows[level]], prior)
            out[cut] += z[np.arange(len(aim)), aim] - np.log(row_sums(np.exp(z)))
    return out / math.log(10)


class Trainer:
    """Steps of adaptive gradient descent from given weights; a row moves by what the tokens of a step ask together."""

    def __init__(self, known: Vocabulary, weights: Weights) -> None:
        self.known, self.start = known, weights
        self.now = Weights([t.copy() for t in weights.tables])
        self.squares = [np.full_like(t, CAUTION) for t in weights.tables]
        self.met = [np.zeros(len(t), np.float32) for t in weights.tables]

    def learn(self, leaves: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> None:
        classes, slots = leaves // SLOTS, leaves % SLOTS
        rows = features(hashes, counts, classes)
        for start in range(0, len(leaves), STEP):
            cut = slice(start, start + STEP)
            for level, aim in enumerate((classes[cut], slots[cut])):
                own = [r[cut] for r in rows[level]]
                prior = self.known.slot_prior.take(classes[cut], axis=0) if level else self.known.class_prior
                slope = self.now.logits(level, own, prior)
                np.exp(slope, out=slope)
                slope /= row_sums(slope)[:, None]
                slope[np.arange(len(aim)), aim] -= 1
                self._step(level, np.concatenate(own), slope)

    def _step(self, level: int, rows: np.ndarray, slope: np.ndarray) -> None:
        """A step by ``slope``, a row per token; ``rows`` names the weight rows of all tokens, feature by feature."""
        order = np.argsort(rows.astype(np.uint16), kind="stable")  # sorted by radix; tables have at most 2^16 rows
        sorted_rows = rows[order]
        order %= len(slope)
        first = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
        # two choices are one complex number, so that a sum takes half as many additions
        g = np.add.reduceat(slope.take(order, axis=0).view(np.complex64), first, axis=0).view(np.float32)
        at = sorted_rows[first]
        squares = self.squares[level].take(at, axis=0)
        squares += g * g
        self.squares[level][at] = squares
        np.sqrt(squares, out=squares)
        g *= RATE
        g /= squares
        self.now.tables[level][at] = self.now.tables[level].take(at, axis=0) - g
        self.met[level][at] += np.diff(np.append(first, len(rows)))

    def moves(self) -> list[np.ndarray]:
        """Of each table: moves times how often each row was met, and how often."""
        out = []
        for new, old, met in zip(self.now.tables, self.start.tables, self.met):
            out += [(new - old) * met[:, None], met]
        return out


def _sum(a: list[np.ndarray] | None, b: list[np.ndarray] | None) -> list[np.ndarray] | None:
    if a is None or b is None:
        return b if a is None else a
    return [x + y for x, y in zip(a, b)]


def train(rows: DataFrame, known: Vocabulary) -> Weights:
    """Weights from ``rows`` (text), the learned documents."""
    context = rows.sparkSession.sparkContext
    shared, weights = context.broadcast(known), Weights.zero()
    source = rows.select("text")
    for _ in range(ROUNDS):
        sent = context.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            words, trainer, met = Words(shared.value), Trainer(shared.value, sent.value), False
            for batch in batches:
                texts = byte_texts(batch.column("text"))
                for part in row_groups([len(t) // 6 for t in texts], GROUP_WORDS):
                    slots, counts = words.sequence(texts[part])
                    trainer.learn(np.array(words.leaves, np.int64)[slots], np.array(words.hashes, np.uint64)[slots], counts)
                    met = True
                    if len(words) > TABLE_SIZE:
                        words = Words(shared.value)
            if met:
                yield pa.RecordBatch.from_pydict({"moves": [b"".join(a.tobytes() for a in trainer.moves())]})

        moved = source.mapInArrow(run, "moves binary").rdd.map(lambda r: _arrays(bytes(r.moves)))
        parts = moved.treeAggregate(None, _sum, _sum, depth=3)
        if parts is None:
            break
        weights = Weights([
            old + total / np.maximum(met, 1)[:, None] for old, total, met in zip(weights.tables, parts[::2], parts[1::2])
        ])
    return weights


def _arrays(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    for bits, n in zip(ROWS_BITS, (CLASSES, SLOTS)):
        for shape in ((1 << bits, n), (1 << bits,)):
            size = 4 * math.prod(shape)
            out.append(np.frombuffer(data[at : at + size], np.float32).reshape(shape))
            at += size
    return out


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text")
    learned = rows.filter(F.coalesce(remainder(F.col("doc_id"), 7) != 2, F.lit(True)))
    counts = saved(word_counts(learned))
    known = vocabulary(counts)
    weights = train(learned, known)
    sent = spark.sparkContext.broadcast((known, weights))
    info = pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("model", pa.float64())])
    schema = pa.schema([("at", pa.int64()), ("word", pa.binary()), ("n", pa.int64()), ("info", info)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = sent.value
        words = Words(known)
        for batch in batches:
            texts, ids = byte_texts(batch.column("text")), batch.column("doc_id").to_pylist()
            ats = batch.column("at").to_numpy()
            for part in row_groups([len(t) // 6 for t in texts], GROUP_WORDS):
                slots, sizes = words.sequence(texts[part])
                leaves = np.array(words.leaves, np.int64)[slots]
                logs = np.array(words.logs, np.float64)[slots]
                own = log_probabilities(known, weights, leaves, np.array(words.hashes, np.uint64)[slots], sizes)
                hot = logs >= 0
                n = len(sizes)
                columns = [
                    pa.array(ids[part], pa.int64()), pa.array(sizes), pa.array(sums_by(hot.astype(np.int64), sizes)),
                    pa.array(sums_by(np.where(hot, logs, 0.0), sizes)), pa.array(sums_by(own - known.leaf_cost[leaves], sizes)),
                ]
                # a document's own row goes with a word that no text can hold
                yield output({
                    "at": ats[part], "word": [b" %d" % (a % 4096) for a in ats[part].tolist()], "n": np.zeros(n, np.int64),
                    "info": pa.StructArray.from_arrays(columns, fields=list(info)),
                }, schema)
                rest = np.flatnonzero(~hot)
                owner = np.repeat(np.arange(n), sizes)[rest]
                pairs, times = np.unique(owner * len(words) + slots[rest], return_counts=True)
                owner, slot = np.divmod(pairs, len(words))
                yield output({
                    "at": ats[part][owner], "word": [words.words[s] for s in slot.tolist()], "n": times,
                    "info": pa.nulls(len(pairs), info),
                }, schema)
                if len(words) > TABLE_SIZE:
                    words = Words(known)

    kind = "struct<doc_id: bigint, n_tokens: bigint, known: bigint, logs: double, model: double>"
    numbered = rows.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("at"))
    parts = numbered.mapInArrow(run, f"at long, word binary, n long, info {kind}")
    joined = parts.join(counts.select("word", "c"), "word", "left")
    seen = F.col("c").isNotNull()
    summed = joined.groupBy("at").agg(
        F.max("info").alias("i"), F.sum(F.when(seen, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.when(seen, F.col("n") * F.log10(F.col("c") + 1)).otherwise(0.0)).alias("logs"),
    )
    logs = F.col("i.logs") + F.col("logs")
    cost = F.lit(math.log10(known.tokens + known.distinct + 1))
    return summed.select(
        F.col("i.doc_id").alias("doc_id"), F.coalesce(remainder(F.col("i.doc_id"), 7) == 2, F.lit(False)).alias("held_out"),
        F.col("i.n_tokens").alias("n_tokens"), (F.col("i.known") + F.col("known")).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"), (logs - F.col("i.n_tokens") * cost).alias("base_score"),
        (F.col("i.model") + logs).alias("score"),
    )
