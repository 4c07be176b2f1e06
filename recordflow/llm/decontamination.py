"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with white space runs as one space.  An item
of n characters may differ from a passage by ``n * RATE // 100`` edits
(insertions, deletions, substitutions).  Cut into one piece more than that, at
least one piece stands unchanged in every such passage.  An automaton finds all
pieces in one pass over each text; around each hit Myers' bit-parallel
algorithm gives the least distance of the whole item to any passage there.

The items are taken in blocks of at most ``BLOCK_CHARS`` characters (or of one
item); every text is read once per block, whatever the number of blocks.

Edge cases: null and empty texts and items match nothing; items too short for
an edit match exactly; repeated rows and repeated items each give their rows;
ties in distance go to the first passage; empty tables give empty results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.base import output, packed, pick, unpacked

RATE = 6
BLOCK_CHARS = 8 << 20


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(text: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length with their places."""
    edges = [len(text) * i // (budget + 1) for i in range(budget + 2)]
    return [(s, text[s:e]) for s, e in zip(edges, edges[1:]) if e > s]


def least_distance(masks: dict[str, int], size: int, text: str, most: int) -> tuple[int, int]:
    """Least edit distance of the pattern to a passage of ``text`` and where the passage ends; above ``most``, most + 1.

    One machine step per character: the pattern's column of differences stands
    in two integers of ``size`` bits.
    """
    full, top = (1 << size) - 1, size - 1
    plus, minus, score, best, end = full, 0, size, most + 1, -1
    for i, c in enumerate(text):
        x = masks.get(c, 0) | minus
        zero = ((plus + (x & plus)) ^ plus) | x
        up, down = minus | (full & ~(plus | zero)), plus & zero
        score += ((up >> top) & 1) - ((down >> top) & 1)
        up = (up << 1) & full
        minus = up & zero
        plus = ((down << 1) & full) | (full & ~(up | zero))
        if score < best:
            best, end = score, i + 1
            if not best:
                break
    return best, end


class Matcher:
    """The items of a block: an automaton over all their pieces, and what verification needs."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.items = [(i, plain(t)) for i, t in items if t and plain(t)]
        self.budgets = [len(t) * RATE // 100 for _, t in self.items]
        self.masks: dict[int, dict[str, int]] = {}
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, text) in enumerate(self.items):
            for place, piece in pieces(text, self.budgets[k]):
                found[piece].append((k, place))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def _masks(self, k: int) -> dict[str, int]:
        if k not in self.masks:
            masks: dict[str, int] = defaultdict(int)
            for i, c in enumerate(self.items[k][1]):
                masks[c] |= 1 << i
            self.masks[k] = dict(masks)
        return self.masks[k]

    def matches(self, text: str | None, first: bool = False) -> list[tuple[int, int, int]]:
        """(item id, distance, end of the passage in the plain text); with ``first`` one match is enough."""
        if not text or not self.items:
            return []
        text = plain(text)
        begins: dict[int, set[int]] = defaultdict(set)
        for end, (size, owners) in self.automaton.iter(text):
            for k, place in owners:
                begins[k].add(end + 1 - size - place)
        out = []
        for k, places in sorted(begins.items()):
            item, own = self.items[k]
            budget, size = self.budgets[k], len(own)
            exact = min((p for p in places if p >= 0 and text.startswith(own, p)), default=None)
            best, stop = (0, exact + size) if exact is not None else (budget + 1, -1)
            spots = sorted(places) if best else []
            while spots:
                low = high = spots[0]
                n = 1
                while n < len(spots) and spots[n] - high <= 2 * budget:
                    high = spots[n]
                    n += 1
                spots = spots[n:]
                start = max(low - budget, 0)
                found, end = least_distance(self._masks(k), size, text[start : high + size + budget], budget)
                if found < best:
                    best, stop = found, start + end
            if best <= budget:
                out.append((item, best, stop))
                if first:
                    break
        return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, a block of bounded size at a time."""
    items = pick(benchmark, "item_id", "text").filter(F.length("text") > 0)
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-chars // BLOCK_CHARS)
    for block in range(count):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).collect()
        yield sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, distance, passage_end: a row for each document row and item it holds."""
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int64()), ("passage_end", pa.int64())])
    ddl = "doc_id long, item_id long, distance long, passage_end long"
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))

    def block_matches(items: list[tuple[int, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for batch in batches:
                found = [
                    (d, *m) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                    for m in matcher.matches(t)
                ]
                if found:
                    yield output(dict(zip(schema.names, zip(*found))), schema)

        return rows.mapInArrow(run, ddl)

    found = [block_matches(items) for items in _blocks(benchmark)]
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], ddl)


def _holds(docs: DataFrame, items: list[tuple[int, str]]) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(shared.value)
        for column in columns:
            yield pa.array(np.array([bool(matcher.matches(t, first=True)) for t in column.to_pylist()], bool))

    return F.arrow_udf(run, "boolean").asNondeterministic()(F.col("text"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; no shuffle."""
    rows = packed(docs, "text")
    for items in _blocks(benchmark):
        rows = rows.withColumn("held", _holds(docs, items)).filter(~F.col("held")).drop("held")
    return unpacked(rows, docs)
