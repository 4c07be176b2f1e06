"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

One replaced letter moves two letter counts by one, one inserted or deleted
letter moves one count.  So the words near a word lie in a box of count vectors
around it, and a k-d tree prunes all boxes out of reach.  There is a tree for each
pair of lengths: the words of one length are its points, the words of the same
length (replaced letters) and of one letter less (inserted letters) search it.
Points have 32 whole-word counts (a to z, and six that other letters share) and
the same 32 counts of their first half, which part words made of the same
letters: one edit moves those by one up and one down at most.

The upper levels of the trees split the words of a length into cells of some
CELL words; their cuts come from a bounded sample and only decide where work is
done, as those of a range partitioning do.  A word is a point of one cell and
is sent to the cells its box meets, of the same length only to later ones, so each
pair is met once.  A cell grows its own tree down to leaves of LEAF words, keeps
pairs that agree before or behind the middle of the word, and verifies them
letter by letter.  A cell returns a row per word, not per pair.

Edge cases: null and empty texts have no words; a null id reads as an empty one;
a repeated row counts again; of forms with equal counts the smallest word in
code-point order wins; texts and words may have any length (counts are kept up to
2^31); words that cannot be told apart by their vectors share a leaf, whatever
their number; an empty table gives no row; columns other than ``doc_id`` and
``text``, also ones of similar names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recordflow.llm.base import fraction, output, pick, saved

LEAST_LETTERS, LEAST_COUNT, FORM_FACTOR, DELETE_EVERY = 6, 5, 5, 199
#: A maximal run of enough letters; possessive, so it needs no stack.
RUN = r"[A-Za-zÀ-ÿ]{%d,}+" % LEAST_LETTERS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a cell, words of a leaf, and words of the sample that places the upper cuts (expected number).
CELL, LEAF, SAMPLE = 8192, 16, 1 << 17
#: Words that search a cell's tree at a time, and pairs that are verified at a time.
STEP, PAIRS = 4096, 1 << 20
#: Letters counted in the whole word, and again in its first half.
COUNTS = 32
PLACES = np.array([c - 97 if 97 <= c <= 122 else 26 + c % 6 for c in range(256)])
FAR = 1 << 30


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: the words of at least LEAST_LETTERS letters that occur LEAST_COUNT times or more."""
    found = F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")
    runs = pick(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), found)
    lowered = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    runs = runs.select("id", lowered.alias("run"))
    hashed = runs.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    spot = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), spot), F.col("run").substr(spot + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % DELETE_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


# ------------------------------------------------------------------ k-d trees
def letters(words: list[bytes], size: int) -> np.ndarray:
    """Words of up to ``size`` Latin-1 letters as rows of bytes, filled up with zeros."""
    return np.array(words, f"S{size}").view(np.uint8).reshape(len(words), size)


def count_vectors(rows: np.ndarray, half: int) -> np.ndarray:
    """Letter counts of each row, and those of its first ``half`` letters."""
    out = np.zeros((len(rows), 2 * COUNTS), np.uint8 if rows.shape[1] < 256 else np.int32)
    every = np.arange(len(rows))
    for k in range(rows.shape[1]):
        filled = every[rows[:, k] > 0]
        places = PLACES[rows[filled, k]]
        out[filled, places] += 1
        if k < half:
            out[filled, COUNTS + places] += 1
    return out


@dataclass
class Tree:
    """Nodes by number: inner ones send ``count <= cut`` of a place left; leaves have place -1 and a range of ``order``."""

    place: np.ndarray
    cut: np.ndarray
    low: np.ndarray  # bounds of the node's box in its own place
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    order: np.ndarray


def _cut(points: np.ndarray) -> tuple[int, int] | None:
    """The place and count that part the points most evenly; None if all are equal."""
    some = points[:: max(1, len(points) // 1024)]
    middle = np.sort(some, axis=0)[len(some) // 2].astype(np.int64)
    best = None
    for shift in (0, 1):
        share = np.abs((some <= middle - shift).mean(axis=0) - 0.5)
        place = int(share.argmin())
        if share[place] < 0.5 and (best is None or share[place] < best[0]):
            best = share[place], place, int(middle[place]) - shift
    if best is None:
        least = points.min(axis=0)
        uneven = np.flatnonzero(least < points.max(axis=0))
        return (int(uneven[0]), int(least[uneven[0]])) if len(uneven) else None
    return best[1:]


def grow(points: np.ndarray, most: int) -> Tree:
    """A k-d tree with leaves of at most ``most`` points, or of equal ones."""
    nodes: list[list[int]] = []
    order = np.arange(len(points))
    open_nodes = [(0, len(points), {}, -1, 0)]
    while open_nodes:
        start, stop, box, parent, side = open_nodes.pop()
        at = len(nodes)
        if parent >= 0:
            nodes[parent][4 + side] = at
        own = order[start:stop]
        cut = _cut(points[own]) if stop - start > most else None
        if cut is None:
            nodes.append([-1, 0, 0, 0, -1, -1, start, stop])
            continue
        place, value = cut
        low, high = box.get(place, (-FAR, FAR))
        nodes.append([place, value, low, high, -1, -1, start, stop])
        goes_left = points[own, place] <= value
        middle = start + int(goes_left.sum())
        order[start:stop] = np.concatenate([own[goes_left], own[~goes_left]])
        open_nodes.append((middle, stop, box | {place: (value + 1, high)}, at, 1))
        open_nodes.append((start, middle, box | {place: (low, value)}, at, 0))
    return Tree(*np.array(nodes, np.int64).T.copy(), order)


def visits(tree: Tree, vectors: np.ndarray, lose: int, gain: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``vectors``, leaf node) wherever the leaf's box can hold a word one edit away.

    ``lose`` and ``gain`` are the whole-word counts the edit may take and give;
    those of the first half move by one each way.
    """
    limits = np.array([lose, gain, 1, 1])
    rows, nodes = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    spent = np.zeros((len(vectors), 4), np.int64)
    found_rows, found_leaves = [], []
    while len(rows):
        place = tree.place[nodes]
        ends = place < 0
        found_rows.append(rows[ends])
        found_leaves.append(nodes[ends])
        rows, nodes, spent, place = rows[~ends], nodes[~ends], spent[~ends], place[~ends]
        own, every = vectors[rows, place].astype(np.int64), np.arange(len(rows))
        kind = np.where(place < COUNTS, 0, 2)
        cut, low, high = tree.cut[nodes], tree.low[nodes], tree.high[nodes]
        sides = []
        for column, more, child in (
            (kind, np.maximum(0, own - cut) - np.maximum(0, own - high), tree.left),
            (kind + 1, np.maximum(0, cut + 1 - own) - np.maximum(0, low - own), tree.right),
        ):
            total = spent[every, column] + more
            near = total <= limits[column]
            after = spent[near]
            after[np.arange(len(after)), column[near]] = total[near]
            sides.append((rows[near], child[nodes[near]], after))
        rows, nodes, spent = (np.concatenate(parts) for parts in zip(*sides))
    return np.concatenate(found_rows), np.concatenate(found_leaves)


# ------------------------------------------------------------------ cells
def _half_hashes(rows: np.ndarray, start: int, stop: int) -> np.ndarray:
    out = np.full(len(rows), 7, np.uint64)
    for k in range(start, stop):
        out = (out ^ rows[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether ``long`` is ``short`` with one letter more: equal up to a place, and from there one later."""
    size = short.shape[1]
    ahead, behind = short != long[:, :size], short != long[:, 1:]
    first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), size)
    last = np.where(behind.any(axis=1), size - 1 - behind[:, ::-1].argmax(axis=1), -1)
    return last < first


def near_pairs(points: np.ndarray, seekers: np.ndarray, own: int, shorter: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(seeker, point) pairs one edit apart.

    Points and seekers are rows of letters, points of full width; with
    ``shorter`` seekers have one letter less.  The first ``own`` seekers are the
    points themselves, and each pair of points comes once.
    """
    size = points.shape[1]
    half = size // 2
    tree = grow(count_vectors(points, half), LEAF)
    head, tail = _half_hashes(points, 0, half), _half_hashes(points, half + shorter, size)
    width = size - shorter
    for begin in range(0, len(seekers), STEP):
        part = seekers[begin : begin + STEP, :width]
        rows, leaves = visits(tree, count_vectors(part, half), 0 if shorter else 1, 1)
        head_of, tail_of = _half_hashes(part, 0, half), _half_hashes(part, half, width)
        counts = tree.stop[leaves] - tree.start[leaves]
        ends = np.cumsum(counts)
        done = 0
        while done < len(rows):
            upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS, "right")))
            n = counts[done:upto]
            seek = np.repeat(rows[done:upto], n)
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            point = tree.order[np.repeat(tree.start[leaves[done:upto]], n) + inside]
            done = upto
            agree = (head_of[seek] == head[point]) | (tail_of[seek] == tail[point])
            if own:
                agree &= (seek + begin >= own) | (seek + begin < point)
            seek, point = seek[agree], point[agree]
            for k in range(0, len(seek), PAIRS // 16):
                s, p = seek[k : k + PAIRS // 16], point[k : k + PAIRS // 16]
                near = _inserted(part[s], points[p]) if shorter else _replaced(part[s], points[p])
                yield s[near] + begin, p[near]


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _cell(cell: pa.Table) -> pa.Table:
    """For each word with a near word in this cell: their number, and the one of largest count."""
    size = cell.column("size")[0].as_py()
    words = [w.encode("latin-1") for w in cell.column("word").to_pylist()]
    n, home = cell.column("n").to_numpy(), cell.column("home").to_numpy()
    rows = letters(words, size)
    short = rows[:, size - 1] == 0
    at_home, longer, shorter = np.flatnonzero(home), np.flatnonzero(~home & ~short), np.flatnonzero(~home & short)
    left, right = [], []
    for own, seek, less in ((len(at_home), np.concatenate([at_home, longer]), False), (0, shorter, True)):
        if len(at_home) and len(seek):
            for s, p in near_pairs(rows[at_home], rows[seek], own, less):
                left.append(seek[s])
                right.append(at_home[p])
    if not left:
        return NEAR.empty_table()
    a, b = np.concatenate(left), np.concatenate(right)
    who, other = np.concatenate([a, b]), np.concatenate([b, a])
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(np.array(words, f"S{size}"), kind="stable")] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], who))
    found, first, times = np.unique(who[order], return_index=True, return_counts=True)
    best = other[order][first]
    texts = cell.column("word").combine_chunks()
    return pa.table(
        [texts.take(pa.array(found)), pa.array(times), pa.array(n[best]), texts.take(pa.array(best))], schema=NEAR
    )


def _upper_trees(words: DataFrame) -> dict[int, Tree]:
    """The upper levels of the tree of each length with more than CELL words, from a sample of bounded expected size."""
    sizes = {r["size"]: r["count"] for r in words.groupBy(F.length("word").alias("size")).count().collect()}
    large = [k for k, c in sizes.items() if c > CELL]
    if not large:
        return {}
    share = min(1.0, SAMPLE / sum(sizes[k] for k in large))
    drawn = words.filter(F.length("word").isin(large) & (fraction(11, F.col("word")) < share)).select("word").collect()
    out = {}
    for size in large:
        some = [r.word.encode("latin-1") for r in drawn if len(r.word) == size]
        if some:
            out[size] = grow(count_vectors(letters(some, size), size // 2), max(1, CELL * len(some) // sizes[size]))
    return out


DEALT = pa.schema([("size", pa.int32()), ("cell", pa.int64()), ("home", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])


def dealt_to_cells(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """size, cell, home, word, n: every word as a point of its cell (``home``), and where else it searches."""
    shared = words.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            texts = batch.column("word").to_pylist()
            sizes = np.array([len(t) for t in texts])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                own = letters([texts[i].encode("latin-1") for i in rows], size)
                for target, lose in ((size, 1), (size + 1, 0)):
                    every, home = np.arange(len(rows)), np.zeros(len(rows), np.int64)
                    row, cell = every, home
                    if target in trees:
                        vectors = count_vectors(own, target // 2)
                        row, cell = visits(trees[target], vectors, lose, 1)
                        if target == size:
                            home[:] = _home(trees[target], vectors)
                    keep = cell >= home[row] if target == size else cell >= 0
                    row, cell = row[keep], cell[keep]
                    at = pa.array(rows[row])
                    yield output({
                        "size": np.full(len(row), target, np.int32), "cell": cell,
                        "home": (cell == home[row]) & (target == size),
                        "word": batch.column("word").take(at), "n": batch.column("n").take(at),
                    }, DEALT)

    return words.select("word", "n").mapInArrow(run, "size int, cell long, home boolean, word string, n long")


def _home(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    """The leaf whose box holds each vector."""
    nodes = np.zeros(len(vectors), np.int64)
    while True:
        place = tree.place[nodes]
        rows = np.flatnonzero(place >= 0)
        if not len(rows):
            return nodes
        at = nodes[rows]
        nodes[rows] = np.where(vectors[rows, place[rows]] <= tree.cut[at], tree.left[at], tree.right[at])


# ------------------------------------------------------------------ forms
def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best_n, best: for each word that has near words, their number and the one of largest n."""
    dealt = dealt_to_cells(words, _upper_trees(words))
    found = dealt.groupBy("size", "cell").applyInArrow(_cell, "word string, n_near long, best_n long, best string")
    least = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("least")
    whole = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least)
    return whole.select("word", "n_near", (-F.col("least.m")).alias("best_n"), F.col("least.w").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """word, root: the end of the chain of forms from each word of ``links`` (word, form).

    Each round doubles the steps taken; a form counts at least FORM_FACTOR times
    its word, so chains are short and have no cycle.
    """
    now = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = saved(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ), narrow=True)
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of ``word_counts``."""
    words = saved(word_counts(docs), narrow=True)
    joined = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= FORM_FACTOR * F.col("n")
    whole = saved(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    ), narrow=True)
    ends = roots(whole.filter("form is not null").select("word", "form"))
    return whole.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
