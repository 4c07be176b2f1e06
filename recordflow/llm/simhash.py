"""SimHash near-duplicates with bit-sliced comparison.

A fingerprint has a bit where over half of a text's word shingles (XXH64, seed
42) have it.  Fingerprints at most ``RADIUS`` bits apart agree on at least two
of ``RADIUS + 2`` bands of bits, so each is dealt out under every pair of
bands.  Inside a bucket fingerprints stand as 64 vertical bit planes; planes
shifted by a lag compare every row with the row that far after it, 64 rows a
word, in carry-save counters, and words of rows that are all too far are left
out of the later planes.  Large buckets compare blocks of rows that have been
reached with the rows that have not, so that a dense group costs about one
pass.  Only links that join something new in the bucket leave a task.

``keep_distinct`` takes documents by similarity instead.  Documents of one set
of five-word shingles (by a hash of 128 bits) stand for each other; a SimHash of
256 bits over the distinct shingles proposes pairs that agree on one of many
random sets of bits, compared by the same bit planes and counters; inside what
the proposals connect the exact share of shingles in common decides for every
pair.  The random sets work in waves: rows that an earlier wave has joined carry
one label, and a wave only links different labels, so a family of copies gives
about a link a row.  Bits of a set grow with the logarithm of the rows, so that
buckets stay small, and the number of sets grows to keep the recall.

Edge cases: null and empty texts have fingerprint zero and are linked like any
other; rows with equal texts share a fingerprint; repeated ids count as rows;
a component without any id has a null ``component_id``; an empty table gives
an empty result.  Casing is folded for A-Z alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from recordflow.llm.base import byte_texts, output, packed, pick, saved, sums_by, unpacked
from recordflow.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: For documents by similarity: words of a shingle, least share of shingles in common, words of a fingerprint, those that
#: are compared and bits they may differ in, tables of so many random bits.  Sets of equal size that share 0.8 differ in
#: 15.15 % of the bits; such a pair is proposed with probability 0.998.
SIMILAR_SHINGLE, SIMILARITY, WIDE, SENT, WIDE_RADIUS = 5, 0.8, 4, 2, 36
#: Least bits of a table, rows a bucket has on average at most beyond those, share of bits in which such sets differ, and
#: the share of such pairs that no table proposes.
TABLE_BITS, BUCKET, DIFFER, MISSED = 14, 8, 0.1515, 0.002
#: Tables of the first waves, and of each later one.
WAVES = (6, 24, 96)
#: Rows of a component that are compared exactly at once, and rows of a large one that every block gets.
BLOCK, SHOWN = 512, 8
_SALTS = np.random.default_rng(42).integers(0, 1 << 64, WIDE, np.uint64)
#: Rows compared at once, and the size from which a bucket is searched by blocks of reached rows.
CHUNK, LARGE, QUERIES = 1 << 17, 192, 64
#: Bit planes after which rows that are too far are left out.
CHECKS = {64: (20, 28, 36, 48), 64 * SENT: (80, 96, 112)}
HASHES = 1 << 16


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(len(words) - width + 1, 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    stops = ends[-n:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, n, HASHES):
        found = np.array([digest(line[s:e], SEED) for s, e in zip(starts[i : i + HASHES], stops[i : i + HASHES])], "<u8")
        ones += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``docs`` with fp (a signed long) in place of ``text``; one pass over the texts."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(np.array([fingerprint(t, width) for t in byte_texts(column)], np.uint64).view(np.int64))

    return docs.withColumn("fp", F.arrow_udf(run, "long").asNondeterministic()(F.col("text"))).drop("text")


def planes(values: np.ndarray) -> np.ndarray:
    """64 bit planes of ``values`` (of each of its columns): word w of plane b holds bit b of rows 64w to 64w+63."""
    if values.ndim == 2:
        return np.concatenate([planes(column) for column in values.T])
    n = len(values)
    padded = np.zeros(-(-n // 64) * 64, "<u8")
    padded[:n] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def lanes(word: np.ndarray) -> np.ndarray:
    """Positions of the set bits of consecutive words."""
    return np.flatnonzero(np.unpackbits(np.ascontiguousarray(word).view(np.uint8), bitorder="little"))


def within(diff, shape: tuple, valid: np.ndarray, radius: int, bits: int = 64) -> np.ndarray:
    """Bits of ``valid`` whose rows differ in at most ``radius`` of ``bits`` planes; ``diff(b, alive)`` gives plane b of the words alive.

    Differences are added up in bit-sliced counters, least bit first, that
    carry into ``over``; the counters are compared with the radius bit by bit.
    """
    flat = valid.reshape(-1)
    alive = np.flatnonzero(flat)
    counters = [np.zeros(len(alive), np.uint64) for _ in range(radius.bit_length())]
    over = np.zeros(len(alive), np.uint64)

    def near() -> np.ndarray:
        more, equal = over.copy(), ~over
        for k in reversed(range(len(counters))):
            if radius >> k & 1:
                equal &= counters[k]
            else:
                more |= equal & counters[k]
                equal &= ~counters[k]
        return flat[alive] & ~more

    for b in range(bits):
        if b in CHECKS[bits]:
            keep = np.flatnonzero(near())
            alive, over, counters = alive[keep], over[keep], [c[keep] for c in counters]
        if not len(alive):
            break
        carry = diff(b, alive)
        for k, c in enumerate(counters):
            counters[k], carry = c ^ carry, c & carry
        over |= carry
    out = np.zeros(flat.shape, np.uint64)
    out[alive] = near()
    return out.reshape(shape)


def _small(
    fps: np.ndarray, sizes: np.ndarray, starts: np.ndarray, radius: int, labels: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows of buckets, largest bucket first, by lag; rows of one label aren't compared."""
    sliced = planes(fps)
    size_of = np.repeat(sizes, sizes)
    ends = np.repeat(starts + sizes, sizes)
    rows = np.arange(len(fps))
    left, right = [], []
    for lag in range(1, int(sizes.max())):
        n = int(np.searchsorted(-size_of, -lag))  # rows of buckets larger than the lag come first
        words = -(-n // 64)
        valid = np.zeros(words * 64, np.uint8)
        valid[:n] = rows[:n] + lag < ends[:n]
        if labels is not None:
            valid[:n] &= labels[:n] != labels[np.minimum(rows[:n] + lag, len(fps) - 1)]
        valid = np.packbits(valid, bitorder="little").view("<u8")
        skip, turn = divmod(lag, 64)
        edge = sliced.shape[1]

        def diff(b: int, alive: np.ndarray) -> np.ndarray:
            at = alive + skip
            low = sliced[b, np.minimum(at, edge - 1)]
            if turn:
                low = (low >> np.uint64(turn)) | (sliced[b, np.minimum(at + 1, edge - 1)] << np.uint64(64 - turn))
            return sliced[b, alive] ^ low

        found = lanes(within(diff, valid.shape, valid, radius, len(sliced)))
        left.append(found)
        right.append(found + lag)
    return np.concatenate(left), np.concatenate(right)


def _large(fps: np.ndarray, radius: int, labels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of links of one bucket: reached rows are compared with rows not yet reached.

    Rows of the label of a reached one are reached without a link.
    """
    left, right = [], []
    rest = np.arange(1, len(fps))
    todo = [0]
    while len(rest):
        if not todo:
            todo.append(int(rest[0]))
            rest = rest[1:]
            continue
        block, todo = todo[:QUERIES], todo[QUERIES:]
        if labels is not None:
            joined = np.isin(labels[rest], labels[block])
            todo += rest[joined].tolist()
            rest = rest[~joined]
            if not len(rest):
                break
        sliced = planes(fps[rest])
        marks = np.unpackbits(fps[block].astype("<u8").view(np.uint8).reshape(len(block), -1), axis=1, bitorder="little")
        full = np.where(marks.astype(bool), np.uint64(2**64 - 1), np.uint64(0))
        words = sliced.shape[1]
        valid = np.zeros(words * 64, np.uint8)
        valid[: len(rest)] = 1
        valid = np.tile(np.packbits(valid, bitorder="little").view("<u8"), (len(block), 1))
        near = within(lambda b, alive: sliced[b, alive % words] ^ full[alive // words, b], valid.shape, valid, radius, len(sliced))
        reached = np.zeros(len(rest), bool)
        for k, q in enumerate(block):
            found = lanes(near[k])
            found = found[~reached[found]]
            reached[found] = True
            left.append(np.full(len(found), q))
            right.append(rest[found])
        todo += rest[reached].tolist()
        rest = rest[~reached]
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


def _forest(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the links join something new."""
    root = list(range(size))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    new = np.zeros(len(left), bool)
    for i, (x, y) in enumerate(zip(left.tolist(), right.tolist())):
        x, y = top(x), top(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            new[i] = True
    return new


def bucket_links(keys: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links up to ``radius`` that connect what is near inside each bucket, fewer than rows; ``keys`` are sorted."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(keys)))
    left, right = [], []
    for k in np.flatnonzero(sizes >= LARGE):
        own = fps[first[k] : first[k] + sizes[k]]
        a, b = _large(own, radius)
        left.append(own[a])
        right.append(own[b])
    small = np.flatnonzero((sizes > 1) & (sizes < LARGE))
    if len(small):
        small = small[np.argsort(-sizes[small], kind="stable")]
        size = sizes[small]
        starts = np.cumsum(size) - size
        rows = np.repeat(first[small] - starts, size) + np.arange(int(size.sum()))
        own = fps[rows]
        a, b = _small(own, size, starts, radius)
        new = _forest(len(own), a, b)
        left.append(own[a[new]])
        right.append(own[b[new]])
    if not left:
        return np.zeros(0, fps.dtype), np.zeros(0, fps.dtype)
    return np.concatenate(left), np.concatenate(right)


def band_masks(radius: int = RADIUS) -> list[int]:
    """Pairs of ``radius + 2`` bands of bits: fingerprints within the radius agree on one of the masks."""
    bands = radius + 2
    edges = [round(64 * i / bands) for i in range(bands + 1)]
    masks = [((1 << e) - 1) ^ ((1 << s) - 1) for s, e in zip(edges, edges[1:])]
    return [x | y for x, y in combinations(masks, 2)]


def fingerprint_links(distinct: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """a, b: links between the fingerprints ``fp`` of ``distinct`` that agree on a mask and differ in ``radius`` bits at most.

    They have the same components as all such links.
    """
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(masks)]
    dealt = distinct.select("fp", F.explode(F.array(*keys)).alias("key")).repartition("key").sortWithinPartitions("key")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = bucket_links(keys, fps.view(np.uint64), radius)
        return output({"a": a.view(np.int64), "b": b.view(np.int64)}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            held.append((batch.column("key").to_numpy(), batch.column("fp").to_numpy()))
            rows += batch.num_rows
            if rows >= CHUNK and held[-1][0][0] != held[-1][0][-1]:
                keys, fps = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
                yield links(keys[:cut], fps[:cut])
                held, rows = [(keys[cut:], fps[cut:])], len(keys) - cut
        if held:
            yield links(*(np.concatenate(x) for x in zip(*held)))

    return dealt.select("key", "fp").mapInArrow(run, "a long, b long").distinct()


def _rooted(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` (with ``fp``; saved) and ``root``, a fingerprint that is the same for all rows of a component."""
    found = components(links)
    return rows.join(found, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id for every row."""
    rows = saved(fingerprints(pick(docs, "doc_id", "text")))
    links = fingerprint_links(rows.select("fp").distinct(), band_masks(), RADIUS)
    rooted = saved(_rooted(rows, links))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")).withColumnRenamed("root", "of")
    joined = rooted.join(least, F.col("root") == F.col("of"))
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``SIMILAR_SHINGLE`` words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(len(words) - SIMILAR_SHINGLE + 1, 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    pairs = zip((ends - lengths)[:n].tolist(), ends[-n:].tolist())
    return np.unique(np.fromiter((digest(line[s:e], SEED) for s, e in pairs), np.uint64, n))


def wide_fingerprint(found: np.ndarray) -> np.ndarray:
    """``WIDE`` words: bits that over half of the set's members have, each member spread to that many words."""
    ones = np.zeros(64 * WIDE, np.int64)
    for i in range(0, len(found), HASHES):
        x = found[i : i + HASHES, None] ^ _SALTS
        for odd, turn in ((0xBF58476D1CE4E5B9, 30), (0x94D049BB133111EB, 27)):
            x = (x ^ (x >> np.uint64(turn))) * np.uint64(odd)
        x ^= x >> np.uint64(31)
        bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8 * WIDE), axis=1, bitorder="little")
        full = len(bits) // 255 * 255  # sums of so many fit a byte
        ones += bits[:full].reshape(-1, 255, 64 * WIDE).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[full:].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(found), bitorder="little").view("<u8")


def wide_fingerprints(rows: DataFrame) -> DataFrame:
    """at, doc_id, s0, s1 (a hash of the whole shingle set), f0 to f3 (its fingerprint) of ``rows`` (at, doc_id, text)."""
    names = ["s0", "s1", *[f"f{i}" for i in range(WIDE)]]
    schema = pa.schema([("at", pa.int64()), *[(n, pa.int64()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, len(names)), np.uint64)
            for row, text in zip(found, byte_texts(batch.column("text"))):
                own = shingle_set(text)
                row[:2] = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes(), SEED), np.uint64)
                row[2:] = wide_fingerprint(own)
            columns = {n: np.ascontiguousarray(found[:, i]).view(np.int64) for i, n in enumerate(names)}
            made = output({"at": batch.column("at"), **columns}, schema)
            yield pa.RecordBatch.from_arrays([*made.columns, batch.column("doc_id")], [*schema.names, "doc_id"])

    kind = dict(rows.dtypes)["doc_id"]
    ddl = ", ".join(f"{n} long" for n in schema.names) + f", doc_id {kind}"
    return rows.select("at", "doc_id", "text").mapInArrow(run, ddl)


def tables_for(bits: int) -> int:
    """How many random sets of ``bits`` bits leave out at most ``MISSED`` of the pairs that differ in each bit with ``DIFFER``."""
    all_bits = 64 * WIDE
    agree = [math.comb(all_bits - d, bits) / math.comb(all_bits, bits) for d in range(all_bits + 1)]
    share = [math.comb(all_bits, d) * DIFFER**d * (1 - DIFFER) ** (all_bits - d) for d in range(all_bits + 1)]
    tables = 1
    while sum(s * (1 - a) ** tables for s, a in zip(share, agree)) > MISSED:
        tables += 1
    return tables


def random_masks(rows: int = 0) -> list[list[int]]:
    """Random sets of bits for so many rows, each as ``WIDE`` signed words."""
    n_bits = max(TABLE_BITS, math.ceil(math.log2(max(rows, 1) / BUCKET)))
    random, masks = np.random.default_rng(9), []
    for _ in range(tables_for(n_bits)):
        bits = np.zeros(64 * WIDE, np.uint8)
        bits[random.choice(64 * WIDE, n_bits, replace=False)] = 1
        masks.append(np.packbits(bits, bitorder="little").view("<i8").tolist())
    return masks


def wide_links(keys: np.ndarray, labels: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of labels that connect those of near rows inside each bucket; ``fps`` has ``SENT`` words a row.

    Rows are sorted by ``keys``, then ``labels``.  The least label of what is
    near is the hub of its links, so tables whose buckets share a family mostly
    name the same links.
    """
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(keys)))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in np.flatnonzero(sizes >= LARGE):
        own = slice(first[k], first[k] + sizes[k])
        a, b = _large(fps[own], WIDE_RADIUS, labels[own])
        left.append(first[k] + a)
        right.append(first[k] + b)
    small = np.flatnonzero((sizes > 1) & (sizes < LARGE))
    if len(small):
        small = small[np.argsort(-sizes[small], kind="stable")]
        size = sizes[small]
        starts = np.cumsum(size) - size
        rows = np.repeat(first[small] - starts, size) + np.arange(int(size.sum()))
        a, b = _small(fps[rows], size, starts, WIDE_RADIUS, labels[rows])
        left.append(rows[a])
        right.append(rows[b])
    names, group = np.unique(labels, return_inverse=True)
    a, b = group[np.concatenate(left)], group[np.concatenate(right)]
    a, b = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    new = _forest(len(names), a, b)
    return names[a[new]], names[b[new]]


def near_links(sets: DataFrame, masks: list[list[int]]) -> DataFrame:
    """a, b: links between labels of rows of ``sets`` (label, f0 to f3) that are near and agree on a mask.

    With rows of one label joined, they have the same components as all such links.
    """
    sent = [f"f{i}" for i in range(SENT)]
    keys = [F.xxhash64(F.lit(i), *[F.col(f"f{w}").bitwiseAND(F.lit(m)) for w, m in enumerate(mask)]) for i, mask in enumerate(masks)]
    dealt = sets.select("label", *sent, F.explode(F.array(*keys)).alias("key")).repartition("key").sortWithinPartitions("key", "label")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(keys: np.ndarray, labels: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = wide_links(keys, labels, fps)
        return output({"a": a, "b": b}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            fps = np.stack([batch.column(n).to_numpy() for n in sent], axis=1).view(np.uint64)
            held.append((batch.column("key").to_numpy(), batch.column("label").to_numpy(), fps))
            rows += batch.num_rows
            if rows >= CHUNK and held[-1][0][0] != held[-1][0][-1]:
                full = [np.concatenate(x) for x in zip(*held)]
                cut = int(np.searchsorted(full[0], full[0][-1]))  # the last bucket may go on
                yield links(*[x[:cut] for x in full])
                held, rows = [tuple(x[cut:] for x in full)], len(full[0]) - cut
        if held:
            yield links(*[np.concatenate(x) for x in zip(*held)])

    return dealt.select("key", "label", *sent).mapInArrow(run, "a long, b long").distinct()


def near_groups(sets: DataFrame) -> DataFrame:
    """``sets`` (at, f0 to f3; saved) with label, the least ``at`` of what nearness connects."""
    masks = random_masks(sets.count())
    labelled, wave = sets.withColumn("label", F.col("at")), 0
    while masks:
        now, masks = masks[: WAVES[wave]], masks[WAVES[wave] :]
        wave = min(wave + 1, len(WAVES) - 1)
        found = components(near_links(labelled, now))
        joined = labelled.join(found, F.col("label") == F.col("node"), "left").withColumn("label", F.coalesce("root", "label"))
        labelled = saved(joined.drop("node", "root"), narrow=True)
    return labelled


def shared_enough(sets: list[np.ndarray], labels: np.ndarray) -> list[tuple[int, int]]:
    """Links of sets that share at least ``SIMILARITY``, fewer than sets; with those of one label joined, they connect all such pairs."""
    sizes = np.array([len(s) for s in sets])
    places = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    marks = np.zeros(int(places.max(initial=-1)) + 1, np.int64)
    found, group = [], np.unique(labels, return_inverse=True)[1]
    todo, open_ = [], np.ones(len(sets), bool)
    while open_.any():
        if not todo:
            todo = [int(np.flatnonzero(open_)[0])]
        at = todo.pop()
        # whatever is joined to this one already needs no comparison
        joined = np.flatnonzero(open_ & (group == group[at]))
        open_[joined] = False
        todo += joined[joined != at].tolist()
        if not open_.any():
            break
        own = places[starts[at] : starts[at] + sizes[at]]
        marks[own] = 1
        common = sums_by(marks[places], sizes)
        marks[own] = 0
        near = np.flatnonzero(open_ & (common >= SIMILARITY * (sizes + sizes[at] - common)))
        open_[near] = False
        todo += near.tolist()
        found += [(at, int(k)) for k in near]
    return found


def _compared(dealt: DataFrame) -> DataFrame:
    """a, b: links of enough shingles in common among the rows of each (root, i, j) of ``dealt`` (and at, label, shingles)."""
    schema, by = pa.schema([("a", pa.int64()), ("b", pa.int64())]), ["root", "i", "j"]

    def links(held: list[tuple]) -> pa.RecordBatch:
        ats = [r[0] for r in held]
        found = shared_enough([r[2] for r in held], np.array([r[1] for r in held])) if len(held) > 1 else []
        return output({"a": [ats[x] for x, _ in found], "b": [ats[y] for _, y in found]}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            keys = zip(*[batch.column(n).to_pylist() for n in by])
            ats, labels, sets = (batch.column(n) for n in ("at", "label", "shingles"))
            for k, key in enumerate(keys):
                if key != now and held:
                    yield links(held)
                    held = []
                now = key
                held.append((ats[k].as_py(), labels[k].as_py(), sets[k].values.to_numpy()))
        if held:
            yield links(held)

    ordered = dealt.select(*by, "at", "label", "shingles").repartition(*by).sortWithinPartitions(*by)
    return ordered.mapInArrow(run, "a long, b long")


def similar_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links with the components of all pairs that share ``SIMILARITY`` of their shingles, inside what nearness connects.

    ``rows`` (at, text), ``sets`` (at, f0 to f3; saved): a row for each
    distinct shingle set.  Every pair of a component of near rows is compared
    exactly, unless links found before join the two anyway.  Components of over
    ``BLOCK`` rows are first compared inside blocks, to each of which a few
    rows of the component go as well; if that leaves more than one group, the
    blocks of all but the largest group are compared with all blocks.
    """
    near = near_groups(sets).filter(F.col("label") != F.col("at")).select("at", F.col("label").alias("root"))
    near = near.union(near.select(F.col("root").alias("at"), "root")).distinct()  # roots are no nodes of their own there

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([shingle_set(t).view(np.int64) for t in byte_texts(column)], pa.list_(pa.int64()))

    of_text = F.arrow_udf(run, "array<long>").asNondeterministic()(F.col("text"))
    read = saved(rows.join(near, "at").select("at", "root", of_text.alias("shingles")))
    sizes = saved(read.groupBy("root").agg(F.count(F.lit(1)).alias("n")), narrow=True)
    counted = read.join(sizes, "root").withColumn("h", F.xxhash64("at"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = counted.withColumn("i", F.pmod("h", blocks).cast("int"))
    least = Window.partitionBy("root").orderBy("h", "at")
    shown = counted.filter(F.col("n") > BLOCK).select("root", "at", "h").withColumn("r", F.row_number().over(least)).filter(F.col("r") <= SHOWN)
    spread = counted.join(shown.select("at"), "at").select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"))
    spread = spread.filter(F.col("i") != F.pmod("h", blocks))  # each is in its own block anyway
    first = own.unionByName(spread).withColumn("j", F.col("i")).withColumn("label", F.col("at"))
    links = saved(_compared(first), narrow=True)
    large = sizes.filter(F.col("n") > BLOCK)
    if large.isEmpty():
        return links

    joined = components(links)
    large_rows = read.join(large, "root").join(joined.withColumnRenamed("root", "label"), F.col("at") == F.col("node"), "left")
    labelled = large_rows.withColumn("label", F.coalesce("label", "at")).drop("node")
    groups = labelled.groupBy("root", "label").agg(F.count(F.lit(1)).alias("c"))
    groups = groups.groupBy("root").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.max("c").alias("c"))
    left = labelled.join(groups, "root").filter(F.col("c") < F.col("n"))
    # blocks of the other groups are numbered before those of the largest
    few, many = (F.ceil(x / BLOCK).cast("int") for x in (F.col("n") - F.col("c"), F.col("c")))
    in_main, h = F.col("label") == F.col("main"), F.xxhash64("at")
    block = F.when(in_main, few + F.pmod(h, many)).otherwise(F.pmod(h, few)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(in_main, few).otherwise(few + many) - 1)).alias("o")
    pairs = left.withColumn("block", block).select("*", other)
    pairs = pairs.withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o"))
    return links.union(_compared(pairs))


def keep_distinct(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, less all but one of each group of similar rows: the least id, then the first row.

    Row numbers are fixed by file and place: ``docs`` are read from files or saved.
    """
    rows = packed(docs, "doc_id", "text").withColumn("at", F.monotonically_increasing_id())
    best = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", F.col("at").alias("first")))
    alike = wide_fingerprints(rows).groupBy("s0", "s1").agg(
        F.min("at").alias("at"), best.alias("best"), *[F.min(f"f{i}").alias(f"f{i}") for i in range(WIDE)]
    )
    sets = saved(alike.drop("s0", "s1"))
    found = components(similar_links(rows.select("at", "text"), sets.drop("best")))
    rooted = sets.join(found, F.col("at") == F.col("node"), "left").withColumn("root", F.coalesce("root", "at"))
    kept = rooted.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.first").alias("kept"))
    return unpacked(rows.select("row", "at").join(kept, F.col("at") == F.col("kept"), "left_semi"), docs)
