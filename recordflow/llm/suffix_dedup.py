"""Exact substring deduplication by threshold-bounded interval expansion.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere
else is removed.  No suffix array of the whole corpus is built:

1. Each string of LENGTH bytes (window) is assigned to its minimiser, the
   least-hashed ``SEED`` bytes inside it.  Equal windows have equal minimisers
   at the same place, so only minimisers whose hash occurs twice or more can
   hold repeated windows; all others are gone after one narrow aggregation.
   Inside text of a short period (a row of dashes, a line said over and over) a
   minimiser comes back once a period.  Where all its windows equal, byte for
   byte, those one period earlier, it is an echo: its windows and the earlier
   ones are covered, and the earlier ones stand for it, so a run of any length
   leaves a few minimisers.
2. The windows assigned to a remaining minimiser form one snippet.  Snippets
   are dealt out by the minimiser's hash and aligned at it.  Equal snippets
   count once from here on.
3. In a task, all groups are expanded together, breadth first.  The intervals
   start as the members of a group in suffix order behind the minimiser with
   the common prefixes of neighbours; each level extends every interval by one
   byte to the left through the (positional) Burrows-Wheeler transform of the
   group: members are regrouped stably by the byte in front, and the common
   prefix of two new neighbours is one more than the least between them.
   A window is repeated where a neighbour's prefix reaches LENGTH; a member
   alone in its interval is dropped, and the expansion ends with the leftmost
   window assigned to a member.

The transform's rows are bytes, so hashes only propose and never decide.  Groups
of more than ``HOT_GROUP`` members are not gathered: their windows are counted
one by one in an ordinary aggregation, by two independent hashes of 64 bits.

Edge cases: null texts are empty; texts shorter than LENGTH keep all; repeated
rows are different places, so both copies go; matches never cross documents and
may overlap themselves; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from recordflow.llm.base import byte_texts, output, pick, saved

LENGTH, SEED = 200, 64
LEFT = LENGTH - SEED  # a window starts at most so many bytes before its minimiser
#: Starts of windows hashed at once; a power of two, so that a place fits below the hash.
CHUNK_BITS = 18
CHUNK = 1 << CHUNK_BITS
#: Bytes of snippets that a task expands at once, beyond whole groups.
EXPAND_BYTES = 8 << 20
HOT_GROUP = 100_000
_BASE = 0x5851F42D4C957F2D
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPAN = CHUNK + LENGTH + SEED
_POWERS = np.full(_SPAN, np.uint64(_BASE))
_POWERS[0] = 1
_POWERS = np.multiply.accumulate(_POWERS)
_INVERSES = np.full(_SPAN, np.uint64(pow(_BASE, -1, 1 << 64)))
_INVERSES[0] = 1
_INVERSES = np.multiply.accumulate(_INVERSES)


def minimisers(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (hash, place, first window, last window, period or 0) of a text's minimisers, a chunk of windows at a time."""
    windows = len(text) - LENGTH + 1
    codes = np.frombuffer(text, np.uint8)
    span = LENGTH - SEED + 1
    for start in range(0, windows, CHUNK):
        some = min(CHUNK, windows - start)
        part = codes[start : start + some + LENGTH - 1]
        prefix = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _POWERS[: len(part)], out=prefix[1:])
        hashes = (prefix[SEED:] - prefix[:-SEED]) * _INVERSES[: len(part) - SEED + 1]
        hashes ^= hashes >> np.uint64(31)
        hashes *= _MIX
        hashes ^= hashes >> np.uint64(29)
        bits = np.uint64(CHUNK_BITS + 1)
        least = ((hashes >> bits) << bits) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: -(span - width)], least[span - width :])
        place = (least & np.uint64((2 << CHUNK_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        at = place[first]
        period = _echoes(part, hashes[at], at, first, last)
        yield hashes[at].view(np.int64), at + start, first + start, last + start, period


def _echoes(codes: np.ndarray, hashes: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For minimisers whose windows all equal those one period earlier, the period; else 0.

    A period is the distance to a minimiser of equal hash just before; the bytes decide.
    """
    echo = np.zeros(len(place), np.int64)
    again = 1 + np.flatnonzero(hashes[1:] == hashes[:-1])
    period = place[again] - place[again - 1]
    inside = first[again] >= period
    again, period = again[inside], period[inside]
    for p in np.unique(period).tolist():
        some = again[period == p]
        differ = np.concatenate([[0], np.cumsum(codes[p:] != codes[:-p])])
        echo[some] = p * (differ[last[some] + LENGTH - p] == differ[first[some] - p])
    return echo


def _packed_place(place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place, and how far before it its windows start, in one integer."""
    return (place << 16) | ((place - first) << 8) | (place - last)


def _packed_run(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Covered bytes in one negative integer; texts are shorter than 2^31 bytes."""
    return ~((start << 31) | stop)


def _anchors(rows: DataFrame) -> DataFrame:
    """hash, at, spot for each minimiser of ``rows`` (at, text), but one for each run of echoes.

    A run has the hash of its first echo, which the minimiser before it has too.
    """
    schema = pa.schema([("hash", pa.int64()), ("at", pa.int64()), ("spot", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for at, text in zip(batch.column("at").to_pylist(), byte_texts(batch.column("text"))):
                for hashes, place, first, last, period in minimisers(text):
                    own = period == 0
                    spots = _packed_place(place, first, last)[own]
                    echo = np.flatnonzero(period)
                    if len(echo):
                        starts, stops = first[echo] - period[echo], last[echo] + LENGTH
                        begin, end = merged(starts, stops)
                        heads = echo[np.argsort(starts, kind="stable")][np.searchsorted(np.sort(starts), begin)]
                        hashes, spots = np.append(hashes[own], hashes[heads]), np.append(spots, _packed_run(begin, end))
                    held.append((hashes, np.full(len(hashes), at), spots))
                    size += len(hashes)
                if size > CHUNK:
                    yield output(dict(zip(schema.names, map(np.concatenate, zip(*held)))), schema)
                    held, size = [], 0
            if held:
                yield output(dict(zip(schema.names, map(np.concatenate, zip(*held)))), schema)

    return rows.select("at", "text").mapInArrow(run, "hash long, at long, spot long")


def _snippets(chosen: DataFrame) -> DataFrame:
    """hash, at, first, left, snippet for each entry of ``chosen`` (at, text, marks: array of hash and spot).

    A run of echoes has an empty snippet and, negative, its length as ``left``.
    """
    schema = pa.schema([("hash", pa.int64()), ("at", pa.int64()), ("first", pa.int64()), ("left", pa.int32()), ("snippet", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for row, (at, marks) in enumerate(zip(batch.column("at").to_pylist(), batch.column("marks"))):
                own = marks.values
                spots = own.field("spot").to_numpy(zero_copy_only=False)
                hashes = own.field("hash").to_numpy(zero_copy_only=False)
                runs = spots < 0
                if runs.any():
                    start, stop = ~spots[runs] >> 31, ~spots[runs] & ((1 << 31) - 1)
                    yield output({
                        "hash": hashes[runs], "at": np.full(len(start), at), "first": start,
                        "left": (start - stop).astype(np.int32), "snippet": [b""] * len(start),
                    }, schema)
                    hashes, spots = hashes[~runs], spots[~runs]
                place = spots >> 16
                first, last = place - ((spots >> 8) & 255), place - (spots & 255)
                for i in range(0, len(spots), CHUNK):
                    cut = slice(i, i + CHUNK)
                    parts = [texts[row][s:e] for s, e in zip(first[cut].tolist(), (last[cut] + LENGTH).tolist())]
                    yield output({
                        "hash": hashes[cut], "at": np.full(len(parts), at),
                        "first": first[cut], "left": (place - first)[cut].astype(np.int32), "snippet": parts,
                    }, schema)

    return chosen.mapInArrow(run, "hash long, at long, first long, left int, snippet binary")


def expand(groups: np.ndarray, lefts: np.ndarray, snippets: list[bytes]) -> np.ndarray:
    """Marks [level, member]: the member's window that starts ``level`` bytes before the minimiser is repeated.

    Members are distinct (group, left, snippet).  All groups advance one level
    together; level 0 is the interval of each minimiser itself.
    """
    n = len(snippets)
    sizes = np.fromiter(map(len, snippets), np.int64, n)
    codes = np.frombuffer(b"".join(snippets), np.uint8)
    member = np.repeat(np.arange(n), sizes)
    column = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes - LEFT + lefts, sizes)
    # columns before LEFT lie left of the minimiser; 256 stands for no byte there
    table = np.full((LEFT + LENGTH, n), 256, np.uint16)
    table[column, member] = codes
    stops = sizes - lefts  # bytes from the minimiser to the snippet's end
    ahead = np.where(table[LEFT:] == 256, 0, table[LEFT:]).astype(np.uint8).T.copy()
    words = ahead.view(">u8")
    order = np.lexsort([*words.T[::-1].astype(np.uint64), groups])
    ahead = ahead[order]
    differ = ahead[1:] != ahead[:-1]
    reach = np.zeros(n + 1, np.int64)  # common prefix, from the minimiser on, of a row and the one before it
    reach[1:n] = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
    reach[1:n] = np.minimum(reach[1:n], np.minimum(stops[order][1:], stops[order][:-1]))
    # the hash is only a hint: less than a whole minimiser in common is another group
    reach[1:n][(groups[order][1:] != groups[order][:-1]) | (reach[1:n] < SEED)] = 0
    marks = np.zeros((LEFT + 1, n), bool)
    for level in range(LEFT + 1):
        if level:
            order, reach = _extend(order, reach, table[LEFT - level])
        together = (reach[:-1] > 0) | (reach[1:] > 0)
        if not together.all():  # a member alone can't be repeated further left
            kept = np.flatnonzero(together)
            order, reach = order[kept], np.append(reach[:-1][kept], 0)
        if not len(order):
            break
        marks[level, order] = np.maximum(reach[:-1], reach[1:]) >= LENGTH - level
    return marks


def _extend(order: np.ndarray, reach: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte to the left: rows of each interval regrouped stably by the byte in front."""
    front = before[order].astype(np.int64)
    linked = reach[1:-1] > 0
    split = linked & (front[1:] != front[:-1])
    if not split.any():
        return order, reach
    interval = np.cumsum(np.concatenate([[True], ~linked]))
    keys = interval * 257 + front
    moved = np.argsort(keys, kind="stable")
    sorted_keys = keys[moved]
    same = sorted_keys[1:] == sorted_keys[:-1]
    new = np.zeros(len(reach), np.int64)
    start, stop = moved[:-1] + 1, moved[1:] + 1  # rows between two new neighbours
    next_to = same & (stop == start + 1)
    new[1:-1][next_to] = reach[moved[1:][next_to]]
    apart = np.flatnonzero(same & ~next_to)
    if len(apart):
        ranges = np.stack([start[apart], stop[apart]], axis=1).reshape(-1)
        new[1 + apart] = np.minimum.reduceat(reach, ranges)[::2]
    return order[moved], new


def _spans(groups: np.ndarray, ats: np.ndarray, firsts: np.ndarray, lefts: np.ndarray, snippets: list[bytes]) -> dict:
    """Covered bytes (at, start, stop) of whole groups."""
    slots: dict[tuple, int] = {}
    slot = np.fromiter((slots.setdefault(k, len(slots)) for k in zip(groups.tolist(), lefts.tolist(), snippets)), np.int64, len(snippets))
    distinct = list(slots)
    marks = expand(np.array([k[0] for k in distinct]), np.array([k[1] for k in distinct], np.int64), [k[2] for k in distinct])
    width = np.array([len(k[2]) - LENGTH + 1 for k in distinct])  # windows of the member
    offset = np.array([k[1] for k in distinct])
    hit = np.zeros((len(distinct), LEFT + 3), np.int8)  # by window, with a column free on each side
    level, who = np.nonzero(marks)
    window = offset[who] - level
    good = (window >= 0) & (window < width[who])
    hit[who[good], window[good] + 1] = 1
    twice = np.bincount(slot, minlength=len(distinct)) > 1
    hit[(np.arange(LEFT + 3)[None, :] >= 1) & (np.arange(LEFT + 3)[None, :] <= width[:, None]) & twice[:, None]] = 1
    edge = np.diff(hit, axis=1)
    owner, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    runs = np.bincount(owner, minlength=len(distinct))
    run_start = np.cumsum(runs) - runs
    each = runs[slot]
    pick_run = np.repeat(run_start[slot], each) + np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
    base = np.repeat(firsts, each)
    return {"at": np.repeat(ats, each), "start": base + begin[pick_run], "stop": base + end[pick_run] - 1 + LENGTH}


def _repeated(snippets: DataFrame) -> DataFrame:
    """at, start, stop: covered bytes; ``snippets`` are dealt out by hash, a group in one task."""
    schema = pa.schema([("at", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
    names = ["hash", "at", "first", "left"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            lefts, firsts = (batch.column(c).to_numpy().astype(np.int64) for c in ("left", "first"))
            runs = lefts < 0  # covered already
            if runs.any():
                yield output({"at": batch.column("at").to_numpy()[runs], "start": firsts[runs], "stop": (firsts - lefts)[runs]}, schema)
                batch = batch.filter(pa.array(~runs))
            if not batch.num_rows:
                continue
            held.append((*(batch.column(c).to_numpy().astype(np.int64) for c in names), batch.column("snippet").to_pylist()))
            size += batch.column("snippet").nbytes
            if size >= EXPAND_BYTES and held[-1][0][0] != held[-1][0][-1]:
                *arrays, own = _joined(held)
                cut = int(np.searchsorted(arrays[0], arrays[0][-1]))  # the last group may go on
                yield output(_spans(*(a[:cut] for a in arrays), own[:cut]), schema)
                held = [(*(a[cut:] for a in arrays), own[cut:])]
                size = sum(map(len, own[cut:]))
        if held:
            yield output(_spans(*_joined(held)), schema)

    dealt = snippets.repartition("hash").sortWithinPartitions("hash")
    return dealt.mapInArrow(run, "at long, start long, stop long")


def _joined(held: list[tuple]) -> tuple:
    *arrays, texts = zip(*held)
    return (*(np.concatenate(a) for a in arrays), [t for some in texts for t in some])


def _hot_repeated(snippets: DataFrame) -> DataFrame:
    """at, start, stop for the windows of groups too large for a task: each window counted by two hashes."""
    schema = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("at", pa.int64()), ("start", pa.int64())])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                some = batch.slice(i, 1024)
                h, g, at, start = [], [], [], []
                for a, f, text in zip(some.column("at").to_pylist(), some.column("first").to_pylist(), some.column("snippet").to_pylist()):
                    for w in range(len(text) - LENGTH + 1):
                        own = text[w : w + LENGTH]
                        h.append(xxhash.xxh64_intdigest(own))
                        g.append(xxhash.xxh64_intdigest(own, 1))
                        at.append(a)
                        start.append(f + w)
                yield output({
                    "h": np.array(h, np.uint64).view(np.int64), "g": np.array(g, np.uint64).view(np.int64),
                    "at": np.array(at, np.int64), "start": np.array(start, np.int64),
                }, schema)

    each = snippets.select("at", "first", "snippet").mapInArrow(windows, "h long, g long, at long, start long")
    often = each.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return each.join(often, ["h", "g"], "left_semi").select("at", "start", (F.col("start") + LENGTH).alias("stop"))


def covered(rows: DataFrame, hot_group: int = HOT_GROUP) -> DataFrame:
    """``rows`` (at: a fixed row number, text, ...) with ``spans``, the unmerged (start, stop) of its covered bytes, or null.

    The whole of ``rows`` is joined twice on ``at``, so that Spark shuffles it once and reuses that.
    """
    anchors = _anchors(rows)
    often = saved(anchors.groupBy("hash").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"))
    marks = anchors.join(often, "hash").groupBy("at").agg(F.collect_list(F.struct("hash", "spot")).alias("marks"))
    hot = often.filter(F.col("members") > hot_group).select("hash")
    snippets = _snippets(rows.join(marks, "at"))
    if hot.isEmpty():
        spans = _repeated(snippets)
    else:
        cold = snippets.join(hot.toDF("of"), (F.col("hash") == F.col("of")) & (F.col("left") >= 0), "left_anti")
        spans = _repeated(cold).union(_hot_repeated(snippets.join(hot, "hash", "left_semi")))
    by_row = spans.groupBy("at").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return rows.join(by_row, "at", "left")


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs; runs that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > reach[:-1]]))
    return starts[new], reach[np.append(new[1:], len(starts)) - 1]


def _runs(spans) -> tuple[np.ndarray, np.ndarray]:
    if not spans.is_valid or not len(spans.values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = spans.values
    return merged(own.field("start").to_numpy(zero_copy_only=False), own.field("stop").to_numpy(zero_copy_only=False))


def _kept(text: bytes, starts: np.ndarray, stops: np.ndarray) -> list[bytes]:
    edges = [0, *np.stack([starts, stops], axis=1).reshape(-1).tolist(), len(text)]
    return [text[s:e] for s, e in zip(edges[::2], edges[1::2])]


def removal_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    Row numbers are fixed by file and place: ``docs`` are read from files or saved.
    """
    rows = pick(docs, "doc_id", "text").withColumn("at", F.monotonically_increasing_id())
    kind = "struct<n_bytes: bigint, n_removed: bigint, n_spans: bigint, kept_sha256: string>"

    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in columns:
            found = []
            for text, own in zip(byte_texts(texts), spans):
                starts, stops = _runs(own)
                digest = hashlib.sha256()
                for part in _kept(text, starts, stops):
                    digest.update(part)
                found.append((len(text), int((stops - starts).sum()), len(starts), digest.hexdigest()))
            yield pa.StructArray.from_arrays(
                [pa.array([f[i] for f in found], pa.int64()) for i in range(3)] + [pa.array([f[3] for f in found], pa.string())],
                names=["n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    digest = F.arrow_udf(run, kind).asNondeterministic()(F.col("text"), F.col("spans"))
    return covered(rows).select("doc_id", digest.alias("d")).select("doc_id", "d.*")


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with the covered bytes cut out of ``text`` and ``n_chars`` counted anew where there is one.

    A cut that would split a character leaves that character whole.  A null
    text stays null.
    """
    names = ["text" if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)]
    rows = docs.toDF(*names).withColumn("at", F.monotonically_increasing_id())

    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in columns:
            found = []
            for text, own in zip(texts.cast(pa.binary()).to_pylist(), spans):
                if text is None:
                    found.append(None)
                    continue
                inside = lambda i: i < len(text) and 128 <= text[i] < 192  # noqa: E731,B023
                cuts = []
                for start, stop in zip(*(x.tolist() for x in _runs(own))):
                    while inside(start):
                        start += 1
                    while inside(stop):
                        stop -= 1
                    if start < stop:
                        cuts.append((start, stop))
                at = np.array(cuts, np.int64).reshape(-1, 2)
                found.append(b"".join(_kept(text, at[:, 0], at[:, 1])).decode())
            yield pa.array(found, pa.string())

    cleaned = covered(rows).withColumn("cleaned", F.arrow_udf(run, "string").asNondeterministic()(F.col("text"), F.col("spans")))
    new = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    return cleaned.select(*[new.get(c, F.col(n)) for c, n in zip(docs.columns, names)]).toDF(*docs.columns)
