"""Language identification by nearest centroid.

A text is the vector of its byte pairs and triples (lower case, every ASCII
character that is no letter read as a space), hashed to ``SIZE`` places, as
``log(1 + count) * idf`` with length one.  Each language has up to
``CENTROIDS`` centroids from spherical clustering.  The nearest centroid by
cosine names the language; a vector farther from it than ``radius`` of that
language is rejected (column ``rejected``; the nearest name is still given).

Edge cases: a text that is null or has no letter is ``und`` with score 0;
without learned rows every text is; equal texts get equal results, and of
equally near languages the first by name wins; a document without an id or
language is not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.base import fraction, output, pick, remainder

SIZE = 1 << 12
CENTROIDS = 4
#: Documents per language that clustering uses at most (as an expectation over the hash that picks them).
FIT_ROWS = 300
ROUNDS = 8
#: Share of the learned documents within a language's radius, and the factor on that radius.
WITHIN, SLACK = 0.995, 1.1
CHUNK = 1 << 20
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def counts_of(text: str) -> np.ndarray:
    """Hashed n-gram counts of one text, a chunk at a time."""
    codes = np.frombuffer(b" " + text.lower().encode().translate(_LETTERS) + b" ", np.uint8)
    counts = np.zeros(SIZE)
    for start in range(0, len(codes), CHUNK):
        part = codes[start : start + CHUNK + 2].astype(np.uint32)
        pairs = part[:-1] * np.uint32(257) + part[1:]
        triples = pairs[:-1] * np.uint32(263) + part[2:]
        new = len(pairs) if start + CHUNK + 2 >= len(codes) else CHUNK
        for codes_of, salt in ((pairs[:new], 0x9E3779B1), (triples[:CHUNK], 0x85EBCA6B)):
            counts += np.bincount((codes_of * np.uint32(salt)) >> np.uint32(32 - 12), minlength=SIZE)
    counts[_BLANK] = 0
    return counts


#: Where a pair of spaces falls: it tells nothing.
_BLANK = int((np.array([32 * 257 + 32], np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(20))[0])


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    found = np.stack([counts_of(t) for t in texts])
    found = np.log1p(found) * idf
    norms = np.linalg.norm(found, axis=1, keepdims=True)
    return (found / np.where(norms > 0, norms, 1)).astype(np.float32)


def cluster(points: np.ndarray) -> tuple[np.ndarray, float]:
    """Centroids of unit length, and the distance that ``WITHIN`` of the points keep, with slack."""
    middle = points.mean(axis=0)
    chosen = [int(np.argmax(points @ middle))]
    while len(chosen) < min(CENTROIDS, len(points)):
        nearest = (points @ points[chosen].T).max(axis=1)
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-6:
            break
        chosen.append(far)
    centres = points[chosen]
    for _ in range(ROUNDS):
        at = np.argmax(points @ centres.T, axis=1)
        sums = np.stack([points[at == k].sum(axis=0) if (at == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    distances = 1 - (points @ centres.T).max(axis=1)
    return centres.astype(np.float32), float(np.quantile(distances, WITHIN) * SLACK + 1e-6)


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centres: np.ndarray
    radius: dict[str, float]


def _readable(rows: DataFrame) -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from the documents that ``learn`` (over doc_id) admits: document frequencies from all, centroids from a sample."""
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text", "lang")
    rows = rows.filter(learn & F.col("lang").isNotNull() & _readable(rows))
    known = rows.select("lang", "doc_id", "text")
    frequency = pa.schema([("place", pa.int32()), ("docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total[:SIZE] += counts_of(text) > 0
                total[SIZE] += 1
        if total[SIZE]:
            yield output({"place": np.arange(SIZE + 1, dtype=np.int32), "docs": total}, frequency)

    # SIZE + 1 numbers, whatever the size of the corpus
    found = known.select("text").mapInArrow(count, "place int, docs long").groupBy("place").agg(F.sum("docs").alias("docs")).collect()
    seen = np.zeros(SIZE + 1)
    for row in found:
        seen[row.place] = row.docs
    idf = np.log((1 + seen[SIZE]) / (1 + seen[:SIZE])) + 1

    by_lang = pick(docs, "doc_id", "lang").filter(learn & F.col("lang").isNotNull()).groupBy("lang").count()
    shares = by_lang.select(F.col("lang").alias("of"), (F.lit(float(fit_rows)) / F.col("count")).alias("share"))
    # a row per language
    sample = known.join(F.broadcast(shares), F.col("lang") == F.col("of")).filter(fraction(3, F.col("doc_id")) < F.col("share"))
    fields = pa.schema([("lang", pa.string()), ("vector", pa.binary())])

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start in range(0, len(texts), 256):
                some = vectors(texts[start : start + 256], idf).astype(np.float16)
                yield output({"lang": batch.column("lang")[start : start + 256], "vector": [v.tobytes() for v in some]}, fields)

    def centres(frame: pd.DataFrame) -> pd.DataFrame:
        points = np.stack([np.frombuffer(v, np.float16) for v in sorted(frame["vector"])]).astype(np.float32)
        found, radius = cluster(points)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centre": [c.tobytes() for c in found], "radius": radius})

    embedded = sample.select("lang", "text").mapInArrow(embed, "lang string, vector binary")
    # about fit_rows vectors in a group, CENTROIDS rows a language back
    rows = embedded.groupBy("lang").applyInPandas(centres, "lang string, centre binary, radius double").collect()
    rows.sort(key=lambda r: (r.lang, r.centre))
    matrix = np.stack([np.frombuffer(r.centre, np.float32) for r in rows]) if rows else np.zeros((0, SIZE), np.float32)
    return Model(idf, [r.lang for r in rows], matrix, {r.lang: r.radius for r in rows})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine), rejected for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for column in columns:
            texts, names, scores, far = column.to_pylist(), [], [], []
            for start in range(0, len(texts), 256):
                some = texts[start : start + 256]
                if not known.languages:
                    names += ["und"] * len(some)
                    scores += [0.0] * len(some)
                    far += [True] * len(some)
                    continue
                near = vectors([t or "" for t in some], known.idf) @ known.centres.T
                best = near.argmax(axis=1)
                cosines = np.clip(near[np.arange(len(some)), best].astype(np.float64), 0, 1).round(5)
                found = [known.languages[b] for b in best]
                names += found
                scores += cosines.tolist()
                far += [1 - c > known.radius[n] for c, n in zip(cosines, found)]
            yield pa.StructArray.from_arrays([pa.array(names), pa.array(scores, pa.float64()), pa.array(far)], fields=list(kind))

    rows = pick(docs, "doc_id", "text")
    named = rows.select("doc_id", _readable(rows).alias("readable"), F.arrow_udf(run, "struct<lang:string,score:double,rejected:boolean>").asNondeterministic()(F.col("text")).alias("found"))
    blank = ~F.col("readable")
    return named.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        F.when(blank, "und").otherwise(F.col("found.lang")).alias("lang_pred"),
        F.when(blank, 0.0).otherwise(F.col("found.score")).alias("score"),
        (blank | F.col("found.rejected")).alias("rejected"),
    )
