"""Spelling variants, the filter audit and nearest neighbours against brute force, and on messy tables."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordflow.llm import filter_audit, nearest, spelling

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("TEXT", "word", "n", "size", "cell", "part", "mask", "digest", "id", "run", "h", "bound", "dim", "rank")


def clashing(frame, case=True):
    """With ``case`` also a column that differs from another in case alone, which no file can hold."""
    own = {c.lower() for c in frame.columns}
    return frame.select("*", *[F.lit("x").alias(c) for c in CLASHES if c.lower() not in own or case and c == "TEXT"])


# ------------------------------------------------------------------ spelling variants
def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    by_size, links = defaultdict(list), defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    for size, own in by_size.items():
        for a in own:
            links[a] += [b for b in [*own, *by_size.get(size + 1, []), *by_size.get(size - 1, [])] if near(a, b)]
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= 5 * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, n, len(links[w]), form.get(w), words.get(form.get(w)), root))
    return out


def found_variants(frame):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(frame).collect()}


def test_spelling_variants_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found_variants(docs) == brute_variants([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def dense_texts():
    """Words of few letters, so that most have near words and many share all letter counts."""
    draw = random.Random(3)
    words = ["".join(draw.choice("abAé") for _ in range(draw.choice([5, 6, 6, 7, 7, 8]))) for _ in range(700)]
    words += ["ab" * 40, "ab" * 40 + "a", "ab" * 39 + "ba", "x" * 3000, "x" * 3001]
    return [(i, " ".join(f"{w}{draw.choice(' ,1')}" for w in draw.choices(words, k=900) + words)) for i in range(12)]


@pytest.mark.parametrize("cell", [40, 8192])
def test_spelling_variants_of_dense_words(spark, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL", cell)
    rows = dense_texts()
    frame = clashing(spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS))
    expected = brute_variants(rows)
    assert found_variants(frame) == expected
    assert sum(r[2] for r in expected) > 2000 and any(r[3] for r in expected)


def test_spelling_handles_messy_rows(spark):
    rows = [(1, "colour " * 60), (2, None), (3, ""), (None, "color colours " * 5), (None, "color colours " * 5), (4, "colour×colour ÷÷÷÷÷÷ 12"), (4, "colour×colour")]
    frame = clashing(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS))
    assert found_variants(frame) == brute_variants(rows)
    assert spelling.variants(frame.filter("false")).count() == 0


def test_upper_trees_keep_every_neighbour():
    draw = random.Random(5)
    words = sorted({"".join(draw.choice("abcde") for _ in range(8)).encode() for _ in range(3000)})
    rows = spelling.letters(words, 8)
    vectors = spelling.count_vectors(rows, 4)
    tree = spelling.grow(vectors, 50)
    home, visited = spelling._home(tree, vectors), set(zip(*spelling.visits(tree, vectors, 1, 1)))
    at = {w: i for i, w in enumerate(words)}
    for w, i in list(at.items())[::7]:
        for k, c in itertools.product(range(8), b"abcde"):
            other = at.get(w[:k] + bytes([c]) + w[k + 1 :])
            if other is not None:
                assert (i, home[other]) in visited


# ------------------------------------------------------------------ filter audit
def brute_audit(rows, labels):
    texts = [(i, t or "", p or "") for i, t, p in rows]
    least = {}
    for i, t, _ in texts:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    fails = []
    for i, t, _ in texts:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails.append({
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i,
        })
    out, orders = {}, ["".join(o) for o in itertools.permutations("ABCDE")]
    shapley = Counter()
    for order in orders:
        for (i, _, part), failed in zip(texts, fails):
            removed = False
            for step, f in enumerate(order, 1):
                row = out.setdefault((part, order, step), [0] * 6)
                if failed[f] and removed:
                    row[2] += 1
                if failed[f] and not removed:
                    removed = True
                    shapley[part, f] += 1
                    row[1] += 1
                    row[4] += i is not None and i in good
                    row[5] += i is not None and i in toxic
                row[0] += not removed
                row[3] += failed[f] and sum(failed.values()) == 1
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found_audit(spark, path, labels, files):
    names = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    rows = filter_audit.audit(spark, path, labels, files).select(*names).collect()
    assert len(set(rows)) == len(rows)
    return {tuple(r) for r in rows}


def audit_rows():
    draw = random.Random(7)
    texts = [None, "", "short text", " ".join(map(str, range(150))), " ".join(map(str, range(150))) + " a|b", "LOUD " * 120, "same " * 200]
    rows = [(draw.choice([None, *range(40)]), draw.choice(texts), draw.choice([None, "", "en", "de"])) for _ in range(300)]
    labels = [(draw.choice([None, *range(50)]), draw.choice([None, 0, 1]), draw.choice([None, 0, 1])) for _ in range(60)]
    return rows, labels


@pytest.mark.parametrize("files", [1, 3, 100])
def test_filter_audit_equals_brute_force_in_micro_batches(spark, tmp_path, files):
    rows, labels = audit_rows()
    # ids fall over the files, so that smaller ids come in later micro-batches
    rows.sort(key=lambda r: -(r[0] or 0))
    for k in range(0, 300, 60):
        part = spark.createDataFrame([(i, t, p, "a", 0) for i, t, p in rows[k : k + 60]], DOCS)
        clashing(part, case=False).coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    known = clashing(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert found_audit(spark, str(tmp_path / "docs"), known, files) == brute_audit(rows, labels)


def test_filter_audit_of_one_file_and_of_no_rows(spark, tmp_path):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    expected = brute_audit(docs.select("doc_id", "text", "lang").collect(), labels.select("doc_id", "quality", "toxic").collect())
    assert found_audit(spark, f"{SF}/documents.parquet", labels, None) == expected
    docs.filter("false").write.parquet(str(tmp_path / "none"))
    assert filter_audit.audit(spark, str(tmp_path / "none"), labels).count() == 0


def test_a_micro_batch_retracts_what_smaller_ids_repeat(spark):
    state = lambda rows: spark.createDataFrame(rows, filter_audit.STATE)
    text = b"t"
    earlier = state([(text, "en", 1, 0, 7, 2, 3), (text, "de", 1, 0, 9, 1, 0), (b"u", "en", 0, 0, 1, 1, 0)])
    now = state([(text, "en", 1, 0, 5, 1, 1)])
    found = {tuple(r) for r in filter_audit.counter_changes(earlier, now).collect()}
    # two documents of id 7 move to the repeated ones, id 5 enters first, one larger id enters repeated
    assert found == {("en", 1, 0, 1 - 2), ("en", 17, 0, 2 + 1)}
    assert filter_audit.counter_changes(earlier, now.filter("false")).count() == 0


# ------------------------------------------------------------------ nearest neighbours
def brute_nearest(rows, every, k=5):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    rows = [(i, v) for i, v in rows if np.isfinite(v).all() and v.any()]
    out = {}
    for i, q in rows:
        if i % every == 0:
            scores = [(-(q * v).sum() / (np.sqrt((v * v).sum()) * np.sqrt((q * q).sum())), j) for j, v in rows if j != i and len(v) == len(q)]
            out[i] = [(r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return out


def found_nearest(frame, every):
    out = defaultdict(list)
    for r in nearest.nearest(frame, F.col("vec_id") % every == 0).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.rank, r.vec_id, r.score))
    return dict(out)


@pytest.mark.parametrize("cell", [60, 2048])
def test_nearest_neighbours_recall(spark, monkeypatch, cell):
    monkeypatch.setattr(nearest, "CELL", cell)
    monkeypatch.setattr(nearest, "ROOT", 1)
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    expected = brute_nearest([(r.vec_id, r.embedding) for r in frame.collect()], 10)
    found = found_nearest(frame, 10)
    assert found.keys() == expected.keys()
    hits = sum(len({v for _, v, _ in found[q]} & {v for _, v, _ in expected[q]}) for q in expected)
    assert hits >= 0.95 * sum(map(len, expected.values()))
    scores = {(q, v): s for q, rows in expected.items() for _, v, s in rows}
    assert all(scores.get((q, v), s) == pytest.approx(s, abs=1e-12) for q, rows in found.items() for _, v, s in rows)
    assert all([r for r, _, _ in rows] == [1, 2, 3, 4, 5] for rows in found.values())


def test_nearest_neighbours_on_messy_vectors(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL", 20)
    monkeypatch.setattr(nearest, "ROOT", 1)
    draw = random.Random(9)
    same = [draw.gauss(0, 1) for _ in range(6)]
    rows = [(i, same) for i in range(100)] + [(i, [draw.gauss(0, 1) for _ in range(6)]) for i in range(100, 150)]
    rows += [(150, None), (200, []), (250, [0.0] * 6), (300, [1.0, None] * 3), (350, [float("nan")] * 6), (400, [float("inf")] * 6)]
    rows += [(None, same), (450, [1.0, 2.0]), (451, [2.0, 1.0]), (50, same), (100, same), (500, [1e200] * 3)]
    frame = clashing(spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int"))
    expected, found = brute_nearest(rows, 50), found_nearest(frame, 50)
    found_ids = {q: [v for _, v, _ in r] for q, r in found.items()}
    # equal vectors tie to the smaller ids, also from cells dealt in several
    assert found_ids[0] == [1, 2, 3, 4, 5] and found_ids[50] == [0, 1, 2, 3, 4]
    assert found_ids[450] == [451] and 500 not in found_ids
    assert {q for q in expected if expected[q]} >= found.keys() and not {150, 200, 250, 300, 350, 400} & found.keys()
    assert nearest.nearest(frame.filter("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_stopping_test():
    assert nearest.chi_square_cdf(nearest.stopping_ratio(8, 0.95), 8) == pytest.approx(0.95)
    assert nearest.stopping_ratio(8, 0.95) == pytest.approx(15.507, abs=1e-3)
    draw = np.random.default_rng(1)
    a, b = draw.standard_normal((2, 4000, 64))
    ratios = (((a - b) @ nearest.directions(64)) ** 2).sum(axis=1) / ((a - b) ** 2).sum(axis=1)
    assert np.mean(ratios <= nearest.stopping_ratio()) == pytest.approx(nearest.CONFIDENCE, abs=0.02)
