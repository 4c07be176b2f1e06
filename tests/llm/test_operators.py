"""The operators for training text against brute force, and on messy tables."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from recordflow.llm import (
    components, decontamination, language_id, language_model, mixing, quality_classifier, quality_rules, simhash, suffix_dedup,
    token_counts, url_filters,
)
from recordflow.llm.queries import TOKENIZER, learned

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Ärger " + " ".join(f"word{i}" for i in range(20_000))
MESSY = [
    (1, "the cat sat on the mat " * 3, "en", "b", 66), (2, None, "en", None, None), (3, "", "en", "a", 0), (None, "no id here", None, "a", 10),
    (4, "der hund und die katze", "de", "b", 22), (4, "der hund und die katze", "de", "b", 22), (5, " \n\t ", "de", "c", 4),
    (6, "12345 !!!", None, "c", 9), (7, LONG, "en", "c", len(LONG)), (8, "▁ two  spaces <s> \x00 é ß", "fr", "b", 20),
]
LABELS = [(1, 1, 0), (2, 0, 0), (3, None, 0), (4, 1, 0), (4, 0, 0), (6, 0, 1), (None, 1, 0), (7, 1, 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def messy(spark):
    frame = spark.createDataFrame(MESSY, DOCS)
    clash = [F.lit("x").alias(c) for c in ("TEXT", "row", "at", "score", "fp", "held_out", "size", "u", "cleaned", "spans")]
    return frame.select("*", *clash)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def empty(frame):
    return frame.filter("false")


def test_token_counts_equal_the_library(docs, texts, messy):
    path = public_tokenizers.path(TOKENIZER)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for frame, rows in ((docs, texts.items()), (messy, [(r[0], r[1]) for r in MESSY])):
        found = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(frame, path).collect())
        expected = Counter()
        for i, t in rows:
            n = len(library.encode(t or ""))
            expected[(i, len((t or "").encode()), n, n > 4096)] += 1
        assert found == expected
    assert token_counts.count_tokens(empty(messy), path).count() == 0


def test_token_counts_of_odd_texts():
    path = public_tokenizers.path(TOKENIZER)
    counts, library = token_counts.Counts(path), token_counts.load(path)[0]
    odd = [" ", "  ", " a", "a ", "a  b", "▁", "a▁b", "\n\n", "</s><unk>", "😀 😀", "x" * 500, "a b", "ﬁ　ﬀ", "\r\n\t", "é é"]
    odd += [f"a {chr(c)}b" for c in [*range(1, 0x3100), *range(0xFE00, 0x10000)]]
    assert [t for t in odd if counts.of(t) != len(library.encode(t))] == []
    assert not token_counts.split_is_exact(["a▁b"]) and token_counts.split_is_exact(["▁▁a", "b"])


def brute_removal(all_texts, length=200):
    seen = Counter(t[p : p + length] for t in all_texts for p in range(len(t) - length + 1))
    out = []
    for t in all_texts:
        steps = np.zeros(len(t) + 1, np.int64)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                steps[p] += 1
                steps[p + length] -= 1
        gone = np.cumsum(steps)[: len(t)] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_equals_brute_force(spark, docs, texts):
    cases = [t.encode() for t in texts.values()]
    cases += [b"a" * 450, b"ab" * 300, b"xyz" * 100 + b"\x00" * 250, cases[0], b"Q" + cases[1][5:], b"", "ß".encode() * 300]
    rows = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(cases)], "doc_id long, text string")
    found = sorted(tuple(r) for r in suffix_dedup.removal_digests(rows).collect())
    assert found == [(i, *e) for i, e in enumerate(brute_removal(cases))]


def test_suffix_dedup_on_periodic_texts(spark):
    """Runs of a short period leave few minimisers, and windows elsewhere still find what the run holds."""
    random = np.random.default_rng(5)
    cases = [b"-" * 700, b"Is onhe. " * 60, b"Is onhe. " * 22 + b"I", b"head " + b"Is onhe. " * 25 + b"tail", b"=" * 199, b"=" * 200, b"-" * 200]
    cases += [b"line by line\n" * 21_000 + b"the end", b"a line of more than one hundred and thirty-six bytes " * 3 + b"-" * 300 + b"=" * 300 + b"-" * 201]
    for period in (1, 2, 7, 50, 120, 136, 137, 150):
        unit = bytes(random.integers(97, 100, period, dtype=np.uint8))
        runs = [unit * int(random.integers(2, 2 + 900 // period)) for _ in range(3)]
        cases += [b"<" + runs[0] + b"|" + runs[1][1:] + b">", runs[2][period // 2 :], (unit * 900)[period // 3 :][:200]]
    rows = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(cases)], "doc_id long, text string")
    found = sorted(tuple(r) for r in suffix_dedup.removal_digests(rows).collect())
    assert found == [(i, *e) for i, e in enumerate(brute_removal(cases))]
    for text in (b"-" * 600_000, b"Is onhe. " * 50_000):
        assert sum(int((period == 0).sum()) for *_, period in suffix_dedup.minimisers(text)) < 12


def test_suffix_dedup_counts_hot_groups_by_window(spark):
    body = " ".join(f"passage{i}" for i in range(60))
    rows = spark.createDataFrame([(i, f"{i} head {body} tail {i * 7} " + "-" * 500) for i in range(30)], "doc_id long, text string")
    plain, split = (
        {(r.at, tuple(zip(*(x.tolist() for x in suffix_dedup.merged(np.array([s.start for s in r.spans]), np.array([s.stop for s in r.spans])))))
          ) for r in suffix_dedup.covered(rows.withColumn("at", F.monotonically_increasing_id()), hot).collect()}
        for hot in (suffix_dedup.HOT_GROUP, 2)
    )
    assert plain == split and len(plain) == 30


def test_suffix_dedup_on_messy_rows(messy):
    rows = suffix_dedup.removal_digests(messy).collect()
    assert len(rows) == len(MESSY) and {r.n_bytes for r in rows if r.doc_id in (2, 3)} == {0}
    kept = suffix_dedup.without_repeats(messy)
    assert kept.columns == messy.columns and kept.count() == len(MESSY)
    assert suffix_dedup.removal_digests(empty(messy)).count() == 0


def brute_fingerprint(text, width=4):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1 if words else 0))]
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def brute_roots(fps, near):
    root = list(range(len(fps)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if near(fps[i], fps[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(fps))]


def test_simhash_equals_brute_force(spark, texts):
    cases = [*texts.values(), None, "", "one", "One", texts[0] + " extra words", " ".join(texts[1].split()[1:])]
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = {r.doc_id: r for r in simhash.near_duplicates(rows).collect()}
    fps = [brute_fingerprint(t or "") for t in cases]
    roots = brute_roots(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    assert [(found[i].fingerprint, found[i].component_id) for i in range(len(cases))] == [(f"{f:016x}", r) for f, r in zip(fps, roots)]


@pytest.mark.parametrize("radius", [4, 12])
def test_buckets_small_and_large_connect_what_is_near(radius):
    random = np.random.default_rng(radius)
    base = random.integers(0, 1 << 63, 6, dtype=np.uint64)
    def near_copies(n):
        flips = np.zeros(n, np.uint64)
        for _ in range(radius):
            flips ^= np.uint64(1) << random.integers(0, 64, n).astype(np.uint64)
        return base[random.integers(0, 6, n)] ^ flips
    fps = np.concatenate([near_copies(n) for n in (3, 40, 300, 1, 130)])
    keys = np.repeat(np.arange(5), (3, 40, 300, 1, 130))
    a, b = simhash.bucket_links(keys, fps, radius)
    assert (np.bitwise_count(a ^ b) <= radius).all()
    for k in range(5):
        own = np.unique(fps[keys == k]).tolist()
        expected = brute_roots(own, lambda x, y: (x ^ y).bit_count() <= radius)
        links = [(x, y) for x, y in zip(a.tolist(), b.tolist()) if x in own and y in own]
        pairs = set(links) | {(y, x) for x, y in links}
        # links of another bucket may join more, never less
        found = brute_roots(own, lambda x, y: (x, y) in pairs)
        assert len(set(found)) <= len(set(expected)) if keys.size and k in (0, 1, 3, 4) else found == expected


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 300), (7, 7)] + [(1000, 1000 + i) for i in range(1, 40)]
    found = dict(components.components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert all(found[i] == 0 for i in range(1, 51)) and found[200] == found[300] == 100 and found[1039] == 1000
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similar_rows_leave_one(spark, texts):
    words = texts[3].split()
    cases = [*list(texts.values())[:60], texts[3], " ".join(words[:-2]), None, None, "short"]
    rows = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(cases)], DOCS)
    sets = [simhash_set(t or "") for t in cases]
    roots = brute_roots(sets, lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b))
    assert sorted(r.doc_id for r in simhash.keep_distinct(rows).collect()) == sorted(set(roots))
    assert simhash.keep_distinct(empty(rows)).count() == 0


def kept_of(spark, cases):
    rows = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(cases)], DOCS)
    return sorted(r.doc_id for r in simhash.keep_distinct(rows).collect())


def brute_kept(cases):
    sets = [simhash_set(t) for t in cases]
    return sorted(set(brute_roots(sets, lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b))))


def of_words(seed, n):
    return [f"w{x}" for x in np.random.default_rng(seed).integers(0, 1 << 40, n)]


def test_similar_rows_of_one_template(spark):
    # every page is near to all others, and similar to one
    page, cases = of_words(1, 400), []
    for k in range(300):
        own = page[:352] + of_words(100 + k, 48)
        cases += [" ".join(own), " ".join(own[:-2])]
    expected = brute_kept(cases)
    assert len(cases) > simhash.BLOCK and len(expected) == 300
    assert kept_of(spark, cases) == expected


def test_similar_rows_at_the_least_similarity(spark):
    cases = []
    for k in range(60):
        own = of_words(k, 400)
        cases += [" ".join(own), " ".join(own[:357] + of_words(1000 + k, 43))]
    sets = [simhash_set(t) for t in cases]
    assert all(0.79 < len(a & b) / len(a | b) < 0.82 for a, b in zip(sets[::2], sets[1::2]))
    expected = brute_kept(cases)
    assert len(expected) <= 60 and len(kept_of(spark, cases)) <= len(expected) + 1


def test_similar_rows_with_a_line_said_often(spark):
    line = of_words(7, 11) * 300
    cases = [" ".join(line + of_words(k, 150)) for k in range(4)]  # share the line alone
    words = of_words(50, 400)
    cases += [" ".join(words), " ".join(words + of_words(51, 5) * 300)]  # the same but for the line
    assert kept_of(spark, cases) == brute_kept(cases) == [0, 1, 2, 3, 4]


def simhash_set(text):
    words = text.encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1 if words else 0)))


def edit_distance_to_passage(pattern, text):
    row = [0] * (len(text) + 1)
    for p in pattern:
        new = [row[0] + 1]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_decontamination_finds_every_passage_within_the_budget(spark):
    items = [(i, r.text) for i, r in enumerate(spark.read.parquet(f"{SF}/benchmark.parquet").limit(6).collect())]
    random = np.random.default_rng(4)
    cases = []
    for i, t in items:
        for edits in (0, 3, len(t) * 6 // 100, len(t) * 6 // 100 + 6):
            letters = list(t)
            for at in sorted(random.choice(len(t), edits, replace=False), reverse=True):
                letters[at : at + 1] = [[], ["q"], [letters[at], "z"]][random.integers(3)]
            cases.append("Before it.\n " + "".join(letters).upper() + " and after")
    cases += ["", None, "nothing of the kind"]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(cases)], DOCS)
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, " ")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in decontamination.contaminated(docs, bench).collect()}
    expected = {}
    for k, t in enumerate(cases):
        for i, item in items:
            d = edit_distance_to_passage(decontamination.plain(item), decontamination.plain(t or ""))
            if d <= len(decontamination.plain(item)) * decontamination.RATE // 100:
                expected[(k, i)] = d
    assert found == expected and len(found) >= 18
    kept = decontamination.without_contaminated(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(cases))) - {k for k, _ in expected})
    assert decontamination.contaminated(docs, empty(bench)).count() == 0


def test_mixing_targets_and_copies(docs, messy):
    for frame in (docs, messy):
        rows = mixing.mix(frame).collect()
        assert len(rows) == frame.count()
        sizes = {}
        for r in rows:
            sizes.setdefault(r.source, []).append(r)
        order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
        words = {s: sum(r.size for r in sizes[s]) for s in order}
        weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
        total, full = 1.5 * sum(words.values()), set()
        while True:
            level = (total - sum(2 * words[s] for s in full)) / sum(weights[s] for s in order if s not in full)
            more = {s for s in order if s not in full and level * weights[s] > 2 * words[s]}
            if not more:
                break
            full |= more
        for s in order:
            target = 2 * words[s] if s in full else level * weights[s]
            assert all(r.source_size == words[s] and math.isclose(r.target, target, rel_tol=1e-9) for r in sizes[s])
            largest = max(r.size for r in sizes[s])
            assert abs(sum(r.taken for r in sizes[s]) - target) <= largest + 1
        assert all(r.taken <= 2 * r.size for r in rows)
        assert sorted(map(str, mixing.mix(frame).collect())) == sorted(map(str, rows))
        assert mixing.mixed_documents(frame).count() == sum(r.taken > 0 for r in rows)
    assert mixing.mix(empty(messy)).count() == 0


def test_mixing_replaces_columns_of_its_own_names(docs):
    plain = mixing.mixed_documents(docs)
    found = mixing.mixed_documents(docs.withColumn("Mix_Copies", F.lit("old")).withColumn("mix_target", F.lit(0)))
    assert found.columns == plain.columns
    assert sorted((r.doc_id, r.mix_copies) for r in found.collect()) == sorted((r.doc_id, r.mix_copies) for r in plain.collect())


def test_url_rules_and_mined_rules(spark):
    urls = [
        (1, "http://a.Example.COM/en/1"), (2, "https://www.example.com/en/1?x=1"), (3, "https://b.net/es/9#top"), (4, "http://net/fr/"),
        (5, "http://b.net/esp"), (6, None), (7, "no scheme"), (8, "http://x.com"), (9, "http://x.com?y=/"), (10, "http://q.org/es/5"), (3, "https://b.net/es/9#top"),
    ] + [(100 + i, f"http://h{i % 7}.net/es/{i}") for i in range(60)] + [(200 + i, f"http://h{i % 7}.com/de/{i}") for i in range(60)]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("html", F.lit("x")).withColumn("host", F.lit("y"))
    rows = url_filters.judge(pages).collect()
    by_id = {r.page_id: r for r in rows}
    assert len(rows) == len(urls)
    assert [by_id[i].rule for i in range(1, 11)] == [
        "example.com/en/", "www.example.com/en/", "net/es/", "net/fr/", None, None, None, None, None, None,
    ]
    assert (by_id[1].host, by_id[1].path) == ("a.example.com", "/en/1") and (by_id[9].host, by_id[9].path) == ("x.com", "")
    assert (by_id[6].host, by_id[7].path, by_id[6].verdict) == ("", "", "allow")
    assert by_id[2].verdict == "allow" and by_id[3].verdict == "block"
    assert by_id[10].verdict == "block" and "path:es" in by_id[10].mined_rule  # mined from the blocked es pages
    assert url_filters.judge(empty(pages)).count() == 0
    assert {r.verdict for r in url_filters.judge(pages, {}).collect()} == {"allow"}


def test_url_rules_of_four_tokens(spark):
    parts = [["a", "b", "c", "d"], ["a", "b", "c"], ["a", "b", "d"], ["a", "c", "d"], ["b", "c", "d"]]
    rows = [(p, "allow" if len(p) < 4 else "block") for p in parts for _ in range(10)]
    found = url_filters.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string")).collect()
    assert ["a", "b", "c", "d"] in [r.rule_tokens for r in found if r.verdict == "block"]


def brute_rules(rows):
    """Kept rules by counting every set of tokens that some page holds."""
    held = Counter()
    for tokens, verdict in rows:
        for k in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), k):
                held[part, verdict] += 1
                held[part, None] += 1
    least = math.ceil(url_filters.SUPPORT * len(rows))
    rules = {(p, v): n / held[p, None] for (p, v), n in held.items() if v and n >= least and n / held[p, None] >= url_filters.CONFIDENCE}
    redundant = lambda p, v, c: any(
        rules.get((q, v), -1) >= c for k in range(1, len(p)) for q in itertools.combinations(p, k))
    return {(p, v, c, held[p, v] / len(rows)) for (p, v), c in rules.items() if not redundant(p, v, c)}


@pytest.mark.parametrize("seed", range(4))
def test_mined_rules_equal_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(url_filters, "SUPPORT", 0.03)
    rng = random.Random(seed)
    rows = []
    for _ in range(120):
        tokens = {t for t in "abcdef" if rng.random() < 0.5}
        tokens |= {"same1", "same2"} if "a" in tokens else set()       # on the very pages of a
        tokens |= {"all1", "all2"} | ({"sure"} if {"b", "c"} <= tokens else set())
        block = {"b", "c"} <= tokens or ({"a", "d"} <= tokens and rng.random() < 0.9)
        rows.append((sorted(tokens), "block" if block else "allow"))
    rows.append(([], "allow"))
    found = url_filters.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string")).collect()
    assert {(tuple(r.rule_tokens), r.verdict, r.confidence, r.support) for r in found} == brute_rules(rows)
    assert len(found) == len(brute_rules(rows)) and all(r.rarest in r.rule_tokens for r in found)


def test_many_tokens_that_all_pages_share(spark):
    many = [f"t{i}" for i in range(30)]
    rows = [(many, "block") for _ in range(400)] + [([*many, "odd"], "allow") for _ in range(40)]
    found = url_filters.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string")).collect()
    assert sorted((r.rule_tokens, r.verdict, r.confidence) for r in found) == sorted(
        [([t], "block", 400 / 440) for t in many] + [(["odd"], "allow", 1.0)])


def brute_repeats(words):
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    return len(hit)


def test_quality_rules(spark, docs, texts, messy, labels):
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    for frame, own, rows in ((docs, marks, list(texts.items())), (messy, labels, [(r[0], r[1]) for r in MESSY])):
        found = quality_rules.judge(frame, own).collect()
        expected = Counter()
        for i, t in rows:
            t = t or ""
            words = t.encode().split()
            chars = sum(len(w.decode()) for w in words)
            lines = Counter(x for x in t.split("\n") if x.encode().split())
            repeat = brute_repeats(words)
            failed = len(words) < 50 or 100 * repeat > 50 * len(words)
            expected[(i, len(words), chars, sum(t.count(c) for c in "#*$%&|<>"), sum(lines.values()) - len(lines), repeat, failed)] += 1
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found) == expected
        assert not any(r.kept and r.base_failed for r in found)
    good = {r.doc_id for r in marks.filter("quality = 1").collect()}
    judged = quality_rules.judge(docs, marks).filter("not base_failed").collect()
    assert sum(r.kept for r in judged if r.doc_id in good) >= 0.98 * sum(r.doc_id in good for r in judged)
    assert quality_rules.judge(empty(messy), labels).count() == 0
    assert quality_rules.judge(messy, empty(labels)).filter("not base_failed and not kept").count() == 0


def test_quality_classifier(spark, messy, labels):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit(docs, marks, learned())
    scored = quality_classifier.score_documents(docs, model)
    held = scored.filter("held_out").join(marks, "doc_id")
    assert held.filter("predicted = quality").count() >= 0.97 * held.count()
    assert scored.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)).count() == 0
    small = quality_classifier.fit(messy, labels, learned())
    rows = quality_classifier.score_documents(messy, small).collect()
    assert len(rows) == len(MESSY) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    kept = quality_classifier.keep_good(messy, small, 0.0)
    assert kept.columns == messy.columns and kept.count() == len(MESSY)
    blank = quality_classifier.fit(messy, empty(labels), learned())
    assert {r.score for r in quality_classifier.score_documents(messy, blank).collect()} == {0.5}
    assert quality_classifier.score_documents(empty(messy), blank).count() == 0


def test_classifier_ngram_counts():
    words = quality_classifier.Words()
    several, counts = quality_classifier.ngrams([b"", b"a", b"a b", b"a b c d"], words)
    assert counts.tolist() == [0, 2, 6, 16] and len(several) == 24
    assert quality_classifier.ngrams([b"a b c d"], words)[0].tolist() == several[8:].tolist()


def test_language_id(spark, messy):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify(docs, language_id.fit(docs, learned())).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    small = language_id.identify(messy, language_id.fit(messy, learned())).collect()
    assert len(small) == len(MESSY) and all(0 <= r.score <= 1 for r in small)
    assert {r.lang_pred for r in small if r.doc_id in (2, 3, 5, 6)} == {"und"}
    blank = language_id.fit(empty(messy), learned())
    assert {r.lang_pred for r in language_id.identify(messy, blank).collect()} == {"und"}


def test_language_model(spark, docs, texts, messy):
    for frame, rows in ((docs, list(texts.items())), (messy, [(r[0], r[1]) for r in MESSY])):
        held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        tokens = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
        c = Counter(w for i, ws in tokens if not held(i) for w in ws)
        n, v = sum(c.values()), len(c)
        expected = sorted(
            (str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4)) for i, ws in tokens
        )
        found = language_model.score(frame).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found) == expected
        assert all(r.score < 0 for r in found)
    assert language_model.score(empty(messy)).count() == 0


def test_language_model_trains_on_all_learned_rows(spark, docs, monkeypatch):
    seen = []
    monkeypatch.setattr(language_model, "train", lambda rows, known: seen.append(rows.count()) or language_model.Weights.zero())
    language_model.score(docs)
    assert seen == [sum(zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for r in docs.select("doc_id").collect())]


def test_language_model_is_a_distribution():
    known = language_model.Vocabulary(
        10, 3, {b"a": 4, b"": 3}, {b"a": 0, b"": 1}, np.zeros(language_model.OWN + language_model.SHARED),
        np.log(np.full(32, 1 / 32, np.float32)), np.log(np.full((32, 32), 1 / 32, np.float32)),
    )
    weights = language_model.Weights.zero()
    random = np.random.default_rng(7)
    for t in weights.tables:
        t[:] = random.normal(size=t.shape)
    leaves = np.arange(language_model.OWN + language_model.SHARED)
    # the same history before each possible leaf
    history = np.array([11, 12], np.uint64)
    total = 0.0
    for leaf in leaves:
        found = language_model.log_probabilities(known, weights, np.array([3, 5, leaf]), np.array([*history, 0], np.uint64), np.array([3]))
        total += 10 ** found[2]
    assert math.isclose(total, 1, rel_tol=1e-3)


def test_language_model_step_equals_a_scalar_one():
    random, size = np.random.default_rng(3), language_model.OWN + language_model.SHARED
    log_shares = lambda x: np.log(x / x.sum(axis=-1, keepdims=True)).astype(np.float32)
    priors = log_shares(random.random(32)), log_shares(random.random((32, 32)))
    known = language_model.Vocabulary(10, 3, {b"": 3}, {b"": 0}, np.zeros(size), *priors)
    leaves, counts = random.integers(0, size, 90), np.array([40, 1, 49])
    hashes = random.integers(0, 1 << 63, 20).astype(np.uint64)[random.integers(0, 20, 90)]
    trainer = language_model.Trainer(known, language_model.Weights.zero())
    for t in trainer.now.tables:
        t[:] = random.normal(size=t.shape)
    tables = [t.astype(float) for t in trainer.now.tables]
    trainer.learn(leaves, hashes, counts)
    rows = language_model.features(hashes, counts, leaves // 32)
    for level, (table, now) in enumerate(zip(tables, trainer.now.tables)):
        asked = {}
        for k, leaf in enumerate(leaves.tolist()):
            prior = priors[1][leaf // 32] if level else priors[0]
            own = [int(r[k]) for r in rows[level]]
            logits = [sum(table[r][j] for r in own) + float(prior[j]) for j in range(32)]
            mass = sum(math.exp(z) for z in logits)
            aim = leaf % 32 if level else leaf // 32
            for r in own:
                asked.setdefault(r, [0.0] * 32)
                for j, z in enumerate(logits):
                    asked[r][j] += math.exp(z) / mass - (j == aim)
        for r, g in asked.items():
            for j in range(32):
                table[r][j] -= language_model.RATE * g[j] / math.sqrt(language_model.CAUTION + g[j] ** 2)
        assert np.allclose(table, now, atol=1e-4)
        assert trainer.met[level].sum() == 3 * len(leaves)


def test_language_model_gains_on_held_out_texts(spark):
    found = language_model.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out")
    base, own = found.agg(F.sum("base_score"), F.sum("score")).first()
    assert own > base


def test_pipeline_stages(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, sf_dir).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        assert after.columns[: len(columns)] == columns and 0 < after.count() <= before.count()
        before = after
    assert before.columns[len(columns) :] == ["mix_copies", "mix_target"]
    found = corpus_pipeline.run(spark, sf_dir)
    assert sorted(r.doc_id for r in found.collect()) == sorted(r.doc_id for r in before.collect())


def test_pipeline_stages_on_messy_rows(spark, messy):
    sf_dir = "/root/testdata/sf0.001"
    plain = messy.select(*[F.col(c) for c in ("doc_id", "lang", "source", "n_chars")], F.expr("substring('x', 1, 0)").alias("text"))
    for frame in (plain, empty(plain)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, frame, sf_dir).count()


def family(n, most):
    draw = np.random.default_rng(1)
    bits = np.tile(draw.integers(0, 2, 64 * simhash.WIDE).astype(np.uint8), (n, 1))
    for row in bits:
        row[draw.choice(len(row), draw.integers(1, most + 1), replace=False)] ^= 1
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


@pytest.mark.parametrize("most", [11, 22])
def test_waves_leave_few_links_of_a_family(spark, monkeypatch, most):
    n, links = 1000, []
    rows = [(k, *map(int, row)) for k, row in enumerate(family(n, most).view(np.int64))]
    sets = spark.createDataFrame(rows, "at long, f0 long, f1 long, f2 long, f3 long").checkpoint()
    connect = simhash.components
    monkeypatch.setattr(simhash, "components", lambda found: links.append(found.count()) or connect(found))
    found = simhash.near_groups(sets).collect()
    assert len(found) == n and {r.label for r in found} == {0}
    assert sum(links) < 3 * n and len(links) == 3


def test_tables_keep_the_recall_as_rows_grow():
    assert len(simhash.random_masks()) == len(simhash.random_masks(100_000)) == simhash.tables_for(14)
    masks = np.array(simhash.random_masks(1 << 24), np.int64).view(np.uint64)
    assert {int(n) for n in np.bitwise_count(masks).sum(axis=1)} == {21} and len(masks) == simhash.tables_for(21)


def test_wide_links_equal_brute_force():
    words = np.concatenate([family(250, 30), family(3, 60), np.random.default_rng(4).integers(0, 1 << 63, (40, simhash.WIDE)).astype(np.uint64)])
    fps, keys = words[:, : simhash.SENT], np.repeat(np.arange(3), [230, 43, 20])
    labels = np.arange(len(keys)) // 2 * 2  # every other row carries the label of the one before
    a, b = simhash.wide_links(keys, labels, fps)
    near = lambda x, y: keys[x] == keys[y] and np.bitwise_count(fps[x] ^ fps[y]).sum() <= simhash.WIDE_RADIUS
    expected = brute_roots(range(len(keys)), lambda x, y: labels[x] == labels[y] or near(x, y))
    pairs = set(zip(a.tolist(), b.tolist()))
    found = brute_roots(range(len(keys)), lambda x, y: labels[x] == labels[y] or (labels[x], labels[y]) in pairs or (labels[y], labels[x]) in pairs)
    assert found == expected


def test_tables_name_the_same_links_of_a_family():
    n, links = 1000, set()
    words = family(n, 11)
    for mask in np.array(simhash.random_masks(), np.int64).view(np.uint64):
        _, keys = np.unique(words & mask, axis=0, return_inverse=True)
        order = np.lexsort((np.arange(n), keys.ravel()))
        a, b = simhash.wide_links(keys.ravel()[order], order, words[order][:, : simhash.SENT])
        links |= set(zip(a.tolist(), b.tolist()))
    # one table alone gives nearly one link a row, all 96 together few more
    assert len(links) < 15 * n
