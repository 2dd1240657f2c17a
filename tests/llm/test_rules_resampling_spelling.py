"""Operators 11 to 13 against brute force on small tables, with nulls, ties, repeated rows,
empty tables, long texts and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_rules, resampling, spelling

DOCS = "doc_id long, text string"


# --- operator 11 -----------------------------------------------------------------------------

def direct_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(inside)}


def rule_texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    good = [" ".join(word() for _ in range(90)) + "." for _ in range(60)]
    loud = [" ".join(word().upper() + "!!" for _ in range(90)) for _ in range(4)]
    signs = [" ".join(word() + "$$$" for _ in range(90)) for _ in range(4)]
    odd = ["", None, " \n\t ", "a a a a", "x\nx\n x\nx", "é b c\x1cd", "one two three one two three one two", "w " * 50_000]
    return good, loud, signs, odd


def test_rules_counts_equal_brute_force(spark):
    good, loud, signs, odd = rule_texts()
    texts = [*good[:5], *loud, *signs, *odd[:-1], "a b a b a b c"]
    rows = quality_rules.counted(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert {k: r[k] for k in direct_counts("")} == direct_counts(texts[r.doc_id])


def test_rules_reject_every_kind_and_keep_clean_texts(spark):
    good, loud, signs, odd = rule_texts()
    texts = [*good, *loud, *signs, *odd]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], DOCS + ", n_words int")  # a clashing name
    out = {r.doc_id: r for r in quality_rules.judged(docs).collect()}
    assert [out[i].kept for i in range(len(texts))] == [True] * len(good) + [False] * (len(texts) - len(good))
    assert all(out[i].base_failed for i in range(len(good) + 8, len(texts)))
    assert not any(out[i].base_failed for i in range(len(good) + 8))


def test_estimation_recovers_known_accuracies():
    rng = np.random.default_rng(3)
    is_good = rng.random(40_000) < 0.7
    wanted_good, wanted_bad = np.array([.95, .9, .85, .97]), np.array([.8, .7, .9, .6])
    right = rng.random((len(is_good), 4)) < np.where(is_good[:, None], wanted_good, wanted_bad)
    votes = np.where(right == is_good[:, None], 1, -1) * (rng.random(right.shape) < 0.9)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    share = quality_rules.BELIEF_SHARE
    try:
        quality_rules.BELIEF_SHARE = 0.0  # the data alone
        model = quality_rules.estimate(patterns, n.astype(float))
        for _ in range(10):
            quality_rules.ROUNDS += 30
            model = quality_rules.estimate(patterns, n.astype(float))
    finally:
        quality_rules.BELIEF_SHARE, quality_rules.ROUNDS = share, 30
    assert abs(model.prior - 0.7) < 0.03
    assert np.abs(model.on_good - wanted_good).max() < 0.04 and np.abs(model.on_bad - wanted_bad).max() < 0.06


def test_posterior_column_equals_the_model(spark):
    good, loud, signs, odd = rule_texts()
    docs = spark.createDataFrame(list(enumerate([*good, *loud, *signs, *odd[:5]])), DOCS)
    voted = quality_rules.counted(docs).select("*", *quality_rules.votes())
    names = [f"vote_{r[0]}" for r in quality_rules.RULES]
    model = quality_rules.fit(voted)
    rows = voted.withColumn("p", model.posterior_column()).collect()
    assert np.allclose([r.p for r in rows], model.posterior(np.array([[r[n] for n in names] for r in rows])))


def test_rules_empty_table_and_repeated_rows(spark):
    assert quality_rules.judged(spark.createDataFrame([], DOCS)).count() == 0
    text = " ".join(rule_texts()[0][:2])
    rows = quality_rules.judged(spark.createDataFrame([(1, text), (1, text), (None, text)], DOCS)).collect()
    assert len(rows) == 3 and len({r.posterior for r in rows}) == 1 and all(r.kept for r in rows)


# --- operator 12 -----------------------------------------------------------------------------

def direct_features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]  # noqa: B905
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def direct_resampling(docs, target, drawn=25):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(direct_features(text)[1])
    for text in target:
        t.update(direct_features(text)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    rows = []
    for doc_id, text in docs:
        n, buckets = direct_features(text)
        weight = sum(map(gain, buckets)) // len(buckets) if buckets else 0
        h = int(hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), n])
    part = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(part[:25 * len(part) // 100])}
    return sorted((*r[:4], rank.get(r[0])) for r in rows)


def resampling_docs():
    rng = random.Random(9)
    word = lambda: rng.choice(["The", "cat", "naïve", "ÀÉ", "x" * 90, "漢字", "a1", f"W{rng.randrange(50)}"])
    texts = [rng.choice([" ", ", ", "\n"]).join(word() for _ in range(rng.choice([3, 19, 20, 60, 400]))) for _ in range(120)]
    return list(enumerate([*texts, "", None, "!!! ...", "one", "A" * 5000 + " b " * 3000]))


def test_resampling_equals_brute_force(spark, monkeypatch):
    docs, target = resampling_docs(), ["the cat w1 w2 naïve", None, "", "cat " * 50, "x" * 90 + " the"]
    wide = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS + ", score string, bucket int").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    monkeypatch.setattr(resampling, "BLOCK", 2000)  # several blocks, and one text longer than a block
    out = resampling.resampled(wide, goal).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, out.collect())) == direct_resampling(docs, target)


@pytest.mark.parametrize("second", ["b", "é", "x" * 63, "y" * 64, "z" * 65, "q" * 300])
def test_pair_crc_equals_hashing_the_pair(second):
    texts = [f"Some {second} {second}", second, f"{second} tail"]
    got = resampling.features(texts)
    want = [direct_features(t) for t in texts]
    for i, (n, buckets) in enumerate(want):
        assert sorted(got[1][got[0] == i].tolist()) == sorted(buckets) and got[2][i] == n


def test_resampling_empty_tables_and_null_ids(spark):
    none, goal = spark.createDataFrame([], DOCS), spark.createDataFrame([], "text string")
    assert resampling.resampled(none, goal).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(None, text), (None, text), (3, text), (3, text)], DOCS)
    rows = resampling.resampled(docs, goal).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1] and len({r.weight for r in rows}) == 1


# --- operator 13 -----------------------------------------------------------------------------

def direct_words(docs):
    total = Counter()
    for doc_id, text in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            total[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def direct_variants(words):
    near = {w: [v for v in words if v != w and is_near(v, w)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 5 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=str)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def spelling_docs(seed=1):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("aabbé") for _ in range(rng.randrange(6, 10))) for _ in range(40)]
    texts = []
    for i in range(60):
        words = []
        for _ in range(120):
            w = rng.choice(stems[:8] if rng.random() < .7 else stems)
            if rng.random() < .3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abé") + w[at:], w[:at] + rng.choice("abÿ") + w[at + 1:]])
            words.append(w.upper() if rng.random() < .1 else w)
        texts.append(rng.choice([" ", "-", "1"]).join(words))
    return list(enumerate([*texts, "", None, "ß÷× short"]))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_variants_equal_brute_force(spark, seed):
    docs = spelling_docs(seed)
    table = spark.createDataFrame([(i, t, "x") for i, t in docs], DOCS + ", word string").repartition(3)
    want = direct_variants(direct_words(docs))
    got = spelling.variants(table).select(*COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(r[1] for r in want)


def test_variants_of_runs_chains_and_long_words(spark):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(5 ** (i + 1)))
    long = "é" * 3000
    docs = [(1, text), (1, ""), (None, f"{long} " * 5 + f"{long}é " * 25 + "aaaaaaa " * 5), (7, None)]
    got = spelling.variants(spark.createDataFrame(docs, DOCS)).select(*COLUMNS)
    want = direct_variants(direct_words(docs))
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert {r[2] for r in want if r[0] in chain} == {chain[-1]} and long in {r[0] for r in want}


def test_node_numbers_tell_prefixes_apart(spark):
    words = sorted({"".join(w) for n in (1, 2, 3, 5) for w in zip(*[iter(random.Random(4).choices("abc", k=3000))] * n)} | {"é" * 40})  # noqa: B905
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    rows = spelling.numbered(table.repartition(7), "word").collect()
    seen = {}
    for r in rows:
        assert len(r.nodes) == len(r.word) + 1
        for d, node in enumerate(r.nodes):
            assert seen.setdefault(r.word[:d], node) == node
    assert len(set(seen.values())) == len(seen)
    assert [r.word for r in sorted(rows, key=lambda r: r.id)] == words


def test_variants_empty_and_repeated_rows(spark):
    assert spelling.variants(spark.createDataFrame([], DOCS)).count() == 0
    row = (4, "wonder wonder wander")
    got = spelling.variants(spark.createDataFrame([row] * 5, DOCS)).select(*COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == direct_variants(direct_words([row] * 5))
    assert got.where(F.col("word") == "wonder").first().n == 10
