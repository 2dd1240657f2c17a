"""Exact and near deduplication against brute force on small fixtures."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, near_dedup

SCHEMA = "doc_id long, text string, fp string, sha string, component string, digest string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "x", "y", "z", "w") for i, t in rows], SCHEMA)


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out, held = [], ""
    for c in lowered + " ":
        if c in " \t\n\r\x0b\x0c":
            if held:
                out.append(held)
            held = ""
        else:
            held += c
    return out


def shingles(text):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if len(w) >= 5 else {tuple(w)}


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_exact_matches_brute_force(spark):
    rng = random.Random(3)
    texts = ["", None, "a", "A", "a ", "x" * 100_000, "x" * 99_999 + "y", "ünï", "tie"]
    rows = [(i, rng.choice(texts)) for i in range(300)] + [(1000, "only"), (None, "a"), (None, None)]
    by_text = defaultdict(list)
    for i, t in rows:
        by_text[t or ""].append(i)
    out = exact_dedup.classes(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    want = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in by_text.items()}
    for r in out:
        ids = want[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max(i for i in ids if i is not None)
        assert r.kept == (r.doc_id == r.keep_id)


def test_exact_repeated_rows_keep_exactly_one(spark):
    rows = [(7, "t")] * 5 + [(3, "t"), (8, "u"), (None, "v"), (None, "v")]
    out = exact_dedup.classes(frame(spark, rows)).collect()
    kept = defaultdict(int)
    for r in out:
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}
    left = exact_dedup.keep_latest(frame(spark, rows))
    assert left.columns == frame(spark, []).columns
    assert sorted((r.doc_id or -1, r.text) for r in left.collect()) == [(-1, "v"), (7, "t"), (8, "u")]


def test_exact_empty_table(spark):
    assert exact_dedup.classes(frame(spark, [])).collect() == []
    assert exact_dedup.keep_latest(frame(spark, [])).collect() == []


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2 ** 64, 5000, np.uint64)
    fps = np.concatenate([fps, fps[:700], fps[:90]])
    parts = np.array_split(rng.permutation(fps), 7)
    blocks = defaultdict(list)
    for part in parts:
        keys, counts = np.unique(part, return_counts=True)
        for block, remainders, n in exact_dedup.build_filter(keys, counts, 4):
            assert (np.diff(remainders.astype(object)) > 0).all()
            blocks[block].append((remainders, n))
    got = {}
    for block, runs in blocks.items():
        remainders, counts = exact_dedup.merge_runs(runs)
        for r, n in zip(remainders, counts, strict=True):
            got[(block << 60) | int(r)] = int(n)
    keys, counts = np.unique(fps, return_counts=True)
    assert got == {int(k): int(n) for k, n in zip(keys, counts, strict=True)}


def test_equal_fingerprints_of_different_texts_are_told_apart(spark, monkeypatch):
    """With a fingerprint that always collides, only the bytes decide."""
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(5).cast("long"))
    out = {r.doc_id: r for r in exact_dedup.classes(frame(spark, [(1, "a"), (2, "b"), (3, "a"), (4, "c")])).collect()}
    assert [out[i].keep_id for i in (1, 2, 3, 4)] == [3, 2, 3, 4]
    assert [out[i].group_size for i in (1, 2, 3, 4)] == [2, 1, 2, 1]


def _mutated(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 9)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for size in (5, 6, 8, 12, 30, 60, 120, 300):
        base = [rng.choice(vocabulary) for _ in range(size)]
        rows += [(n, " ".join(base)), (n + 1, " ".join(base).upper())]
        n += 2
        for _ in range(6):
            rows.append((n, _mutated(rng, base, rng.randrange(1, max(2, size // 12)))))
            n += 1
        chain = base  # a chain whose ends are far apart
        for _ in range(4):
            chain = _mutated(rng, chain, max(1, size // 40)).split()
            rows.append((n, " ".join(chain)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "a b"), (n + 4, "A  b"), (n + 5, "É é"), (n + 6, "é é")]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_near_defined_cases(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (5, text), (9, text), (None, text), (None, None), (2, "")]
    out = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in out) == sorted([
        (5, 36, 5, True), (5, 36, 5, True), (9, 36, 5, False), (-1, 36, -1, True), (-1, 0, -1, True), (2, 0, 2, True)])
    assert near_dedup.near_duplicates(frame(spark, [])).collect() == []
    left = near_dedup.keep_one(frame(spark, rows))
    assert left.columns == frame(spark, []).columns and left.count() == 5


def test_near_repeated_ids_have_the_shingles_of_all_their_texts(spark):
    """As the SQL says; ids next to them keep their links, whichever digest is the smaller one."""
    rng = random.Random(8)
    rows, want = [], {}
    for i in range(0, 100, 10):
        a, b, c = ([f"{i}{x}{rng.randrange(10 ** 6)}" for _ in range(60)] for x in "abc")
        near = [*a[:-1], "other"]
        rows += [(i + 1, " ".join(a)), (i + 1, " ".join(b)), (i + 5, " ".join(a)), (i + 9, " ".join(near))]
        rows += [(i + 2, " ".join(c[:40])), (i + 2, " ".join(c[20:])), (i + 2, None), (i + 4, " ".join(c))]
        want |= {i + 1: (112, i + 1), i + 5: (56, i + 5), i + 9: (56, i + 5), i + 2: (56, i + 2), i + 4: (56, i + 2)}
    out = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in out)


def test_large_group_needs_few_comparisons(spark):
    """A band key shared by all is not compared pair by pair, and no component is lost."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, _mutated(rng, base, 2)) for i in range(300)]
    out = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert {r.component_id for r in out} == {0}


def test_registers_and_estimate():
    rng = np.random.default_rng(4)
    for n in (1, 5, 40, 3000):
        s = np.unique(rng.integers(0, 2 ** 64, n, np.uint64))
        regs = near_dedup.registers(s)
        for bucket in range(near_dedup.BUCKETS):
            own = [int(x) for x in s if int(x) >> (64 - near_dedup._BITS) == bucket]
            if own:
                bits = format((min(own) << near_dedup._BITS) & (2 ** 64 - 1), "064b")
                zeros = min(63, len(bits) - len(bits.lstrip("0")))
                mantissa = int((bits[zeros + 1:] + "0" * 64)[:near_dedup.MANTISSA], 2)
                assert regs[bucket] == (zeros << near_dedup.MANTISSA) | mantissa
    for size in (40, 150, 4000):  # estimates are close to the true similarity for small and large sets
        errors = []
        for _ in range(60):
            base = np.unique(rng.integers(0, 2 ** 64, size, np.uint64))
            other = np.unique(np.concatenate([base[rng.random(len(base)) < 0.85], rng.integers(0, 2 ** 64, size // 8, np.uint64)]))
            true = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
            estimate, witnesses = near_dedup.estimated_jaccard(near_dedup.registers(base)[None], near_dedup.registers(other)[None])
            room = 0.75 - near_dedup.estimate_floor(len(base), len(other), witnesses)[0]
            errors.append(abs(estimate[0] - true) / room)
        assert max(errors) < 1 and np.mean(errors) < 0.35


def test_components_with_a_node_of_a_third_of_all_edges(spark):
    """A hub, repeated edges, a path through hubs, and random edges against a union-find."""
    rng = random.Random(5)
    edges = [(7, i) for i in range(1000, 3000)] + [(i, 7) for i in range(1000, 1500)]
    edges += [(5, 2999), (6, 6)] + [(i, i + 1) for i in range(5000, 5040)]
    edges += [(rng.randint(10_000, 14_000), rng.randint(10_000, 14_000)) for _ in range(3000)]
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            top[b] = a
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in near_dedup.components(df).collect()}
    assert got == {x: root(x) for x in list(top)}
    hub = df.where("a = 7").select(F.col("a").alias("u"), F.col("b").alias("v"))
    parts = hub.groupBy("u", F.pmod(F.xxhash64("v"), F.lit(near_dedup.SPREAD))).count().agg(F.max("count")).first()[0]
    assert parts < 2000 / near_dedup.SPREAD * 2
    assert {tuple(r) for r in near_dedup._to_least(hub).select("u", "v", "m").collect()} == {(7, i, 7) for i in range(1000, 3000)}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 140)] + [(200, 201)]
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {j: 100 for j in range(100, 140)} | {200: 200, 201: 200}
