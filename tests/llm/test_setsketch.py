"""Near-duplicate components against all pairs, registers against true similarity."""

import random

import numpy as np
import pytest

from gustgrid.llm.setsketch import REGISTERS, components, estimate, near_duplicates, sketches

SCHEMA = "doc_id long, text string, n long, id string, component_id int"


def shingles(text, k):
    low = (text or "").encode()
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in low).split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k):
    sets = [(i, shingles(t, k)) for i, t in rows]
    comp = {i: i for i, _ in rows}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = root(i), root(j)
                comp[max(p, q)] = min(p, q)
    return {(i, len(s), root(i) if s else i) for i, s in sets}


def corpus(seed):
    """Exact and near copies, borderline chains, documents that share a long passage, and tiny texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [" ".join(words(rng.randrange(1, 80))) for _ in range(60)]
    for _ in range(6):
        base = words(rng.randrange(20, 200))
        for _ in range(12):
            near = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 10))):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            texts.append(" ".join(near))
        texts += [" ".join(base), " ".join(base).upper()]
    chain = words(100)
    for step in range(15):
        texts.append(" ".join(chain))
        chain = chain[4:] + words(4)
    passage = words(120)
    texts += [" ".join(passage + words(rng.randrange(20, 60))) for _ in range(40)]
    texts += ["a", "A", "a b", "a b a b", "", " \t ", "b a", "a b a"]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts))


@pytest.mark.parametrize("k,seed", [(2, 1), (5, 2)])
def test_components_equal_all_pairs(spark, k, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA).repartition(5)
    got = near_duplicates(df, words=k).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute(rows, k)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_nulls_repeats_and_empty(spark):
    rows = [(5, "x y z w v u"), (5, "x y z w v u"), (5, "other text of the same id here"), (9, "other text of the same id here"), (None, "x y z w v u"), (3, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, words=2).collect()), key=str)
    assert got == sorted([(5, 5, 5, True), (5, 5, 5, True), (5, 6, 5, True), (9, 6, 5, False), (None, 5, None, True), (3, 0, 3, True), (None, 0, None, True)], key=str)
    assert near_duplicates(df.limit(0)).collect() == []


def test_star_forest(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    comp = {}
    find = lambda x: x if comp.setdefault(x, x) == x else find(comp[x])
    for a, b in edges:
        p, q = find(a), find(b)
        comp[max(p, q)] = min(p, q)
    got = dict((r.node, r.comp) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: find(x) for x in comp if find(x) != x}


def test_estimates_are_near_the_truth_and_registers_merge():
    rng = np.random.default_rng(5)
    for share in (0.2, 0.5, 0.8, 0.95):
        errors = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, 1200, dtype=np.uint64)
            both = int(1000 * share)
            x, y = pool[:1000], np.concatenate([pool[:both], pool[1000 : 1000 + (1000 - both) // 5]])
            truth = both / len(np.union1d(x, y))
            rx, ry, rxy = sketches([np.sort(x), np.sort(y), np.union1d(x, y)])
            assert (np.maximum(rx, ry) == rxy).mean() > 0.999
            errors.append(estimate(rx[None], ry[None], np.array([float(len(x))]), np.array([float(len(y))]))[0] - truth)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 1.6 / REGISTERS**0.5
