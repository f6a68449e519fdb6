"""Spelling variants against comparing all pairs in Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from gustgrid.llm.queries import QUERIES
from gustgrid.llm.trie_variants import count_words, lowered_runs, near_pairs, slipped, spelling_variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    deletions, near_of = {}, {w: set() for w in counts}
    for w in counts:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            deletions.setdefault(key, []).append(w)
    for group in deletions.values():
        for a in group:
            near_of[a].update(b for b in group if b not in near_of[a] and near(a, b))
    forms = {}
    for w, others in near_of.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, counts[w], len(near_of[w]), counts[forms[w]] if forms[w] else None))
    return sorted(out)


def variants(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    return sorted(tuple(r) for r in spelling_variants(df, **options).collect())


@pytest.mark.parametrize("depth", [32, 5])
def test_all_short_words(spark, depth):
    """Dense words over few letters with runs; with a depth of 5 the longer ones meet by deletions."""
    rng = random.Random(depth)
    words = {"".join(rng.choice("aabé") for _ in range(rng.randrange(1, 9))) for _ in range(700)} | {"a" * k for k in range(1, 12)}
    counts = {w: rng.choice([1, 2, 5, 30, 400, 5000, 60000]) for w in words}
    assert variants(spark, counts, depth=depth) == brute(counts)


def test_pairs_come_once(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(2, 7))) for _ in range(400)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    for depth in (32, 4):
        got = [tuple(sorted(r)) for r in near_pairs(df, depth).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if near(a, b)}


def test_long_words_and_chains(spark):
    long = "abcdefghij" * 4000
    chain = {"chained": 10, "chainer": 100, "chainers": 1000, "chaiers": 10_000, "haiers": 100_000, "haierz": 1_000_000}
    counts = {long: 50, long[:20_000] + "z" + long[20_001:]: 2, long[:-1]: 3, long + "j": 700, "x" * 33: 5, "x" * 32: 60, "x" * 34: 1, "y" * 32: 1, "y" * 31 + "x": 11, **chain}
    assert variants(spark, counts) == brute(counts)


def test_empty_null_and_repeated_words(spark):
    df = spark.createDataFrame([("word", 2), (None, 9), ("", 5), ("word", 3), ("wort", 50)], "word string, n long")
    assert sorted(tuple(r) for r in spelling_variants(df).collect()) == [("word", "wort", "wort", 5, 1, 50), ("wort", None, "wort", 50, 1, None)]
    none = spelling_variants(df.filter("false"))
    assert none.collect() == [] and none.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    with pytest.raises(ValueError):
        spelling_variants(df, ratio=1)


def counted(rows):
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_counts(spark):
    rng = random.Random(6)
    rows = [(i % 50, " ".join(rng.choice(["Schreibung", "ÉCOLES", "écoles", "Straße", "variants", "varıants", "short", "x" * 30, "a×b÷cdefg", "naïveté"]) + "-" for _ in range(40))) for i in range(200)]
    rows += [(None, "variants variants"), (3, None), (4, ""), (5, "letters" * 30000), (5, "letters" * 30000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    runs = lowered_runs(df, "doc_id", "text", "A-Za-z\\u00C0-\\u00FF", 7)
    assert {r.word: r.n for r in count_words(slipped(runs, 31), 7, 2).collect()} == counted(rows)


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op11_trie_spelling_variants"](spark, "/root/testdata/sf0.001").collect())
    assert got == brute(counted([(r.doc_id, r.text) for r in docs]))
    assert any(r[1] for r in got)
