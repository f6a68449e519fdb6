"""Document counts by brute force, robust estimates by numpy, scores on held-out labels."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gustgrid.llm.common import STEP_BYTES, steps
from gustgrid.llm.doc_stats import counts
from gustgrid.llm.mcd_rules import CONSISTENCY, CUTOFF, FLOOR, KEPT_SHARE, P, STEPS, VECTOR, chi2_quantile, chi2_share, quality_rules, robust_estimates
from gustgrid.llm.queries import QUERIES
from gustgrid.llm.rff_quality import fit, pool_adjacent, quality_scores

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["a b c a b c", "x\nx\n\n x\nx \n y y", None, "", " \n ", "é ß é ß é ß #$|", "one", "w " * 500, "a\tb\x0bc\x0cd\re f g", "\n\n\n", "日本 語\n日本 語\n日本 語", "<>&%*"]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_brute_force(spark):
    given = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    c = counts(pa.array(TEXTS + given))
    got = list(zip(*(c[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert got == [brute(t) for t in TEXTS + given]
    assert counts(pa.array(TEXTS)[3:5])["n_words"].tolist() == [0, 0]


def test_steps_hold_whole_texts():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * STEP_BYTES, None, "b", "c" * (2 * STEP_BYTES), ""]})
    parts = list(steps(batch, "text"))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist() and len(parts) > 1


def test_chi_square():
    assert chi2_quantile(0.95, 4) == pytest.approx(9.4877, abs=1e-3) and chi2_share(4.3515, 5) == pytest.approx(0.5, abs=1e-4)


def test_robust_estimates_follow_the_same_steps_in_numpy(spark):
    rng = np.random.default_rng(2)
    good = rng.normal([5, 0.5, 0.1, 0.2], [0.6, 0.4, 0.1, 0.1], (900, P))
    rows = np.concatenate([good, rng.normal([9, 6, 0.9, 0.9], 0.1, (300, P))])
    df = spark.createDataFrame([("all", *map(float, r)) for r in rows], "g string, " + ", ".join(f"{x} double" for x in VECTOR))
    got = robust_estimates(df).first()
    pick = lambda v, q: np.sort(v)[int(np.ceil(q * len(v))) - 1]
    mean = np.array([pick(rows[:, k], 0.5) for k in range(P)])
    inverse = np.diag(1 / ((1.4826 * np.array([pick(abs(rows[:, k] - mean[k]), 0.5) for k in range(P)])) ** 2 + np.square(FLOOR)))
    for _ in range(STEPS):
        d = np.einsum("ni,ij,nj->n", rows - mean, inverse, rows - mean)
        near = rows[d <= pick(d, KEPT_SHARE)]
        mean, inverse = near.mean(0), np.linalg.inv(np.cov(near.T, bias=True) * CONSISTENCY + np.diag(np.square(FLOOR)))
    assert np.allclose(got.mean, mean, atol=2e-2) and np.allclose(got.inverse, inverse.reshape(-1), rtol=5e-2, atol=0.1)
    d = np.einsum("ni,ij,nj->n", rows - mean, inverse, rows - mean)
    assert (d[:900] <= CUTOFF).all() and (d[900:] > CUTOFF).all()


def test_rules_on_odd_rows_and_planted_noise(spark):
    clean = [" ".join(f"{w}{(i * 7 + k * 3) % 97}" for k in range(60) for w in ("some", "word")) for i in range(80)]
    noise = [" ".join(f"$$$%%%w{i}x{k}" for k in range(90)) for i in range(12)]
    rows = [(i, t, "en", "a", "x") for i, t in enumerate(clean)] + [(100 + i, t, "en", "a", "x") for i, t in enumerate(noise)]
    rows += [(200, None, None, None, "x"), (200, "", "en", None, "x"), (None, clean[0], None, "b", "x"), (201, clean[1], "de", None, "x")]
    got = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words string")).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[i][0].kept for i in range(80)) and not any(by[100 + i][0].kept for i in range(12))
    assert all(r.base_failed and not r.kept for r in by[200]) and by[None][0].kept and by[201][0].kept
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).collect() == []


def test_repeats_alone_are_rejected(spark):
    def words(i, n):
        return [f"{'some' if k % 2 else 'word'}{(i * 7 + k * 3) % 97}x{k}" for k in range(n)]

    def lines(i, n, repeated):
        own = [" ".join(words(i, 240)[k * 12 : k * 12 + 12]) for k in range(n)]
        return "\n".join([*own, *own[:1] * repeated])

    clean = [lines(i, 20, i % 8 == 0) for i in range(80)]
    # A third and two thirds of the lines repeat one; two fifths of the words stand in repeated windows.
    repeated = [lines(i, 12, 6) for i in range(6)] + [" ".join(w := words(i, 80)) + " " + " ".join(w[:20]) for i in range(6)]
    short = ["\n".join([" ".join(words(i, 200)), *["ok"] * 9]) for i in range(6)]
    docs = clean + repeated + short
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(docs)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert all(got[i].kept for i in range(80)) and not any(got[i].kept for i in range(80, len(docs)))


def test_isotonic_blocks():
    x, v = pool_adjacent(np.array([0.0, 1, 2, 3, 4]), np.array([1.0, 0, 2, 1, 3]), np.array([2.0, 2, 2, 2, 3]))
    assert np.allclose(v, [0.25, 0.75, 1.0]) and (np.diff(x) > 0).all()


def test_scores_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op8_random_fourier_quality"](spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in got.items())
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert np.mean([got[i].predicted == q for i, q in labels]) >= 0.95
    # The labels of held-out rows change nothing.
    docs, given = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    flipped = given.selectExpr("doc_id", "CASE WHEN pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 5) = 0 THEN 1 - quality ELSE quality END AS quality")
    again = {r.doc_id: r.score for r in quality_scores(docs, flipped).collect()}
    assert max(abs(again[i] - r.score) for i, r in got.items()) < 1e-4


def test_scores_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "c"), (1, "", "c"), (None, "text", "c"), (2, "a b", "c")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 1)], "doc_id long, quality int")
    assert len(quality_scores(docs, labels).collect()) == 4
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(docs.limit(0), labels).collect() == [] and fit(spark.createDataFrame([], "y double, fold long, " + ", ".join(f"{s} double" for s in [
        "log_words", "word_len", "symbols", "upper", "digits", "punct", "stops", "distinct", "top_word", "repeats", "dup_lines", "line_len"]))).values.tolist() == [0.5]
