"""The whole pipeline against a chain of brute-force stages."""

import hashlib
import math
import re

import corpus_pipeline
from gustgrid.llm.rff_quality import quality_scores
from gustgrid.llm.stages import drop_near_duplicates, mix_sources, tokenize
from tests.llm.test_decontam import brute as windows_hit
from tests.llm.test_setsketch import brute as near_components
from tests.llm.test_token_dac import library_rows
from tests.llm.test_water_fill import looped

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mixed(rows):
    """(doc_id, copies) by the clamp-and-share loop and one running sum over the hash order of each source."""
    size = {r.doc_id: len(WORD.findall(r.text)) for r in rows}
    sources = sorted({r.source for r in rows})
    total = {s: sum(size[r.doc_id] for r in rows if r.source == s) for s in sources}
    target = looped(total, {s: i % 3 + 1 for i, s in enumerate(sources)}, 3.0)
    copies = {}
    for s in sources:
        whole, run = math.floor(target[s] / total[s]), 0
        for r in sorted((r for r in rows if r.source == s), key=lambda r: (hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest(), r.doc_id)):
            run += size[r.doc_id]
            copies[r.doc_id] = whole + (2 * run - size[r.doc_id] < 2 * (target[s] - whole * total[s]))
    return copies


def test_run_equals_the_chain(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = {r.doc_id for r in quality_scores(docs, labels).collect() if r.predicted == 1}
    rows = [r for r in docs.collect() if r.doc_id in good]
    unique = {i for i, _, comp in near_components([(r.doc_id, r.text) for r in rows], 5) if comp == i}
    rows = [r for r in rows if r.doc_id in unique]
    dirty = {i for i, n, hit, _ in windows_hit([(r.doc_id, r.text) for r in rows], items) if hit and 20 * hit >= n}
    rows = [r for r in rows if r.doc_id not in dirty]
    copies = mixed(rows)
    order = [(r.doc_id, r.text) for r in sorted(rows, key=lambda r: r.doc_id) for _ in range(copies[r.doc_id])]
    want, _ = library_rows(order)
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and len({r[0] for r in got}) < docs.count() and dirty


def test_stage_columns_and_names(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "source_mix", "token_output"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0, name
    assert tokenize(spark, docs, SF).count() == 0


def test_repeated_rows_and_ids(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text, "a"), (1, text, "a"), (2, text, "a"), (3, "zz yy xx ww vv uu", "b"), (3, "other words of the third id", "b"), (None, text, "c"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = drop_near_duplicates(spark, df, SF).collect()
    # Both texts of id 3 stay, as they differ; the text without an id is a copy of id 1.
    assert sorted(map(str, (r.doc_id for r in kept))) == ["1", "3", "3", "None"]
    mixed_rows = mix_sources(spark, df, SF)
    assert mixed_rows.columns == df.columns and set(map(str, mixed_rows.distinct().collect())) <= set(map(str, df.collect()))


def test_rows_of_one_id_are_judged_by_their_text(spark):
    a, b = "alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine"
    df = spark.createDataFrame([(5, a, "x"), (5, b, "x"), (2, b, "y"), (None, a, "z"), (None, "only here, and nowhere else at all", "z")], "doc_id long, text string, source string")
    kept = sorted(((r.doc_id, r.text) for r in drop_near_duplicates(spark, df, SF).collect()), key=str)
    assert kept == sorted([(2, b), (5, a), (None, "only here, and nowhere else at all")], key=str)


def test_columns_with_the_names_of_helpers(spark):
    """Every name that a stage uses inside may be a column of the documents, and keeps its values."""
    names = ["_rows", "_score", "_s", "_key", "_bucket", "_before", "_run", "_copy", "_copies", "_size", "_items", "_spans", "_n_hit", "_row", "_text", "_first", "_extra", "kept", "id", "n", "a.b"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    wide = docs.selectExpr("*", *(f"concat('{n}-', doc_id) AS `{n}`" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert rows and all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in names), name
