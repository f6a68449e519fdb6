"""Phrases by brute force; notices with changes; no Python in the plan."""

import re

from gustgrid.llm.license_diag import PHRASES, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    "This work is licensed under the GNU General Public License, version 3.\nmit license MIT-License", "cc by cc by, CC BY-NC", "gnu general public licence; gnu general public license",
    None, "", " .,", "mit", "license mit", "gnu gnu general public license license", "é mit license ß", "apache license " * 50, "MIT LICENSE", "mitlicense mit\n\nlicense",
    "Permission is hereby granted, free of charge, to ANY person obtaining one copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "all rights reserved", "redistribution of sources", "word " * 3000 + "mit license", "\x00mit\x01license",
]


def brute(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_columns(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "mit license", ""), (3, "cc by", ""), (3, "cc by", "")]
    got = license_scan(spark.createDataFrame(rows, "doc_id long, text string, n_words string")).collect()
    want = sorted(((i, *brute(t)) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == want
    by_id = {r.doc_id: r for r in got}
    assert by_id[13].labels == "mit" and by_id[13].base_labels == "" and 0.6 <= by_id[13].score < 1
    assert by_id[14].labels == "reserved" and by_id[15].labels == "" and by_id[15].score == 0
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert license_scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_plan_is_native_and_sends_the_templates(spark):
    text = license_scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and not any(x in text for x in ("Python", "Pandas", "Arrow", "ExistingRDD", "SortMergeJoin"))
