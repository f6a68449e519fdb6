"""Mined rules against all token subsets; url parts; listed rules."""

from collections import Counter
from itertools import combinations

from gustgrid.llm.url_rules import MIN_CONFIDENCE, MIN_LIFT, MIN_ROWS, MIN_SUPPORT, judge_urls, mine_rules, url_parts

URLS = ["https://WWW.Bad.example.com/en/12?utm=1#x", "http://good.example.org/en/3", "no scheme", None, "ftp://h", "https://a.b/c?d://e", "x://?q", "https://example.org/es/1",
        "https://sub.example.org/en/17", "https://notexample.org/es/9", "https://x.com/de/4", "https://x.com/fr/", "https://com/fr/1", "https://é.org/"]


def test_parts_and_listed_rules(spark):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    none = mine_rules(spark.createDataFrame([], "tokens array<string>, blocked boolean"))
    got = {r.page_id: r for r in judge_urls(url_parts(df), none).collect()}
    assert [got[i].host for i in range(7)] == ["www.bad.example.com", "good.example.org", "", "", "h", "a.b", ""]
    assert [got[i].path for i in range(7)] == ["/en/12", "/en/3", "", "", "", "/c", ""]
    assert [got[i].rule for i in range(7, 14)] == ["example.org/es/", "example.org/en/1", "org/", "com/de/", "com/fr/", "com/fr/", "org/"]
    assert [got[i].verdict for i in (0, 3, 7, 8, 9, 10, 11)] == ["allow", "allow", "block", "block", "allow", "block", "allow"]


def test_rules_equal_all_subsets(spark):
    rows = []
    for i in range(120):
        tokens = ["s:https", f"h:{'abcd'[i % 4]}", f"p:{'xyz'[i % 3]}"] + (["q:utm"] if i % 5 == 0 else [])
        rows.append((sorted(tokens), (i % 4 == 0 and i % 3 != 1) or i % 5 == 0 and i % 3 == 2))
    total, bad = len(rows), sum(b for _, b in rows)
    every, blocked = Counter(), Counter()
    for tokens, b in rows:
        for k in range(1, len(tokens) + 1):
            for c in combinations(tokens, k):
                every[c] += 1
                blocked[c] += b
    rules = {c: blocked[c] / every[c] for c in every if blocked[c] >= max(MIN_ROWS, MIN_SUPPORT * total)}
    want = {c: v for c, v in rules.items() if v >= max(MIN_CONFIDENCE, MIN_LIFT * bad / total)
            and not any(tuple(t for t in c if t != x) in rules and rules[tuple(t for t in c if t != x)] >= v for x in c)}
    mined = mine_rules(spark.createDataFrame(rows, "tokens array<string>, blocked boolean"))
    assert {tuple(r.antecedent): r.confidence for r in mined.collect()} == want and want
    pages = spark.createDataFrame([(i, "u", "", "", t) for i, (t, _) in enumerate(rows)] + [(900, "u", "", "", [])], "page_id long, url string, host string, path string, tokens array<string>")
    got = {r.page_id: r for r in judge_urls(pages, mined).collect()}
    for i, (tokens, _) in enumerate(rows):
        hits = [v for c, v in want.items() if set(c) <= set(tokens)]
        assert got[i].verdict == ("block" if hits else "allow") and got[i].confidence == (max(hits) if hits else None)
    assert got[900].verdict == "allow"


def test_rules_where_most_pages_are_blocked(spark):
    rows = [(["h:bad"], True)] * 90 + [(["h:good"], False)] * 5 + [(["h:good"], True)] * 5
    mined = mine_rules(spark.createDataFrame(rows, "tokens array<string>, blocked boolean")).collect()
    assert [(r.antecedent, r.confidence) for r in mined] == [(["h:bad"], 1.0)]
    every = mine_rules(spark.createDataFrame(rows[:90], "tokens array<string>, blocked boolean")).collect()
    assert [(r.antecedent, r.confidence) for r in every] == [(["h:bad"], 1.0)]


def test_no_python_in_the_plan(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = judge_urls(url_parts(pages), mine_rules(spark.createDataFrame([(["a"], True)] * 9, "tokens array<string>, blocked boolean")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))
