"""URL filters by association rules, with DataFrame functions and Spark's FP-growth only.

A URL is a set of tokens (scheme, host labels, path parts with digits folded, query keys, fragment).
FP-growth finds the frequent token sets of the labelled URLs, with the label as one more token. A set
with the label over the same set without it is a rule; rules stay if enough rows carry them, if
their confidence is high and above the overall share, and if no rule with one token less is as
confident. Rules are matched by an inverted index: each is filed under its rarest token, pages meet
it through that token alone and are then tested for the others.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, functions as F

from gustgrid.llm.common import LOWER, UPPER
from gustgrid.session import stage

LABEL = "@block"
MIN_SUPPORT, MIN_ROWS, MIN_CONFIDENCE, MIN_LIFT = 0.004, 5, 0.5, 1.2

# Verdict, and host and path start.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def split_url(url: str) -> dict[str, str]:
    """SQL of host, path and the rest of a url column; null or without :// gives empty strings."""
    part = "regexp_extract(coalesce({u}, ''), '(?s)^(.*?)://([^/?#]*)([^?#]*)([?][^#]*)?(#.*)?$', {k})"
    return {name: part.format(u=url, k=k) for k, name in ((1, "scheme"), (3, "path"), (4, "query"), (5, "fragment"))} | {
        "host": f"translate({part.format(u=url, k=2)}, '{UPPER}', '{LOWER}')"}


TOKENS = (
    "array_sort(array_distinct(concat("
    "CASE WHEN host = '' THEN array() ELSE concat(array(concat('s:', lower(scheme))), transform(split(host, '[.]'), x -> concat('h:', x))) END, "
    "transform(filter(split(path, '/'), x -> x <> ''), x -> concat('p:', regexp_replace(x, '[0-9]+', '0'))), "
    "transform(filter(split(substr(query, 2), '&'), x -> x <> ''), x -> concat('q:', split(x, '=')[0])), "
    "CASE WHEN fragment = '' THEN array() ELSE array('f:') END)))"
)


def url_parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col, url, host, path, tokens``."""
    parts = split_url(f"`{url_col}`")
    return pages.selectExpr(f"`{id_col}` AS {id_col}", f"`{url_col}` AS url", *(f"{sql} AS {name}" for name, sql in parts.items())).selectExpr(
        id_col, "url", "host", "path", f"{TOKENS} AS tokens")


def mine_rules(labelled: DataFrame) -> DataFrame:
    """(antecedent, token, support, confidence) of rows (tokens, blocked boolean).

    ``token`` is the antecedent's rarest one. No labelled row, or none blocked, gives no rule.
    """
    labelled = stage(labelled.filter("blocked IS NOT NULL AND size(tokens) > 0"), "labelled-urls")
    total, blocked = labelled.agg(F.count(F.lit(1)), F.count(F.when(F.col("blocked"), 1))).first()
    none = labelled.sparkSession.sql("SELECT CAST(NULL AS ARRAY<STRING>) AS antecedent, '' AS token, 0L AS support, 0D AS confidence WHERE false")
    if not blocked:
        return none
    items = labelled.selectExpr(f"CASE WHEN blocked THEN concat(tokens, array('{LABEL}')) ELSE tokens END AS items")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(MIN_SUPPORT, MIN_ROWS / total))).fit(items)
    sets = stage(model.freqItemsets.selectExpr("array_sort(items) AS items", "freq"), "token-sets")
    plain = sets.filter(f"NOT array_contains(items, '{LABEL}')").selectExpr("items AS antecedent", "freq AS rows")
    rules = sets.filter(f"array_contains(items, '{LABEL}') AND size(items) > 1").selectExpr(f"array_remove(items, '{LABEL}') AS antecedent", "freq AS support")
    rules = rules.join(plain, "antecedent").selectExpr("antecedent", "support", "support / CAST(rows AS DOUBLE) AS confidence")
    shorter = rules.selectExpr("antecedent AS part", "confidence AS known")
    beaten = rules.filter("size(antecedent) > 1").selectExpr("antecedent", "confidence", "explode(antecedent) AS x").selectExpr(
        "antecedent", "confidence", "array_remove(antecedent, x) AS part").join(shorter, "part").filter("known >= confidence").select("antecedent").distinct()
    # Where most rows are blocked, halfway from their share to 1, so that a rule of full confidence always passes.
    share = blocked / total
    least = max(MIN_CONFIDENCE, min(MIN_LIFT * share, (1 + share) / 2))
    kept = rules.filter(f"support >= {MIN_ROWS} AND confidence >= {least!r}D").join(beaten, "antecedent", "left_anti")
    rare = plain.filter("size(antecedent) = 1").selectExpr("antecedent[0] AS token", "rows")
    filed = kept.selectExpr("*", "explode(antecedent) AS token").join(rare, "token").groupBy("antecedent", "support", "confidence").agg(
        F.min(F.struct("rows", "token")).alias("r"))
    return stage(filed.selectExpr("antecedent", "r.token AS token", "support", "confidence"), "url-rules")


def list_rule(rules: list[tuple[str, str]] = RULES) -> tuple[str, str]:
    """SQL of the longest listed rule that fits host and path, and of its verdict."""
    cases, verdicts = "", ""
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        fits = f"(host = '{host}' OR endswith(host, '.{host}')) AND startswith(path, '/{path}')"
        cases, verdicts = cases + f" WHEN {fits} THEN '{rule}'", verdicts + f" WHEN {fits} THEN '{verdict}'"
    return f"CASE{cases} END", f"CASE{verdicts} END"


def judge_urls(parts: DataFrame, rules: DataFrame, id_col: str = "page_id") -> DataFrame:
    """One row per page row: ``id_col, host, path, rule, verdict, confidence``.

    ``confidence`` is that of the best mined rule (null without one); listed rules come first, then a
    mined rule blocks, else the page is allowed. Null urls have no tokens and are allowed.
    """
    rows = parts.withColumn("_row", F.monotonically_increasing_id())
    met = rows.selectExpr("_row", "tokens", "explode(tokens) AS token").join(rules, "token").filter("size(array_except(antecedent, tokens)) = 0")
    best = met.groupBy("_row").agg(F.max("confidence").alias("confidence"))
    rule, verdict = list_rule()
    return rows.join(best, "_row", "left").selectExpr(
        id_col, "host", "path", f"{rule} AS rule", f"coalesce({verdict}, CASE WHEN confidence IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict", "confidence")
