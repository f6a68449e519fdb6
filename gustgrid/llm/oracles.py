"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from gustgrid.llm.license_diag import COVER, NEAR, templates
from gustgrid.llm.url_rules import MIN_CONFIDENCE, MIN_LIFT, MIN_ROWS, MIN_SUPPORT, RULES

# Words between white space, after lower-casing A-Z only.
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

OP3 = (r"""
WITH d AS (SELECT doc_id, regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
cut AS (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS a FROM i WHERE len(ws) > 0),
win AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, array_to_string(ws[a:a+12], ' ') AS w, least(13, len(ws)) AS n FROM cut),
lens AS (SELECT DISTINCT n FROM win),
place AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS a FROM d, lens WHERE len(ws) >= n),
hit AS (SELECT p.doc_id, p.a, p.n, win.item FROM place p JOIN win ON win.n = p.n AND win.w = array_to_string(p.ws[p.a:p.a+p.n-1], ' ')),
words AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS x FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)""").replace("{low}", _LOWERED)

OP4 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPLIT.format(text=_LOWERED)} AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 2 THEN [ws]
    ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i:i+1])) END AS s FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
k AS (SELECT doc_id, n, hash(x) AS x FROM g),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM k a JOIN k b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(low.b, s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(low.b, s.doc_id)) AS kept
FROM sets s LEFT JOIN low ON low.a = s.doc_id"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight,
             CAST(source_size AS DOUBLE) * 3e0 AS cap FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
        - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, coalesce(least(cap, weight * (max(CASE WHEN level * weight < cap THEN level END) OVER ())), cap) AS target FROM l),
r AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM d)
SELECT r.doc_id, r.size, t.source_size, t.target,
  CAST(r.size * (CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END
    + CASE WHEN 2 * r.run - r.size < 2 * (t.target - (CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END) * t.source_size)
      THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source"""


def _op1() -> str:
    """All token subsets of the labelled pages, counted one by one."""
    cases, verdicts = "", ""
    for verdict, rule in sorted(RULES, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        fits = f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '/{path}')"
        cases, verdicts = cases + f" WHEN {fits} THEN '{rule}'", verdicts + f" WHEN {fits} THEN '{verdict}'"
    text = r"""
WITH u AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^(.*?)://([^/?#]*)([^?#]*)([?][^#]*)?(#.*)?$', ['scheme', 'host', 'path', 'query', 'fragment']) AS p FROM pages),
parts AS (
  SELECT page_id, translate(p.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, p.path AS path, p.scheme AS scheme, p.query AS query, p.fragment AS fragment FROM u),
tokens AS (
  SELECT page_id, host, path, list_sort(list_distinct(list_concat(
    CASE WHEN host = '' THEN [] ELSE list_concat(['s:' || lower(scheme)], list_transform(string_split(host, '.'), lambda x: 'h:' || x)) END,
    list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'p:' || regexp_replace(x, '[0-9]+', '0', 'g')),
    list_transform(list_filter(string_split(substr(query, 2), '&'), lambda x: x <> ''), lambda x: 'q:' || string_split(x, '=')[1]),
    CASE WHEN fragment = '' THEN [] ELSE ['f:'] END))) AS tokens FROM parts),
y AS (SELECT doc_id, max(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS blocked FROM labels
      WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
l AS (SELECT tokens, blocked FROM tokens JOIN y ON y.doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]+)', 1), '') AS BIGINT) WHERE len(tokens) > 0),
n AS (SELECT count(*) AS total, count(*) FILTER (blocked) AS bad FROM l),
m AS (SELECT tokens, blocked, unnest(range(1, CAST(pow(2, len(tokens)) AS BIGINT))) AS mask FROM l),
sub AS (SELECT list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS a, blocked FROM m),
rules AS (
  SELECT a, count(*) FILTER (blocked) AS support, count(*) FILTER (blocked) / CAST(count(*) AS DOUBLE) AS confidence FROM sub, n GROUP BY a, total
  HAVING count(*) FILTER (blocked) >= ceil(least(1e0, greatest({support}, {rows} / CAST(total AS DOUBLE))) * total)),
shorter AS (SELECT a, unnest(list_transform(a, lambda x: list_filter(a, lambda z: z <> x))) AS part, confidence FROM rules WHERE len(a) > 1),
beaten AS (SELECT DISTINCT s.a FROM shorter s JOIN rules r ON r.a = s.part WHERE r.confidence >= s.confidence),
kept AS (SELECT rules.* FROM rules, n WHERE a NOT IN (SELECT a FROM beaten) AND support >= {rows} AND confidence >= greatest({confidence}, {lift} * bad / total)),
best AS (SELECT page_id, max(confidence) AS confidence FROM tokens JOIN kept ON list_has_all(tokens, a) GROUP BY page_id)
SELECT t.page_id, host, path, CASE{cases} END AS rule,
       coalesce(CASE{verdicts} END, CASE WHEN b.confidence IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, b.confidence
FROM tokens t LEFT JOIN best b USING (page_id)"""
    for name, value in (("support", f"{MIN_SUPPORT}"), ("rows", MIN_ROWS), ("confidence", MIN_CONFIDENCE), ("lift", MIN_LIFT), ("cases", cases), ("verdicts", verdicts)):
        text = text.replace("{" + name + "}", str(value))
    return text


def _op6() -> str:
    rows = ", ".join(f"({t}, '{label}', {n}, {str(phrase).lower()}, {p}, '{gram}')" for t, label, n, phrase, p, gram in templates())
    return (r"""
WITH t(template, label, length, phrase, tpos, gram) AS (VALUES {rows}),
d AS (SELECT doc_id, regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM d),
h AS (SELECT doc_id, t.*, i - 1 - tpos AS diagonal FROM g JOIN t ON t.gram = ws[i] || ' ' || ws[i+1]),
v AS (SELECT doc_id, template, label, length, diagonal, list(DISTINCT tpos) AS tpos, bool_or(phrase) AND count(*) = length - 1 AS base FROM h
      GROUP BY doc_id, template, label, length, diagonal),
w AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {near} THEN 1 ELSE 0 END AS fresh FROM v),
x AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM w),
s AS (SELECT doc_id, template, label, length, span, len(list_distinct(flatten(list(tpos)))) / CAST(length - 1 AS DOUBLE) AS share,
        count(*) FILTER (base) AS n_base, min(diagonal) FILTER (base) AS first, max(diagonal) FILTER (base) AS last FROM x GROUP BY doc_id, template, label, length, span),
r AS (SELECT doc_id, CAST(sum(n_base) AS BIGINT) AS n_base, min(first) AS first_word, max(last) AS last_word,
        array_to_string(list_sort(list(DISTINCT label) FILTER (n_base > 0)), ',') AS base_labels,
        array_to_string(list_sort(list(DISTINCT label) FILTER (n_base > 0 OR share >= {cover})), ',') AS labels,
        max(share) FILTER (share >= {cover}) AS score FROM s GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0e0) AS score
FROM d LEFT JOIN r USING (doc_id)""").replace("{rows}", rows).replace("{low}", _LOWERED).replace("{near}", str(NEAR)).replace("{cover}", str(COVER))


def _op13(k: int = 40, rounds: int = 5) -> str:
    """Exact integer clustering, a materialised step for each round."""
    near = """SELECT vec_id, v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
      SELECT vec_id, n, v, cluster, CAST(list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT) AS d FROM x, {cents}) GROUP BY vec_id, n, v"""
    steps = ""
    for r in range(rounds):
        steps += f""",
a{r} AS MATERIALIZED ({near.replace("{cents}", f"c{r}")}),
c{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m, c) AS c FROM c{r} LEFT JOIN (
    SELECT cluster, list(m ORDER BY i) AS m FROM (
      SELECT cluster, i, CAST((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
      FROM a{r}, range(1, 65) t(i) GROUP BY cluster, i) GROUP BY cluster) USING (cluster))"""
    return f"""
WITH x AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY key, v) - 1 AS INTEGER) AS cluster, v AS c
  FROM (SELECT v, sha256(concat('2:', coalesce(CAST(vec_id AS VARCHAR), ''))) AS key FROM x ORDER BY key, v LIMIT {k})){steps},
f AS MATERIALIZED ({near.replace("{cents}", f"c{rounds}")})
SELECT vec_id, f.cluster, distance, CAST(sum(distance) OVER (PARTITION BY f.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM f JOIN c{rounds} USING (cluster)"""


ORACLES: dict[str, str] = {"op1_association_url_filter": _op1(), "op6_diagonal_license_scan": _op6(), "op3_aho_corasick_decontamination": OP3, "op4_setsketch_near_dedup": OP4, "op10_water_fill_mix": OP10,
                          "op13_centroid_clusters": _op13()}
