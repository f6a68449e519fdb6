"""Spelling variants of a vocabulary by a trie frontier.

Two words are near if they differ by one inserted, deleted or replaced code point. The trie of all words
is a distributed table with one row for each edge, and a frontier of (word, position, node, edits)
states meets it level by level in an equi-join on the node: without an edit a state follows its own
letters and spawns states with one edit; with an edit it only follows the rest of its word; where the
rest ends on a terminal node, word and node are near.

* The trie is built forwards and backwards. An edit in a word's second half is found forwards, one in its
  first half backwards, so states start deep in the trie, where nodes have few children, and the
  root is never joined. A state without edits ends where its subtree holds no other word.
* A replacement is found from the word with the smaller letter, a length change from the longer word
  (the last letter of a run is the one deleted), so each pair is found once.
* An edge knows the number of words behind it, that word if it is the only one (then the rest is compared
  at once), and bit sets of the lengths and next letters behind it, which end hopeless states early.
* Words longer than ``depth`` would only make the loop long. Their pairs share a word with one letter
  deleted: each letter gives one hashed row, hashes meet in an equi-join and texts are compared.

Each level is written to the shared folder. Nothing but the longest length and the largest count
reaches the driver; per-word results are counts and minima, so no list of neighbours is ever gathered.

Defined cases: null words are left out; repeated words count together; a word without near words has
``n_near`` 0, no form and itself as root; an empty vocabulary gives no rows; further columns are dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from gustgrid.llm.common import LOWER, UPPER
from gustgrid.session import stage

# Code points of the longest words in the trie.
DEPTH = 32


def lowered_runs(docs: DataFrame, id_col: str, text_col: str, letters: str, least: int) -> DataFrame:
    """(id, run): every maximal run of ``letters`` with ``least`` code points or more, A-Z lower-cased."""
    run = F.col("run")
    found = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{letters}]{{{least},}}"), F.lit(0))).alias("run"))
    return found.select("id", F.when(F.lower(run) == run, run).otherwise(F.translate(run, UPPER, LOWER)).alias("run"))


def slipped(runs: DataFrame, every: int) -> DataFrame:
    """(word): each run, less one code point where the crc32 of ``<id>:<run>`` is a multiple of ``every``."""
    hashed = runs.withColumn("h", F.crc32(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), "run").cast("binary")))
    return hashed.selectExpr(
        f"CASE WHEN h % {every} = 0 THEN concat(left(run, CAST(h % length(run) AS INT)), substr(run, CAST(h % length(run) AS INT) + 2)) ELSE run END AS word")


def count_words(words: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


_HALF = "CAST(IF(back, length(w) - length(w) div 2, length(w) div 2) AS INT)"


def _both_ways(words: DataFrame) -> DataFrame:
    """(back, w, half, start): each word forwards and backwards, the level from which edits are made, and the level
    its search starts at (before the last two letters, so that the last can be deleted)."""
    ways = words.selectExpr("inline(array(named_struct('back', false, 'w', word), named_struct('back', true, 'w', reverse(word))))")
    return ways.selectExpr("back", "w", f"{_HALF} AS half").selectExpr("*", "least(half, greatest(length(w) - 2, 0)) AS start")


def edge_table(words: DataFrame) -> DataFrame:
    """(back, depth, node, n_words, only, terminal, lengths, nexts) of every edge that a search can cross.

    An edge is named by the node it leads to; ``lengths`` and ``nexts`` are sets of 64 bits. Sorted by
    depth within partitions, so a level's read skips the pages of others.
    """
    cut = _both_ways(words).selectExpr("back", "w", "explode(sequence(start + 1, length(w))) AS depth")
    return cut.selectExpr("back", "depth", "left(w, depth) AS node", "w").groupBy("back", "depth", "node").agg(
        F.count(F.lit(1)).alias("n_words"), F.min("w").alias("only"), F.expr("bool_or(length(w) = depth)").alias("terminal"),
        F.expr("bit_or(shiftleft(1L, length(w) % 64))").alias("lengths"),
        F.expr("bit_or(shiftleft(1L, ascii(substr(w, depth + 1, 1)) % 64))").alias("nexts"),
    ).sortWithinPartitions("depth")


def _outcome(kind: int, when: str, rest: str, length: str) -> str:
    """SQL of the state after an edge: it ends on a near word (``target``), goes on, or is NULL."""
    return f"""CASE WHEN {when} THEN CASE
        WHEN {rest} = '' THEN IF(terminal, named_struct('kind', {kind}, 'target', next), NULL)
        WHEN n_words = 1 THEN IF(concat(next, {rest}) = only, named_struct('kind', {kind}, 'target', only), NULL)
        WHEN (lengths & shiftleft(1L, ({length}) % 64)) != 0 AND (nexts & shiftleft(1L, ascii({rest}) % 64)) != 0
          THEN named_struct('kind', {kind}, 'target', CAST(NULL AS STRING)) END END"""


def _step(frontier: DataFrame, edges: DataFrame, level: int) -> DataFrame:
    """States (back, w, kind, node, target) after the edges of one level; kind 0: no edit, 1: replaced, 2: deleted."""
    letters = frontier.selectExpr(
        "back", "w", "kind", "node", f"substr(w, {level} + 1, 1) AS x", f"substr(w, {level} + 2, 1) AS y",
        f"back AND {level} > 0 AND substr(w, {level}, 1) = substr(w, {level} + 1, 1) AS again", f"{level} >= {_HALF} AS edits")
    leads = edges.filter(F.col("depth") == level + 1).selectExpr(
        "back AS e_back", f"left(node, {level}) AS parent", f"substr(node, {level} + 1) AS c", "node AS next", "n_words", "only", "terminal", "lengths", "nexts")
    met = letters.join(leads, F.expr("back = e_back AND node = parent AND (c = x AND kind < 2 OR c = y AND kind != 1 OR c > x AND kind = 0 AND edits)"))
    deleted_here = "kind = 0 AND edits AND c = y AND IF(back, NOT again, x != y)"
    outcomes = ", ".join([
        f"IF(kind = 0 AND c = x AND n_words > 1 AND length(w) > {level} + 1, named_struct('kind', 0, 'target', CAST(NULL AS STRING)), NULL)",
        # The last letter deleted: the word ends one letter behind this edge.
        f"IF(kind = 0 AND c = x AND terminal AND length(w) = {level} + 2 AND (NOT back OR x != y), named_struct('kind', 2, 'target', next), NULL)",
        _outcome(1, "kind = 0 AND edits AND c > x OR kind = 1 AND c = x", f"substr(w, {level} + 2)", "length(w)"),
        _outcome(2, f"{deleted_here} OR kind = 2 AND c = y", f"substr(w, {level} + 3)", "length(w) - 1"),
    ])
    return met.selectExpr("back", "w", "next AS node", f"explode(array({outcomes})) AS state").filter("state IS NOT NULL").select("back", "w", "state.kind", "node", "state.target")


def trie_pairs(words: DataFrame, shortest: int, longest: int) -> DataFrame:
    """(word, near): each near pair among words of ``shortest`` to ``longest`` code points, once."""
    edges = stage(edge_table(words), "trie-edges")
    starts, frontier, found = _both_ways(words), None, []
    for level in range(max(0, min(shortest // 2, shortest - 2)), longest):
        fresh = starts.filter(F.col("start") == level).selectExpr("back", "w", "0 AS kind", f"left(w, {level}) AS node")
        met = fresh if frontier is None else fresh.unionByName(frontier)
        states = stage(_step(met, edges, level), f"trie-level-{level}")
        found.append(states.filter("target IS NOT NULL"))
        frontier = states.filter("target IS NULL").drop("target")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.selectExpr("IF(back, reverse(w), w) AS word", "IF(back, reverse(target), target) AS near")


def long_pairs(words: DataFrame, depth: int) -> DataFrame:
    """(word, near): each near pair whose longer word has more than ``depth`` code points, once."""
    texts = words.filter(F.length("word") >= depth).selectExpr("unhex(md5(word)) AS key", "word", "length(word) AS size", "xxhash64(word) AS whole")
    cuts = texts.filter(F.col("size") > depth).selectExpr("key", "size", "word", "explode(sequence(0, size - 1)) AS at").selectExpr(
        "key", "size", "at", "substr(word, at + 1, 1) AS x", "substr(word, at + 2, 1) AS y", "xxhash64(concat(left(word, at), substr(word, at + 2))) AS rest")
    cuts = stage(cuts, "variant-cuts")
    other = cuts.selectExpr("key AS near_key", "size AS s", "at AS a", "x AS z", "rest AS r")
    replaced = cuts.join(other, F.expr("size = s AND at = a AND rest = r AND x < z")).select("key", "near_key", "at", F.lit(True).alias("same"))
    shorter = texts.selectExpr("key AS near_key", "size AS s", "whole")
    deleted = cuts.filter("x != y").join(shorter, F.expr("size - 1 = s AND rest = whole")).select("key", "near_key", "at", F.lit(False).alias("same"))
    named = replaced.unionByName(deleted).join(texts.select("key", "word"), "key").join(texts.selectExpr("key AS near_key", "word AS near"), "near_key")
    # Hashes only propose: the texts decide.
    return named.filter("left(word, at) = left(near, at) AND substr(word, at + 2) = substr(near, IF(same, at + 2, at + 1))").select("word", "near")


def near_pairs(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(word, near): each pair of near words once; ``words`` has distinct words (and is read once a level)."""
    span = words.agg(F.min(F.length("word")).alias("least"), F.max(F.length("word")).alias("most")).first()
    if span["most"] is None:
        return words.selectExpr("word", "word AS near")
    pairs = []
    if span["least"] <= depth:
        pairs.append(trie_pairs(words.filter(F.length("word") <= depth), span["least"], min(span["most"], depth)))
    if span["most"] > depth:
        pairs.append(long_pairs(words, depth))
    return pairs[0] if len(pairs) == 1 else pairs[0].unionByName(pairs[1])


def spelling_variants(counted: DataFrame, ratio: int = 10, depth: int = DEPTH) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``counted`` (word, n).

    The form is the near word with the largest n (ties: the first in code-point order), if that is at least
    ``ratio`` times the word's; the root is the end of the chain of forms. ``ratio`` is 2 or more.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = stage(counted.filter("word IS NOT NULL AND length(word) > 0").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    pairs = near_pairs(words, depth)
    ways = pairs.selectExpr("inline(array(named_struct('word', word, 'near', near), named_struct('word', near, 'near', word)))")
    best = ways.join(words.selectExpr("word AS near", "n AS near_n"), "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("top"))
    rows = stage(words.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near", f"IF(-top.less >= {ratio} * n, top.near, NULL) AS form", f"IF(-top.less >= {ratio} * n, -top.less, NULL) AS form_n"), "variants")
    # Counts grow by the ratio along a chain, so the largest and least bound its length; each round doubles the step.
    span = words.agg(F.max("n").alias("most"), F.min("n").alias("least")).first()
    links = math.floor(math.log(max(1, span["most"] / span["least"])) / math.log(ratio) + 1e-9) if span["most"] else 0
    roots = rows.filter("form IS NOT NULL").selectExpr("word", "form AS root")
    for _ in range(math.ceil(math.log2(links)) if links > 1 else 0):
        hop = roots.selectExpr("word AS root", "root AS further")
        roots = stage(roots.join(hop, "root", "left").selectExpr("word", "coalesce(further, root) AS root"), "variant-roots")
    return rows.join(roots, "word", "left").selectExpr("word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")
