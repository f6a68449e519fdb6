"""Near-duplicate components by SetSketch registers.

A document is the set of its word shingles. Each shingle carries a Poisson process of points on
every register; a register keeps the smallest point over all shingles, rounded to an exponentially
spaced level (base ``BASE``) and truncated to 16 bits. Registers of equal parameters merge by
maximum and agree between two sets with a probability close to their Jaccard similarity, so:

1. equal sets are one class; a class is its smallest id;
2. register bands are bucket keys. A pair of similarity 0.8 misses all 40 bands of 5 registers
   with probability (1 - 0.8**5)**40 = 1e-7;
3. every class of a bucket is compared with the bucket's leader (its smallest class). The
   similarity is estimated by maximum likelihood over the three register counts (greater, equal,
   less) and the two set sizes; pairs that cannot be links are put aside. The best leader of each
   class is confirmed on the full sets, which already merges most groups;
4. buckets that still hold several components are searched completely, in blocks of bounded size,
   for pairs of different components that may be links. Each block gives a spanning forest of such
   pairs, so its output is no longer than its input; the forests' components are candidate groups;
5. the members of a candidate group meet again in blocks with their full sets, and every pair of
   different components that may be a link is checked there. Only links that merge two components
   leave the block. No link is lost, and no group is expanded into its pairs.

All tables stay distributed; intermediate ones are written to the shared folder.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from gustgrid.llm.common import flat, mix, steps, window_hashes, word_bounds, word_hashes
from gustgrid.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
BASE = 1.001
# Level of the point 1.0: levels of points up to 1.001**2000 stay above zero.
SHIFT = 2000
# Most members of one block of a bucket.
BLOCK = 256
# A pair goes on to the full sets if its estimate is at most this many standard errors too low.
ERRORS = 4.5


def sets_of(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: A-Z lower-cased, words split at white space.

    A text of fewer words is one shingle; a text without words has none.
    """
    data, offsets = flat(texts)
    starts, ends, rows = word_bounds(data, offsets)
    tokens = word_hashes(data, starts, ends, lower=True)
    h, at_row, _ = window_hashes(tokens, rows, words)
    count = np.bincount(rows, minlength=len(texts))
    first = np.cumsum(count) - count
    bounds = np.searchsorted(at_row, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        if count[i] >= words:
            s = np.sort(h[bounds[i] : bounds[i + 1]])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif count[i]:
            own = tokens[first[i] : first[i] + count[i]]
            whole, _, _ = window_hashes(own, np.zeros(len(own), np.int64), len(own))
            out.append(mix(whole + np.uint64(count[i])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _minima(elements: np.ndarray, rows: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Smallest point of each register of each row, of all points below the row's limit."""
    least = np.full(len(limit) * REGISTERS, np.inf)
    state, x = mix(elements + np.uint64(0x51ED27)), np.zeros(len(elements))
    bound = limit[rows]
    while len(state):
        state = state + np.uint64(0x9E3779B97F4A7C15)
        z = mix(state)
        x = x - np.log1p(-(z >> np.uint64(24)).astype(np.float64) * 2.0**-40) / REGISTERS
        live = x < bound
        state, x, rows, bound, z = state[live], x[live], rows[live], bound[live], z[live]
        register = ((z & np.uint64(0xFFFFFF)) * np.uint64(REGISTERS) >> np.uint64(24)).astype(np.int64)
        np.minimum.at(least, rows * REGISTERS + register, x)
    return least.reshape(len(limit), REGISTERS)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (uint16) of each set; an empty set has zeros."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    todo = np.flatnonzero(sizes)
    # Points beyond the limit cannot be a minimum once all registers are met; few sets need more.
    for room in (3.0, 12.0, 40.0):
        if not len(todo):
            break
        limit = (np.log(REGISTERS) + room) / sizes[todo]
        least = _minima(np.concatenate([sets[i] for i in todo]), np.repeat(np.arange(len(todo)), sizes[todo]), limit)
        full = np.isfinite(least).all(axis=1)
        level = np.floor(1.0 - np.log(least[full]) / np.log(BASE)) + SHIFT
        out[todo[full]] = np.clip(level, 1, 65535).astype(np.uint16)
        todo = todo[~full]
    return out


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood similarity of register rows with known set sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    u = na / (na + nb)
    v = 1.0 - u
    j = np.linspace(0.0, 1.0, 101)[None, :] * (np.minimum(na, nb) / np.maximum(na, nb))[:, None]

    def p(x):
        return np.clip(-np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1.0)

    up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    same = np.clip(1.0 - up - down, 1e-12, 1.0)
    score = more[:, None] * np.log(up) + less[:, None] * np.log(down) + (a.shape[1] - more - less)[:, None] * np.log(same)
    return j[np.arange(len(j)), score.argmax(axis=1)]


def _registers(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint16).reshape(len(col), REGISTERS)


def _sketch_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                sets = sets_of(part.column(1), words)
                registers = sketches(sets)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(np.bitwise_xor.reduce(mix(s + np.uint64(1)), initial=0)) for s in sets], pa.uint64()).view(pa.int64()),
                    pa.array([int(np.add.reduce(mix(s ^ np.uint64(0xA5A5A5A5)))) for s in sets], pa.uint64()).view(pa.int64()),
                    pa.array([r.tobytes() for r in registers], pa.binary()),
                ], ["id", "n", "k1", "k2", "regs"])

    return run


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = _registers(batch.column(1)).reshape(batch.num_rows, BANDS, ROWS).astype(np.uint64)
        h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (batch.num_rows, BANDS))
        for k in range(ROWS):
            h = mix(h * np.uint64(0x94D049BB133111EB) + regs[:, :, k] + np.uint64(1))
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(h.reshape(-1).view(np.int64))], ["cls", "bucket"])


def _estimate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        na, nb = (batch.column(k).to_numpy().astype(np.float64) for k in (2, 3))
        est = estimate(_registers(batch.column(4)), _registers(batch.column(5)), na, nb)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(est)], ["a", "b", "est"])


def _verify_batches(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                # 100 * intersection >= 80 * union, in whole numbers.
                linked.append(100 * both >= round(100 * threshold) * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


def _set_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                sets = sets_of(part.column(1), words)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "shingles"])

    return run


class _Union:
    """Disjoint sets of a block's rows."""

    def __init__(self, comps: np.ndarray):
        _, first, inverse = np.unique(comps, return_index=True, return_inverse=True)
        self.root = first[inverse]

    def merge(self, x: int, y: int) -> None:
        self.root[self.root == self.root[y]] = self.root[x]


def _overlap(x: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of one sorted set with each of several non-empty ones."""
    every = np.concatenate(sets)
    met = x[np.minimum(np.searchsorted(x, every), len(x) - 1)] == every
    sizes = [len(s) for s in sets]
    return np.add.reduceat(met.astype(np.int64), np.cumsum(sizes) - sizes)


def _block_links(lowest: float, threshold: float, exact: bool):
    """Links of each block group of a sorted stream (rows that share key, i, j).

    Rows of block ``i`` meet rows of block ``j``. A pair of different components whose estimate is at
    least ``lowest`` merges them, if ``exact`` only after a check of the full sets. The merging pairs
    are a spanning forest: fewer than the rows.
    """

    def links(group: pa.Table) -> list[tuple[int, int]]:
        cls, comp, n, blk = (group.column(c).to_numpy() for c in ("cls", "comp", "n", "blk"))
        if (comp == comp[0]).all():
            return []
        regs, union = _registers(group.column("regs")), _Union(comp)
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in group.column("shingles")] if exact else []
        # An id with several texts meets all its sets; sizes belong to the sets.
        n = np.array([len(v) for v in sets]) if exact else n
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
        out = []
        for x in left:
            y = right[(union.root[right] != union.root[x]) & (right > x if i == j else True)]
            y = y[np.minimum(n[y], n[x]) >= threshold * np.maximum(n[y], n[x])]
            # A cheap count first: the estimate is never far above the share of equal registers.
            y = y[(regs[y] == regs[x]).sum(axis=1) >= (lowest - 0.05) * REGISTERS] if len(y) else y
            if not len(y):
                continue
            est = estimate(np.broadcast_to(regs[x], (len(y), REGISTERS)), regs[y], np.full(len(y), float(n[x])), n[y].astype(np.float64))
            y = y[np.argsort(-est, kind="stable")][: int((est >= lowest).sum())]
            while len(y):
                # The best row of every other component first: one link makes the rest needless.
                roots, first = np.unique(union.root[y], return_index=True)
                tried = y[first]
                if exact:
                    both = _overlap(sets[x], [sets[k] for k in tried])
                    good = tried[100 * both >= round(100 * threshold) * (n[x] + n[tried] - both)]
                else:
                    good = tried
                for k in good:
                    if union.root[k] != union.root[x]:
                        out.append((int(cls[x]), int(cls[k])))
                        union.merge(x, k)
                y = np.delete(y, first)
                y = y[union.root[y] != union.root[x]]
        return out

    def bounds(table: pa.Table) -> np.ndarray:
        key = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
        return np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            at = bounds(table)
            if len(at) > 1:
                yield from emit(table, [*at])
                held = table.slice(int(at[-1])).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from emit(table, [*bounds(table), table.num_rows])

    def emit(table: pa.Table, at: list[int]) -> Iterator[pa.RecordBatch]:
        found = [p for a, b in zip(at, at[1:]) for p in links(table.slice(a, b - a))]
        if found:
            x, y = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return run


def _in_blocks(members: DataFrame) -> DataFrame:
    """Rows (key, cls, comp) of keys with several components, dealt into block pairs (key, i, j).

    Rows of a key's largest component never need to meet each other, so they have blocks of their
    own that meet only the blocks of the others: a huge group with a few stragglers costs a copy of
    the stragglers for every block.
    """
    each = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    most = each.groupBy("key").agg(F.sum("m").alias("rows"), F.max(F.struct("m", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    dealt = members.join(most.selectExpr(
        "key", "top.comp AS top", f"CAST(ceil(top.m / {BLOCK}e0) AS INT) AS mine", f"CAST(ceil((rows - top.m) / {BLOCK}e0) AS INT) AS others"), "key")
    dealt = dealt.selectExpr("key", "cls", "comp", "mine", "others", "comp = top AS big",
                             "CAST(pmod(xxhash64(cls), CASE WHEN comp = top THEN mine ELSE others END) AS INT) + CASE WHEN comp = top THEN 0 ELSE mine END AS blk")
    return dealt.selectExpr("key", "cls", "comp", "blk", "explode(CASE WHEN big THEN sequence(mine, mine + others - 1) ELSE sequence(0, mine + others - 1) END) AS other").selectExpr(
        "key", "cls", "comp", "blk", "least(blk, other) AS i", "greatest(blk, other) AS j")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of an edge: comp is the smallest node reachable.

    Alternating large and small stars until the edges are a star forest; every step is an
    aggregation and a join, so a hub's edges are spread by the other end.
    """
    e = stage(edges.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").filter("u <> v").distinct(), "stars")
    while True:
        # Done when every node that points has one target, and no target points on.
        ends = e.selectExpr("inline(array(struct(u AS x, 1 AS points, 0 AS target), struct(v AS x, 0 AS points, 1 AS target)))")
        ends = ends.groupBy("x").agg(F.sum("points").alias("points"), F.max("target").alias("target"))
        if not ends.filter("points > 1 OR (points = 1 AND target = 1)").agg(F.count(F.lit(1))).first()[0]:
            return e.selectExpr("u AS node", "v AS comp")
        both = e.union(e.selectExpr("v AS u", "u AS v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.filter("v > u").join(low, "u").selectExpr("v AS u", "m AS v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("explode(array(struct(u AS u, m AS v), struct(v AS u, m AS v))) AS p").selectExpr("p.u", "p.v")
        e = stage(small.filter("u <> v").distinct(), "stars")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per input row: ``id_col, n_shingles, component_id, kept``.

    Documents link at a Jaccard similarity of ``threshold`` or more over their ``words``-word
    shingles; ``component_id`` is the smallest id reachable. Null and empty texts (also texts of
    white space) have no shingles and link with nothing. A null id keeps its row: no component, kept.
    Rows that repeat an id are one document, so all its texts share a component.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    base = stage(rows.mapInArrow(_sketch_batches(words), "id long, n long, k1 long, k2 long, regs binary"), "sketches")
    real = base.filter("id IS NOT NULL AND n > 0")
    classes = stage(real.groupBy("k1", "k2").agg(F.min("id").alias("cls")), "classes")
    reps = real.join(classes.withColumn("id", F.col("cls")), ["k1", "k2", "id"]).dropDuplicates(["k1", "k2", "id"])
    reps = stage(reps.select("cls", "n", "regs"), "reps")

    bands = reps.select("cls", "regs").mapInArrow(_band_batches, "cls long, bucket long")
    leaders = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("lead")).filter("size > 1")
    members = stage(bands.join(leaders, "bucket"), "members")
    lowest = threshold - ERRORS * (threshold * (1 - threshold) / REGISTERS) ** 0.5

    def scored(pairs: DataFrame) -> DataFrame:
        side = {s: reps.selectExpr(f"cls AS {s}", f"n AS n{s}", f"regs AS r{s}") for s in "ab"}
        near = pairs.join(side["a"], "a").join(side["b"], "b").filter(f"least(na, nb) >= {threshold} * greatest(na, nb)")
        return near.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_estimate_batches, "a long, b long, est double").filter(F.col("est") >= lowest)

    candidates = stage(scored(members.filter("cls <> lead").selectExpr("cls AS a", "lead AS b").distinct()), "candidates")

    def sets_for(needed: DataFrame) -> DataFrame:
        """Full sets of the documents with these ids (one column, distinct)."""
        texts = rows.join(needed.hint("shuffle_hash"), "id", "left_semi").distinct()
        return stage(texts.mapInArrow(_set_batches(words), "id long, shingles binary").filter("octet_length(shingles) > 0"), "sets")

    # The best leader of each class: most groups become one component with one check a row.
    best = stage(candidates.groupBy("a").agg(F.max(F.struct("est", F.expr("-b AS nb"))).alias("x")).selectExpr("a", "-x.nb AS b"), "best")
    sets = sets_for(best.selectExpr("explode(array(a, b)) AS id").distinct())
    both = best.join(sets.withColumnsRenamed({"id": "a", "shingles": "sa"}), "a").join(sets.withColumnsRenamed({"id": "b", "shingles": "sb"}), "b")
    sure = stage(both.select("a", "b", "sa", "sb").mapInArrow(_verify_batches(threshold), "a long, b long, linked boolean").filter("linked").select("a", "b"), "links")
    comp = components(sure)

    def blocks(keyed: DataFrame, *more: DataFrame) -> DataFrame:
        """Block pairs of (key, cls), with components so far and registers (and what ``more`` adds by cls)."""
        own = keyed.join(comp, keyed.cls == comp.node, "left").selectExpr("key", "cls", "coalesce(comp, cls) AS comp")
        full = _in_blocks(own).join(reps, "cls")
        for m in more:
            full = full.join(m, "cls")
        return full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").select(
            "key", "i", "j", "cls", "comp", "blk", "n", "regs", *(c for m in more for c in m.columns if c != "cls"))

    forest = blocks(members.selectExpr("bucket AS key", "cls")).mapInArrow(_block_links(lowest, threshold, exact=False), "a long, b long")
    forest = stage(forest.distinct(), "forest")
    groups = components(forest.union(comp.selectExpr("node AS a", "comp AS b")))
    # Groups with a pair of different components: all their members meet with their sets.
    open_ = forest.join(groups, forest.a == groups.node, "left").selectExpr("coalesce(comp, a) AS key").distinct()
    grouped = stage(groups.selectExpr("comp AS key", "node AS cls").union(groups.selectExpr("comp AS key", "comp AS cls").distinct()).join(open_, "key", "left_semi"), "groups")
    fresh = grouped.selectExpr("cls AS id").distinct().join(sets.select("id"), "id", "left_anti")
    more_sets = sets.union(sets_for(fresh)).withColumnRenamed("id", "cls")
    late = stage(blocks(grouped, more_sets).mapInArrow(_block_links(lowest, threshold, exact=True), "a long, b long").distinct(), "links")
    comp = components(sure.union(late))

    linked = classes.join(comp, classes.cls == comp.node, "left").selectExpr("k1", "k2", "coalesce(comp, cls) AS comp")
    out = base.select("id", "n", "k1", "k2").join(linked, ["k1", "k2"], "left").selectExpr(
        f"id AS {id_col}", "n AS n_shingles", "CASE WHEN n = 0 OR id IS NULL THEN id ELSE comp END AS component_id")
    return out.withColumn("kept", F.expr(f"{id_col} <=> component_id"))
