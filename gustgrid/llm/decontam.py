"""Benchmark decontamination with one Aho-Corasick automaton.

Every test item is normalised (A-Z lower-cased, words of letters, digits and non-ASCII characters,
one space between) and cut into windows of 13 consecutive words; a shorter item is one window. All
windows are the patterns of one automaton, which each worker builds once. Every document is
normalised the same way and scanned once; hits become word positions by counting spaces, and word
positions become offsets of the original text.

The item windows are a stated query set. The automaton holds at most ``BLOCK_PATTERNS`` windows;
a larger set is scanned in blocks one after another in the same pass over the rows, so no row is
shuffled and no window is left out.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gustgrid.llm.common import worker_cache
from gustgrid.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_PATTERNS = 500_000
# SQL of the rule: any hit, and hits of a twentieth of the words.
CONTAMINATED = "(_n_hit > 0 AND 20 * _n_hit >= _n_words)"
# Bytes of UTF-8: A-Z to a-z, ASCII that is no word character to a space, the rest as it is.
FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 48 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 127 else b for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split(b" ")


def normal(text: str | None) -> tuple[str, int]:
    """The words between single spaces, with one at each end, as one character per byte; and their number."""
    words = [w for w in words_of(text) if w]
    return (" " + b" ".join(words).decode("latin-1") + " " if words else "", len(words))


def item_windows(items: DataFrame, item_id: str, item_text: str, window: int) -> DataFrame:
    """(pattern, items): each distinct window with the sorted ids (as text) of the items that have it.

    Items without words have no window; windows of an item without an id hit, but name no item.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, str | None]] = []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [w for w in words_of(text) if w]
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    out.append((" " + b" ".join(words[i : i + window]).decode("latin-1") + " ", ident))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.string()), pa.array([i for _, i in out], pa.string())], ["pattern", "item"])

    pieces = items.select(F.col(item_id).cast("string"), F.col(item_text)).mapInArrow(cut, "pattern string, item string")
    return pieces.groupBy("pattern").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _automaton(shared, key: str):
    import ahocorasick

    kept = worker_cache("automaton")
    if key not in kept:
        built = ahocorasick.Automaton()
        for k, (pattern, _) in enumerate(shared.value):
            built.add_word(pattern, k)
        built.make_automaton()
        for old in [x for x in kept if x.startswith("automaton-")][:-1]:
            kept.pop(old)
        kept[key] = built
    return kept[key]


def _scan(shared, key: str, text_at: int):
    """Adds the block's hits to the last two columns: flat word bounds (end exclusive) and item ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not shared.value:
            yield from batches
            return
        automaton, patterns = _automaton(shared, key), shared.value
        for batch in batches:
            spans, items = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            for row, text in enumerate(batch.column(text_at)):
                string, _ = normal(text.as_py())
                if not string:
                    continue
                hits = list(automaton.iter(string))
                if hits:
                    gaps = np.flatnonzero(np.frombuffer(string.encode("latin-1"), np.uint8) == 32)
                    ends = np.array([e for e, _ in hits])
                    begins = ends - np.array([len(patterns[k][0]) for _, k in hits]) + 1
                    bounds = np.stack([np.searchsorted(gaps, begins), np.searchsorted(gaps, ends)], axis=1)
                    spans[row] = [*spans[row], *np.unique(bounds, axis=0).reshape(-1).tolist()]
                    items[row] = sorted({*items[row], *(i for _, k in hits for i in patterns[k][1])})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], batch.schema.names)

    return run


def _measure(text_at: int):
    """Turns word bounds into counts and ranges of the original text: adds ``_n_words`` and ``_n_hit``, replaces ``_spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hits, ranges = [], [], []
            for text, flat in zip(batch.column(text_at), batch.column(batch.num_columns - 2).to_pylist()):
                text = text.as_py()
                n, hit, spans = normal(text)[1], 0, []
                if flat:
                    step = np.zeros(n + 1, np.int64)
                    np.add.at(step, flat[0::2], 1)
                    np.add.at(step, flat[1::2], -1)
                    inside = np.cumsum(step)[:n] > 0
                    hit = int(inside.sum())
                    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
                    places = [m.span() for m in WORD.finditer(text)]
                    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                        spans += [places[a][0], places[b - 1][1]]
                counts.append(n)
                hits.append(hit)
                ranges.append(spans)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(ranges, pa.list_(pa.int64())), batch.column(batch.num_columns - 1), pa.array(counts, pa.int64()), pa.array(hits, pa.int64())],
                [*batch.schema.names, "_n_words", "_n_hit"])

    return run


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13) -> DataFrame:
    """The document rows with ``_spans, _items, _n_words, _n_hit`` (columns of these names are replaced).

    ``_n_hit`` counts the words inside any occurrence of an item window, ``_items`` are the sorted ids
    (as text) of items with an occurring window, ``_spans`` the merged hit ranges as start, end, start,
    end, ... in code points of the original text. Null and empty texts have no words; ids may be null
    or repeat; without items nothing is hit.
    """
    spark = docs.sparkSession
    windows = stage(item_windows(items, item_id, item_text, window), "windows")
    blocks = -(-max(1, windows.count()) // BLOCK_PATTERNS)
    rows = docs.drop("_spans", "_items", "_n_words", "_n_hit")
    text_at = rows.columns.index(text_col)
    rows = rows.withColumns({"_spans": F.expr("CAST(array() AS ARRAY<BIGINT>)"), "_items": F.expr("CAST(array() AS ARRAY<STRING>)")})
    key, scans = f"automaton-{uuid.uuid4().hex}", []
    for b in range(blocks):
        block = windows if blocks == 1 else windows.filter(f"pmod(xxhash64(pattern), {blocks}) = {b}")
        # Bounded: about BLOCK_PATTERNS windows at a time.
        shared = spark.sparkContext.broadcast([(r.pattern, r["items"]) for r in block.collect()])
        scans.append(_scan(shared, f"{key}-{b}", text_at))
    measure = _measure(text_at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One worker for all blocks and the counts, as each worker process costs memory.
        for scan in scans:
            batches = scan(batches)
        yield from measure(batches)

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("_n_words", LongType()), StructField("_n_hit", LongType())]))
