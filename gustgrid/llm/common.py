"""Shared helpers of the training-data operators: tables, row keys, and words of whole Arrow batches."""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from gustgrid.session import configure

# Workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text that one numpy step holds (a longer text is a step of its own).
STEP_BYTES = 2_000_000
# [^\x20\x09-\x0D]+ and, after lower-casing A-Z, [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, as byte classes.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_SQL = r"[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: small Arrow batches, because texts are long."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


# A random 64-bit code of each byte value; the lower-casing table gives A-Z the codes of a-z.
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_FOLDED = np.arange(256)
_FOLDED[65:91] += 32
_CODES_LOWER = _CODES[_FOLDED]
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SPACES)] = False
_BASE = np.uint64(0xD6E8FEB86659FD93)


def worker_cache(owner: str = "") -> dict:
    """A dictionary that stays in a Python worker between tasks, until another owner asks for one.

    Workers are shared by all stages of a session, so what one stage holds is freed when the next begins.
    """
    kept = sys.modules.setdefault("_gustgrid_worker_cache", types.ModuleType("_gustgrid_worker_cache")).__dict__
    if kept.get("owner") != owner:
        kept.clear()
        kept["owner"] = owner
    return kept


def steps(batch: pa.RecordBatch, text: str):
    """Slices of a batch with at most STEP_BYTES of text each; null texts become empty."""
    worker_cache()
    col = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)) if len(col) else []
    at = 0
    while at < len(col):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + STEP_BYTES, side="right")))
        yield batch.slice(at, to - at)
        at = to


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row begins (one entry more than rows)."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = _IS_WORD):
    """Start and end byte and row of every word."""
    inside = is_word[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = inside[first]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[last] = inside[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word: codes of its bytes times powers of an odd base, mixed."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    index = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
    codes = (_CODES_LOWER if lower else _CODES)[data[index + np.repeat(starts, lengths)]] * powers[index]
    sums = np.add.reduceat(codes, np.cumsum(lengths) - lengths)
    return mix(sums + lengths.astype(np.uint64) * _GOLD)


def window_hashes(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of every window of ``k`` consecutive words of one row."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = mix(h * _M2 + words[j : j + n] + np.uint64(j))
    at = np.flatnonzero(rows[:n] == rows[k - 1 :])
    return h[at], rows[at], at


def strings(values: list[str | None]) -> pa.Array:
    return pa.array(values, pa.string())
