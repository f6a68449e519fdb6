"""Counts of each document's words, lines and symbols, for whole Arrow batches."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from gustgrid.llm.common import flat, mix, window_hashes, word_bounds, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = b"#*$%&|<>"


def _flags(*chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(b"".join(chars))] = True
    return out


_SYMBOL = _flags(SYMBOLS)
_UPPER = _flags(bytes(range(65, 91)))
_LOWER = _flags(bytes(range(97, 123)))
_DIGIT = _flags(b"0123456789")
_PUNCT = _flags(b"!\"'(),-./:;?@[\\]^_`{}~+=")
_END = _flags(b".!?")
_HEAD = np.ones(256, bool)
_HEAD[0x80:0xC0] = False
_LINE = np.ones(256, bool)
_LINE[10] = False


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: how often its key occurs in its row, and whether an equal one stands before it."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, bool)
    keys = mix(keys + mix(rows.astype(np.uint64) + np.uint64(7)))
    order = np.argsort(keys, kind="stable")
    new = np.append(True, keys[order][1:] != keys[order][:-1])
    group = np.cumsum(new) - 1
    count, later = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    count[order] = np.bincount(group)[group]
    later[order] = ~new
    return count, later


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Whole-number counts of each text; words stand between white space (0x20, 0x09-0x0D), lines between \\n."""
    data, offsets = flat(texts)
    n = len(texts)
    starts, ends, rows = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends, lower=False)
    heads = np.concatenate([[0], np.cumsum(_HEAD[data], dtype=np.int64)])
    out = {"n_words": np.bincount(rows, minlength=n), "chars": _per_row(_HEAD[data], offsets),
           "word_chars": np.bincount(rows, weights=heads[ends] - heads[starts], minlength=n).astype(np.int64)}
    for name, flags in (("n_symbols", _SYMBOL), ("upper", _UPPER), ("lower", _LOWER), ("digits", _DIGIT), ("punct", _PUNCT), ("stops", _END)):
        out[name] = _per_row(flags[data], offsets)

    # Lines with a word, as whole strings.
    line_starts, line_ends, line_rows = word_bounds(data, offsets, _LINE)
    if len(line_starts):
        first = np.searchsorted(starts, line_starts)
        has = (first < len(starts)) & (np.append(starts, np.iinfo(np.int64).max)[np.minimum(first, len(starts))] < line_ends)
        line_starts, line_ends, line_rows = line_starts[has], line_ends[has], line_rows[has]
    _, later = _repeats(word_hashes(data, line_starts, line_ends, lower=False), line_rows)
    out["n_lines"] = np.bincount(line_rows, minlength=n)
    out["n_dup_lines"] = np.bincount(line_rows[later], minlength=n)

    # Words inside a 3-word window that its text holds twice or more.
    windows, window_rows, at = window_hashes(words, rows, 3)
    twice = at[_repeats(windows, window_rows)[0] > 1]
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[twice + k] = True
    out["n_repeat_words"] = np.bincount(rows[covered], minlength=n)
    count, later = _repeats(words, rows)
    out["n_distinct"] = np.bincount(rows[~later], minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, rows, count)
    out["top_word"] = top
    return {k: v.astype(np.int64) for k, v in out.items()}
