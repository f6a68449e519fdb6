"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The last token of a prefix's encoding is unique. An automaton over the vocabulary's byte strings gives,
for every prefix of a piece, the tokens that are its suffixes; the one whose neighbour on the left (the
last token of the prefix before it) it can stand beside is stored, and back-pointers from the end give
the ids. Two tokens can stand beside each other if no merge reaches over their boundary: none of the
pairs on their facing edges has a rank that comes before either part is used up inside its own token.
One step per byte and match, so a piece of any length takes linear time.

Texts are split as the vocabulary file says (byte level): strings of its added tokens first, then
contractions, letters, digits, other marks and white space. Encoded pieces are remembered in two
generations of about ``REMEMBERED_BYTES`` each; everything else is per batch, and no row is shuffled.

Defined cases: a null text is empty and has no ids; rows that repeat are equal; ids may be null;
all other columns of the rows are carried unless they have the name of a result.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from gustgrid.llm.common import worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REMEMBERED_BYTES = 32_000_000
# White space of the byte-level split (Unicode's property White_Space).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NEVER = 1 << 62


def _byte_chars() -> dict[str, int]:
    """Byte values by the characters that stand for them in a byte-level vocabulary file: visible Latin-1
    characters stand for themselves, the others follow from 256 on in ascending order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def latin_pieces() -> re.Pattern:
    """The same pieces for texts of Latin-1 characters, whose classes are short: several times as fast."""
    letters, digits, space = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
    return re.compile(rf" ?[{letters}]+|'(?:[sdmt]|ll|ve|re)| ?[{digits}]+| ?[^{space}{letters}{digits}]+|[{space}]+(?![^{space}])|[{space}]+")


def piece_splitter():
    """A function from a text to its pieces."""
    latin, whole = latin_pieces().findall, piece_pattern().findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return whole(text)
        return latin(text)

    return split


def piece_pattern() -> regex.Pattern:
    """The pieces of the byte-level split: letters, contractions, digits, other marks, white space."""
    return regex.compile(rf" ?\p{{L}}+|'(?:[sdmt]|ll|ve|re)| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


class PrefixBpe:
    """Encoder and decoder of one byte-level vocabulary file (the JSON format of the tokenizers library)."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, split = whole["model"], whole.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or split.get("type") != "ByteLevel" or whole.get("normalizer"):
            raise ValueError("needs a byte-level BPE vocabulary without a normalizer")
        if split.get("add_prefix_space") or not split.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError("prefix spaces, unsplit text and ignored merges are not supported")
        of_char, vocab = _byte_chars(), model["vocab"]
        self.bytes_of: dict[int, bytes] = {i: bytes(of_char[c] for c in t) for t, i in vocab.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        parts = {vocab[a + b]: (vocab[a], vocab[b], r) for r, (a, b) in enumerate(pairs)}
        made = {t: r for t, (_, _, r) in parts.items()}
        if len(parts) < len(pairs) or any(made.get(x, -1) >= r for a, b, r in parts.values() for x in (a, b)):
            raise ValueError("needs one merge for each token, after the merges of its parts")
        # The tokens on the right (left) edge of a token, each with the rank at which it is used up inside it.
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        usable: set[int] = set()
        for token in sorted(self.bytes_of, key=lambda t: made.get(t, -1)):
            if token in parts:
                a, b, r = parts[token]
                self.right[token] = [(token, _NEVER), (b, r), *self.right[b][1:]]
                self.left[token] = [(token, _NEVER), (a, r), *self.left[a][1:]]
                if a not in usable or b not in usable or self._crosses(a, b, r):
                    continue
            elif len(self.bytes_of[token]) > 1:
                continue
            else:
                self.right[token] = self.left[token] = [(token, _NEVER)]
            usable.add(token)
        self.automaton = ahocorasick.Automaton()
        for token in usable:
            data = self.bytes_of[token].decode("latin-1")
            self.automaton.add_word(data, (len(data), token))
        self.automaton.make_automaton()
        self.fits = cache(lambda a, b: not self._crosses(a, b, _NEVER))
        added = {t["content"]: t for t in whole.get("added_tokens") or ()}
        if any(t.get(f) for t in added.values() for f in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens must match as they are")
        self.added = {content: t["id"] for content, t in added.items()}
        self.bytes_of.update({i: c.encode() for c, i in self.added.items()})
        self.cut = re.compile("(" + "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.pieces = piece_splitter()
        self.table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _crosses(self, a: int, b: int, until: int) -> bool:
        """Whether a merge over the boundary of tokens ``a, b`` comes before rank ``until``, before its left part
        is used up in ``a``, and not after its right part is used up in ``b`` (equal ranks go from left to right)."""
        rank = self.rank.get
        for x, gone in self.right[a]:
            for y, spent in self.left[b]:
                r = rank((x, y))
                if r is not None and r < until and r < gone and r <= spent:
                    return True
        return False

    def encode_piece(self, piece: str) -> bytes:
        """Little-endian 32-bit ids of one piece."""
        data = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        last, start, fits = [-1] * (len(data) + 1), [0] * (len(data) + 1), self.fits
        for at, (length, token) in self.automaton.iter(data):
            end = at + 1
            begin = end - length
            if last[end] < 0 and (begin == 0 or (last[begin] >= 0 and fits(last[begin], token))):
                last[end], start[end] = token, begin
        ids, at = [], len(data)
        while at > 0:
            ids.append(last[at])
            at = start[at]
        return array("I", reversed(ids)).tobytes()

    def _remember(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode_piece(piece)
        self.held += 4 * len(piece) + len(ids) + 200
        self.young[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of a text; none for a null."""
        if not text:
            return b""
        if self.held > REMEMBERED_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        out: list[bytes] = []
        known, learn = self.young.get, self._remember
        for part in self.cut.split(text) if self.cut and any(c in text for c in self.added) else (text,):
            if part in self.added:
                out.append(array("I", [self.added[part]]).tobytes())
                continue
            out += [known(piece) or learn(piece) for piece in self.pieces(part)]
        return b"".join(out)

    def decode(self, ids: bytes | None) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters, unknown ids nothing."""
        if not ids:
            return ""
        table, size = self.table, len(self.table)
        numbers = np.frombuffer(ids, "<u4")
        if int(numbers.max()) >= size:
            numbers = numbers[numbers < size]
        return b"".join(map(table.__getitem__, numbers.tolist())).decode("utf-8", "replace")


def _appended(column: str, name: str, kind: pa.DataType, work, path: str):
    """A pass over Arrow batches that appends ``work(model, value)`` of a column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(path)
        for batch in batches:
            values = [work(model, v.as_py()) for v in batch.column(batch.schema.get_field_index(column))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, kind)], [*batch.schema.names, name])

    return run


def worker_model(path: str) -> PrefixBpe:
    """The model of a file, built once in each Python worker."""
    kept = worker_cache("bpe")
    return kept.get(f"bpe-{path}") or kept.setdefault(f"bpe-{path}", PrefixBpe(path))


def bpe_encode(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The rows with ``ids_col``: little-endian 32-bit ids (binary) of each whole text."""
    rows = docs.drop(ids_col) if ids_col != text_col else docs
    schema = StructType([*rows.schema.fields, StructField(ids_col, BinaryType())])
    return rows.mapInArrow(_appended(text_col, ids_col, pa.binary(), PrefixBpe.encode, tokenizer), schema)


def bpe_decode(rows: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows with ``text_col``: the text of each row's ids."""
    rows = rows.drop(text_col)
    schema = StructType([*rows.schema.fields, StructField(text_col, StringType())])
    return rows.mapInArrow(_appended(ids_col, text_col, pa.string(), PrefixBpe.decode, tokenizer), schema)
