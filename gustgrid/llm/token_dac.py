"""Token files of directly addressable codes.

Ids are cut into 8-bit chunks. Level 0 holds the low chunk of every id and a bitmap that says whether
the id goes on; level 1 holds the next chunk of those that do, and so on. A rank directory gives the
number of set bits before every 512th bit, so token ``i`` of a segment is read with one look into
each level and no decoding of its neighbours.

A file set is two Parquet tables in one folder of a store that Spark writes: ``segments`` (about
``SEGMENT`` ids each, in document order: levels, bitmaps, ranks, document ids and ends) and ``index``
(for each segment the number of ids before it). Documents are dealt by range of id, so files are in
ascending id order without one task seeing them all.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gustgrid.llm.common import worker_cache
from gustgrid.llm.prefix_bpe import _byte_chars, piece_splitter

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT = 1 << 20
RANK_BITS = 512
# Bytes of remembered pieces and ids, about, in one generation of a worker.
REMEMBERED_BYTES = 64_000_000
_POPCOUNT = np.array([bin(b).count("1") for b in range(256)], np.uint8)
# The letter of each byte in a byte-level vocabulary.
_LETTERS = {byte: letter for letter, byte in _byte_chars().items()}

SEGMENT_SCHEMA = ("part long, segment long, n_docs long, n_tokens long, doc_ids array<long>, doc_ends array<long>, "
                  "levels array<binary>, bitmaps array<binary>, ranks array<binary>")


def dac_encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Levels, continuation bitmaps and rank directories of ids; the last level has no bitmap bit set."""
    levels, bitmaps, ranks, rest = [], [], [], ids.astype(np.uint32)
    while True:
        levels.append((rest & np.uint32(255)).astype(np.uint8).tobytes())
        rest = rest >> np.uint32(8)
        more = rest > 0
        bits = np.packbits(more)
        counts = _POPCOUNT[np.append(bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8))].reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint32)
        bitmaps.append(bits.tobytes())
        ranks.append((np.cumsum(counts) - counts).astype("<u4").tobytes())
        if not more.any():
            return levels, bitmaps, ranks
        rest = rest[more]


def dac_decode(levels: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a segment."""
    out = None
    for level, bitmap in reversed(list(zip(levels, bitmaps))):
        values = np.frombuffer(level, np.uint8).astype(np.uint32)
        if out is not None:
            values[np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(values)))] |= out << np.uint32(8)
        out = values
    return out


def dac_get(levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes], i: int) -> int:
    """One id, by ranks alone."""
    value, shift = 0, 0
    for level, bitmap, rank in zip(levels, bitmaps, ranks):
        value |= level[i] << shift
        if not bitmap[i >> 3] >> (7 - (i & 7)) & 1:
            return value
        block = i // RANK_BITS
        before = bitmap[block * (RANK_BITS // 8) : i >> 3]
        i = int.from_bytes(rank[4 * block : 4 * block + 4], "little") + sum(map(int.bit_count, before)) + (bitmap[i >> 3] >> (8 - (i & 7))).bit_count()
        shift += 8
    return value


def _byte_letters(piece: str) -> str:
    """The text over which a byte-level vocabulary is made: one letter for each byte."""
    return piece.encode().decode("latin-1").translate(_LETTERS)


class Encoder:
    """Ids of texts as the tokenizers library gives them, each distinct piece encoded once.

    A byte-level vocabulary is applied to pieces of the text (letters, digits, marks, white space). A text
    is cut into them here, the library's model encodes all new pieces of a batch, and their ids are remembered in two
    generations of about ``REMEMBERED_BYTES`` each. Texts with a special token's string go through it whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = piece_splitter()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: set[str]) -> None:
        """Ids of pieces that the young generation lacks: from the old one, the others from the library."""
        old = self.old
        self.young.update((p, old[p]) for p in pieces if p in old)
        tokens = self.tokenizer.model.tokenize
        self.young.update((p, array("I", [t.id for t in tokens(_byte_letters(p))]).tobytes()) for p in pieces if p not in old)
        self.held += sum(map(len, pieces)) + 220 * len(pieces)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; a null text is empty."""
        if self.held > REMEMBERED_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        known, out, cut, new = self.young.get, [], [], set()
        for text in texts:
            if not text:
                out.append(b"")
            elif any(s in text for s in self.special):
                out.append(self._library([text])[0])
            else:
                pieces = self.pieces(text)
                try:
                    out.append(b"".join(map(known, pieces)))
                except TypeError:  # a piece that is not remembered
                    new.update(p for p in pieces if p not in self.young)
                    cut.append((len(out), pieces))
                    out.append(b"")
        if new:
            self._learn(new)
        for i, pieces in cut:
            out[i] = b"".join(map(known, pieces))
        return out


def _write_segments(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache("encoder")
        encoder = kept.get(f"encoder-{path}") or kept.setdefault(f"encoder-{path}", Encoder(path))
        part, segment, docs, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            columns = [[part], [segment], [len(docs)], [len(ids)], [docs], [np.cumsum([len(h) // 4 for h in held]).tolist()], *([x] for x in dac_encode(ids))]
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.binary())] * 3
            names = ["part", "segment", "n_docs", "n_tokens", "doc_ids", "doc_ends", "levels", "bitmaps", "ranks"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for ident, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                docs.append(ident)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= SEGMENT:
                    yield flush()
                    segment, docs, held, size = segment + 1, [], [], 0
        if docs:
            yield flush()

    return run


def write_tokens(docs: DataFrame, out: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> None:
    """Encode every whole text, add ``end_id``, and write the file set ``out`` in ascending id order.

    Null ids come first; rows that repeat an id are ordered by a hash of their text, equal rows are
    interchangeable. A null text is empty: the end id alone.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(F.col("id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
    rows.select("id", "text").mapInArrow(_write_segments(tokenizer, end_id), SEGMENT_SCHEMA).write.parquet(f"{out}/segments")
    sizes = spark.read.parquet(f"{out}/segments").select("part", "segment", "n_tokens")
    # Two running sums: one row for each task of the write, then the segments of each task.
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes.withColumn("own", own).join(parts, "part").selectExpr("part", "segment", "n_tokens", "before + own AS start").write.parquet(f"{out}/index")


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = dac_decode(row["levels"], row["bitmaps"]).astype("<u4")
            ends = row["doc_ends"]
            begins = [0, *ends[:-1]]
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(begins, ends)]
            columns = [row["doc_ids"], [row["start"] + a for a in begins], [b - a for a, b in zip(begins, ends)], crc]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])


def _segments(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(SEGMENT_SCHEMA).parquet(f"{out}/segments").drop("n_tokens").join(
        spark.read.schema("part long, segment long, n_tokens long, start long").parquet(f"{out}/index"), ["part", "segment"])


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files."""
    return _segments(spark, out).select("doc_ids", "doc_ends", "levels", "bitmaps", "start").mapInArrow(
        _read_documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _get_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = [dac_get(row["levels"], row["bitmaps"], row["ranks"], p - row["start"]) for p in row["positions"]]
            yield pa.RecordBatch.from_arrays([pa.array(row["positions"], pa.int64()), pa.array(ids, pa.int64())], ["position", "token"])


def tokens_at(spark: SparkSession, out: str, positions: DataFrame) -> DataFrame:
    """(position, token) of global token positions, each read by rank without decoding a block.

    Segments and positions meet in equal-sized buckets of the position; positions that no token has give no row.
    """
    index = spark.read.schema("part long, segment long, n_tokens long, start long").parquet(f"{out}/index")
    index = index.selectExpr("*", f"explode(sequence(start div {SEGMENT}, (start + n_tokens - 1) div {SEGMENT})) AS bucket")
    asked = positions.selectExpr("CAST(position AS BIGINT) AS position").distinct().selectExpr("*", f"position div {SEGMENT} AS bucket")
    found = asked.join(index, "bucket").filter("position >= start AND position < start + n_tokens")
    # At most SEGMENT distinct positions fall into one segment.
    wanted = found.groupBy("part", "segment", "start").agg(F.collect_list("position").alias("positions"))
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{out}/segments").select("part", "segment", "levels", "bitmaps", "ranks")
    return wanted.join(segments, ["part", "segment"]).select("start", "positions", "levels", "bitmaps", "ranks").mapInArrow(
        _get_tokens, "position long, token long")
