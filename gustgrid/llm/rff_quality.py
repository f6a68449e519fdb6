"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Document statistics are standardised and mapped to ``FEATURES`` cosines of random projections, whose
inner products approximate a Gaussian kernel. Every partition sums its part of the normal equations
per fold; the sums (bounded by FEATURES squared) are solved on the driver. Scores of the labelled
rows come from the fit without their fold, and a non-decreasing step function from those scores to
the labels calibrates the final fit. All labelled rows train; none is sampled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from gustgrid.llm.common import steps
from gustgrid.llm.doc_stats import counts
from gustgrid.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES, BINS, RIDGE = 128, 2000, 1e-3
STATS = ["log_words", "word_len", "symbols", "upper", "digits", "punct", "stops", "distinct", "top_word", "repeats", "dup_lines", "line_len"]


def stats(texts: pa.Array) -> np.ndarray:
    """Statistics of each text; an empty one has zeros. Language, source and ids are no input."""
    c = {k: v.astype(np.float64) for k, v in counts(texts).items()}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    letters = np.maximum(c["upper"] + c["lower"], 1)
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, np.log1p(100 * c["n_symbols"] / words), c["upper"] / letters, np.sqrt(c["digits"] / chars),
        c["punct"] / words, c["stops"] / words, c["n_distinct"] / words, c["top_word"] / words, c["n_repeat_words"] / words,
        c["n_dup_lines"] / np.maximum(c["n_lines"], 1), np.log1p(words / np.maximum(c["n_lines"], 1)),
    ], axis=1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    values: np.ndarray
    seed: int = 7

    def cosines(self, x: np.ndarray) -> np.ndarray:
        """Features of a Gaussian kernel whose width is the square root of the number of statistics; and a constant."""
        rng = np.random.default_rng(self.seed)
        w = rng.normal(size=(x.shape[1], FEATURES)) / np.sqrt(x.shape[1])
        z = np.sqrt(2.0 / FEATURES) * np.cos(np.clip((x - self.mean) / self.scale, -6, 6) @ w + rng.uniform(0, 2 * np.pi, FEATURES))
        return np.concatenate([z, np.ones((len(x), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.round(np.clip(np.interp(self.cosines(x) @ self.weights, self.edges, self.values), 0.0, 1.0), 6)


def _stat_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            x = stats(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x[:, k]) for k in range(len(STATS)))], ["id", *STATS])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(s)).to_numpy(zero_copy_only=False) for s in STATS], axis=1)


def _normal_equations(model: Model):
    """One row (fold, i, j, v) for each entry of a partition's sums; column FEATURES + 1 is the target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z = np.concatenate([model.cosines(_matrix(batch)), batch.column(batch.schema.get_field_index("y")).to_numpy()[:, None]], axis=1)
            folds = batch.column(batch.schema.get_field_index("fold")).to_numpy()
            for f in np.unique(folds):
                own = z[folds == f]
                sums[int(f)] = sums.get(int(f), 0.0) + own.T @ own
        i, j = np.triu_indices(FEATURES + 2)
        for f, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), f)), pa.array(i), pa.array(j), pa.array(s[i, j])], ["fold", "i", "j", "v"])

    return run


def _solve(gram: np.ndarray) -> np.ndarray:
    a, b = gram[: FEATURES + 1, : FEATURES + 1].copy(), gram[: FEATURES + 1, FEATURES + 1]
    ridge = np.full(FEATURES + 1, RIDGE * max(a[FEATURES, FEATURES], 1.0))
    ridge[FEATURES] = 1e-9
    return np.linalg.solve(a + np.diag(ridge), b)


def _fold_scores(model: Model, weights: dict[int, np.ndarray]):
    """Bin of the score that the fit without the row's fold gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z = model.cosines(_matrix(batch))
            folds = batch.column(batch.schema.get_field_index("fold")).to_numpy()
            s = np.zeros(len(z))
            for f, w in weights.items():
                s[folds == f] = z[folds == f] @ w
            bins = np.clip(np.floor((s + 0.5) / 2.0 * BINS), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(batch.schema.get_field_index("y"))], ["bin", "y"])

    return run


def pool_adjacent(x: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and means of the blocks of the non-decreasing least-squares fit of total / weight over x."""
    blocks: list[list[float]] = []
    for c, t, w in zip(x, total, weight):
        blocks.append([c * w, t, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def fit(labelled: DataFrame) -> Model:
    """Model of rows (STATS, y in 0..1, fold). Without labels every score is 0.5."""
    moments = labelled.agg(F.count(F.lit(1)), *(F.avg(s) for s in STATS), *(F.stddev_pop(s) for s in STATS)).first()
    k = len(STATS)
    if not moments[0]:
        return Model(np.zeros(k), np.ones(k), np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    scale = np.array(moments[1 + k :], dtype=float)
    model = Model(np.array(moments[1 : 1 + k], dtype=float), np.where(scale > 1e-9, scale, 1.0), np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    rows = labelled.select(*STATS, "y", "fold").mapInArrow(_normal_equations(model), "fold long, i long, j long, v double").groupBy("fold", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    grams = {}
    for f, part in rows.groupby("fold"):
        g = np.zeros((FEATURES + 2, FEATURES + 2))
        g[part.i, part.j] = part.v
        g[part.j, part.i] = part.v
        grams[int(f)] = g
    total = sum(grams.values())
    model.weights = _solve(total)
    without = {f: _solve(total - g) if len(grams) > 1 else model.weights for f, g in grams.items()}
    bins = labelled.select(*STATS, "y", "fold").mapInArrow(_fold_scores(model, without), "bin long, y double").groupBy("bin").agg(
        F.sum("y").alias("t"), F.count(F.lit(1)).alias("w")).orderBy("bin").toPandas()
    centres = (bins.bin.to_numpy() + 0.5) / BINS * 2.0 - 0.5
    model.edges, model.values = pool_adjacent(centres, bins.t.to_numpy(), bins.w.to_numpy().astype(float))
    return model


def _score_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch)) if batch.num_rows else [], pa.float64())], ["id", "score"])

    return run


def _text_scores(model: Model, at: int, schema: pa.Schema | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, batch.schema.names[at]):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(stats(part.column(at))), pa.float64())], [*part.schema.names, "_score"])

    return run


def held_out(id_col: str):
    """True for rows whose crc32 of the id as text leaves 0 by 5 (a null id counts as empty text)."""
    return F.expr(f"pmod(crc32(CAST(coalesce(CAST(`{id_col}` AS STRING), '') AS BINARY)), 5) = 0")


def labelled_rows(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Statistics with the mean of a document's labels and its fold; held-out ids and null labels never train."""
    y = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(~held_out(id_col)).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.avg(label_col).alias("y"))
    return features.join(y, "id").withColumn("fold", F.expr("pmod(crc32(CAST(CAST(id AS STRING) AS BINARY)), 5)"))


def features_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_stat_batches, "id long, " + ", ".join(f"{s} double" for s in STATS))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """One row per document row: ``id_col, held_out, score, predicted``.

    Texts are read once; empty and null texts are scored by their zero statistics. Rows that repeat an id train with that id's label.
    """
    features = stage(features_of(docs, id_col, text_col), "stats")
    model = fit(stage(labelled_rows(features, labels, id_col, label_col), "labelled"))
    return features.mapInArrow(_score_batches(model), "id long, score double").withColumnRenamed("id", id_col).select(
        id_col, held_out(id_col).alias("held_out"), "score", F.expr(f"CAST(score >= {threshold} AS INT)").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """The document rows that the classifier accepts, with their columns. Only labelled texts are read for the fit."""
    known = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_labelled")).distinct()
    train = docs.join(known.hint("shuffle_hash"), docs[id_col] == known["_labelled"], "left_semi")
    model = fit(stage(labelled_rows(features_of(train, id_col, text_col), labels, id_col, label_col), "labelled"))
    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField("_score", DoubleType())])
    return docs.mapInArrow(_text_scores(model, docs.columns.index(text_col)), schema).filter(F.col("_score") >= threshold).drop("_score")
