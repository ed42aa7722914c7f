"""Quality by ordinal regression: a cumulative-link model on graded ratings.

P(grade > k) = sigmoid(w . x - theta[k]) with one weight vector for all grades and ordered
thresholds. x has hashed words (log counts) and some shares of character kinds. Words in few rated documents get no
weight, as they would be learned by heart. It is
fitted on a bounded sample of rated documents; every text is then scored: expected grade and tail probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import slices, word_hashes
from medlattice.llm.langid import held_out

BITS = 18
SHAPES = 8


def text_features(texts: list, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse hashed words (columns, values, row bounds) and dense shapes of some texts; null counts as empty."""
    hashes, bounds = word_hashes(texts, punctuation=False)
    slots = (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)
    columns, values, sizes = [], [], []
    shapes = np.zeros((len(texts), SHAPES))
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        own, n = np.unique(slots[a:b], return_counts=True)
        v = np.log1p(n)
        columns.append(own)
        values.append(v)
        sizes.append(len(own))
        data = np.frombuffer((texts[i] or "").encode("utf-8", "surrogatepass"), np.uint8)
        if len(data):
            upper = np.count_nonzero((data >= 65) & (data <= 90))
            lower = np.count_nonzero((data >= 97) & (data <= 122))
            digit = np.count_nonzero((data >= 48) & (data <= 57))
            high = np.count_nonzero(data >= 128)
            blank = np.count_nonzero(data <= 32)
            m = len(data)
            shapes[i] = (upper / m, digit / m, (m - upper - lower - digit - high - blank) / m, np.count_nonzero(data == 10) / m, high / m,
                         len(own) / max(1, b - a), (m - blank) / max(1, b - a) / 20, np.log1p(b - a) / 10)
    return (np.concatenate(columns or [np.empty(0, np.int64)]), np.concatenate(values or [np.empty(0)]),
            np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), shapes)


@dataclass
class OrdinalModel:
    words: np.ndarray  # a weight for each slot
    shapes: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    thresholds: np.ndarray  # ascending, one for each grade but the lowest

    def tails(self, texts: list) -> np.ndarray:
        """P(grade >= k) for k = 1.. of each text."""
        columns, values, bounds, shapes = text_features(texts, (len(self.words) - 1).bit_length())
        run = np.concatenate([[0], np.cumsum(self.words[columns] * values)])
        score = run[bounds[1:]] - run[bounds[:-1]] + ((shapes - self.centre) / self.scale) @ self.shapes
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))


def fit_ordinal(columns, values, bounds, shapes, grades, n_grades: int, bits: int = BITS, steps: int = 200, ridge: float = 1e-4,
                least_docs: int = 8) -> OrdinalModel:
    """Full-batch Adam on the cumulative-link likelihood. Threshold gaps are exponentials, so thresholds stay ordered."""
    n, m = len(grades), 1 << bits
    centre = shapes.mean(axis=0) if n else np.zeros(SHAPES)
    scale = np.maximum(shapes.std(axis=0), 1e-6) if n else np.ones(SHAPES)
    x = (shapes - centre) / scale
    row = np.repeat(np.arange(n), np.diff(bounds))
    common = np.bincount(columns, minlength=m) >= least_docs
    kept = common[columns]
    columns, values, row = columns[kept], values[kept], row[kept]
    above = np.array([(grades >= k).mean() if n else 0.5 for k in range(1, n_grades)]).clip(0.01, 0.99)
    start = np.maximum.accumulate(np.log((1 - above) / above))
    first, gaps = start[:1], np.log(np.maximum(np.diff(start), 0.05))
    theta = np.concatenate([np.zeros(m), np.zeros(SHAPES), first, gaps])
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1 if n else 1):
        w, s = theta[:m], theta[m:m + SHAPES]
        cuts = theta[m + SHAPES] + np.concatenate([[0.0], np.cumsum(np.exp(theta[m + SHAPES + 1:]))])
        score = np.bincount(row, w[columns] * values, n) + x @ s
        up = 1 / (1 + np.exp(np.clip(np.concatenate([[-np.inf], cuts, [np.inf]])[None, :] - score[:, None], -40, 40)))
        up[:, 0], up[:, -1] = 1, 0
        slope = up * (1 - up)
        here = np.maximum(up[np.arange(n), grades] - up[np.arange(n), grades + 1], 1e-9)
        d_score = (slope[np.arange(n), grades] - slope[np.arange(n), grades + 1]) / here
        d_cut = np.zeros((n, n_grades + 1))
        d_cut[np.arange(n), grades] -= slope[np.arange(n), grades] / here
        d_cut[np.arange(n), grades + 1] += slope[np.arange(n), grades + 1] / here
        by_cut = d_cut[:, 1:-1].sum(axis=0)
        tails = np.cumsum(by_cut[::-1])[::-1]
        grad = -np.concatenate([np.bincount(columns, values * d_score[row], m), x.T @ d_score, tails[:1],
                                tails[1:] * np.exp(theta[m + SHAPES + 1:])]) / n
        grad[:m + SHAPES] += ridge * theta[:m + SHAPES]
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        theta -= 0.1 * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.99 ** t)) + 1e-8)
    cuts = theta[m + SHAPES] + np.concatenate([[0.0], np.cumsum(np.exp(theta[m + SHAPES + 1:]))])
    return OrdinalModel(theta[:m].astype(np.float32), theta[m:m + SHAPES], centre, scale, cuts)


def grade_of(quality: Column, toxic: Column) -> Column:
    """0: toxic; 1: of low quality; 2: good. Null if there is no rating."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


def fit_quality(rated: DataFrame, n_grades: int, fit_docs: int = 6000, bits: int = BITS) -> OrdinalModel:
    """Fit on (id, text, grade): about ``fit_docs`` of the rows, those with the smallest hashed ids; null grades are left out."""
    rated = rated.where(F.col("grade").between(0, n_grades - 1))
    share = min(1.0, fit_docs / max(1, rated.count()))
    sample = rated.where(F.xxhash64(F.lit("quality"), "id") / F.lit(float(2 ** 64)) + 0.5 <= share)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, grades = batch.column(0).to_pylist(), batch.column(1)
            for a, b in slices(texts):
                c, v, bounds, shapes = text_features(texts[a:b], bits)
                at = pa.array(bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [grades.slice(a, b - a), pa.ListArray.from_arrays(at, pa.array(c.astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(v.astype(np.float32))),
                     pa.array(shapes.tolist(), pa.list_(pa.float64()))], names=["grade", "columns", "amounts", "shapes"])

    got = sample.select("text", F.col("grade").cast("int").alias("grade")).mapInArrow(
        rows, "grade int, columns array<int>, amounts array<float>, shapes array<double>").toPandas()
    if not len(got):
        return fit_ordinal(np.empty(0, np.int64), np.empty(0), np.zeros(1, np.int64), np.zeros((0, SHAPES)), np.empty(0, np.int64), n_grades, bits)
    return fit_ordinal(np.concatenate(got["columns"].tolist()).astype(np.int64), np.concatenate(got["amounts"].tolist()).astype(float),
                       np.concatenate([[0], np.cumsum(got["columns"].map(len))]).astype(np.int64), np.array(got["shapes"].tolist()),
                       got["grade"].to_numpy(np.int64), n_grades, bits)


def score_quality(df: DataFrame, model: OrdinalModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus expected_grade and p_ge_1, p_ge_2, ... of every whole text. Null text: as the empty text.
    The model (2**18 weights, 1 MB) is broadcast."""
    tails = [f"p_ge_{k + 1}" for k in range(len(model.thresholds))]
    keep = [c for c in (keep if keep is not None else df.columns) if c not in ("expected_grade", *tails)]
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = df.select(*keep).schema
    for c in ("expected_grade", *tails):
        schema = schema.add(c, "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            p = np.concatenate([shared.value.tails(texts[a:b]) for a, b in slices(texts)] or [np.empty((0, len(tails)))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p.sum(axis=1)), *[pa.array(np.ascontiguousarray(p[:, k])) for k in range(p.shape[1])]],
                                             names=[*keep, "expected_grade", *tails])

    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(score, schema)


def grade_documents(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = 6000, least: float = 0.5) -> DataFrame:
    """Grades learned from ``labels`` (id, quality, toxic) and expected for every document.

    Only labels of documents that are not held out (crc32 of the id as text divisible by 5) are learned from. Returns
    (id, held_out, expected_grade, p_ge_1, p_ge_2, kept), one row per input row; kept: P(grade = 2) >= ``least``. Null or repeated labels count as they come:
    null ones are left out, repeated ones weigh more. Null text: as the empty text. No labels: no word has weight. Empty table: no rows.
    """
    rated = (df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(~held_out(F.col("id")))
             .join(labels.select(F.col(id_col).alias("id"), grade_of(F.col("quality"), F.col("toxic")).alias("grade")).where("grade is not null"), "id"))
    share = labels.count()
    # the labelled documents' texts are only fetched for the sample
    if share > fit_docs:
        rated = rated.where(F.xxhash64(F.lit("rated"), "id") / F.lit(float(2 ** 64)) + 0.5 <= 2 * fit_docs / share)
    model = fit_quality(rated, 3, fit_docs)
    out = score_quality(df.withColumn("held_out", held_out(F.col(id_col))), model, text_col, [id_col, "held_out"])
    return out.withColumn("kept", F.col("p_ge_2") >= least)
