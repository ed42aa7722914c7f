"""M11 for wide data: principal components by randomised subspace iteration over sparse entries.

Entries are rows (key, idx, value); a basis is a table with a row per column index and one column per direction. A round is two joins with
sums, and the driver only sees matrices of directions x directions, so neither rows nor columns of the data meet in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlattice.operators.metrics import attach_row
from medlattice.session import maybe_broadcast, written

# Directions beyond those asked for (a usual choice of the method).
OVERSAMPLE = 8
# Up to so many columns, there are as many directions: the first round then finds the whole space, however close the variances are.
WHOLE = 128
# Entries of one column index per (index, salt) task where the basis is too large to broadcast.
SALT_TARGET = 100_000


def _names(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def _matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])


def _turned(df: DataFrame, key: str, names: list[str], by: list[np.ndarray], out: list[str]) -> DataFrame:
    """Rows times small matrices, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch, names)
            for m in by:
                rows = rows @ m
            yield pa.RecordBatch.from_arrays([batch.column(key), *[pa.array(rows[:, j]) for j in range(len(out))]], names=[key, *out])

    schema = T.StructType([df.schema[key], *[T.StructField(o, T.DoubleType()) for o in out]])
    return df.select(key, *names).mapInArrow(run, schema)


def _gram(df: DataFrame, names: list[str]) -> np.ndarray:
    """The matrix of inner products of the columns: directions x directions, whatever the table's size. A task sends one such matrix."""
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for batch in batches:
            rows = _matrix(batch, names)
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(range(n * n), pa.int32()), pa.array(total.ravel())], names=["i", "v"])

    out = np.zeros(n * n)
    for r in df.select(*names).mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r.i] = r.v
    return out.reshape(n, n)


def _whitener(gram: np.ndarray) -> np.ndarray:
    """The matrix that makes columns with these inner products orthonormal; directions without length vanish."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > max(values.max(), 0.0) * 1e-13
    return vectors[:, keep] / np.sqrt(values[keep]) if keep.any() else np.zeros((len(gram), 0))


def _orthonormal(df: DataFrame, names: list[str], label: str) -> tuple[DataFrame, list[str]]:
    """The table with orthonormal columns q0.. that span the same (none, if there is none); twice, since once loses digits."""
    by = [_whitener(_gram(df, names))]
    if by[0].shape[1]:
        by.append(_whitener(_gram(_turned(df, "idx", names, by, _names("q", by[0].shape[1])), _names("q", by[0].shape[1]))))
    new = _names("q", by[-1].shape[1])
    return (written(_turned(df, "idx", names, by, new), label) if new else df), new


def principal_components(entries: DataFrame, k: int, key: str = "patient_id", keys: DataFrame | None = None, seed: int = 0,
                         tolerance: float = 1e-6, max_rounds: int = 100, salt_target: int = SALT_TARGET,
                         broadcast_basis: bool = True) -> tuple[DataFrame, DataFrame, list[float]]:
    """(scores, components, variances) of the centered matrix of entries (key, idx, value).

    scores: key, c0..: each row's components; components: idx, c0.. with orthonormal columns; variances: those of the scores, falling.
    Entries that are absent are 0, those of a repeated (key, idx) are added, rows with a null are ignored. ``keys`` names rows without
    entries as well; they are rows of zeros. Of a component the entry with the largest size (ties: smallest idx) is positive. Fewer
    than k are returned if the data have fewer directions. Rounds go on until the leading variances settle; if they do not, it raises.
    """
    e = written(entries.select(key, "idx", "value").dropna().groupBy(key, "idx").agg(F.sum(F.col("value").cast("double")).alias("value")), "component-entries")
    rows = e.select(key) if keys is None else e.select(key).unionByName(keys.select(key).dropna())
    rows = written(rows.distinct(), "component-rows")
    n = rows.count()
    basis = written(e.select("idx").distinct(), "component-columns")
    columns = basis.count()
    width = max(k + OVERSAMPLE, columns if columns <= WHOLE else 0)
    names = _names("q", width)
    # Signs from hashes: the same start however the data are partitioned.
    basis = basis.select("idx", *[(1.0 - 2.0 * F.pmod(F.shiftright(F.xxhash64("idx", F.lit(seed), F.lit(i)), 17), F.lit(2))).alias(q) for i, q in enumerate(names)])
    basis, names = _orthonormal(basis, names, "component-basis")
    if not names or n < 2:
        return rows.limit(0), basis.select("idx").limit(0), []
    means = written(e.groupBy("idx").agg((F.sum("value") / n).alias("mean")), "component-means")
    ways = e.groupBy("idx").agg(F.ceil(F.count(F.lit(1)) / F.lit(salt_target)).alias("ways")).where("ways > 1")
    salts = F.coalesce("ways", F.lit(1))
    salted = e.join(maybe_broadcast(ways), "idx", "left").withColumn("salt", F.pmod(F.xxhash64(key), salts)).drop("ways")

    def project(basis: DataFrame, names: list[str]) -> DataFrame:
        """key, y0..: centered rows times the basis."""
        out = _names("y", len(names))
        small = maybe_broadcast(basis) if broadcast_basis else basis
        if small is basis:
            fan = (basis.join(maybe_broadcast(ways), "idx", "left")
                   .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("ways"))
            met = salted.join(fan, ["idx", "salt"])
        else:
            met = e.join(small, "idx")
        sums = met.groupBy(key).agg(*[F.sum(F.col("value") * F.col(q)).alias(o) for q, o in zip(names, out)])
        shift = means.join(basis, "idx").agg(*[F.sum(F.col("mean") * F.col(q)).alias(f"m_{o}") for q, o in zip(names, out)])
        full = attach_row(rows.join(sums, key, "left"), shift)
        return written(full.select(key, *[(F.coalesce(o, F.lit(0.0)) - F.col(f"m_{o}")).alias(o) for o in out]), "component-scores")

    before = None
    for _ in range(max_rounds):
        y = project(basis, names)
        ynames = _names("y", len(names))
        values, turn = np.linalg.eigh(_gram(y, ynames))
        values, turn = values[::-1], turn[:, ::-1]
        lead = values[:k]
        if before is not None and len(before) == len(lead) and np.abs(lead - before).max() <= tolerance * max(lead[0], 1e-300):
            break
        before = lead
        # Back to columns: the sum of y over all rows is 0, so the means take no part.
        z = e.join(y, key).groupBy("idx").agg(*[F.sum(F.col("value") * F.col(o)).alias(o) for o in ynames])
        basis, names = _orthonormal(written(z, "component-columns"), ynames, "component-basis")
        if not names:
            return rows.limit(0), means.select("idx").limit(0), []
    else:
        raise RuntimeError(f"the components did not settle in {max_rounds} rounds")
    keep = int((lead > max(lead[0], 0.0) * 1e-12).sum())
    turn, out = turn[:, :keep], _names("c", keep)
    comps = _turned(basis, "idx", names, [turn], out)
    signs = comps.agg(*[F.max(F.struct(F.abs(c), -F.col("idx"), F.signum(c).alias("s")))["s"].alias(c) for c in out]).first()
    turn = turn * np.array([s or 1.0 for s in signs])
    return (_turned(y, key, ynames, [turn], out), _turned(basis, "idx", names, [turn], out), [float(v) / (n - 1) for v in lead[:keep]])
