"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medlattice.session import ensure_checkpoint_dir

_BASE = 0x2545F4914F6CDD1D
# Freeing one large block raises the C library's bounds from which it returns each array's memory to the system.
np.empty(16 << 20, np.uint8)
_powers: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
# Words are runs of anything but the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    This cuts the lineage at a table that outlives lost executors, and gives
    the planner the written size, so that its own broadcast threshold decides
    on a measured size.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, task, schema) -> DataFrame:  # noqa: ANN001
    """``df.mapInArrow`` in batches of at most some 2 MB. Spark's own bound is 10,000 rows: tens of MB of texts, held several
    times over by the executor's buffers and by its worker. Set for the session, unless it has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(key, None) is None:
        df.sparkSession.conf.set(key, "2m")
    return df.mapInArrow(task, schema)


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join by shuffles at every size. For tables that grow with the input: files of few
    distinct values are small, so Spark would broadcast tables that are many times their size in memory."""
    return df.hint("merge")


def word_count(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def slices(texts: list, max_chars: int = 2_000_000):
    """(start, end) ranges of ``texts`` of about ``max_chars`` characters each;
    a longer text is a range of its own, so memory follows the longest text."""
    start = used = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and used + n > max_chars:
            yield start, i
            start, used = i, 0
        used += n
    if start < len(texts):
        yield start, len(texts)


def text_slices(column: pa.Array, most_bytes: int = 1 << 18) -> Iterator[tuple[int, list]]:
    """(start, texts) of consecutive rows of a string array, of about ``most_bytes`` each; a longer text comes alone. Only
    one slice at a time is turned into Python strings, so a task's memory follows the Arrow batch and the longest text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield start, column.slice(start, end - start).to_pylist()
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (xor-shift multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(texts: list, punctuation: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, ASCII letters lower-cased, of some texts, and where each text's begin
    (len(texts) + 1 places). A word's hash is a polynomial, taken from running sums over the bytes. Without
    ``punctuation``, all ASCII but letters and digits parts words."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    ends = np.cumsum([len(x) + 1 for x in raw])
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    if not punctuation:
        blank = (data < 48) | ((data > 57) & (data < 97)) | ((data > 122) & (data < 128))  # capitals are lower-cased
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    powers, inverse = _power_tables(len(data))
    run = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)])
    hashes = mix64((run[last] - run[first]) * inverse[first] + (last - first).astype(np.uint64))
    return hashes, np.concatenate([[0], np.searchsorted(first, ends)])
