"""Exact deduplication with counting quotient filters.

Each partition builds one filter per block of the fingerprint space: a
64-bit fingerprint is split into block, quotient and remainder; a filter
keeps, for each occupied quotient, its run of sorted remainders with counts.
All bits of the fingerprint are kept, so filters of different partitions
merge without loss, as a merge of sorted runs that adds counts. Fingerprints
counted more than once are routed to byte verification: only rows that carry
one are grouped by their whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import merged, settle

FILTER_SCHEMA = ("block int, quotient_bits int, occupied binary, run_lengths binary, "
                 "remainders binary, counts binary")


def encode_filter(values: np.ndarray, counts: np.ndarray, value_bits: int) -> tuple:
    """A counting quotient filter of sorted distinct ``values`` below 2**value_bits."""
    q = min(value_bits, max(0, int(len(values) - 1).bit_length()))
    r = np.uint64(value_bits - q)
    quotients = (values >> r).astype(np.int64) if q else np.zeros(len(values), np.int64)
    runs = np.bincount(quotients, minlength=1 << q)
    remainders = values & np.uint64((1 << (value_bits - q)) - 1)
    return (q, np.packbits(runs > 0).tobytes(), runs[runs > 0].astype("<u4").tobytes(),
            remainders.astype("<u8").tobytes(), counts.astype("<i8").tobytes())


def decode_filter(q: int, occupied: bytes, run_lengths: bytes, remainders: bytes, counts: bytes,
                  value_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted values and counts of a filter."""
    bits = np.unpackbits(np.frombuffer(occupied, np.uint8))[: 1 << q]
    quotients = np.repeat(np.flatnonzero(bits), np.frombuffer(run_lengths, "<u4")).astype(np.uint64)
    high = quotients << np.uint64(value_bits - q) if q else np.zeros(len(quotients), np.uint64)
    return high | np.frombuffer(remainders, "<u8"), np.frombuffer(counts, "<i8")


def merge_sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted (values, counts) runs; counts of equal values add up."""
    values = np.concatenate([v for v, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    if not len(values):
        return values, counts
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[first], np.add.reduceat(counts, first)


def partition_filters(df: DataFrame, fingerprint: str, block_bits: int) -> DataFrame:
    """One row per partition and block: the filter of that partition's fingerprints."""
    value_bits = 64 - block_bits
    schema = pa.schema([("block", pa.int32()), ("quotient_bits", pa.int32()), ("occupied", pa.binary()),
                        ("run_lengths", pa.binary()), ("remainders", pa.binary()), ("counts", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = (np.empty(0, np.uint64), np.empty(0, np.int64))
        for batch in batches:
            v, c = np.unique(batch.column(0).to_numpy().view(np.uint64), return_counts=True)
            merged = merge_sorted([merged, (v, c.astype(np.int64))])
        values, counts = merged
        if not len(values):
            return
        blocks = (values >> np.uint64(value_bits)).astype(np.int64)
        cuts = np.concatenate([np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])), [len(values)]])
        mask = np.uint64((1 << value_bits) - 1)
        rows: list[tuple] = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows.append((int(blocks[a]), *encode_filter(values[a:b] & mask, counts[a:b], value_bits)))
            if len(rows) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    return df.select(fingerprint).mapInArrow(build, FILTER_SCHEMA)


def merged_counts(filters: DataFrame, block_bits: int, least: int = 1) -> DataFrame:
    """Merge the filters of each block; returns (fingerprint, n) with n >= least."""
    value_bits = 64 - block_bits

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged, block = (np.empty(0, np.uint64), np.empty(0, np.int64)), 0
        for batch in batches:
            parts = [merged]
            for x in batch.to_pylist():
                block = x["block"]
                parts.append(decode_filter(x["quotient_bits"], x["occupied"], x["run_lengths"],
                                           x["remainders"], x["counts"], value_bits))
            merged = merge_sorted(parts)
        values, counts = merged
        keep = counts >= least
        full = values[keep] | (np.uint64(block) << np.uint64(value_bits))
        yield pa.RecordBatch.from_arrays([pa.array(full.view(np.int64)), pa.array(counts[keep])],
                                         names=["fingerprint", "n"])

    return filters.groupBy("block").applyInArrow(merge, "fingerprint long, n long")


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bits: int = 12) -> DataFrame:
    """Groups of two or more byte-equal texts: (text_sha256, keep_id, group_size).

    ``keep_id`` is the largest non-null id of the group. Null texts count as
    empty ones. ``block_bits`` sets how many blocks the merge is dealt over.
    """
    rows = (df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .withColumn("fingerprint", F.xxhash64("text")))
    filters = partition_filters(rows, "fingerprint", block_bits)
    repeated = settle(merged_counts(filters, block_bits, least=2).select("fingerprint"), "repeated")
    verified = (rows.join(repeated, "fingerprint", "left_semi")
                .groupBy("fingerprint", "text").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
                .where("group_size > 1")
                .select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))
    return settle(verified, "groups")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bits: int = 12) -> DataFrame:
    """Every input row with its group of byte-equal texts.

    Returns (id, keep_id, group_size, kept, text_sha256), one row per input
    row. Null text: as the empty text. Null id: never the keeper, unless the
    whole group has none (then ``keep_id`` is null and its rows are kept).
    Rows that repeat the keeper's id are all marked kept. Empty table: no
    rows. Other columns are ignored, whatever their names.
    """
    groups = duplicate_groups(df, id_col, text_col, block_bits)
    rows = df.select(F.col(id_col).alias("id"),
                     F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("text_sha256"))
    out = rows.join(groups, "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return out.select(F.col("id").alias(id_col), keep.alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      F.col("id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          block_bits: int = 12) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: those with the
    largest id of their group (rows that repeat that id stay together)."""
    groups = duplicate_groups(df, id_col, text_col, block_bits)
    own = df.withColumn("__sha256", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    lost = groups.select(F.col("text_sha256").alias("__group"), F.col("keep_id").alias("__keep"))
    gone = (own["__sha256"] == lost["__group"]) & ~own[id_col].eqNullSafe(lost["__keep"])
    return own.join(merged(lost), gone, "left_anti").drop("__sha256")  # the groups grow with the input
