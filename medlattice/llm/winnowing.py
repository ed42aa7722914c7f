"""Document fingerprints by winnowing, with DataFrame functions only.

A text is lower-cased and cut into units (words, or code points). The hash of each
k-gram is a polynomial modulo a prime, composed from the hashes of its halves,
so a gram costs log2(k) steps. Of each window of ``window`` consecutive grams the
smallest hash is chosen, the rightmost one among ties, and its position is kept.
Two texts that share a run of ``k + window - 1`` units share a fingerprint. Window minima are
composed by halves as well. Everything stays in JVM array expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRIME = 2147483647
BASE = 1000003
POSITIONS = 2147483647  # positions fit 31 bits


def _zip(df: DataFrame, name: str, array: str, shift: int, fn) -> DataFrame:
    """``name`` = fn(a[i], a[i + shift]) for every i that has both."""
    a = F.col(array)
    head = F.slice(a, 1, F.greatest(F.size(a) - shift, F.lit(0)))
    tail = F.slice(a, shift + 1, F.greatest(F.size(a) - shift, F.lit(0)))
    return df.withColumn(name, F.zip_with(head, tail, fn))


def _poly(power: int):
    factor = pow(BASE, power, PRIME)
    return lambda a, b: (a * F.lit(factor) + b) % F.lit(PRIME)


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = 4, window: int = 8,
                     unit: str = "word") -> DataFrame:
    """Adds ``name``: array<long> of chosen grams in text order, each ``hash * 2^31 +
    (2^31 - 1 - position)``; :func:`gram_hash` and :func:`gram_position` take them apart.

    ``k`` and ``window`` are powers of two. A text with fewer than ``k`` units is one
    gram; with fewer grams than a window, one window. Null, empty or blank texts have none.
    """
    if k & (k - 1) or window & (window - 1):
        raise ValueError("k and window must be powers of two")
    text_col = F.lower(F.coalesce(F.col(text), F.lit("")))
    cut = r"[\x20\x09-\x0D]+" if unit == "word" else ""
    u, g, m = f"__{name}_units", f"__{name}_grams", f"__{name}_mins"
    out = df.withColumn(u, F.filter(F.split(text_col, cut), lambda x: x != ""))
    out = out.withColumn(g, F.transform(u, lambda x: F.pmod(F.xxhash64(x), F.lit(PRIME))))
    whole = F.aggregate(g, F.lit(0).cast("long"), lambda s, x: (s * F.lit(BASE) + x) % F.lit(PRIME))
    out = out.withColumn(u, F.when((F.size(g) > 0) & (F.size(g) < k), F.array(whole)))
    span = 1
    while span < k:
        out = _zip(out, g, g, span, _poly(span))
        span *= 2
    out = out.withColumn(g, F.coalesce(F.col(u), F.col(g)))
    out = out.withColumn(g, F.transform(g, lambda h, i: h * F.lit(POSITIONS + 1) + (F.lit(POSITIONS) - i)))
    out = out.withColumn(u, F.when((F.size(g) > 0) & (F.size(g) < window), F.array(F.array_min(g))))
    out = out.withColumn(m, F.col(g))
    span = 1
    while span < window:
        out = _zip(out, m, m, span, lambda a, b: F.least(a, b))
        span *= 2
    return out.withColumn(name, F.array_distinct(F.coalesce(F.col(u), F.col(m)))).drop(u, g, m)


def gram_hash(gram: Column) -> Column:
    return F.shiftright(gram, 31)


def gram_position(gram: Column) -> Column:
    return F.lit(POSITIONS) - gram.bitwiseAND(F.lit(POSITIONS))


def gram_hashes(fingerprint: Column) -> Column:
    """Distinct chosen hashes, without positions."""
    return F.array_distinct(F.transform(fingerprint, gram_hash))


def as_text(fingerprint: Column) -> Column:
    """``hash@position`` items, comma-joined."""
    return F.array_join(F.transform(fingerprint, lambda g: F.concat(
        F.lower(F.hex(gram_hash(g))), F.lit("@"), gram_position(g).cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; two empty ones are alike (1)."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union).cast("double")


def in_blocks(df: DataFrame, key: str, text: str, blocks: int = 4096, rows_per_block: int = 500) -> DataFrame:
    """The rows (key, text) with ``__block`` and ``__sentinel`` (0), for :func:`next_values`.

    Rows are dealt to blocks between quantiles of the key (at most ``blocks``,
    so that no block grows with a gap or a cluster of keys), and
    each block also gets a copy (``__sentinel`` 1) of the first row of the next one.
    """
    n = df.count()
    count = max(1, min(blocks, n // rows_per_block))
    cuts = []
    if count > 1:
        shares = [i / count for i in range(1, count)]
        cuts = sorted(set(df.agg(F.percentile_approx(key, shares, 20 * count)).first()[0] or []))
    block = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(key))) if cuts else F.lit(0)
    rows = df.withColumn("__block", F.greatest(block, F.lit(0)))
    # at most `blocks` + 1 rows: the first key of each block
    firsts = rows.groupBy("__block").agg(F.max(key).alias("__key"))
    around = Window.orderBy("__block")
    firsts = firsts.withColumn("__goes", F.coalesce(F.lead("__block").over(around), F.min("__block").over(Window.partitionBy())))
    heads = (rows.join(F.broadcast(firsts.withColumnRenamed("__block", "__from")),
                       (F.col("__block") == F.col("__from")) & F.col(key).eqNullSafe(F.col("__key")))
             .groupBy("__goes").agg(F.max(text).alias(text))
             .select(F.lit(None).cast(df.schema[key].dataType).alias(key), text, F.col("__goes").alias("__block"), F.lit(1).alias("__sentinel")))
    return rows.select(key, text, "__block", F.lit(0).alias("__sentinel")).unionByName(heads)


def next_values(blocked: DataFrame, key: str, text: str, columns: list[str]) -> DataFrame:
    """Adds ``next_<column>`` of the next row in descending key order; the last row is followed by
    the first. Null keys come last; equal keys are ordered by text, downwards."""
    order = Window.partitionBy("__block").orderBy("__sentinel", F.col(key).desc_nulls_last(), F.col(text).desc_nulls_last())
    following = blocked.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return following.where("__sentinel = 0").drop("__block", "__sentinel")


def fingerprint_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, window: int = 8,
                      unit: str = "word") -> DataFrame:
    """Each text's fingerprint, that of its edited text, and their likeness.

    The edited text replaces the last floor(n / 2) code points by the first as many (or all) of
    the next text in descending id order (after the last row: the first). Returns (id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per input row. Null text: empty.
    Null ids come last; a single row is its own successor. Empty table: no rows.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows = with_fingerprint(in_blocks(rows, "id", "body"), "body", "print", k, window, unit)
    rows = next_values(rows, "id", "body", ["body", "print"])
    rows = rows.withColumn("hashes", gram_hashes(F.col("print"))).withColumn("next_hashes", gram_hashes(F.col("next_print")))
    rows = rows.withColumn("n_chars", F.char_length("body").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.expr("substring(body, 1, cast(n_chars - floor(n_chars / 2) as int))"),
        F.substring(F.col("next_body"), F.lit(1), half)))
    rows = with_fingerprint(rows, "edited", "edited_print", k, window, unit)
    rows = rows.withColumn("edited_hashes", gram_hashes(F.col("edited_print")))
    return rows.select(F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("print")).alias("fingerprint"), as_text(F.col("edited_print")).alias("edited_fingerprint"),
                       likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
                       likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"))
