"""Scalar building blocks. Every function returns a JVM-side ``Column``.

Nothing here is a Python UDF: each helper composes built-in expressions so
that it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values of the deterministic hash (a prime modulus, a multiplier,
# and the per-model stride); DuckDB oracles repeat the same arithmetic.
HASH_MODULUS = 10007
HASH_MULTIPLIER = 7919
HASH_STRIDE = 104729


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """text to date; malformed text gives null (also under ANSI mode)."""
    return F.to_date(F.try_to_timestamp(_c(c), F.lit(fmt)))


# ISO-8601 zone forms accepted by F4 (Z, +hh, +hhmm, +hh:mm).
ISO_ZONED_PATTERNS = ("yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ssXXX")


def parse_iso_zoned_date(c: ColumnOrName, patterns: tuple[str, ...] = ISO_ZONED_PATTERNS) -> Column:
    """ISO-8601 timestamp with a zone (``2010-01-31T10:00:00Z``) to its
    UTC calendar date, whatever the session time zone; null if unparsable."""
    ts = F.coalesce(*[F.try_to_timestamp(_c(c), F.lit(p)) for p in patterns])
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))


def shift_days(c: ColumnOrName, days: int) -> Column:
    """date plus (or minus, when negative) a number of days."""
    return F.date_add(_c(c), days)


def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """whole days from ``earlier`` to ``later`` as a long."""
    return F.datediff(_c(later), _c(earlier)).cast("long")


def event_kind(event_id: ColumnOrName) -> Column:
    """First character of the event id (``D`` for DIAG/DRUG, ``L`` for LAB)."""
    return F.substring(_c(event_id), 1, 1)


def normalized_name(c: ColumnOrName) -> Column:
    """F6 plus trimming: names compared lower-case without outer blanks."""
    return F.lower(F.trim(_c(c)))


def number_with_commas(c: ColumnOrName) -> Column:
    """``"1,234.5"`` to 1234.5; empty or malformed text gives null."""
    return F.regexp_replace(_c(c), ",", "").try_cast("double")


def icd9_main_digits(c: ColumnOrName) -> Column:
    """F8: main ICD-9 digits: first four characters of E-codes, else first three."""
    code = _c(c).cast("string")
    return F.when(code.startswith("E"), F.substring(code, 1, 4)).otherwise(F.substring(code, 1, 3))


def svmlight_pair(idx: ColumnOrName, value: ColumnOrName) -> Column:
    """F9 for one pair: ``idx:value`` with six decimals."""
    return F.format_string("%d:%.6f", _c(idx), F.round(_c(value), 6))


def svmlight_features(pairs: ColumnOrName) -> Column:
    """An array of ``struct(idx, value)`` to ``"i:v i:v ..."`` ascending by idx."""
    return F.array_join(
        F.transform(F.array_sort(_c(pairs)), lambda p: svmlight_pair(p["idx"], p["value"])), " ")


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """F16: num / den with 0 for an undefined ratio."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), F.lit(0.0))


def stable_uniform(key: ColumnOrName, seed: int, stream: ColumnOrName | int = 0) -> Column:
    """A deterministic number in [0, 1) from an integer key.

    x = (key * 7919 + stream * 104729 + seed) mod 10007, then x^3 mod 10007
    (a bijection, since 3 does not divide 10006) scaled to [0, 1). It does
    not depend on partitioning or task order, so re-runs and lost executors
    give the same split, and SQL engines can repeat it.
    """
    stream_c = F.lit(stream) if isinstance(stream, int) else _c(stream)
    x = F.pmod(_c(key).cast("long") * HASH_MULTIPLIER + stream_c.cast("long") * HASH_STRIDE + seed,
               F.lit(HASH_MODULUS))
    cube = F.pmod(F.pmod(x * x, F.lit(HASH_MODULUS)) * x, F.lit(HASH_MODULUS))
    return cube.cast("double") / HASH_MODULUS


def stable_uniform_sql(key: str, seed: int, stream: str | int = 0) -> str:
    """The SQL text of :func:`stable_uniform` (used by oracles and docs)."""
    x = f"(({key}) * {HASH_MULTIPLIER} + ({stream}) * {HASH_STRIDE} + {seed}) % {HASH_MODULUS}"
    return (f"CAST((((({x}) * ({x})) % {HASH_MODULUS}) * ({x})) % {HASH_MODULUS} AS DOUBLE)"
            f" / {HASH_MODULUS}")


def membership_flag(matched_key: ColumnOrName) -> Column:
    """1 when a left-joined key matched, else 0."""
    return _c(matched_key).isNotNull().cast("int")


def sigmoid(margin: ColumnOrName) -> Column:
    """logistic function."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(margin)))


def argmax_index(arr: ColumnOrName) -> Column:
    """0-based position of the largest element (first one on ties)."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")
