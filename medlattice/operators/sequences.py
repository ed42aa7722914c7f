"""Visit-sequence datasets: code map, per-patient visit sequences, multi-hot.

Long form ``(subject_id, visit_no, code_idx)`` is the working shape: it is
built with joins and a distributed visit numbering, never by collecting a
patient's history into one value. The nested form (a list of visits of
codes, one row per subject) is offered for consumers that need that
format; the registered queries use the long form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.functions.scalars import icd9_main_digits
from medlattice.operators.indexing import dense_index
from medlattice.session import maybe_broadcast


def build_codemap(diagnoses: DataFrame, transform: Callable[[Column], Column] = icd9_main_digits,
                  code_col: str = "icd9") -> DataFrame:
    """Transformed codes of the given (train) diagnoses numbered 0..
    in code order; nulls ignored. -> code, code_idx (settled: computed once,
    with its measured size, so joins against it can be size-checked)"""
    codes = diagnoses.select(transform(F.col(code_col)).alias("code")).where(F.col("code").isNotNull())
    return dense_index(codes, ["code"], "code_idx").select("code", "code_idx")


def visit_codes(diagnoses: DataFrame, codemap: DataFrame,
                transform: Callable[[Column], Column] = icd9_main_digits, code_col: str = "icd9") -> DataFrame:
    """hadm_id, code_idx per diagnosis row; codes unknown to the map are dropped."""
    d = diagnoses.select("hadm_id", transform(F.col(code_col)).alias("code"))
    return d.join(maybe_broadcast(codemap), "code").select("hadm_id", "code_idx")


def numbered_visits(admissions: DataFrame) -> DataFrame:
    """visit_no 1.. per subject by admit time, ties by hadm_id.

    Not a window partitioned by subject (a subject with a third of all
    stays would sit in one task): every stay gets its global position in
    (subject, admit_time, hadm_id) order from the range-partitioned dense
    index, and visit_no = position - first position of the subject + 1;
    the first position is a partial-aggregated minimum per subject.
    """
    keys = ["subject_id", "admit_time", "hadm_id"]
    return admissions.join(numbered_visit_keys(admissions), keys)


def numbered_visit_keys(admissions: DataFrame) -> DataFrame:
    """Distinct (subject_id, admit_time, hadm_id) with their visit_no: the
    numbering of :func:`numbered_visits` without joining back to the
    admission rows (one row per stay key; repeated admission rows collapse)."""
    keys = ["subject_id", "admit_time", "hadm_id"]
    pos = dense_index(admissions, keys, "_g")
    first = pos.groupBy("subject_id").agg(F.min("_g").alias("_f"))
    return (pos.join(first, "subject_id")
            .select(*keys, (F.col("_g") - F.col("_f") + 1).cast("int").alias("visit_no")))


def visit_code_rows(admissions: DataFrame, diagnoses: DataFrame, codemap: DataFrame,
                    transform: Callable[[Column], Column] = icd9_main_digits) -> DataFrame:
    """subject_id, hadm_id, code_idx (+ split) without visit order: enough
    for order-free statistics such as sequence sizes."""
    c = visit_codes(diagnoses, codemap, transform)
    keep = ["subject_id", "hadm_id"] + [x for x in ("split",) if x in admissions.columns]
    return admissions.select(*keep).join(c, "hadm_id", "left").select(*keep, "code_idx")


def visit_code_counts(admissions: DataFrame, diagnoses: DataFrame, codemap: DataFrame,
                      transform: Callable[[Column], Column] = icd9_main_digits) -> DataFrame:
    """subject_id, hadm_id, n_known (+ split): one row per admission row with
    the number of its diagnoses whose code is in the map (0 when none).

    The count per stay is partial-aggregated before the shuffle on hadm_id,
    so diagnosis rows never cross the network; only one row per stay does.
    """
    n = (visit_codes(diagnoses, codemap, transform)
         .groupBy("hadm_id").agg(F.count(F.lit(1)).alias("n_known")))
    keep = ["subject_id", "hadm_id"] + [x for x in ("split",) if x in admissions.columns]
    return (admissions.select(*keep).join(n, "hadm_id", "left")
            .select(*keep, F.coalesce(F.col("n_known"), F.lit(0)).alias("n_known")))


def visit_sequence_long(admissions: DataFrame, diagnoses: DataFrame, codemap: DataFrame,
                        transform: Callable[[Column], Column] = icd9_main_digits) -> DataFrame:
    """D12 (long): subject_id, visit_no, hadm_id, code_idx (null for a visit
    without known codes, J19). Repeated codes of a visit are kept."""
    v = numbered_visits(admissions)
    c = visit_codes(diagnoses, codemap, transform)
    return v.join(c, "hadm_id", "left").select("subject_id", "visit_no", "hadm_id", "code_idx",
                                               *[x for x in ("split",) if x in admissions.columns])


def subject_labels(mortality: DataFrame) -> DataFrame:
    """One label per subject (the smallest, deterministic)."""
    return mortality.groupBy("subject_id").agg(F.min("mortality").alias("label"))


def sequence_sizes(long_df: DataFrame, labels: DataFrame) -> DataFrame:
    """subject_id, label, n_visits, n_codes per subject.

    ``long_df`` is either the long form (one row per visit code, ``code_idx``)
    or the per-stay counts of ``visit_code_counts`` (``n_known``); the
    latter gives the same numbers from one row per stay.
    """
    keys = ["subject_id"] + (["split"] if "split" in long_df.columns else [])
    codes = (F.sum("n_known") if "n_known" in long_df.columns else F.count("code_idx")).cast("long")
    s = long_df.groupBy(*keys).agg(F.countDistinct("hadm_id").alias("n_visits"), codes.alias("n_codes"))
    return s.join(labels, "subject_id", "left")


def visit_sequences_nested(long_df: DataFrame, labels: DataFrame) -> DataFrame:
    """D12 (nested): subject_id, label, seqs = visits in order, each the
    list of code indexes (ascending). Two-level collect: codes per visit,
    then visits per subject (bounded by the subject's own history)."""
    per_visit = long_df.groupBy("subject_id", "visit_no").agg(
        F.array_sort(F.collect_list("code_idx")).alias("codes"))
    per_subject = per_visit.groupBy("subject_id").agg(
        F.array_sort(F.collect_list(F.struct("visit_no", "codes"))).alias("_v"))
    return (per_subject.join(labels, "subject_id", "left")
            .select("subject_id", "label", F.transform("_v", lambda x: x["codes"]).alias("seqs")))


def num_features(long_df: DataFrame) -> DataFrame:
    """Max code index + 1 over the sequences (0 when there is none)."""
    return long_df.agg((F.coalesce(F.max("code_idx"), F.lit(-1)) + 1).cast("long").alias("num_features"))


def multi_hot(long_df: DataFrame) -> DataFrame:
    """D13/F20 on indices: distinct (subject, visit, code) -- duplicates collapse."""
    return (long_df.where(F.col("code_idx").isNotNull())
            .select("subject_id", "visit_no", "code_idx").distinct())


def multi_hot_visits(admissions: DataFrame, diagnoses: DataFrame, codemap: DataFrame,
                     transform: Callable[[Column], Column] = icd9_main_digits) -> DataFrame:
    """D13/F20 from the raw tables: the rows of :func:`multi_hot`.

    The known codes of a stay become one set before the shuffle on hadm_id
    (``collect_set`` combines map-side; a set is bounded by the code map),
    so diagnosis rows never cross the network. One row per stay key joins
    its set and is exploded; every stay key has its own visit number, so
    the rows are already distinct and no final shuffle is needed.
    """
    sets = (visit_codes(diagnoses, codemap, transform)
            .groupBy("hadm_id").agg(F.collect_set("code_idx").alias("_codes")))
    visits = numbered_visit_keys(admissions).select("hadm_id", "subject_id", "visit_no")
    return (visits.join(sets, "hadm_id")
            .select("subject_id", "visit_no", F.explode("_codes").alias("code_idx")))


def multi_hot_vectors(long_df: DataFrame, n_features: int) -> DataFrame:
    """One 0/1 vector per (subject, visit); empty visits give a zero vector."""
    from pyspark.ml.functions import array_to_vector

    per_visit = long_df.groupBy("subject_id", "visit_no").agg(
        F.array_distinct(F.collect_list("code_idx")).alias("_c"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(n_features - 1)),
                        lambda i: F.when(F.array_contains("_c", i), F.lit(1.0)).otherwise(F.lit(0.0)))
    return per_visit.select("subject_id", "visit_no", array_to_vector(dense).alias("multi_hot"))
