"""Event -> feature ETL, svmlight lines, feature tuples and vectors.

Long form ``(patient_id, idx, value)`` is the working representation: it
needs no pivot, and a patient's row count is bounded by the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.functions.scalars import (event_kind, membership_flag, stable_uniform,
                                          svmlight_features)
from medlattice.operators.indexing import dense_index
from medlattice.session import maybe_broadcast, proven_small

# Fixed values of the Pig variant: the split seed and the test share.
SPLIT_SEED = 6505
TEST_SHARE = 0.20


def feature_map_by_name(events: DataFrame, start: int = 0) -> DataFrame:
    """Distinct event ids ranked by name -> (idx, event_id), settled
    (computed once, with its measured size, for the size-checked joins)."""
    return dense_index(events, ["event_id"], "idx", start=start).select("idx", "event_id")


def _normalize_by_feature_max(values: DataFrame, key: str, value: str, out: str,
                              key_table: DataFrame | None = None) -> DataFrame:
    """A9 + F11: value / max(value) per feature; 0/0 rows are dropped.

    The per-feature maximum is a partial-aggregated ``groupBy`` (one row per
    feature) joined back, broadcast only when its size is proven small, so
    a hot feature never lands in one window partition. The optimizer sizes
    an aggregate like its input, so ``key_table`` (the feature map: at most
    one maximum per entry) may serve as the proof instead.
    """
    maxima = values.groupBy(key).agg(F.max(value).alias("_max"))
    if key_table is not None and proven_small(key_table):
        side = F.broadcast(maxima)
    else:
        side = maybe_broadcast(maxima)
    return (values.join(side, key)
            .withColumn(out, F.try_divide(F.col(value).cast("double"), F.col("_max").cast("double")))
            .where(F.col(out).isNotNull())
            .drop("_max"))


def aggregate_events(filtered: DataFrame, feature_map: DataFrame) -> DataFrame:
    """Sum of values for DIAG/DRUG events, count for LAB events, per
    (patient, feature index); rounded to 6 places, divided by the feature max.

    Returns patient_id, feature_id, feature_value (and label when the
    windowed events carry one: it depends on the patient only, so keeping
    it as a grouping key costs nothing and spares a later join).
    """
    j = (filtered.where(F.col("value").isNotNull())
         .join(maybe_broadcast(feature_map), "event_id"))
    contrib = F.when(event_kind("event_id") == "L", F.lit(1.0)).otherwise(F.col("value"))
    keys = ["patient_id"] + (["label"] if "label" in filtered.columns else [])
    agg = (j.groupBy(*keys, F.col("idx").alias("feature_id"))
           .agg(F.round(F.sum(contrib), 6).alias("v")))
    return _normalize_by_feature_max(agg, "feature_id", "v", "feature_value", key_table=feature_map).drop("v")


def count_features(filtered: DataFrame) -> DataFrame:
    """Non-null value counts per (patient, event id), index by event-id
    rank (0-based), divided by the feature max.

    Returns patient_id, idx, normalized_value (and label, as in
    :func:`aggregate_events`).
    """
    keys = ["patient_id"] + (["label"] if "label" in filtered.columns else [])
    counts = (filtered.where(F.col("value").isNotNull())
              .groupBy(*keys, "event_id").agg(F.count("value").alias("featurevalue")))
    fmap = feature_map_by_name(counts)
    feats = counts.join(maybe_broadcast(fmap), "event_id").select(*keys, "idx", "featurevalue")
    return _normalize_by_feature_max(feats, "idx", "featurevalue", "normalized_value",
                                     key_table=fmap).drop("featurevalue")


def patient_labels(patients: DataFrame, mortality: DataFrame) -> DataFrame:
    """1 when the patient is in mortality, else 0."""
    dead = mortality.select(F.col("patient_id").alias("_dead_id")).distinct()
    return (patients.join(dead, patients.patient_id == dead._dead_id, "left")
            .withColumn("label", membership_flag("_dead_id")).drop("_dead_id"))


def svmlight_rows(features: DataFrame, labels: DataFrame | None = None, idx: str = "feature_id",
                  value: str = "feature_value") -> DataFrame:
    """One row per patient: patient_id, label, features ("i:v ..." ascending).

    ``labels`` holds patient_id, label (patients without one get 0); when
    it is None the features' own label column is used, in the same
    aggregate (no join). The collected list per patient is bounded by the
    vocabulary size.
    """
    pairs = svmlight_features(F.collect_list(F.struct(F.col(idx).alias("idx"), F.col(value).alias("value"))))
    if labels is None:
        return features.groupBy("patient_id").agg(
            F.coalesce(F.max("label"), F.lit(0)).alias("label"), pairs.alias("features"))
    per_patient = features.groupBy("patient_id").agg(pairs.alias("features"))
    return (per_patient.join(labels.select("patient_id", "label"), "patient_id", "left")
            .select("patient_id", F.coalesce("label", F.lit(0)).alias("label"), "features"))


def svmlight_text(rows: DataFrame, with_id: bool = False) -> DataFrame:
    """The two svmlight layouts as a single ``value`` text column.

    ``label feats `` or ``id label feats `` (a trailing blank, as the
    original deliverable writes it).
    """
    parts = ([F.col("patient_id").cast("string")] if with_id else []) + [
        F.col("label").cast("string"), F.col("features")]
    return rows.select(F.concat(F.concat_ws(" ", *parts), F.lit(" ")).alias("value"))


def split_samples(rows: DataFrame, seed: int = SPLIT_SEED, test_share: float = TEST_SHARE) -> DataFrame:
    """D5d/P14: train/test by a deterministic hash of the patient id."""
    u = stable_uniform("patient_id", seed)
    return rows.withColumn("split", F.when(u <= test_share, F.lit("test")).otherwise(F.lit("train")))


def labeled_samples(features_b: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """D5d: svmlight rows of the count features with their window labels, split.

    The labels travel with the count features (see :func:`count_features`);
    a separate (patient_id, label) table may be given instead.
    """
    rows = svmlight_rows(features_b, labels, idx="idx", value="normalized_value")
    return split_samples(rows)


# ---------------------------------------------------------------- D7 / D8

def _restrict(df: DataFrame, col: str, candidates: Iterable[str] | DataFrame | None) -> DataFrame:
    """Keep rows whose ``col`` is a candidate; constants via isin, a
    candidate table via a semi join (broadcast only when proven small)."""
    if candidates is None:
        return df
    if isinstance(candidates, DataFrame):
        cand = candidates.select(F.col(candidates.columns[0]).alias(col)).distinct()
        return df.join(maybe_broadcast(cand), col, "left_semi")
    return df.where(F.col(col).isin(list(candidates)))


def diagnostic_feature_tuples(diagnostic: DataFrame, candidates=None) -> DataFrame:
    """(patient_id, feature_name, value=count) per diagnosis code."""
    d = _restrict(diagnostic, "code", candidates)
    return (d.groupBy("patient_id", F.col("code").alias("feature_name"))
            .agg(F.count(F.lit(1)).cast("double").alias("value")))


def medication_feature_tuples(medication: DataFrame, candidates=None) -> DataFrame:
    """(patient_id, feature_name, value=count) per medicine."""
    m = _restrict(medication, "medicine", candidates)
    return (m.groupBy("patient_id", F.col("medicine").alias("feature_name"))
            .agg(F.count(F.lit(1)).cast("double").alias("value")))


def lab_feature_tuples(lab: DataFrame, candidates=None) -> DataFrame:
    """(patient_id, feature_name, value=average) per test; one ``avg``
    instead of joining a sum and a count."""
    lab = _restrict(lab, "test_name", candidates)
    return (lab.groupBy("patient_id", F.col("test_name").alias("feature_name"))
            .agg(F.avg("value").alias("value")))


def feature_tuples(diagnostic: DataFrame, medication: DataFrame, lab: DataFrame,
                   diag_candidates=None, med_candidates=None, lab_candidates=None) -> DataFrame:
    """The three tuple sets with their source, so equal names never collide."""
    return (diagnostic_feature_tuples(diagnostic, diag_candidates).withColumn("source", F.lit("diagnostic"))
            .unionByName(medication_feature_tuples(medication, med_candidates).withColumn("source", F.lit("medication")))
            .unionByName(lab_feature_tuples(lab, lab_candidates).withColumn("source", F.lit("lab"))))


def feature_tuples_from_records(records: DataFrame, candidates: dict[str, Iterable[str]] | None = None) -> DataFrame:
    """D7 in one pass over a long clinical table (patient_id, kind, name,
    value): count per diagnosis/medication, average per lab test, in a
    single aggregate keyed by (patient, kind, name). ``candidates`` maps a
    kind to its allowed names (P9). -> patient_id, feature_name, value, source
    """
    r = records
    if candidates:
        keep = F.lit(False)
        for kind, names in candidates.items():
            keep = keep | ((F.col("kind") == kind) & F.col("name").isin(list(names)))
        r = r.where(keep)
    agg = r.groupBy("patient_id", "kind", "name").agg(F.count(F.lit(1)).alias("_n"), F.avg("value").alias("_avg"))
    return agg.select("patient_id", F.col("name").alias("feature_name"),
                      F.when(F.col("kind") == "lab", F.col("_avg")).otherwise(F.col("_n").cast("double")).alias("value"),
                      F.col("kind").alias("source"))


def feature_vectors_long(tuples: DataFrame) -> DataFrame:
    """D8 (long form): W2 index over (source, feature_name) in name order,
    joined back -> patient_id, feature_idx, value. Patients without tuples
    are absent, as in the original."""
    index = dense_index(tuples, ["source", "feature_name"], "feature_idx")
    return (tuples.join(maybe_broadcast(index), ["source", "feature_name"])
            .select("patient_id", "feature_idx", "value"))


def assemble_vectors(long_df: DataFrame, num_features: int, key: str = "patient_id",
                     idx: str = "feature_idx", value: str = "value", out: str = "features") -> DataFrame:
    """long form -> one ML vector per key, JVM-side.

    The (idx -> value) map of a key is bounded by the vocabulary; the dense
    array is turned into a vector by ``array_to_vector`` (no Python worker).
    """
    from pyspark.ml.functions import array_to_vector

    per_key = long_df.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(idx).cast("int"), F.col(value).cast("double")))).alias("_m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(num_features - 1)),
                        lambda i: F.coalesce(F.try_element_at(F.col("_m"), i), F.lit(0.0)))
    return per_key.select(key, array_to_vector(dense).alias(out))
