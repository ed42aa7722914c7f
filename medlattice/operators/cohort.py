"""Cohort statistics, index dates and observation windows.

Input shapes:
* events:    patient_id, event_id, event_date (date), value (double, nullable)
* mortality: patient_id, death_date (date), label

Plans are one patient-level aggregate (a single shuffle by patient) and a
tiny cohort-level aggregate; alive and dead cohorts are computed together,
never as separate scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medlattice.functions.scalars import days_between, shift_days

DEAD = "dead"
ALIVE = "alive"


def one_row_per_patient(mortality: DataFrame) -> DataFrame:
    """Several mortality rows per patient would duplicate events in joins:
    keep the earliest death date (and the largest label)."""
    return mortality.groupBy("patient_id").agg(
        F.min("death_date").alias("death_date"), F.max("label").alias("label"))


def dead_events(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """Events of patients present in mortality (left semi join)."""
    return events.join(mortality.select("patient_id"), "patient_id", "left_semi")


def alive_events(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """Events of patients absent from mortality (left anti join, not null-aware)."""
    return events.join(mortality.select("patient_id"), "patient_id", "left_anti")


def with_cohort(per_patient: DataFrame, mortality: DataFrame) -> DataFrame:
    """Tag one-row-per-patient data with 'dead'/'alive' (J18 without KeyError)."""
    dead = mortality.select("patient_id").distinct().withColumn("_dead", F.lit(True))
    return (per_patient.join(dead, "patient_id", "left")
            .withColumn("cohort", F.when(F.col("_dead"), F.lit(DEAD)).otherwise(F.lit(ALIVE)))
            .drop("_dead"))


def patient_profile(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """A1, A3, A5 per patient plus the cohort tag.

    event_count = rows, encounter_count = distinct dates, record_length =
    days from first to last event. One shuffle by patient_id: the distinct
    count is planned as a two-level aggregate keyed on the patient.
    """
    prof = events.groupBy("patient_id").agg(
        F.count("event_id").alias("event_count"),
        F.countDistinct("event_date").alias("encounter_count"),
        days_between(F.max("event_date"), F.min("event_date")).alias("record_length"),
    )
    return with_cohort(prof, mortality)


def _metric_by_cohort(profile: DataFrame, metric: str) -> DataFrame:
    return profile.groupBy("cohort").agg(
        F.min(metric).alias(f"min_{metric}"),
        F.max(metric).alias(f"max_{metric}"),
        F.round(F.avg(metric), 9).alias(f"avg_{metric}"),
    )


def event_count_metrics(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """min/max/avg events per patient for dead and alive patients."""
    return _metric_by_cohort(patient_profile(events, mortality), "event_count")


def encounter_count_metrics(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """min/max/avg distinct event dates per patient by cohort."""
    return _metric_by_cohort(patient_profile(events, mortality), "encounter_count")


def record_length_metrics(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """min/max/avg record length (days) by cohort."""
    return _metric_by_cohort(patient_profile(events, mortality), "record_length")


def cohort_summary(events: DataFrame, mortality: DataFrame) -> DataFrame:
    """All three metrics with avg/min/max and the exact median, one row per cohort.

    ``percentile`` is exact; it keeps a value->count map per cohort, which
    is bounded by the number of distinct metric values, not by rows.
    """
    prof = patient_profile(events, mortality)
    aggs = []
    for m in ("event_count", "encounter_count", "record_length"):
        aggs += [
            F.round(F.avg(m), 9).alias(f"avg_{m}"),
            F.min(m).alias(f"min_{m}"),
            F.max(m).alias(f"max_{m}"),
            F.round(F.percentile(m, F.lit(0.5)), 9).alias(f"median_{m}"),
        ]
    return prof.groupBy("cohort").agg(*aggs)


def top_codes(events: DataFrame, mortality: DataFrame, k: int = 5,
              prefixes: tuple[str, ...] = ("DIAG", "LAB", "DRUG")) -> DataFrame:
    """The k most frequent event ids per cohort and prefix, ties by id.

    One aggregate over (cohort, prefix, event_id) with map-side partial
    counts, then a grouped row_number that Spark plans as WindowGroupLimit.
    """
    dead = mortality.select("patient_id").distinct().withColumn("_dead", F.lit(True))
    prefix = F.coalesce(*[F.when(F.col("event_id").startswith(p), F.lit(p)) for p in prefixes])
    counts = (events.select("patient_id", "event_id")
              .withColumn("event_type", prefix)
              .where(F.col("event_type").isNotNull())
              .join(dead, "patient_id", "left")
              .withColumn("cohort", F.when(F.col("_dead"), F.lit(DEAD)).otherwise(F.lit(ALIVE)))
              .groupBy("cohort", "event_type", "event_id")
              .agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("cohort", "event_type").orderBy(F.desc("n"), F.asc("event_id"))
    return (counts.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))


def index_dates(events: DataFrame, mortality: DataFrame, lead_days: int = 30) -> DataFrame:
    """D3: alive -> last event date (label 0); dead -> death date - lead_days (label 1).

    One per-patient aggregate of the events (partial, so hot patients are
    combined map-side) full-outer-joined to mortality on patient_id: each
    input is read once. Dead patients come from mortality whether or not
    they have events; alive ones are patients with events not in mortality.
    """
    last = events.groupBy("patient_id").agg(F.max("event_date").alias("_last"))
    dead = mortality.select("patient_id", F.col("death_date").alias("_death"))
    j = last.join(dead, "patient_id", "full_outer")
    is_dead = F.col("_death").isNotNull()
    return j.select(
        "patient_id",
        F.when(is_dead, shift_days("_death", -lead_days)).otherwise(F.col("_last")).alias("index_date"),
        F.when(is_dead, F.lit(1)).otherwise(F.lit(0)).alias("label"))


def observation_window(events: DataFrame, index: DataFrame, window_days: int = 2000) -> DataFrame:
    """Events within [index_date - window_days, index_date], both ends inclusive."""
    j = events.join(index, "patient_id")
    return (j.where(F.col("event_date").between(shift_days("index_date", -window_days), F.col("index_date")))
            .select("patient_id", "event_id", "event_date", "value", "label"))


def windowed_event_counts(filtered: DataFrame) -> DataFrame:
    """Events and patients inside the observation window per label."""
    return filtered.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count("value").alias("n_values"),
        F.countDistinct("patient_id").alias("n_patients"))
