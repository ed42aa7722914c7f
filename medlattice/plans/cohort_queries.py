"""Registered cohort-statistics and event->feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from medlattice.operators import cohort, features
from medlattice.plans.fixture_sql import with_views
from medlattice.plans.registry import query


def _metric_sql(metric: str) -> str:
    return with_views(["prof"], f"""
SELECT cohort, min({metric}) AS min_{metric}, max({metric}) AS max_{metric},
       round(avg({metric}), 9) AS avg_{metric}
FROM prof GROUP BY cohort""")


@query("event_count_metrics", _metric_sql("event_count"), ("D1", "A1", "A2", "J5", "J6", "J18", "P1", "P2", "X4"))
def q_event_count_metrics(fx):
    """Events per patient: min/max/avg for dead and alive patients."""
    return cohort.event_count_metrics(fx.events, fx.mortality)


@query("encounter_count_metrics", _metric_sql("encounter_count"), ("D1", "A3"))
def q_encounter_count_metrics(fx):
    """Distinct event dates per patient: min/max/avg by cohort."""
    return cohort.encounter_count_metrics(fx.events, fx.mortality)


@query("record_length_metrics", _metric_sql("record_length"), ("D1", "A5", "F3"))
def q_record_length_metrics(fx):
    """Days from first to last event: min/max/avg by cohort."""
    return cohort.record_length_metrics(fx.events, fx.mortality)


def _summary_sql() -> str:
    cols = []
    for m in ("event_count", "encounter_count", "record_length"):
        cols += [f"round(avg({m}), 9) AS avg_{m}", f"min({m}) AS min_{m}", f"max({m}) AS max_{m}",
                 f"round(quantile_cont({m}, 0.5), 9) AS median_{m}"]
    return with_views(["prof"], f"SELECT cohort, {', '.join(cols)} FROM prof GROUP BY cohort")


@query("cohort_summary", _summary_sql(), ("D2", "A4"))
def q_cohort_summary(fx):
    """All three metrics with the exact median (Hive variant)."""
    return cohort.cohort_summary(fx.events, fx.mortality)


@query("top_codes", with_views(["ev", "mort"], """
SELECT * FROM (
  SELECT cohort, event_type, event_id, n,
         CAST(row_number() OVER (PARTITION BY cohort, event_type ORDER BY n DESC, event_id) AS INT) AS rank
  FROM (SELECT CASE WHEN m.patient_id IS NOT NULL THEN 'dead' ELSE 'alive' END AS cohort,
               CASE WHEN e.event_id LIKE 'DIAG%' THEN 'DIAG' WHEN e.event_id LIKE 'LAB%' THEN 'LAB'
                    WHEN e.event_id LIKE 'DRUG%' THEN 'DRUG' END AS event_type,
               e.event_id, count(*) AS n
        FROM ev e LEFT JOIN (SELECT DISTINCT patient_id FROM mort) m ON e.patient_id = m.patient_id
        GROUP BY 1, 2, 3) c
  WHERE event_type IS NOT NULL) r
WHERE rank <= 5"""), ("T1", "P7"))
def q_top_codes(fx):
    """Five most frequent DIAG/LAB/DRUG codes per cohort (ties by code)."""
    return cohort.top_codes(fx.events, fx.mortality, k=5)


@query("index_dates", with_views(["idx"], "SELECT patient_id, index_date, label FROM idx"),
       ("D3", "A6", "F2", "U1", "P5"))
def q_index_dates(fx):
    """Last event date for alive patients, death date - 30 days for dead ones."""
    return cohort.index_dates(fx.events, fx.mortality, lead_days=30)


@query("filtered_events", with_views(["filt"], "SELECT patient_id, event_id, event_date, value, label FROM filt"),
       ("D4", "J1", "P12", "P13"))
def q_filtered_events(fx):
    """Events inside [index date - 2000 days, index date]."""
    idx = cohort.index_dates(fx.events, fx.mortality)
    return cohort.observation_window(fx.events, idx, window_days=2000)


@query("windowed_event_counts", with_views(["filt"], """
SELECT label, count(*) AS n_events, count(value) AS n_values, count(DISTINCT patient_id) AS n_patients
FROM filt GROUP BY label"""), ("D3", "D4"))
def q_windowed_event_counts(fx):
    """Windowed events, non-null values and patients per label."""
    idx = cohort.index_dates(fx.events, fx.mortality)
    return cohort.windowed_event_counts(cohort.observation_window(fx.events, idx))


@query("feature_map", with_views(["fmap"], "SELECT idx, event_id FROM fmap"), ("W1", "W2", "U2"))
def q_feature_map(fx):
    """Distinct event ids numbered 0.. in name order."""
    return features.feature_map_by_name(fx.events)


def _filtered(fx):
    idx = cohort.index_dates(fx.events, fx.mortality)
    return cohort.observation_window(fx.events, idx)


_AGG_SQL = with_views(["filt", "fmap"], """
SELECT patient_id, feature_id, round(v / max(v) OVER (PARTITION BY feature_id), 9) AS feature_value
FROM (SELECT f.patient_id, m.idx AS feature_id,
             round(sum(CASE WHEN substr(f.event_id, 1, 1) = 'L' THEN 1.0 ELSE f.value END), 6) AS v
      FROM filt f JOIN fmap m ON f.event_id = m.event_id
      WHERE f.value IS NOT NULL GROUP BY f.patient_id, m.idx) a
QUALIFY max(v) OVER (PARTITION BY feature_id) <> 0""")


@query("aggregated_features", _AGG_SQL, ("D5a", "J2", "A7", "A9", "F10", "F11", "P4", "P8", "P16", "A16"))
def q_aggregated_features(fx):
    """Sum (DIAG/DRUG) or count (LAB) per patient and feature, divided by the feature max."""
    agg = features.aggregate_events(_filtered(fx), features.feature_map_by_name(fx.events))
    return agg.select("patient_id", "feature_id", F.round("feature_value", 9).alias("feature_value"))


_COUNT_SQL = with_views(["filt"], """
SELECT patient_id, idx, round(CAST(c AS DOUBLE) / max(c) OVER (PARTITION BY idx), 9) AS normalized_value
FROM (SELECT f.patient_id, m.idx, count(f.value) AS c
      FROM filt f JOIN (SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS idx, event_id
                        FROM (SELECT DISTINCT event_id FROM filt WHERE value IS NOT NULL) d) m
        ON f.event_id = m.event_id
      WHERE f.value IS NOT NULL GROUP BY f.patient_id, m.idx) a""")


@query("count_features", _COUNT_SQL, ("D5b", "A8", "W1", "J7", "J8", "F11", "F12", "P17"))
def q_count_features(fx):
    """Counts per patient and event id, indexed by rank, divided by the max (Pig variant)."""
    return features.count_features(_filtered(fx)).select(
        "patient_id", "idx", F.round("normalized_value", 9).alias("normalized_value"))


_SVM_SQL = with_views(["filt", "fmap", "mort"], """
SELECT a.patient_id, CASE WHEN m.patient_id IS NULL THEN 0 ELSE 1 END AS label,
       string_agg(printf('%d:%.6f', a.feature_id, round(a.feature_value, 6)), ' ' ORDER BY a.feature_id) AS features
FROM (SELECT patient_id, feature_id, v / max(v) OVER (PARTITION BY feature_id) AS feature_value
      FROM (SELECT f.patient_id, m.idx AS feature_id,
                   round(sum(CASE WHEN substr(f.event_id, 1, 1) = 'L' THEN 1.0 ELSE f.value END), 6) AS v
            FROM filt f JOIN fmap m ON f.event_id = m.event_id
            WHERE f.value IS NOT NULL GROUP BY f.patient_id, m.idx) x
      QUALIFY max(v) OVER (PARTITION BY feature_id) <> 0) a
LEFT JOIN mort m ON a.patient_id = m.patient_id
GROUP BY a.patient_id, m.patient_id""")


@query("svmlight_rows", _SVM_SQL, ("D5c", "K4", "F9", "T5", "F18", "A14", "X1"))
def q_svmlight_rows(fx):
    """Per patient: label and 'idx:value' pairs ascending by idx."""
    agg = features.aggregate_events(_filtered(fx), features.feature_map_by_name(fx.events))
    return features.svmlight_rows(agg)


def _split_sql() -> str:
    from medlattice.functions.scalars import stable_uniform_sql

    u = stable_uniform_sql("s.patient_id", features.SPLIT_SEED)
    return with_views(["filt"], f"""
SELECT s.patient_id, s.label, s.features,
       CASE WHEN {u} <= {features.TEST_SHARE} THEN 'test' ELSE 'train' END AS split
FROM (SELECT c.patient_id, l.label,
             string_agg(printf('%d:%.6f', c.idx, round(c.nv, 6)), ' ' ORDER BY c.idx) AS features
      FROM (SELECT patient_id, idx, CAST(c AS DOUBLE) / max(c) OVER (PARTITION BY idx) AS nv
            FROM (SELECT f.patient_id, m.idx, count(f.value) AS c
                  FROM filt f JOIN (SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS idx, event_id
                                    FROM (SELECT DISTINCT event_id FROM filt WHERE value IS NOT NULL) d) m
                    ON f.event_id = m.event_id
                  WHERE f.value IS NOT NULL GROUP BY f.patient_id, m.idx) a) c
      JOIN (SELECT DISTINCT patient_id, label FROM filt) l ON c.patient_id = l.patient_id
      GROUP BY c.patient_id, l.label) s""")


@query("labeled_samples", _split_sql(), ("D5d", "P14", "F17", "X2", "P3", "J4", "T4"))
def q_labeled_samples(fx):
    """svmlight rows of the count features with window labels and a hashed 80/20 split."""
    return features.labeled_samples(features.count_features(_filtered(fx))).select(
        "patient_id", "label", "features", "split")


@query("parsed_svmlight", with_views(["filt", "fmap", "mort"], """
SELECT a.patient_id, CAST(CASE WHEN m.patient_id IS NULL THEN 0 ELSE 1 END AS DOUBLE) AS label,
       CAST(a.feature_id AS INT) AS idx, round(a.feature_value, 6) AS value
FROM (SELECT patient_id, feature_id, v / max(v) OVER (PARTITION BY feature_id) AS feature_value
      FROM (SELECT f.patient_id, m.idx AS feature_id,
                   round(sum(CASE WHEN substr(f.event_id, 1, 1) = 'L' THEN 1.0 ELSE f.value END), 6) AS v
            FROM filt f JOIN fmap m ON f.event_id = m.event_id
            WHERE f.value IS NOT NULL GROUP BY f.patient_id, m.idx) x
      QUALIFY max(v) OVER (PARTITION BY feature_id) <> 0) a
LEFT JOIN mort m ON a.patient_id = m.patient_id"""), ("S7", "K4", "F9", "S1"))
def q_parsed_svmlight(fx):
    """svmlight text (id label i:v ...) written by the ETL, parsed back to pairs."""
    from medlattice.sources.readers import parse_svmlight

    agg = features.aggregate_events(_filtered(fx), features.feature_map_by_name(fx.events))
    text = features.svmlight_text(features.svmlight_rows(agg), with_id=True)
    parsed = parse_svmlight(text, with_id=True)
    return parsed.select("patient_id", "label", F.explode("pairs").alias("p")).select(
        "patient_id", "label", F.col("p.idx").alias("idx"), F.col("p.value").alias("value"))
