import datetime as dt

from pyspark.sql import functions as F

from medlattice.operators import cohort, features

D = dt.date


def _events(spark, rows):
    return spark.createDataFrame(rows, "patient_id long, event_id string, event_date date, value double")


def _mort(spark, rows):
    return spark.createDataFrame(rows, "patient_id long, death_date date, label int")


def test_window_boundaries(spark):
    idx_day = D(2010, 1, 1)
    ev = _events(spark, [
        (1, "DIAG1", idx_day, 1.0),                              # day 0: kept
        (1, "DIAG1", idx_day - dt.timedelta(days=2000), 2.0),   # day 2000: kept
        (1, "DIAG1", idx_day - dt.timedelta(days=2001), 4.0),   # day 2001: dropped
    ])
    mort = _mort(spark, [])
    idx = cohort.index_dates(ev, mort)
    assert idx.collect()[0]["index_date"] == idx_day
    kept = cohort.observation_window(ev, idx).agg(F.sum("value")).first()[0]
    assert kept == 3.0


def test_dead_index_is_death_minus_30(spark):
    ev = _events(spark, [(7, "LAB1", D(2000, 3, 1), None)])
    mort = _mort(spark, [(7, D(2000, 3, 31), 1)])
    r = cohort.index_dates(ev, mort).collect()
    assert [(x.patient_id, x.index_date, x.label) for x in r] == [(7, D(2000, 3, 1), 1)]


def test_cohort_metrics_split(spark):
    ev = _events(spark, [(1, "DIAG1", D(2000, 1, 1), 1.0), (1, "DIAG2", D(2000, 1, 1), 1.0),
                         (1, "LAB1", D(2000, 1, 11), None), (2, "DRUG1", D(2001, 1, 1), 3.0)])
    mort = _mort(spark, [(2, D(2001, 2, 1), 1), (3, D(2001, 2, 1), 1)])  # 3 has no events: left out
    ec = {r.cohort: r for r in cohort.event_count_metrics(ev, mort).collect()}
    assert ec["alive"].max_event_count == 3 and ec["dead"].avg_event_count == 1.0
    enc = {r.cohort: r for r in cohort.encounter_count_metrics(ev, mort).collect()}
    assert enc["alive"].min_encounter_count == 2
    rl = {r.cohort: r for r in cohort.record_length_metrics(ev, mort).collect()}
    assert rl["alive"].max_record_length == 10 and rl["dead"].max_record_length == 0


def test_aggregate_events_sum_count_and_zero_max(spark):
    ev = _events(spark, [(1, "DIAG1", D(2000, 1, 1), 2.0), (1, "DIAG1", D(2000, 1, 2), 2.0),
                         (2, "DIAG1", D(2000, 1, 1), 1.0), (1, "LAB1", D(2000, 1, 1), 9.0),
                         (1, "LAB1", D(2000, 1, 1), None), (1, "DRUG1", D(2000, 1, 1), 0.0)])
    filt = ev.withColumn("label", F.lit(0))
    fmap = features.feature_map_by_name(ev)
    out = {(r.patient_id, r.feature_id): r.feature_value
           for r in features.aggregate_events(filt, fmap).collect()}
    m = {r.event_id: r.idx for r in fmap.collect()}
    assert m == {"DIAG1": 0, "DRUG1": 1, "LAB1": 2}
    assert out[(1, 0)] == 1.0 and out[(2, 0)] == 0.25
    assert out[(1, 2)] == 1.0            # count of non-null lab values
    assert (1, 1) not in out             # 0 / 0 dropped


def test_svmlight_worked_example(spark):
    feats = spark.createDataFrame([(1, 1, 1.0), (1, 3, 0.8), (2, 1, 0.5), (3, 3, 1.0)],
                                  "patient_id long, idx int, value double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "patient_id long, label int")
    rows = {r.patient_id: (r.label, r.features)
            for r in features.svmlight_rows(feats, labels, idx="idx", value="value").collect()}
    assert rows[1] == (1, "1:1.000000 3:0.800000")
    assert rows[2] == (0, "1:0.500000")
    text = features.svmlight_text(features.svmlight_rows(feats, labels, idx="idx", value="value"), with_id=True)
    assert "1 1 1:1.000000 3:0.800000 " in [r.value for r in text.collect()]


def test_split_is_disjoint_and_covering(spark):
    rows = spark.range(0, 2000).withColumnRenamed("id", "patient_id")
    s = features.split_samples(rows)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000 and set(counts) == {"train", "test"}
    assert 300 < counts["test"] < 500


def test_index_dates_cover_dead_without_events(spark):
    ev = _events(spark, [(1, "LAB1", D(2000, 3, 1), None), (2, "LAB1", D(2001, 1, 5), 1.0)])
    mort = _mort(spark, [(2, D(2001, 2, 1), 1), (9, D(2002, 1, 31), 1)])
    got = {r.patient_id: (r.index_date, r.label) for r in cohort.index_dates(ev, mort).collect()}
    assert got == {1: (D(2000, 3, 1), 0), 2: (D(2001, 1, 2), 1), 9: (D(2002, 1, 1), 1)}


def test_feature_tuples_one_pass(spark):
    recs = spark.createDataFrame([
        (1, "diagnostic", "250.0", None), (1, "diagnostic", "250.0", None), (1, "lab", "hgb", 10.0),
        (1, "lab", "hgb", 14.0), (2, "medication", "metformin", None), (2, "lab", "ldl", 3.0)],
        "patient_id long, kind string, name string, value double")
    t = {(r.patient_id, r.source, r.feature_name): r.value for r in features.feature_tuples_from_records(recs).collect()}
    assert t == {(1, "diagnostic", "250.0"): 2.0, (1, "lab", "hgb"): 12.0,
                 (2, "medication", "metformin"): 1.0, (2, "lab", "ldl"): 3.0}
    c = features.feature_tuples_from_records(recs, {"lab": ["hgb"], "diagnostic": ["250.0"]})
    assert c.count() == 2


def test_feature_map_proves_maxima_small(spark, monkeypatch):
    import medlattice.session as session

    fmap = spark.createDataFrame([(0, "DIAG1"), (1, "LAB2")], "idx long, event_id string")
    filt = spark.createDataFrame([(1, "DIAG1", 2.0), (2, "DIAG1", 4.0), (1, "LAB2", 7.0)],
                                 "patient_id long, event_id string, value double")
    # every estimate says "large" except the given feature map's
    monkeypatch.setattr(session, "estimated_bytes", lambda df: 0 if df is fmap else 1 << 60)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = features.aggregate_events(filt, fmap)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        got = sorted((r.patient_id, r.feature_id, r.feature_value) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    # the maxima join is broadcast too (it would be a sort-merge join without the proof)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert got == [(1, 0, 0.5), (1, 1, 1.0), (2, 0, 1.0)]
