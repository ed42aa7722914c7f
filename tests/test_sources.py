from pyspark.ml.linalg import Vectors

from medlattice.operators import features
from medlattice.sources import clinical, readers, writers


def test_table_name_and_malformed(spark, tmp_path):
    p = tmp_path / "PATIENT.csv"
    p.write_text("subject_id,sex,dob,dod\n1,F,1950-01-01,\n2,M,1960-02-02,2000-01-01\n3,F\n")
    assert readers.table_name_from_path(str(p)) == "PATIENT"
    assert readers.table_name_from_path("hdfs://x/y/LAB") == "LAB"
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("subject_id", "sex", "dob", "dod")])
    df = readers.load_csv_table(spark, str(p), schema=schema)
    assert spark.table("PATIENT").count() == 2           # malformed short line dropped
    pats = {r.subject_id: r.dod for r in clinical.clean_patients(df).collect()}
    assert pats == {"1": "", "2": "2000-01-01"}


def test_raw_lab_cleaning(spark):
    raw = spark.createDataFrame([
        ("7", "2010-03-04T23:00:00Z", "HbA1c", "1,234.5"),
        ("7", "2010-03-04T23:00:00Z", "Glucose", ""),
        ("8", "2011-01-01T00:00:00Z", "Glucose", None),
    ], "Member_ID string, Date_Resulted string, Result_Name string, Numeric_Result string")
    out = clinical.clean_lab_results(raw).collect()
    assert len(out) == 1 and out[0].value == 1234.5 and out[0].test_name == "hba1c"
    assert str(out[0].date) == "2010-03-04"


def test_candidates(spark, tmp_path):
    p = tmp_path / "cands.txt"
    p.write_text("Metformin\n metformin \nLANTUS\n\n")
    assert sorted(r.value for r in readers.read_candidates(spark, str(p)).collect()) == ["lantus", "metformin"]


def test_svmlight_round_trip(spark, tmp_path):
    feats = spark.createDataFrame([(1, 0, 1.0), (1, 3, 0.8), (2, 1, 0.5)], "patient_id long, idx int, value double")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "patient_id long, label int")
    rows = features.svmlight_rows(feats, labels, idx="idx", value="value")
    writers.write_text_lines(features.svmlight_text(rows, with_id=True), str(tmp_path / "svm"))
    back = {r.patient_id: (r.label, r.features)
            for r in readers.read_svmlight(spark, str(tmp_path / "svm"), num_features=4, with_id=True).collect()}
    assert back[1] == (1.0, Vectors.dense([1.0, 0.0, 0.0, 0.8]))
    assert back[2] == (0.0, Vectors.dense([0.0, 0.5, 0.0, 0.0]))


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "patient_id long, name string")
    writers.write_csv(df, str(tmp_path / "out"))
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("patient_id", T.LongType()), T.StructField("name", T.StringType())])
    back = readers.read_csv(spark, str(tmp_path / "out"), schema)
    assert sorted(map(tuple, back.collect())) == [(1, "a b"), (2, "c")]
    writers.write_space_delimited(df, str(tmp_path / "sp"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "sp")).collect()) == ["1 a b", "2 c"]


def test_zoned_dates_ignore_session_zone(spark):
    from medlattice.functions.scalars import parse_iso_zoned_date

    df = spark.createDataFrame([("2010-03-04T23:30:00Z",), ("2010-03-04T23:30:00-05:00",), ("junk",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = [str(r[0]) for r in df.select(parse_iso_zoned_date("s")).collect()]
            assert got == ["2010-03-04", "2010-03-05", "None"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_parse_date_and_days(spark):
    from medlattice.functions.scalars import days_between, parse_date, shift_days

    df = spark.createDataFrame([("2012-02-28",), ("bad",)], "s string")
    rows = df.select(parse_date("s").alias("d")).select(
        "d", shift_days("d", 2).alias("e"), days_between(shift_days("d", 2), "d").alias("n")).collect()
    assert str(rows[0].d) == "2012-02-28" and str(rows[0].e) == "2012-03-01" and rows[0].n == 2
    assert rows[1].d is None
