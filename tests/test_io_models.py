import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from medlattice.operators import models, sequences
from medlattice.sources import clinical, readers, writers


def test_headerless_declared_schema(spark, tmp_path):
    p = tmp_path / "events.csv"
    p.write_text("1,DIAG1,desc,2010-01-02,1.5\n2,LAB3,x,2010-02-03,\n")
    df = readers.read_csv(spark, str(p), readers.EVENTS_SCHEMA, header=False)
    rows = sorted(df.collect())
    assert rows[0].timestamp == dt.date(2010, 1, 2) and rows[0].value == 1.5 and rows[1].value is None


def test_seizure_wide_csv(spark, tmp_path):
    p = tmp_path / "seizure.csv"
    header = ",".join([f"X{i}" for i in range(1, 4)] + ["y"])
    p.write_text(header + "\n1,2,3,5\n4,5,6,1\n")
    df = readers.read_seizure_csv(spark, str(p), n_inputs=3)
    got = sorted((r.label, r.features.toArray().tolist()) for r in df.collect())
    assert got == [(0, [4.0, 5.0, 6.0]), (4, [1.0, 2.0, 3.0])]


def test_sequences_partitioned_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, [[0, 2], []], "train"), (2, 0, [[1]], "test")],
                               "subject_id long, label int, seqs array<array<int>>, split string")
    writers.write_partitioned_parquet(df, str(tmp_path / "seq"))
    back = readers.read_sequences(spark, str(tmp_path / "seq"), split="train").collect()
    assert len(back) == 1 and back[0].seqs == [[0, 2], []]


def test_weights_table_and_predictions_csv(spark, tmp_path):
    w = spark.createDataFrame([(1, 0, 0.5), (2, 3, -1.0)], "model_id int, idx int, weight double")
    w.write.parquet(str(tmp_path / "w"))
    assert readers.read_model_weights(spark, str(tmp_path / "w")).count() == 2
    preds = spark.createDataFrame([(7, 0.25), (8, 0.75)], "subject_id long, p double")
    writers.write_predictions(preds, str(tmp_path / "pred"), "subject_id", "p", "SUBJECT_ID", "MORTALITY")
    schema = T.StructType([T.StructField("SUBJECT_ID", T.LongType()), T.StructField("MORTALITY", T.DoubleType())])
    back = sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "pred"), schema).collect()))
    assert back == [(7, 0.25), (8, 0.75)]


def test_model_save_load_and_pipeline(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.linalg import Vectors

    rows = [(i, Vectors.dense([float(i % 5), float((i * 7) % 11), float(i % 3)])) for i in range(60)]
    df = spark.createDataFrame(rows, ["patient_id", "features"])
    fitted = models.clustering_pipeline(k=3, pca_k=2).fit(df)
    writers.save_model(fitted, str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a = {r.patient_id: r.cluster for r in fitted.transform(df).collect()}
    b = {r.patient_id: r.cluster for r in again.transform(df).collect()}
    assert a == b and set(a.values()) <= {0, 1, 2}


def test_graph_loaders(spark):
    lab = spark.createDataFrame([("1", "86400000", "hgb", "13.5"), ("1", "0", "hgb", ""), ("2", "0", "na", None)],
                                "subject_id string, date string, lab_name string, value string")
    out = clinical.clean_graph_labs(lab).collect()
    assert [(r.subject_id, r.date, r.value) for r in out] == [(1, 86400000, "13.5")]
    dx = spark.createDataFrame([("3", "5", "250.01", "2")], "subject_id string, date string, code string, sequence string")
    assert clinical.clean_graph_diagnostics(dx).first().sequence == 2
    med = spark.createDataFrame([("3", "5", "insulin")], "subject_id string, date string, med_name string")
    assert clinical.clean_graph_medications(med).first().subject_id == 3


def test_raw_diagnostics_join(spark):
    enc = spark.createDataFrame([("e1", "m1", "2012-05-06T10:00:00Z"), ("e2", "m2", "2012-05-07T10:00:00Z")],
                                "Encounter_ID string, Member_ID string, Encounter_DateTime string")
    dx = spark.createDataFrame([("e1", "250.01"), ("e1", "V77.1"), ("e3", "401.9")], "Encounter_ID string, code string")
    got = sorted((r.patient_id, str(r.date), r.code) for r in clinical.clean_diagnostics(enc, dx).collect())
    assert got == [("m1", "2012-05-06", "250.01"), ("m1", "2012-05-06", "v77.1")]
    med = spark.createDataFrame([("m1", "2012-05-06T23:59:59Z", "METFORMIN")],
                                "Member_ID string, Order_Date string, Drug_Name string")
    assert clinical.clean_medication_orders(med).first().medicine == "metformin"


def test_mlp_best_and_single_row_transform(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(i, Vectors.dense([float(i % 2), float((i + 1) % 2)]), float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, ["vec_id", "features", "label"])
    model, acc = models.mlp_best(df, df, n_inputs=2, n_classes=2, hidden=4, iterations=(20, 60))
    assert 0.0 <= acc <= 100.0
    one = spark.createDataFrame([(99, Vectors.dense([1.0, 0.0]), 1.0)], ["vec_id", "features", "label"])
    assert model.transform(one).count() == 1


def test_streaming_kmeans_stream(spark, tmp_path):
    from medlattice.streaming import kmeans as sk

    src = tmp_path / "points"
    for i, pts in enumerate([[[0.0, 0.0], [1.0, 1.0]], [[10.0, 10.0]]]):
        spark.createDataFrame([(p,) for p in pts], "x array<double>").write.parquet(str(src / f"part{i}"))
    stream = (spark.readStream.schema("x array<double>").option("maxFilesPerTrigger", 1)
              .parquet(str(src / "*")))
    init = spark.createDataFrame([(0, [0.0, 0.0], 0.5), (1, [10.0, 10.0], 0.5)],
                                 "cluster int, center array<double>, weight double")
    state, last = sk.run_streaming_kmeans(spark, stream, init, work_dir=str(tmp_path / "state"))
    final = {r.cluster: (r.weight, r.center) for r in sk.latest_centers(spark, state, last).collect()}
    # batch updates compose: weights add up to 0.5 + points assigned
    assert abs(final[0][0] + final[1][0] - (1.0 + 3)) < 1e-9
    assert final[1][1] == [10.0, 10.0]
