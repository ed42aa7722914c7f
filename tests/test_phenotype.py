import datetime as dt

from medlattice.operators import phenotype as ph

D = dt.date


def _records(spark, rows):
    return spark.createDataFrame(rows, "patient_id string, kind string, name string, date date, value double")


def _labels(spark, rows, rules=ph.REFERENCE_RULES):
    return {r.patient_id: r.label for r in ph.phenotype_labels(_records(spark, rows), rules).collect()}


def test_case_rules(spark):
    rows = [
        ("a", "diagnostic", "250.3", D(2000, 1, 1), None),                     # T2 only -> case
        ("b", "diagnostic", "250.3", D(2000, 1, 1), None),
        ("b", "medication", "Lantus", D(2000, 1, 1), None),                     # T1 med only -> case
        ("c", "diagnostic", "250.3", D(2000, 1, 1), None),
        ("c", "medication", "lantus", D(2000, 2, 1), None),
        ("c", "medication", "metformin", D(2000, 1, 1), None),                  # T1 after T2 -> case
        ("d", "diagnostic", "250.3", D(2000, 1, 1), None),
        ("d", "medication", "lantus", D(2000, 1, 1), None),
        ("d", "medication", "metformin", D(2000, 1, 1), None),                  # equal dates -> other
        ("e", "diagnostic", "250.01", D(2000, 1, 1), None),
        ("e", "diagnostic", "250.3", D(2000, 1, 1), None),                      # T1 dx -> not case
    ]
    got = _labels(spark, rows)
    assert got == {"a": 1, "b": 1, "c": 1, "d": 3, "e": 3}


def test_control_glucose_limits(spark):
    rows = [
        ("f", "lab", "fasting glucose", D(2000, 1, 1), 110.0),   # >= 110 abnormal -> other
        ("g", "lab", "glucose", D(2000, 1, 1), 110.0),           # > 110 needed -> control
        ("h", "lab", "Glucose", D(2000, 1, 1), 90.0),
        ("h", "diagnostic", "790.21", D(2000, 1, 1), None),      # dm related -> other
        ("i", "lab", "glucose", D(2000, 1, 1), 50.0),
        ("i", "diagnostic", "250.99", D(2000, 1, 1), None),      # contains 250. -> other
        ("j", "lab", "hba1c", D(2000, 1, 1), 5.9),               # no glucose test -> other
        ("k", "lab", "blood glucose", D(2000, 1, 1), 300.0),     # unknown test never abnormal -> control
        ("l", "lab", "glucose", D(2000, 1, 1), 80.0),
        ("l", "diagnostic", "V77.1", D(2000, 1, 1), None),       # matches after lower-casing -> other
    ]
    assert _labels(spark, rows) == {"f": 3, "g": 2, "h": 3, "i": 3, "j": 3, "k": 2, "l": 3}


def test_three_source_api_and_glucose_means(spark):
    diag = spark.createDataFrame([("a", D(2000, 1, 1), "250.3")], "patient_id string, date date, code string")
    med = spark.createDataFrame([("b", D(2000, 1, 1), "insulin nph")], "patient_id string, date date, medicine string")
    lab = spark.createDataFrame([("a", D(2000, 1, 1), "glucose", 100.0), ("c", D(2000, 1, 1), "glucose", 80.0)],
                                "patient_id string, date date, test_name string, value double")
    labels = ph.phenotype(med, lab, diag)
    got = {r.patient_id: r.label for r in labels.collect()}
    assert got == {"a": 1, "b": 3, "c": 2}
    means = {r.label: r.mean_glucose for r in ph.glucose_means(lab, labels).collect()}
    assert means == {1: 100.0, 2: 80.0}
