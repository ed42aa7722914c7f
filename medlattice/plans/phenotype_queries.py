"""Registered phenotyping, feature-tuple and raw-record cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from medlattice.operators import features, phenotype
from medlattice.plans.fixture_sql import with_views
from medlattice.plans.registry import query
from medlattice.sources import clinical

RULES = phenotype.FIXTURE_RULES

_PHENO_CTE = ("pheno", """
WITH p AS (SELECT patient_id,
  bool_or(flag = 'A' AND brand = 1) AS t1d, bool_or(flag = 'A' AND brand IN (2, 3)) AS t2d,
  bool_or(flag = 'R' AND brand IN (4, 5)) AS t1m, bool_or(flag = 'R' AND brand IN (6, 7)) AS t2m,
  min(CASE WHEN flag = 'R' AND brand IN (4, 5) THEN ship_date END) AS m1,
  min(CASE WHEN flag = 'R' AND brand IN (6, 7) THEN ship_date END) AS m2,
  bool_or(flag = 'N' AND brand IN (8, 9)) AS glu,
  bool_or(flag = 'N' AND ((brand = 8 AND quantity >= 40) OR (brand = 9 AND quantity > 40))) AS abn,
  bool_or(flag = 'A' AND brand IN (1, 2, 3)) AS rel
  FROM line GROUP BY patient_id)
SELECT patient_id, CASE WHEN NOT t1d AND t2d AND (NOT t1m OR NOT t2m OR m1 > m2) THEN 1
                        WHEN glu AND NOT abn AND NOT rel THEN 2 ELSE 3 END AS label FROM p""")


def _labels(fx):
    return phenotype.phenotype_labels(fx.records, RULES)


@query("phenotype_labels", with_views(["line"], "SELECT patient_id, label FROM pheno", [_PHENO_CTE]),
       ("D6", "P9", "P10", "P11", "U3", "U4", "J10", "J11", "A12", "F5"))
def q_phenotype_labels(fx):
    """Case (1), control (2) or other (3) per patient."""
    return _labels(fx)


@query("phenotype_counts", with_views(["line"], """
SELECT label, count(*) AS n_patients FROM pheno GROUP BY label""", [_PHENO_CTE]), ("D6", "A20"))
def q_phenotype_counts(fx):
    """Patients per phenotype label."""
    return phenotype.label_counts(_labels(fx))


@query("glucose_means", with_views(["line"], """
SELECT p.label, round(avg(l.quantity), 9) AS mean_glucose, count(*) AS n_tests
FROM line l JOIN pheno p ON l.patient_id = p.patient_id
WHERE l.flag = 'N' AND l.brand IN (8, 9) GROUP BY p.label""", [_PHENO_CTE]), ("A13",))
def q_glucose_means(fx):
    """Mean glucose test value per phenotype label."""
    return phenotype.glucose_means(fx.labs, _labels(fx), RULES)


@query("diagnostic_features", with_views(["line"], """
SELECT patient_id, CAST(brand AS VARCHAR) AS feature_name, CAST(count(*) AS DOUBLE) AS value
FROM line WHERE flag = 'A' GROUP BY 1, 2"""), ("D7", "A10"))
def q_diagnostic_features(fx):
    """Diagnosis counts per (patient, code)."""
    return features.diagnostic_feature_tuples(fx.diagnostics)


@query("medication_features", with_views(["line"], """
SELECT patient_id, CAST(brand AS VARCHAR) AS feature_name, CAST(count(*) AS DOUBLE) AS value
FROM line WHERE flag = 'R' GROUP BY 1, 2"""), ("D7", "A10"))
def q_medication_features(fx):
    """Medication counts per (patient, medicine)."""
    return features.medication_feature_tuples(fx.medications)


@query("lab_features", with_views(["line"], """
SELECT patient_id, CAST(brand AS VARCHAR) AS feature_name, round(avg(quantity), 9) AS value
FROM line WHERE flag = 'N' GROUP BY 1, 2"""), ("D7", "A11", "J9"))
def q_lab_features(fx):
    """Average lab value per (patient, test)."""
    t = features.lab_feature_tuples(fx.labs)
    return t.select("patient_id", "feature_name", F.round("value", 9).alias("value"))


# Candidate sets of the fixture: the codes, medicines and tests the rules use.
DIAG_CANDIDATES = ("1", "2", "3")
MED_CANDIDATES = ("4", "5", "6", "7")
LAB_CANDIDATES = ("8", "9")

_TUPLES_SQL = """
SELECT patient_id, CAST(brand AS VARCHAR) AS feature_name, CAST(count(*) AS DOUBLE) AS value, 'diagnostic' AS source
FROM line WHERE flag = 'A' {d} GROUP BY 1, 2
UNION ALL
SELECT patient_id, CAST(brand AS VARCHAR), CAST(count(*) AS DOUBLE), 'medication'
FROM line WHERE flag = 'R' {m} GROUP BY 1, 2
UNION ALL
SELECT patient_id, CAST(brand AS VARCHAR), round(avg(quantity), 9), 'lab'
FROM line WHERE flag = 'N' {l} GROUP BY 1, 2"""


@query("candidate_features", with_views(["line"], _TUPLES_SQL.format(
    d="AND brand IN (1, 2, 3)", m="AND brand IN (4, 5, 6, 7)", l="AND brand IN (8, 9)")), ("D7", "P9", "U1"))
def q_candidate_features(fx):
    """Feature tuples restricted to candidate codes, medicines and tests."""
    t = features.feature_tuples_from_records(fx.records, {"diagnostic": DIAG_CANDIDATES,
                                                          "medication": MED_CANDIDATES, "lab": LAB_CANDIDATES})
    return t.select("patient_id", "feature_name", F.round("value", 9).alias("value"), "source")


@query("feature_vectors", with_views(["line"], """
SELECT t.patient_id, i.feature_idx, t.value
FROM t JOIN (SELECT source, feature_name,
                    CAST(row_number() OVER (ORDER BY source, feature_name) - 1 AS BIGINT) AS feature_idx
             FROM (SELECT DISTINCT source, feature_name FROM t) d) i
  ON t.source = i.source AND t.feature_name = i.feature_name""",
    [("t", _TUPLES_SQL.format(d="", m="", l=""))]), ("D8", "W2", "F19", "J14"))
def q_feature_vectors(fx):
    """Long-form patient vectors: feature index by (source, name) order."""
    t = features.feature_tuples_from_records(fx.records)
    v = features.feature_vectors_long(t)
    return v.select("patient_id", "feature_idx", F.round("value", 9).alias("value"))


# ------------------------------------------------------------ D9 raw text

def _raw_medication(fx):
    m = fx.line.where(F.col("flag") == "R")
    return m.select(F.col("patient_id").cast("string").alias("Member_ID"),
                    F.concat(F.date_format("ship_date", "yyyy-MM-dd"), F.lit("T12:30:00Z")).alias("Order_Date"),
                    F.concat(F.lit("Drug "), F.col("brand").cast("string")).alias("Drug_Name"))


def _raw_lab(fx):
    m = fx.line.where(F.col("flag") == "N")
    value = F.when(F.col("linenumber") == 7, F.lit("")).otherwise(F.format_number(F.col("quantity") * 100, 1))
    return m.select(F.col("patient_id").cast("string").alias("Member_ID"),
                    F.concat(F.date_format("ship_date", "yyyy-MM-dd"), F.lit("T08:00:00Z")).alias("Date_Resulted"),
                    F.concat(F.lit("Lab "), F.col("brand").cast("string")).alias("Result_Name"),
                    value.alias("Numeric_Result"))


@query("cleaned_medication", with_views(["line"], """
SELECT CAST(patient_id AS VARCHAR) AS patient_id, ship_date AS date,
       'drug ' || CAST(brand AS VARCHAR) AS medicine
FROM line WHERE flag = 'R'"""), ("D9", "F4", "F6", "S4"))
def q_cleaned_medication(fx):
    """Medication orders parsed from raw text (ISO date with zone, lower-case name)."""
    return clinical.clean_medication_orders(_raw_medication(fx))


@query("cleaned_lab_results", with_views(["line"], """
SELECT CAST(patient_id AS VARCHAR) AS patient_id, ship_date AS date,
       'lab ' || CAST(brand AS VARCHAR) AS test_name, quantity * 100 AS value
FROM line WHERE flag = 'N' AND linenumber <> 7"""), ("D9", "F7", "P6"))
def q_cleaned_lab_results(fx):
    """Lab results from raw text: empty results dropped, thousands commas removed."""
    return clinical.clean_lab_results(_raw_lab(fx))


@query("cleaned_diagnostics", with_views(["line"], """
SELECT CAST(o.o_custkey AS VARCHAR) AS patient_id, CAST(o.o_orderdate AS DATE) AS date,
       'dx' || CAST(l.brand AS VARCHAR) AS code
FROM orders o JOIN line l ON l.encounter_id = o.o_orderkey WHERE l.flag = 'A'"""), ("D9", "J3"))
def q_cleaned_diagnostics(fx):
    """Encounters joined to their diagnosis codes from raw text."""
    enc = fx.spark.read.parquet(f"{fx.dir}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("Encounter_ID"),
        F.col("o_custkey").cast("string").alias("Member_ID"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("Encounter_DateTime"))
    dx = fx.line.where(F.col("flag") == "A").select(
        F.col("encounter_id").cast("string").alias("Encounter_ID"),
        F.concat(F.lit("DX"), F.col("brand").cast("string")).alias("code"))
    return clinical.clean_diagnostics(enc, dx)


# ----------------------------------------------------------- D10 raw text

@query("graph_lab_records", with_views(["line"], """
SELECT suppkey AS subject_id, CAST(datediff('day', DATE '1970-01-01', ship_date) AS BIGINT) * 86400000 AS date,
       'L' || CAST(partkey AS VARCHAR) AS lab_name, CAST(quantity AS VARCHAR) AS value
FROM line WHERE flag = 'N' AND linenumber <> 7"""), ("D10", "F12", "P6", "S5"))
def q_graph_lab_records(fx):
    """Lab rows of the graph loader from raw text: epoch dates, text values, empties dropped."""
    m = fx.line.where(F.col("flag") == "N")
    raw = m.select(F.col("suppkey").cast("string").alias("subject_id"),
                   (F.unix_date("ship_date").cast("long") * 86400000).cast("string").alias("date"),
                   F.concat(F.lit("L"), F.col("partkey").cast("string")).alias("lab_name"),
                   F.when(F.col("linenumber") == 7, F.lit("")).otherwise(F.col("quantity").cast("string")).alias("value"))
    return clinical.clean_graph_labs(raw)


@query("graph_patient_records", with_views(["mort"], """
SELECT CAST(c.c_custkey AS VARCHAR) AS subject_id,
       CASE WHEN c.c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex, '' AS dob,
       COALESCE(CAST(m.death_date AS VARCHAR), '') AS dod
FROM customer c LEFT JOIN mort m ON m.patient_id = c.c_custkey"""), ("D10", "P15"))
def q_graph_patient_records(fx):
    """Patient rows of the graph loader: missing dob/dod filled with ''."""
    c = fx.spark.read.parquet(f"{fx.dir}/customer.parquet").select("c_custkey", "c_nationkey")
    m = fx.mortality.select(F.col("patient_id").alias("c_custkey"), "death_date")
    raw = c.join(m, "c_custkey", "left").select(
        F.col("c_custkey").cast("string").alias("subject_id"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("sex"),
        F.lit(None).cast("string").alias("dob"),
        F.date_format("death_date", "yyyy-MM-dd").alias("dod"))
    return clinical.clean_patients(raw)
