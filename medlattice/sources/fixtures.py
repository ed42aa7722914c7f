"""Clinical views over the driver's star-schema tables.

The driver ships order/line tables, not patient records, so these views
map them onto the logical tables the operators expect (see FIXTURES.md):

* ``line``     one row per order line with its patient (customer), dates and code
* ``events``   patient_id, event_id (DIAG*/DRUG*/LAB*), event_date, value
* ``mortality`` patient_id, death_date, label for the HOUSEHOLD segment
* phenotype sources (diagnostic, medication, lab), graph edges, visit data

All views are lazy DataFrame expressions; Catalyst prunes the columns and
pushes the filters into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlattice.sources.tables import read_table

# Fixed values of the mapping: the return flag names the record kind, the
# brand number is the code, line 7 carries a missing value, and the
# HOUSEHOLD segment marks the dead.
FLAG_DIAGNOSIS = "A"
FLAG_DRUG = "R"
FLAG_LAB = "N"
MISSING_VALUE_LINE = 7
DEAD_SEGMENT = "HOUSEHOLD"


def line(spark: SparkSession, data_dir: str) -> DataFrame:
    li = read_table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_shipdate")
    od = read_table(spark, data_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pt = read_table(spark, data_dir, "part").select("p_partkey", "p_brand")
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .join(pt, li.l_partkey == pt.p_partkey)
        .select(
            F.col("o_custkey").alias("patient_id"),
            F.col("o_orderkey").alias("encounter_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_suppkey").alias("suppkey"),
            F.col("l_partkey").alias("partkey"),
            F.regexp_replace("p_brand", "Brand#", "").cast("int").alias("brand"),
            F.col("l_linenumber").alias("linenumber"),
            F.col("l_quantity").alias("quantity"),
        )
    )


def events(line_df: DataFrame) -> DataFrame:
    """patient_id, event_id, event_date, value (null on line 7)."""
    kind = (F.when(F.col("flag") == FLAG_DIAGNOSIS, "DIAG")
            .when(F.col("flag") == FLAG_DRUG, "DRUG").otherwise("LAB"))
    return line_df.select(
        "patient_id",
        F.concat(kind, F.col("brand").cast("string")).alias("event_id"),
        F.col("ship_date").alias("event_date"),
        F.when(F.col("linenumber") == MISSING_VALUE_LINE, F.lit(None).cast("double"))
        .otherwise(F.col("quantity")).alias("value"),
    )


def mortality(spark: SparkSession, data_dir: str, events_df: DataFrame) -> DataFrame:
    """Dead patients: HOUSEHOLD customers with events; death date = last event."""
    dead = (read_table(spark, data_dir, "customer")
            .where(F.col("c_mktsegment") == DEAD_SEGMENT).select(F.col("c_custkey").alias("patient_id")))
    return (events_df.join(dead, "patient_id", "left_semi")
            .groupBy("patient_id")
            .agg(F.max("event_date").alias("death_date"))
            .withColumn("label", F.lit(1)))


def clinical_records(line_df: DataFrame) -> DataFrame:
    """One long table of diagnoses, drugs and labs for phenotyping and features.

    kind in {'diagnostic','medication','lab'}, name = brand code as text,
    value = quantity (labs only are meaningful), date = ship date.
    """
    kind = (F.when(F.col("flag") == FLAG_DIAGNOSIS, "diagnostic")
            .when(F.col("flag") == FLAG_DRUG, "medication").otherwise("lab"))
    return line_df.select(
        "patient_id", kind.alias("kind"), F.col("brand").cast("string").alias("name"),
        F.col("ship_date").alias("date"), F.col("quantity").alias("value"))


def diagnostics(line_df: DataFrame) -> DataFrame:
    return line_df.where(F.col("flag") == FLAG_DIAGNOSIS).select(
        "patient_id", F.col("ship_date").alias("date"), F.col("brand").cast("string").alias("code"))


def medications(line_df: DataFrame) -> DataFrame:
    return line_df.where(F.col("flag") == FLAG_DRUG).select(
        "patient_id", F.col("ship_date").alias("date"), F.col("brand").cast("string").alias("medicine"))


def lab_results(line_df: DataFrame) -> DataFrame:
    return line_df.where(F.col("flag") == FLAG_LAB).select(
        "patient_id", F.col("ship_date").alias("date"),
        F.col("brand").cast("string").alias("test_name"), F.col("quantity").alias("value"))


def graph_records(line_df: DataFrame) -> DataFrame:
    """Graph inputs: patient = supplier, code = flag + part key.

    Columns: patient_id, kind, code, date, value, encounter_id, linenumber.
    """
    kind = (F.when(F.col("flag") == FLAG_DIAGNOSIS, "diagnostic")
            .when(F.col("flag") == FLAG_DRUG, "medication").otherwise("lab"))
    return line_df.select(
        F.col("suppkey").alias("patient_id"), kind.alias("kind"),
        F.concat(F.col("flag"), F.col("partkey").cast("string")).alias("code"),
        F.col("ship_date").alias("date"), F.col("quantity").alias("value"),
        "encounter_id", "linenumber")


def graph_patients(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every patient vertex (suppliers), including those without codes."""
    return read_table(spark, data_dir, "supplier").select(F.col("s_suppkey").alias("patient_id"))


def admissions(spark: SparkSession, data_dir: str) -> DataFrame:
    """hadm_id, subject_id, admit_time (every order is a hospital stay)."""
    return read_table(spark, data_dir, "orders").select(
        F.col("o_orderkey").alias("hadm_id"), F.col("o_custkey").alias("subject_id"),
        F.col("o_orderdate").cast("date").alias("admit_time"))


def diagnoses_icd(line_df: DataFrame) -> DataFrame:
    """hadm_id, icd9 text built from the brand (E-codes every fifth brand)."""
    code = F.concat(
        F.when(F.col("brand") % 5 == 0, F.lit("E")).otherwise(F.lit("")),
        (F.col("brand") + 100).cast("string"), F.lit("."), F.col("linenumber").cast("string"))
    return line_df.where(F.col("flag") == FLAG_DIAGNOSIS).select(
        F.col("encounter_id").alias("hadm_id"), code.alias("icd9"))


def subject_mortality(spark: SparkSession, data_dir: str) -> DataFrame:
    """subject_id, mortality (1 for HOUSEHOLD customers)."""
    return read_table(spark, data_dir, "customer").select(
        F.col("c_custkey").alias("subject_id"),
        (F.col("c_mktsegment") == DEAD_SEGMENT).cast("int").alias("mortality"))


def subject_split(subject_id: str = "subject_id") -> F.Column:
    """train (0-6), validation (7), test (8-9) by the last digit of the id."""
    d = F.pmod(F.col(subject_id), F.lit(10))
    return F.when(d <= 6, "train").when(d == 7, "validation").otherwise("test")


def embeddings(spark: SparkSession, data_dir: str) -> DataFrame:
    """vec_id, embedding (array<float>), label."""
    return read_table(spark, data_dir, "embeddings").select("vec_id", "embedding", "label")
