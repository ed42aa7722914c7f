"""Typed clinical tables from raw text tables (all columns strings).

These are the loaders of the phenotyping and graph jobs, written as column
expressions (no per-row lambdas): ISO dates with a zone, lower-cased names,
numbers with thousands commas, empty strings for missing values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.functions.scalars import normalized_name, number_with_commas, parse_iso_zoned_date


def _non_empty(c: str) -> F.Column:
    """Keep rows whose text is neither null nor empty."""
    return F.col(c).isNotNull() & (F.col(c) != "")


def clean_medication_orders(raw: DataFrame) -> DataFrame:
    """Member_ID, Order_Date, Drug_Name -> patient_id, date, medicine."""
    return raw.select(
        F.col("Member_ID").alias("patient_id"),
        parse_iso_zoned_date("Order_Date").alias("date"),
        F.lower("Drug_Name").alias("medicine"))


def clean_lab_results(raw: DataFrame) -> DataFrame:
    """Member_ID, Date_Resulted, Result_Name, Numeric_Result -> patient_id,
    date, test_name, value; empty results dropped, commas stripped."""
    return raw.where(_non_empty("Numeric_Result")).select(
        F.col("Member_ID").alias("patient_id"),
        parse_iso_zoned_date("Date_Resulted").alias("date"),
        F.lower("Result_Name").alias("test_name"),
        number_with_commas("Numeric_Result").alias("value"))


def clean_diagnostics(encounter: DataFrame, encounter_dx: DataFrame) -> DataFrame:
    """Encounter ⋈ encounter_dx on Encounter_ID -> patient_id, date, code."""
    return encounter.join(encounter_dx, "Encounter_ID").select(
        F.col("Member_ID").alias("patient_id"),
        parse_iso_zoned_date("Encounter_DateTime").alias("date"),
        F.lower("code").alias("code"))


def clean_patients(raw: DataFrame) -> DataFrame:
    """subject_id, sex, dob, dod with missing text filled by '' (P15)."""
    return raw.select("subject_id", "sex", "dob", "dod").fillna("")


def clean_graph_labs(raw: DataFrame) -> DataFrame:
    """subject_id, date (epoch), lab_name, value (text); empty values dropped."""
    return raw.where(_non_empty("value")).select(
        F.col("subject_id").cast("long").alias("subject_id"),
        F.col("date").cast("long").alias("date"),
        F.col("lab_name"), F.col("value").cast("string").alias("value"))


def clean_graph_diagnostics(raw: DataFrame) -> DataFrame:
    """subject_id, date (epoch), code, sequence (int)."""
    return raw.select(F.col("subject_id").cast("long").alias("subject_id"),
                      F.col("date").cast("long").alias("date"), "code",
                      F.col("sequence").cast("int").alias("sequence"))


def clean_graph_medications(raw: DataFrame) -> DataFrame:
    """subject_id, date (epoch), med_name."""
    return raw.select(F.col("subject_id").cast("long").alias("subject_id"),
                      F.col("date").cast("long").alias("date"), "med_name")


def normalize_names(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, normalized_name(col))
