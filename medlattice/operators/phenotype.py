"""Rule-based type-2 diabetes phenotyping in one aggregate per patient.

The original computes ~15 set operations (distinct/subtract/intersection),
each a shuffle. Here every rule is a boolean or a conditional minimum of a
single ``groupBy(patient_id)`` with partial aggregation, and the label is a
``when`` chain over those flags: one shuffle, any skew absorbed map-side.

Input: a long table ``patient_id, kind, name, date, value`` where kind is
'diagnostic', 'medication' or 'lab' (see :func:`clinical_union`).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.functions.scalars import normalized_name

CASE, CONTROL, OTHER = 1, 2, 3


@dataclass(frozen=True)
class PhenotypeRules:
    """Code sets and lab thresholds. Names are compared lower-case and
    trimmed on both sides. ``abnormal`` holds (test name, operator, limit)."""

    t1_dx: tuple[str, ...]
    t2_dx: tuple[str, ...]
    t1_med: tuple[str, ...]
    t2_med: tuple[str, ...]
    dm_related_dx: tuple[str, ...]
    abnormal: tuple[tuple[str, str, float], ...]
    glucose_names: tuple[str, ...] = ()
    glucose_substring: str | None = "glucose"
    dm_related_substring: str | None = "250."
    extra: dict = field(default_factory=dict)


# The published criteria of the type-2 diabetes rule (code and
# medicine lists, lab limits), as published. Names are lower-cased and
# trimmed when compared, so "ACTOS", "glucatrol " and "V77.1" match their
# lower-case forms; "code1"/"med1" are inert placeholders.
REFERENCE_RULES = PhenotypeRules(
    t1_dx=("code1", "250.01", "250.03", "250.11", "250.13", "250.21", "250.23", "250.31",
           "250.33", "250.41", "250.43", "250.51", "250.53", "250.61", "250.63", "250.71",
           "250.73", "250.81", "250.83", "250.91", "250.93"),
    t1_med=("med1", "lantus", "insulin glargine", "insulin aspart", "insulin detemir",
            "insulin lente", "insulin nph", "insulin reg", "insulin,ultralente"),
    t2_dx=("250.3", "250.32", "250.2", "250.22", "250.9", "250.92", "250.8", "250.82", "250.7",
           "250.72", "250.6", "250.62", "250.5", "250.52", "250.4", "250.42", "250.00", "250.02"),
    t2_med=("chlorpropamide", "diabinese", "diabanase", "diabinase", "glipizide", "glucotrol",
            "glucotrol xl", "glucatrol ", "glyburide", "micronase", "glynase", "diabetamide",
            "diabeta", "glimepiride", "amaryl", "repaglinide", "prandin", "nateglinide",
            "metformin", "rosiglitazone", "pioglitazone", "acarbose", "miglitol", "sitagliptin",
            "exenatide", "tolazamide", "acetohexamide", "troglitazone", "tolbutamide", "avandia",
            "actos", "ACTOS", "glipizide"),
    dm_related_dx=("790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84",
                   "648", "648", "648.01", "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1",
                   "256.4"),
    abnormal=(("hba1c", ">=", 6.0), ("hemoglobin a1c", ">=", 6.0),
              ("fasting glucose", ">=", 110.0), ("fasting blood glucose", ">=", 110.0),
              ("fasting plasma glucose", ">=", 110.0), ("glucose", ">", 110.0),
              ("glucose, serum", ">", 110.0)),
)

# Fixed values of the test fixture (brand numbers stand in for codes).
FIXTURE_RULES = PhenotypeRules(
    t1_dx=("1",), t2_dx=("2", "3"), t1_med=("4", "5"), t2_med=("6", "7"),
    dm_related_dx=("1", "2", "3"),
    abnormal=(("8", ">=", 40.0), ("9", ">", 40.0)),
    glucose_names=("8", "9"), glucose_substring=None, dm_related_substring=None,
)


def clinical_union(diagnostic: DataFrame, medication: DataFrame, lab: DataFrame) -> DataFrame:
    """The three sources as one long table (patient_id, kind, name, date, value)."""
    return (
        diagnostic.select("patient_id", F.lit("diagnostic").alias("kind"), F.col("code").alias("name"),
                          "date", F.lit(None).cast("double").alias("value"))
        .unionByName(medication.select("patient_id", F.lit("medication").alias("kind"),
                                       F.col("medicine").alias("name"), "date",
                                       F.lit(None).cast("double").alias("value")))
        .unionByName(lab.select("patient_id", F.lit("lab").alias("kind"), F.col("test_name").alias("name"),
                                "date", F.col("value").cast("double")))
    )


def _lower_set(values) -> list[str]:
    return sorted({v.strip().lower() for v in values})


def _is_glucose(name: Column, rules: PhenotypeRules) -> Column:
    conds = []
    if rules.glucose_names:
        conds.append(name.isin(_lower_set(rules.glucose_names)))
    if rules.glucose_substring:
        conds.append(name.contains(rules.glucose_substring.lower()))
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def _is_abnormal(name: Column, value: Column, rules: PhenotypeRules) -> Column:
    """Threshold rule per test name; unknown tests are never abnormal."""
    ops = {">=": lambda v, x: v >= x, ">": lambda v, x: v > x,
           "<=": lambda v, x: v <= x, "<": lambda v, x: v < x}
    out = F.lit(False)
    for test, op, limit in rules.abnormal:
        out = out | ((name == test.strip().lower()) & ops[op](value, F.lit(limit)))
    return out


def _is_dm_related(name: Column, rules: PhenotypeRules) -> Column:
    c = name.isin(_lower_set(rules.dm_related_dx))
    if rules.dm_related_substring:
        c = c | name.contains(rules.dm_related_substring.lower())
    return c


def phenotype_flags(records: DataFrame, rules: PhenotypeRules) -> DataFrame:
    """Per patient: t1d, t2d, t1m, t2m, first T1/T2 medication dates, glu, abn, rel."""
    name = normalized_name("name")
    kind = F.col("kind")
    dx, med, lab = kind == "diagnostic", kind == "medication", kind == "lab"
    t1m_row = med & name.isin(_lower_set(rules.t1_med))
    t2m_row = med & name.isin(_lower_set(rules.t2_med))

    def any_of(c: Column, alias: str) -> Column:
        return F.coalesce(F.bool_or(c), F.lit(False)).alias(alias)

    return records.groupBy("patient_id").agg(
        any_of(dx & name.isin(_lower_set(rules.t1_dx)), "t1d"),
        any_of(dx & name.isin(_lower_set(rules.t2_dx)), "t2d"),
        any_of(t1m_row, "t1m"),
        any_of(t2m_row, "t2m"),
        F.min(F.when(t1m_row, F.col("date"))).alias("m1"),
        F.min(F.when(t2m_row, F.col("date"))).alias("m2"),
        any_of(lab & _is_glucose(name, rules), "glu"),
        any_of(lab & _is_abnormal(name, F.col("value"), rules), "abn"),
        any_of(dx & _is_dm_related(name, rules), "rel"),
    )


def phenotype_labels(records: DataFrame, rules: PhenotypeRules = REFERENCE_RULES) -> DataFrame:
    """patient_id, label (1 case, 2 control, 3 other) for every patient
    present in any source.

    case    = no T1 dx, a T2 dx, and (no T1 med, or no T2 med, or the first
              T1 med strictly after the first T2 med)
    control = a glucose test, no abnormal lab, no diabetes-related dx
    """
    f = phenotype_flags(records, rules)
    case = (~F.col("t1d")) & F.col("t2d") & ((~F.col("t1m")) | (~F.col("t2m")) | (F.col("m1") > F.col("m2")))
    control = F.col("glu") & (~F.col("abn")) & (~F.col("rel"))
    label = F.when(case, F.lit(CASE)).when(control, F.lit(CONTROL)).otherwise(F.lit(OTHER))
    return f.select("patient_id", label.alias("label"))


def phenotype(medication: DataFrame, lab: DataFrame, diagnostic: DataFrame,
              rules: PhenotypeRules = REFERENCE_RULES) -> DataFrame:
    """D6 with the original three inputs."""
    return phenotype_labels(clinical_union(diagnostic, medication, lab), rules)


def label_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_patients"))


def glucose_means(lab: DataFrame, labels: DataFrame, rules: PhenotypeRules = REFERENCE_RULES) -> DataFrame:
    """Mean glucose value over lab rows of each phenotype group.

    Lab rows are reduced to (sum, non-null count, rows) per patient map-side
    before the join with the labels, so only one row per patient is
    shuffled (a patient with a third of the rows included); the group mean
    is the sum of sums over the sum of counts, i.e. the mean over rows.
    """
    name = normalized_name("test_name")
    g = (lab.where(_is_glucose(name, rules))
         .groupBy("patient_id").agg(F.sum("value").alias("_s"), F.count("value").alias("_nv"),
                                    F.count(F.lit(1)).alias("_nt")))
    per_label = g.join(labels, "patient_id").groupBy("label").agg(
        F.sum("_s").alias("_s"), F.sum("_nv").alias("_nv"), F.sum("_nt").alias("n_tests"))
    mean = F.when(F.col("_nv") > 0, F.col("_s") / F.col("_nv"))
    return per_label.select("label", F.round(mean, 9).alias("mean_glucose"), "n_tests")
