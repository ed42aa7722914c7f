"""Registered visit-sequence queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from medlattice.operators import sequences
from medlattice.plans.fixture_sql import with_views
from medlattice.plans.registry import query

_CODE = "CASE WHEN icd9 LIKE 'E%' THEN substr(icd9, 1, 4) ELSE substr(icd9, 1, 3) END"
_CTES = [
    ("cmap", f"""
SELECT code, CAST(row_number() OVER (ORDER BY code) - 1 AS BIGINT) AS code_idx
FROM (SELECT DISTINCT {_CODE} AS code FROM dx JOIN adm ON dx.hadm_id = adm.hadm_id
      WHERE adm.split = 'train') c"""),
    ("vlong", f"""
SELECT v.subject_id, v.visit_no, v.hadm_id, c.code_idx, v.split
FROM (SELECT hadm_id, subject_id, split,
             row_number() OVER (PARTITION BY subject_id ORDER BY admit_time, hadm_id) AS visit_no
      FROM adm) v
LEFT JOIN (SELECT d.hadm_id, m.code_idx FROM dx d JOIN cmap m ON {_CODE.replace('icd9', 'd.icd9')} = m.code) c
  ON v.hadm_id = c.hadm_id"""),
]


def _codemap(fx):
    train = fx.admissions.where(F.col("split") == "train").select("hadm_id")
    return sequences.build_codemap(fx.diagnoses_icd.join(train, "hadm_id", "left_semi"))


def _long(fx):
    return sequences.visit_sequence_long(fx.admissions, fx.diagnoses_icd, _codemap(fx))


@query("code_map", with_views(["dx", "adm"], "SELECT code, code_idx FROM cmap", _CTES[:1]),
       ("D11", "F8", "W3", "S9", "X5"))
def q_code_map(fx):
    """Main ICD-9 digits of train diagnoses numbered in code order."""
    return _codemap(fx)


@query("visit_sequence_codes", with_views(["dx", "adm"], """
SELECT subject_id, split, CAST(visit_no AS INT) AS visit_no, hadm_id, code_idx FROM vlong""", _CTES),
       ("D12", "T6", "J19", "P18"))
def q_visit_sequence_codes(fx):
    """Visits of every subject in admission order with their known codes."""
    return _long(fx).select("subject_id", "split", "visit_no", "hadm_id", "code_idx")


@query("visit_sequence_sizes", with_views(["dx", "adm"], """
SELECT s.subject_id, s.split, s.n_visits, s.n_codes, l.label
FROM (SELECT subject_id, split, count(DISTINCT hadm_id) AS n_visits, count(code_idx) AS n_codes
      FROM vlong GROUP BY subject_id, split) s
LEFT JOIN (SELECT c_custkey AS subject_id,
                  min(CAST(c_mktsegment = 'HOUSEHOLD' AS INT)) AS label
           FROM customer GROUP BY c_custkey) l ON s.subject_id = l.subject_id""", _CTES), ("D12", "J20"))
def q_visit_sequence_sizes(fx):
    """Visits and known codes per subject, with the mortality label."""
    rows = sequences.visit_code_counts(fx.admissions, fx.diagnoses_icd, _codemap(fx))
    return sequences.sequence_sizes(rows, sequences.subject_labels(fx.subject_mortality))


@query("num_features", with_views(["dx", "adm"], """
SELECT CAST(COALESCE(max(code_idx), -1) + 1 AS BIGINT) AS num_features FROM vlong WHERE split = 'train'""",
    _CTES), ("A27",))
def q_num_features(fx):
    """Largest code index in the train sequences plus one."""
    rows = sequences.visit_code_rows(fx.admissions, fx.diagnoses_icd, _codemap(fx))
    return sequences.num_features(rows.where(F.col("split") == "train"))


@query("multi_hot_visits", with_views(["dx", "adm"], """
SELECT DISTINCT subject_id, CAST(visit_no AS INT) AS visit_no, code_idx FROM vlong WHERE code_idx IS NOT NULL""",
    _CTES), ("D13", "F20"))
def q_multi_hot_visits(fx):
    """Multi-hot visit rows as (subject, visit, code) indices; repeats collapse."""
    return sequences.multi_hot_visits(fx.admissions, fx.diagnoses_icd, _codemap(fx))
