"""SQL text of the fixture views, used by the DuckDB oracles as CTEs.

Each entry is (name, dependencies, body). ``with_views(names, select)``
prefixes a query with every view it needs, in dependency order. The SQL is
plain ANSI that DuckDB runs over the driver's parquet views.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "line": ((), """
SELECT o.o_custkey AS patient_id, o.o_orderkey AS encounter_id,
       CAST(o.o_orderdate AS DATE) AS order_date, CAST(l.l_shipdate AS DATE) AS ship_date,
       l.l_returnflag AS flag, l.l_suppkey AS suppkey, l.l_partkey AS partkey,
       CAST(replace(p.p_brand, 'Brand#', '') AS INT) AS brand,
       l.l_linenumber AS linenumber, l.l_quantity AS quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                JOIN part p ON l.l_partkey = p.p_partkey"""),
    "ev": (("line",), """
SELECT patient_id,
       concat(CASE flag WHEN 'A' THEN 'DIAG' WHEN 'R' THEN 'DRUG' ELSE 'LAB' END,
              CAST(brand AS VARCHAR)) AS event_id,
       ship_date AS event_date,
       CASE WHEN linenumber = 7 THEN NULL ELSE quantity END AS value
FROM line"""),
    "mort": (("ev",), """
SELECT e.patient_id, max(e.event_date) AS death_date, 1 AS label
FROM ev e JOIN customer c ON c.c_custkey = e.patient_id
WHERE c.c_mktsegment = 'HOUSEHOLD' GROUP BY e.patient_id"""),
    "idx": (("ev", "mort"), """
SELECT patient_id, max(event_date) AS index_date, 0 AS label FROM ev
WHERE patient_id NOT IN (SELECT patient_id FROM mort) GROUP BY patient_id
UNION ALL
SELECT patient_id, CAST(death_date - INTERVAL 30 DAY AS DATE) AS index_date, 1 AS label FROM mort"""),
    "filt": (("ev", "idx"), """
SELECT e.patient_id, e.event_id, e.event_date, e.value, i.label
FROM ev e JOIN idx i ON e.patient_id = i.patient_id
WHERE e.event_date <= i.index_date
  AND e.event_date >= CAST(i.index_date - INTERVAL 2000 DAY AS DATE)"""),
    "prof": (("ev", "mort"), """
SELECT p.*, CASE WHEN m.patient_id IS NOT NULL THEN 'dead' ELSE 'alive' END AS cohort
FROM (SELECT patient_id, count(event_id) AS event_count,
             count(DISTINCT event_date) AS encounter_count,
             CAST(datediff('day', min(event_date), max(event_date)) AS BIGINT) AS record_length
      FROM ev GROUP BY patient_id) p
LEFT JOIN (SELECT DISTINCT patient_id FROM mort) m ON p.patient_id = m.patient_id"""),
    "fmap": (("ev",), """
SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS idx, event_id
FROM (SELECT DISTINCT event_id FROM ev) d"""),
    "graph_rec": (("line",), """
SELECT suppkey AS patient_id,
       CASE flag WHEN 'A' THEN 'diagnostic' WHEN 'R' THEN 'medication' ELSE 'lab' END AS kind,
       concat(flag, CAST(partkey AS VARCHAR)) AS code, ship_date AS date, quantity AS value,
       encounter_id, linenumber
FROM line"""),
    "gedges": (("graph_rec",), """
SELECT DISTINCT patient_id, code FROM graph_rec"""),
    "adm": ((), """
SELECT o_orderkey AS hadm_id, o_custkey AS subject_id, CAST(o_orderdate AS DATE) AS admit_time,
       CASE WHEN o_custkey % 10 <= 6 THEN 'train' WHEN o_custkey % 10 = 7 THEN 'validation'
            ELSE 'test' END AS split
FROM orders"""),
    "dx": (("line",), """
SELECT encounter_id AS hadm_id,
       concat(CASE WHEN brand % 5 = 0 THEN 'E' ELSE '' END, CAST(100 + brand AS VARCHAR),
              '.', CAST(linenumber AS VARCHAR)) AS icd9
FROM line WHERE flag = 'A'"""),
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(names: list[str] | tuple[str, ...], select: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH v1 AS (...), v2 AS (...), <extra ctes> <select>``."""
    parts = [f"{n} AS ({VIEWS[n][1].strip()})" for n in _order(list(names))]
    parts += [f"{n} AS ({body.strip()})" for n, body in (extra or [])]
    if not parts:
        return select.strip()
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()
