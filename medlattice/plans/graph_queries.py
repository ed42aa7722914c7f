"""Registered graph queries (G1-G7) over the supplier-part fixture graph."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from medlattice.operators import graph
from medlattice.plans.fixture_sql import with_views
from medlattice.plans.registry import query

# Query parameters: the patient whose neighbours are ranked, the walk settings.
QUERY_PATIENT = 1
WALK_ROUNDS = 100
RESTART = 0.15


def _graph(fx):
    return graph.build_graph(fx.graph_patients, fx.graph_records)


_VERTICES = ("verts", """
SELECT s_suppkey AS vertex_id, 'patient' AS kind, CAST(s_suppkey AS VARCHAR) AS key FROM supplier
UNION ALL
SELECT -row_number() OVER (ORDER BY kind, code) AS vertex_id, kind, code AS key
FROM (SELECT DISTINCT kind, code FROM graph_rec) d""")

_EDGES = ("gedge", """
SELECT src, dst, kind, date, value FROM (
  SELECT r.patient_id AS src, v.vertex_id AS dst, r.kind, r.date, r.value,
         row_number() OVER (PARTITION BY r.patient_id, r.kind, r.code
                            ORDER BY r.date DESC, r.encounter_id DESC, r.linenumber DESC) AS rn
  FROM graph_rec r JOIN verts v ON v.kind = r.kind AND v.key = r.code) x WHERE rn = 1
UNION ALL
SELECT dst, src, kind, date, value FROM (
  SELECT r.patient_id AS src, v.vertex_id AS dst, r.kind, r.date, r.value,
         row_number() OVER (PARTITION BY r.patient_id, r.kind, r.code
                            ORDER BY r.date DESC, r.encounter_id DESC, r.linenumber DESC) AS rn
  FROM graph_rec r JOIN verts v ON v.kind = r.kind AND v.key = r.code) y WHERE rn = 1""")

_PAIRS = ("pc", "SELECT src AS patient_id, dst AS code_id FROM gedge WHERE src >= 0")


@query("graph_vertices", with_views(["graph_rec"], "SELECT vertex_id, kind, key FROM verts", [_VERTICES]),
       ("G1", "W2", "U1", "P19"))
def q_graph_vertices(fx):
    """Patient vertices (suppliers) and one vertex per distinct (kind, code)."""
    return _graph(fx)[0]


@query("graph_edges", with_views(["graph_rec"], "SELECT src, dst, kind, date, value FROM gedge",
                                 [_VERTICES, _EDGES]), ("G1", "A15", "U2"))
def q_graph_edges(fx):
    """Both directions per distinct (patient, code) with its latest record."""
    return _graph(fx)[1]


@query("jaccard_top10", with_views(["graph_rec"], f"""
SELECT patient_id, round(similarity, 9) AS similarity FROM (
  SELECT p.vertex_id AS patient_id,
         COALESCE(CAST(COALESCE(x.i, 0) AS DOUBLE) / NULLIF(m.n + COALESCE(d.n, 0) - COALESCE(x.i, 0), 0), 0.0) AS similarity
  FROM verts p
  LEFT JOIN (SELECT b.patient_id, count(*) AS i FROM pc a JOIN pc b ON a.code_id = b.code_id
             WHERE a.patient_id = {QUERY_PATIENT} AND b.patient_id <> {QUERY_PATIENT} GROUP BY b.patient_id) x
    ON x.patient_id = p.vertex_id
  LEFT JOIN (SELECT patient_id, count(*) AS n FROM pc GROUP BY patient_id) d ON d.patient_id = p.vertex_id
  CROSS JOIN (SELECT count(*) AS n FROM pc WHERE patient_id = {QUERY_PATIENT}) m
  WHERE p.kind = 'patient' AND p.vertex_id <> {QUERY_PATIENT}) s
ORDER BY round(similarity, 12) DESC, patient_id LIMIT 10""", [_VERTICES, _EDGES, _PAIRS]),
       ("G3", "G2", "T2", "P19", "P20", "F16", "A17", "U5"))
def q_jaccard_top10(fx):
    """Ten patients most similar to the query patient (Jaccard over codes)."""
    keys = graph.patient_code_keys(fx.graph_records)
    top = graph.jaccard_one_vs_all(keys, fx.graph_patients, QUERY_PATIENT, k=10, code_cols=("kind", "code"))
    return top.select("patient_id", F.round("similarity", 9).alias("similarity"))


@query("jaccard_pairs", with_views(["graph_rec"], """
SELECT x.p1, x.p2, round(CAST(x.i AS DOUBLE) / (da.n + db.n - x.i), 9) AS similarity
FROM (SELECT a.patient_id AS p1, b.patient_id AS p2, count(*) AS i
      FROM pc a JOIN pc b ON a.code_id = b.code_id AND a.patient_id < b.patient_id
      GROUP BY a.patient_id, b.patient_id) x
JOIN (SELECT patient_id, count(*) AS n FROM pc GROUP BY patient_id) da ON da.patient_id = x.p1
JOIN (SELECT patient_id, count(*) AS n FROM pc GROUP BY patient_id) db ON db.patient_id = x.p2""",
    [_VERTICES, _EDGES, _PAIRS]), ("G4", "J15"))
def q_jaccard_pairs(fx):
    """Jaccard similarity of every patient pair that shares a code."""
    keys = graph.patient_code_keys(fx.graph_records)
    s = graph.jaccard_all_pairs(keys, distinct_input=True, code_cols=("kind", "code"))
    return s.select("p1", "p2", F.round("similarity", 9).alias("similarity"))


def _walk_sql(rounds: int, final: str) -> str:
    a = RESTART
    ctes = [_VERTICES, _EDGES,
            ("we", """SELECT e.src, e.dst, 1.0 / d.n AS w FROM gedge e
                      JOIN (SELECT src, count(*) AS n FROM gedge GROUP BY src) d ON d.src = e.src"""),
            ("r0", f"SELECT vertex_id AS vid, CAST({a} AS DOUBLE) AS rank FROM verts WHERE vertex_id = {QUERY_PATIENT}")]
    for i in range(rounds):
        ctes.append((f"r{i + 1}", f"""
SELECT vid, (1 - {a}) * s + CASE WHEN vid = {QUERY_PATIENT} THEN {a} ELSE 0 END AS rank
FROM (SELECT vid, sum(m) AS s FROM (
        SELECT e.dst AS vid, r.rank * e.w AS m FROM r{i} r JOIN we e ON e.src = r.vid
        UNION ALL SELECT vertex_id, 0.0 FROM verts WHERE vertex_id = {QUERY_PATIENT}) u
      GROUP BY vid) g"""))
    ctes.append(("ranks", f"""SELECT v.vertex_id, v.kind, COALESCE(r.rank, 0.0) AS rank
                            FROM verts v LEFT JOIN r{rounds} r ON r.vid = v.vertex_id"""))
    return with_views(["graph_rec"], final, ctes)


@query("random_walk_ranks", _walk_sql(WALK_ROUNDS, "SELECT vertex_id, kind, round(rank, 9) AS rank FROM ranks"),
       ("G5", "A18", "J16", "J17"))
def q_random_walk_ranks(fx):
    """Walk probability of every vertex after 100 rounds with restart 0.15."""
    v, e = _graph(fx)
    r = graph.random_walk(v, e, QUERY_PATIENT, WALK_ROUNDS, RESTART)
    return r.select("vertex_id", "kind", F.round("rank", 9).alias("rank"))


@query("random_walk_patients", _walk_sql(WALK_ROUNDS, f"""
SELECT patient_id, round(rank, 9) AS rank,
       CAST(row_number() OVER (ORDER BY round(rank, 12) DESC, patient_id) AS BIGINT) AS position
FROM (SELECT vertex_id AS patient_id, rank FROM ranks
      WHERE kind = 'patient' AND vertex_id <> {QUERY_PATIENT}) p"""), ("G6", "T3", "P19", "P20"))
def q_random_walk_patients(fx):
    """Every other patient ranked by walk probability from the query patient."""
    v, e = _graph(fx)
    r = graph.random_walk_one_vs_all(v, e, QUERY_PATIENT, WALK_ROUNDS, RESTART)
    return r.select("patient_id", F.round("rank", 9).alias("rank"), "position")


@query("pic_clusters", None, ("G7",))
def q_pic_clusters(fx):
    """Power-iteration clustering (k=3, 100 iterations) of the Jaccard graph."""
    keys = graph.patient_code_keys(fx.graph_records)
    sims = graph.jaccard_all_pairs(keys, distinct_input=True, code_cols=("kind", "code"))
    return graph.power_iteration_clusters(sims, k=3, max_iter=100)
