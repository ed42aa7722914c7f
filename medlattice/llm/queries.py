"""Registered queries of the operators, and the SQL of those that SQL can express.

Each query applies its operator to a whole table and derives the columns asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medlattice.llm import (chosen_path, exact_dedup, hard_negatives, langid, merkle, mixing, packing, pii, quality, shards,
                            url_trust, warc, winnowing)
from medlattice.llm.common import table

SOURCE_WEIGHTS = [5.0, 2.0, 1.0]
MAX_RATE = 3
SEQUENCE = 4096
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "coverage")


def op2_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op5_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trust.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprint_pairs(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest are of the base spans; ``spans`` has the accepted candidates as well, whose probabilities follow in turn."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))

    def of(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    n = [of(k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *n, F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"),
                        F.array_join(F.transform(F.filter("spans", lambda s: s["probability"].isNotNull()), lambda s: F.round(s["probability"], 4).cast("string")), ",").alias("probabilities"))


def op8_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), length=SEQUENCE, end_id=1, keep_ids=False)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS, MAX_RATE)
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine_hard_negatives(vectors, F.col("id") % 50 == 0)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves of the whole rows; tampered texts have lost their line feeds."""
    fields = ["doc_id", "source", "lang", "n_chars"]
    odd = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", merkle.leaf_hash(*map(F.col, fields), F.col("text")).alias("leaf"),
        merkle.leaf_hash(*map(F.col, fields), odd).alias("tampered"))
    proofs = merkle.build_manifest(rows).proofs()
    return (proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
                          merkle.fold(F.col("tampered"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op13_shuffled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the shards as written and read back."""
    written = shards.write_shards(table(spark, sf_dir, "documents"), shards=16)
    text = F.coalesce("text", F.lit(""))
    return written.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                          F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_chosen_path, op3_exact_dedup, op4_warc, op5_url_trust, op6_winnowing,
                                   op7_personal_data, op8_best_two_fit, op9_quality, op10_mixing, op11_hard_negatives,
                                   op12_merkle_manifest, op13_shuffled_shards)}

# Largest id of each group of equal texts; row counts and digests as in the contract.
_EXACT_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

# All anchors against all rows, and a rank in each window.
_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


# The lowest bit of a CRC-32, whose final inversion turns it: bytes from the left, eight shifts each.
_CRC_BIT = """(xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: unicode((doc_id::VARCHAR)[i])::UBIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [1::UBIGINT, 1, 1, 1, 1, 1, 1, 1]), lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT) & 1)"""


def _tree_sql(name: str, leaves: str) -> str:
    """Levels of trees of fan 3 over (key, place, h, n); where n is 1, h is the key's root."""
    return f"""{name} AS (
  SELECT key, 0 AS level, place, h, n FROM {leaves}
  UNION ALL
  SELECT key, level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (max(n) + 2) // 3 FROM {name} WHERE n > 1 GROUP BY key, level, place // 3)"""


def _siblings_sql(name: str, leaves: str, tree: str) -> str:
    """(key, place, level, l, r): the siblings of each leaf's ancestor at each level."""
    at = "a.place // CAST(pow(3, t.level) AS BIGINT)"
    return f"""{name} AS (
  SELECT a.key, a.place, t.level, coalesce(string_agg(t.h, '' ORDER BY t.place) FILTER (WHERE t.place < {at}), '') AS l,
         coalesce(string_agg(t.h, '' ORDER BY t.place) FILTER (WHERE t.place > {at}), '') AS r
  FROM {leaves} AS a JOIN {tree} AS t ON t.key = a.key AND t.n > 1 AND t.place // 3 = ({at}) // 3
  GROUP BY a.key, a.place, t.level)"""


_MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('1' || source, '0') AS key, {_leaf_sql("text")} AS h,
         CASE WHEN {_CRC_BIT} = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS tampered
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, h) - 1 AS place, count(*) OVER (PARTITION BY key) AS n FROM d),
{_tree_sql("t", "p")},
subs AS (SELECT key AS source_key, h, '' AS key, row_number() OVER (ORDER BY key) - 1 AS place, count(*) OVER () AS n FROM t WHERE n = 1),
{_tree_sql("c", "subs")},
{_siblings_sql("low", "p", "t")},
{_siblings_sql("high", "subs", "c")},
steps AS (
  SELECT key, place, level, l, r FROM low
  UNION ALL
  SELECT p.key, p.place, 1000 + high.level, l, r FROM p JOIN subs ON subs.source_key = p.key JOIN high ON high.place = subs.place),
paths AS (SELECT key, place, list({{'l': l, 'r': r}} ORDER BY level) AS path, string_agg(l || r, '' ORDER BY level) AS proof FROM steps GROUP BY key, place),
folded AS (
  SELECT p.doc_id, p.h AS leaf, subs.h AS subroot, (SELECT h FROM c WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_prepend({{'l': p.tampered, 'r': ''}}, coalesce(path, [])), lambda x, s: {{'l': sha256(s.l || x.l || s.r), 'r': ''}}).l AS folded_root
  FROM p JOIN subs ON subs.source_key = p.key LEFT JOIN paths ON paths.key = p.key AND paths.place = p.place)
SELECT *, folded_root = root AS verified FROM folded
"""

ORACLES: dict[str, str] = {"op3_exact_dedup": _EXACT_SQL, "op11_hard_negatives": _NEGATIVES_SQL, "op12_merkle_manifest": _MERKLE_SQL}
