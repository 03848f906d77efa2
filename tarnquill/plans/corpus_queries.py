"""Queries of whole-corpus assignment, keyword parsing and dictionary building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnquill.operators import finalize as Z
from tarnquill.operators import observations as O
from tarnquill.operators.integrity import fingerprint
from tarnquill.operators.vectors import projected
from tarnquill.plans.topic_queries import _M, _shares
from tarnquill.plans.keyword_queries import _Tables
from tarnquill.plans.vector_queries import _BASE as _VECTORS
from tarnquill.plans.vector_queries import _edges, _near, _queries
from tarnquill.sources import table

#: Fixed value: names that the queries exclude.
OUTSIDE = "tariff|offset scheme"


def _final(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    source = F.when(F.col("vec_id") % 5 != 0, "paper").when(F.col("vec_id") % 2 == 0, "patent").otherwise("policy")
    labels = e.select("vec_id", F.when(F.col("vec_id") % 11 == 0, -1).otherwise(F.col("label")).alias("topic_id"))
    return Z.finalise(e.select("vec_id", source.alias("source")), labels, e.select("vec_id", "embedding"))


def corpus_finalise(spark: SparkSession, d: str) -> DataFrame:
    return _final(spark, d)


def corpus_coverage(spark: SparkSession, d: str) -> DataFrame:
    return Z.coverage(_final(spark, d))


def projection_status(spark: SparkSession, d: str) -> DataFrame:
    return Z.projection_status(_queries(spark, d), projected(_near(spark, d, 10), _edges(spark, d), 10), gate=0.3)


def review_packet(spark: SparkSession, d: str) -> DataFrame:
    return Z.review_packet(_shares(_Tables(spark, d)))


def vector_agreement(spark: SparkSession, d: str) -> DataFrame:
    """The vectors against themselves at half precision of the third decimal."""
    e = table(spark, d, "embeddings")
    return Z.agreement(e, e.withColumn("embedding", F.transform("embedding", lambda x: F.round(x.cast("double"), 3))).where("vec_id % 7 <> 0"))


def keyword_observations(spark: SparkSession, d: str) -> DataFrame:
    """Top-level keywords of every snapshot with their scores, the flat list where the JSON gives none."""
    return O.parsed_observations(table(spark, d, "chosen", "snapshot_id", "raw_keywords", "keywords"))


def dictionary_build(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary built from the vocabulary's names and the queries' own term lists."""
    names = table(spark, d, "vocab").select(F.lower(F.trim("normalized_name")).alias("name")).where("name IS NOT NULL AND name <> ''")
    last = F.element_at(F.split("name", " "), -1)
    lists = names.distinct().select("name", F.explode(F.array(
        F.when(last.isin("film", "membrane", "coating"), F.struct(F.lit("direct").alias("decision"), F.lit("T01").alias("topic_code"), F.lit(1).alias("priority"))),
        F.when(last.isin("valve", "reactor", "burner"), F.struct(F.lit("conditional").alias("decision"), F.lit("T02").alias("topic_code"), F.lit(1).alias("priority"))),
        F.when(last.isin("process", "effect", "valve"), F.struct(F.lit("broad_auxiliary").alias("decision"), F.lit("").alias("topic_code"), F.lit(3).alias("priority"))),
    )).alias("d")).where("d IS NOT NULL").select("name", "d.*")
    return O.build_dictionary(names, lists, [("outside", OUTSIDE)])


def table_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Rows and order-free hashes of the tables, to compare releases."""
    out = None
    for name in ("population", "vocab", "observations", "recent_metadata"):
        one = fingerprint(table(spark, d, name)).withColumn("table", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


SQL = {
    "corpus_finalise": _VECTORS + """, meta AS (SELECT vec_id, CASE WHEN vec_id % 5 <> 0 THEN 'paper' WHEN vec_id % 2 = 0 THEN 'patent' ELSE 'policy' END AS source, CASE WHEN vec_id % 11 = 0 THEN -1 ELSE label END AS t, e, u FROM v),
        lg AS (SELECT t, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM meta WHERE source = 'paper' AND t >= 0),
        ct AS (SELECT t, list(x ORDER BY i) AS m FROM (SELECT t, i, avg(x) AS x FROM lg GROUP BY ALL) GROUP BY t),
        cs AS (SELECT vec_id, ct.t, round(list_dot_product(u, list_transform(m, lambda x: x / sqrt(list_dot_product(m, m)))), 9) AS c FROM meta, ct WHERE source <> 'paper'),
        rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, t) AS r FROM cs),
        mv AS (SELECT vec_id, max(t) FILTER (WHERE r = 1) AS moved, max(c) FILTER (WHERE r = 1) AS cosine, max(c) FILTER (WHERE r = 1) - max(c) FILTER (WHERE r = 2) AS margin FROM rk GROUP BY ALL),
        fn AS (SELECT *, coalesce(CASE WHEN source = 'paper' THEN t ELSE moved END, -1) AS topic FROM meta LEFT JOIN mv USING (vec_id))
        SELECT vec_id, source, topic AS topic_id, CASE WHEN topic >= 0 THEN format('F{:04d}', topic + 1) ELSE '' END AS category_id, round(cosine, 6) AS cosine, round(margin, 6) AS margin,
        CASE WHEN source = 'paper' AND topic >= 0 THEN 'assigned' WHEN source = 'paper' THEN 'no_keyword_features' WHEN topic >= 0 THEN 'transferred' ELSE 'unusable_text' END AS status,
        source <> 'paper' AND topic >= 0 AS needs_review FROM fn""",
    "corpus_coverage": """SELECT CASE WHEN vec_id % 5 <> 0 THEN 'paper' WHEN vec_id % 2 = 0 THEN 'patent' ELSE 'policy' END AS source, count(*) AS input_records,
        count(*) FILTER (WHERE vec_id % 5 = 0 OR vec_id % 11 <> 0) AS assigned_records, count(*) FILTER (WHERE vec_id % 5 <> 0 AND vec_id % 11 = 0) AS unassigned_records FROM embeddings GROUP BY ALL""",
    "projection_status": _VECTORS + """, q AS (SELECT query_id, max(s1) AS s1, coalesce(string_agg(topic_id, '|' ORDER BY topic_id::VARCHAR) FILTER (WHERE round(p, 6) >= 0.1 AND round(s1, 6) >= 0.3), '') AS topic_ids FROM proj WHERE n = 10 GROUP BY ALL)
        SELECT vec_id, CASE WHEN s1 IS NULL THEN 'unusable' WHEN round(s1, 6) < 0.3 THEN 'below_similarity_gate' WHEN topic_ids = '' THEN 'below_contribution_threshold' ELSE 'assigned_candidate' END AS status,
        coalesce(topic_ids, '') AS topic_ids FROM v LEFT JOIN q ON vec_id = query_id WHERE vec_id % 100 = 0""",
    "review_packet": _M + """, pk AS (SELECT topic_id, row_id, row_number() OVER (PARTITION BY topic_id ORDER BY round(p, 9) DESC, row_id) AS place FROM shares)
        SELECT topic_id, row_id, 'top' AS kind, place::INT AS place FROM pk WHERE place <= 3 UNION ALL
        SELECT topic_id, row_id, 'sample', r::INT FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY md5(concat(row_id, topic_id, 'tq-5')), row_id) AS r FROM pk WHERE place > 3) WHERE r <= 5""",
    "vector_agreement": """WITH a AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings), b AS (SELECT vec_id, list_transform(x, lambda y: round(y, 3)) AS y FROM a WHERE vec_id % 7 <> 0)
        SELECT count(c) AS compared, round(min(c), 6) AS least, round(avg(c), 6) AS mean, 0::BIGINT AS only_b, count(*) FILTER (WHERE y IS NULL) AS only_a
        FROM (SELECT y, list_dot_product(x, y) / sqrt(list_dot_product(x, x) * list_dot_product(y, y)) AS c FROM a LEFT JOIN b USING (vec_id))""",
    "dictionary_build": """WITH n AS (SELECT DISTINCT lower(trim(normalized_name)) AS name FROM vocab WHERE trim(normalized_name) <> ''), l AS (SELECT name, string_split(name, ' ')[-1] AS w FROM n)
        SELECT format('KW{:05d}', row_number() OVER (ORDER BY name)) AS keyword_code, name AS canonical_name, CASE WHEN w IN ('film', 'membrane', 'coating') THEN 'direct' WHEN w IN ('valve', 'reactor', 'burner') THEN 'conditional'
        WHEN w IN ('process', 'effect') THEN 'broad_auxiliary' WHEN regexp_matches(name, 'tariff|offset scheme') THEN 'excluded_rule' ELSE 'unreviewed' END AS decision,
        CASE WHEN w IN ('film', 'membrane', 'coating') THEN 'T01' WHEN w IN ('valve', 'reactor', 'burner') THEN 'T02' ELSE '' END AS topic_code FROM l""",
}

QUERIES = {f.__name__: f for f in (
    corpus_finalise, corpus_coverage, projection_status, review_packet, vector_agreement, keyword_observations, dictionary_build, table_fingerprints
)}
