"""Queries of splits and candidate metrics: the vectors' numbers modulo five are their split (0 test, 4 validation, else train)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnquill.operators import bundle as B
from tarnquill.plans import vector_queries as W

#: Topics of the candidate, two of which are empty.
K = 12


def _rows(spark: SparkSession, d: str) -> DataFrame:
    split = F.when(F.col("vec_id") % 5 == 0, "test").when(F.col("vec_id") % 5 == 4, "validation").otherwise("train")
    return W._all(spark, d).select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 11 == 0, -1).otherwise(F.col("label")).alias("label"), (F.col("vec_id") % 7 != 0).alias("has_keywords"), split.alias("split")
    )


def split_problems(spark: SparkSession, d: str) -> DataFrame:
    """The three splits, with every fiftieth row given to a second split, and every ninth vector away."""
    rows = _rows(spark, d).select("vec_id", "split")
    twice = rows.unionByName(rows.where("vec_id % 50 = 0").withColumn("split", F.lit("train")))
    return B.split_problems(twice, W._all(spark, d).where("vec_id % 9 <> 0"))


def split_sizes(spark: SparkSession, d: str) -> DataFrame:
    return B.uniform_assignment(_rows(spark, d), K)[0]


def candidate_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d)
    found = B.candidate_metrics(rows.where("split = 'train'"), rows.where("split = 'validation'"), K, 12.5, 0.5)
    return found.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in found.dtypes))


def transfer_summary(spark: SparkSession, d: str) -> DataFrame:
    """Means, deviations and shares passed of the transferred vectors by source."""
    flags = W.transfer_flags(spark, d).select("vec_id", "filter_passed")
    margins = W._margins(W._others(spark, d), W.V.centroids(W._papers(spark, d)))
    source = F.when(F.col("vec_id") % 2 == 0, "patent").otherwise("policy").alias("source")
    found = B.source_summary(margins.join(flags, "vec_id").select("*", source))
    return found.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in found.dtypes))


_METRICS = W._BASE + """, lab AS (SELECT vec_id, CASE WHEN vec_id % 11 = 0 THEN -1 ELSE label END AS label, vec_id % 7 <> 0 AS has, u, e FROM v),
tr AS (SELECT * FROM lab WHERE vec_id % 5 IN (1, 2, 3) AND label >= 0), va AS (SELECT * FROM lab WHERE vec_id % 5 = 4),
sz AS (SELECT label, count(*) AS n, row_number() OVER (ORDER BY count(*), label) AS i, count(*) / sum(count(*)) OVER ()::DOUBLE AS p FROM tr GROUP BY label),
tl AS (SELECT label, i, avg(x) AS x FROM (SELECT label, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM tr) GROUP BY ALL),
tm AS (SELECT label, list(x ORDER BY i) AS m FROM tl GROUP BY label), tc AS (SELECT label, list_transform(m, lambda x: x / sqrt(list_dot_product(m, m))) AS c FROM tm),
ok AS (SELECT * FROM va WHERE has AND label IN (SELECT label FROM sz)),
pd AS (SELECT a.vec_id, a.label, b.label AS l, sum(1 - list_dot_product(a.u, b.u)) AS dist, count(*) AS n FROM ok a, ok b WHERE a.vec_id <> b.vec_id GROUP BY ALL),
ab AS (SELECT vec_id, label, max(dist / n) FILTER (WHERE l = label) AS a, min(dist / n) FILTER (WHERE l <> label) AS b FROM pd GROUP BY ALL),
sd AS (SELECT p.vec_id, max(list_dot_product(u, c)) FILTER (WHERE tc.label = p.label) AS own, max(list_dot_product(u, c)) FILTER (WHERE tc.label <> p.label) AS other FROM va p, tc WHERE p.label IN (SELECT label FROM sz) GROUP BY ALL),
ss AS (SELECT ((1 - other) - (1 - own)) / greatest(1 - own, 1 - other, 1e-12) AS s FROM sd),
ol AS (SELECT label, i, avg(x) AS x FROM (SELECT label, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM ok) GROUP BY ALL), om AS (SELECT label, list(x ORDER BY i) AS m FROM ol GROUP BY label),
sc AS (SELECT label, m, avg(list_distance(e, m)) AS s FROM ok JOIN om USING (label) GROUP BY ALL),
db AS (SELECT avg(r) AS r FROM (SELECT a.label, max((a.s + b.s) / list_distance(a.m, b.m)) AS r FROM sc a, sc b WHERE a.label <> b.label GROUP BY ALL)),
nc AS (SELECT vec_id, ok.label AS own, tc.label AS near, round(list_dot_product(u, c), 9) AS cosine, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_dot_product(u, c), 9) DESC, tc.label) AS r FROM ok, tc),
n2 AS (SELECT vec_id, max(own) AS own, max(near) FILTER (WHERE r = 1) AS near, max(cosine) FILTER (WHERE r = 1) AS c1, max(cosine) FILTER (WHERE r = 2) AS c2 FROM nc GROUP BY ALL),
ce AS (SELECT own, near, count(*) AS n FROM n2 GROUP BY ALL), x AS (SELECT sum(n * (n - 1) / 2) AS ij, sum(n) AS total FROM ce),
xa AS (SELECT sum(n * (n - 1) / 2) AS i FROM (SELECT sum(n) AS n FROM ce GROUP BY own)), xb AS (SELECT sum(n * (n - 1) / 2) AS j FROM (SELECT sum(n) AS n FROM ce GROUP BY near)),
sp AS (SELECT max(round(list_dot_product(a.c, b.c), 9)) AS m FROM tc a, tc b WHERE a.label <> b.label GROUP BY a.label)
SELECT 12 AS requested_k, (SELECT count(*) FROM sz)::INT AS active_topics, (12 - (SELECT count(*) FROM sz))::INT AS empty_topics, round((12 - (SELECT count(*) FROM sz)) / 12::DOUBLE, 6) AS empty_topic_fraction,
sum(n)::BIGINT AS train_documents_assigned, min(n) AS train_topic_size_min, round(quantile_cont(n, 0.1), 6) AS train_topic_size_p10, round(quantile_cont(n, 0.5), 6) AS train_topic_size_median, round(quantile_cont(n, 0.9), 6) AS train_topic_size_p90,
count(*) FILTER (WHERE n < 20)::INT AS train_topics_below_20, round((2 * sum(i * n) / sum(n)::DOUBLE - count(*) - 1) / count(*), 6) AS train_topic_size_gini, round(exp(-sum(p * ln(p))), 6) AS effective_topic_count,
(SELECT round(avg(has::INT), 6) FROM va) AS validation_keyword_coverage, round((SELECT count(*) FROM ok) / (SELECT count(*) FROM va)::DOUBLE, 6) AS validation_active_topic_coverage,
(SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b, 1e-12) END), 6) FROM ab) AS sampled_cosine_silhouette, (SELECT count(*) FROM ok)::INT AS sampled_silhouette_n,
(SELECT round(avg(s), 6) FROM ss) AS simplified_silhouette_mean, (SELECT round(avg((s < 0)::INT), 6) FROM ss) AS simplified_silhouette_negative_fraction, (SELECT round(r, 6) FROM db) AS davies_bouldin,
(SELECT round(avg((own = near)::INT), 6) FROM n2) AS keyword_embedding_top1_agreement, (SELECT round(avg(c1), 6) FROM n2) AS validation_nearest_centroid_cosine_mean, (SELECT round(avg(c1 - c2), 6) FROM n2) AS validation_nearest_centroid_margin_mean,
(SELECT round((ij - i * j / (total * (total - 1) / 2)) / ((i + j) / 2 - i * j / (total * (total - 1) / 2)), 6) FROM x, xa, xb) AS keyword_embedding_ari,
(SELECT round(avg(m), 6) FROM sp) AS nearest_center_cosine_mean, (SELECT round(quantile_cont(m, 0.9), 6) FROM sp) AS nearest_center_cosine_p90, (SELECT round(max(m), 6) FROM sp) AS nearest_center_cosine_max,
12.5::DOUBLE AS nmf_reconstruction_error, 0.5::DOUBLE AS nmf_relative_reconstruction_error FROM sz"""

_SPLIT = "CASE WHEN vec_id % 5 = 0 THEN 'test' WHEN vec_id % 5 = 4 THEN 'validation' ELSE 'train' END"

SQL = {
    "candidate_metrics": _METRICS,
    "split_problems": f"""WITH r AS (SELECT vec_id, {_SPLIT} AS split FROM embeddings UNION ALL SELECT vec_id, 'train' FROM embeddings WHERE vec_id % 50 = 0)
        SELECT split, count(*) AS rows, count(*) FILTER (WHERE vec_id % 9 <> 0) AS vectors, count(*) FILTER (WHERE vec_id % 50 = 0) AS shared FROM r GROUP BY ALL""",
    "split_sizes": f"""WITH r AS (SELECT CASE WHEN vec_id % 11 = 0 THEN -1 ELSE label END AS label, {_SPLIT} AS split FROM embeddings), c AS (SELECT label, split, count(*) AS n FROM r WHERE label >= 0 GROUP BY ALL)
        SELECT g.label::INT AS label, s.split, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY g.label) > 0 AS active FROM (SELECT unnest(range(12)) AS label) g CROSS JOIN (SELECT DISTINCT split FROM r) s LEFT JOIN c USING (label, split)""",
    "transfer_summary": W._BASE + """SELECT CASE WHEN vec_id % 2 = 0 THEN 'patent' ELSE 'policy' END AS source, count(*) AS documents, round(avg(cosine), 6) AS mean_cosine, round(median(cosine), 6) AS median_cosine, round(avg(margin), 6) AS mean_margin,
        round(stddev_samp(cosine), 6) AS std_cosine, round(stddev_samp(margin), 6) AS std_margin, round(avg((NOT (round(cosine, 6) < cosine_p10) AND NOT (round(margin, 6) < margin_p10))::INT), 6) AS passed_fraction FROM margins, limits WHERE other GROUP BY ALL""",
}

QUERIES = {f.__name__: f for f in (split_problems, split_sizes, candidate_metrics, transfer_summary)}
