"""Queries of the release checks: over the tables as built, and over altered copies in which each check has to find the cases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnquill.operators import keywords as K
from tarnquill.operators import multilabel as M
from tarnquill.operators import release as R
from tarnquill.operators import vectors as V
from tarnquill.plans import topic_queries as T
from tarnquill.plans import vector_queries as W
from tarnquill.plans.keyword_queries import _BASE as _KEYWORDS
from tarnquill.plans.keyword_queries import _Tables
from tarnquill.session import cut_lineage


def _united(built: list[DataFrame], altered: list[DataFrame]) -> DataFrame:
    parts = [x.withColumn("subject", F.lit("as built")) for x in built] + [x.withColumn("subject", F.lit("altered")) for x in altered]
    return reduce(DataFrame.unionByName, parts)


def scope_checks(spark: SparkSession, d: str) -> DataFrame:
    """Lists against edges, raw edges, and the default selection."""
    t = _Tables(spark, d)
    shares = cut_lineage(T._shares(t))
    raw = shares.where(F.round("p", 9) >= M.FLOOR)
    scoped = cut_lineage(M.scoped_edges(M.qualified_edges(shares, t.population, T._ledger(spark), T._rejected(shares), F.col("title").rlike(f"(?iu){T.ANCHOR}"))))
    lists = M.label_lists(shares)
    listed = shares.where(F.round("p", 9) >= M.THRESHOLD).select("row_id", "topic_id", F.round("p", 9).alias("p"))
    changed = lambda rows: rows.where("row_id % 101 <> 0").withColumn("p", F.when(F.col("row_id") % 103 == 0, F.col("p") + 0.001).otherwise(F.col("p")))
    kept = scoped.withColumn("stage", F.when((F.col("stage") == "pending") & (F.col("row_id") % 7 == 0), "retained").otherwise(F.col("stage")))
    return _united(
        [R.lists_equal_edges(lists, listed), R.raw_edges_kept(raw, raw.select("row_id", "topic_id", "p")), R.default_clean(scoped)],
        [R.lists_equal_edges(lists, changed(listed)), R.raw_edges_kept(raw, changed(raw)), R.default_clean(kept)],
    )


def keyword_checks(spark: SparkSession, d: str) -> DataFrame:
    """Evidence, exports, anchors and summaries of the dictionary classification."""
    t = _Tables(spark, d)
    hits = cut_lineage(t.hits)
    anchors, eligible, related = K.anchors(hits), cut_lineage(K.eligible_hits(hits)), cut_lineage(K.relations(hits))
    counts = related.groupBy("topic_code").agg(F.count("*").alias("documents"))
    wrong = related.withColumn("matched_codes", F.when(F.col("row_id") % 113 == 0, F.lit("none")).otherwise(F.col("matched_codes")))
    fewer = related.where("row_id % 109 <> 0")
    return _united(
        [R.evidence_observed(related, eligible), R.all_exported(related, eligible), R.conditional_anchored(eligible, anchors), R.summary_recounted(counts, related, "topic_code", "documents")],
        [R.evidence_observed(wrong, eligible), R.all_exported(fewer, eligible), R.conditional_anchored(hits, anchors), R.summary_recounted(counts, fewer, "topic_code", "documents")],
    )


def stage_checks(spark: SparkSession, d: str) -> DataFrame:
    """Populations of the stages, centres, ranks and disjoint samples."""
    t = _Tables(spark, d)
    wanted = t.population.groupBy("source").agg(F.count("*").alias("records"))
    stage = wanted.withColumn("stage", F.lit("finalised"))
    short = t.population.where("row_id % 50 <> 0 OR source <> 'policy'").groupBy("source").agg(F.count("*").alias("records")).withColumn("stage", F.lit("cut"))
    centres = V.centroids(W._all(spark, d))
    top = V.nearest_centroids(W._queries(spark, d), centres)
    longer = centres.withColumn("centroid", F.when(F.col("label") % 3 == 0, F.transform("centroid", lambda x: x * 1.01)).otherwise(F.col("centroid")))
    turned = top.withColumn("rank", F.when(F.col("vec_id") % 200 == 0, 4 - F.col("rank")).otherwise(F.col("rank")))
    papers, queries = W._papers(spark, d), W._queries(spark, d)
    return _united(
        [R.stages_agree(stage, wanted), R.centres_sound(centres), R.ranks_fall(top), R.ids_disjoint(papers, queries, "vec_id")],
        [R.stages_agree(short, wanted), R.centres_sound(longer), R.ranks_fall(turned), R.ids_disjoint(W._all(spark, d), queries, "vec_id")],
    )


def projection_sums(spark: SparkSession, d: str) -> DataFrame:
    """Queries whose projected shares don't sum to 1."""
    return V.projection_sums(V.projected(W._near(spark, d, 10), W._edges(spark, d), 10))


def _rows(*cells: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{check}' AS \"check\", '{subject}' AS subject, {sql} AS violations" for check, subject, sql in cells)


SQL = {
    "scope_checks": T._M + """, ls AS (SELECT row_id, topic_id, round(p, 9) AS p FROM shares WHERE round(p, 9) >= 0.1),
        rw AS (SELECT row_id, topic_id, p FROM shares WHERE round(p, 9) >= 0.05), sc AS (SELECT * FROM scoped WHERE threshold = 0.1),
        bad AS (SELECT * FROM sc WHERE state NOT IN ('keep_core', 'keep_supporting') OR NOT gate OR rejected) """ + _rows(
        ("lists_equal_edges", "as built", "(SELECT count(*) FROM ls WHERE p < 0.1)"), ("raw_edges_kept", "as built", "(SELECT count(*) FROM rw WHERE round(p, 9) < 0.05)"),
        ("default_clean", "as built", "(SELECT count(*) FROM bad WHERE stage = 'retained')"),
        ("lists_equal_edges", "altered", "(SELECT count(*) FROM ls WHERE row_id % 101 = 0 OR row_id % 103 = 0)"),
        ("raw_edges_kept", "altered", "(SELECT count(*) FROM rw WHERE row_id % 101 = 0 OR row_id % 103 = 0)"),
        ("default_clean", "altered", "(SELECT count(*) FROM bad WHERE stage = 'retained' OR (stage = 'pending' AND row_id % 7 = 0))"),
    ),
    "keyword_checks": _KEYWORDS + """, pairs AS (SELECT DISTINCT row_id, topic_code FROM eligible), tc AS (SELECT topic_code, bool_or(row_id % 109 = 0) AS hit FROM related GROUP BY ALL) """ + _rows(
        ("evidence_observed", "as built", "(SELECT count(*) FROM related r ANTI JOIN pairs USING (row_id, topic_code))"),
        ("all_exported", "as built", "(SELECT count(*) FROM pairs ANTI JOIN related USING (row_id, topic_code))"),
        ("conditional_anchored", "as built", "(SELECT count(*) FROM eligible WHERE decision = 'conditional' AND len(families) > 0 AND NOT list_has_any(families, anchor_topics))"),
        ("summary_recounted", "as built", "(SELECT count(*) FROM tc WHERE hit IS NULL)"),
        ("evidence_observed", "altered", "(SELECT count(*) FROM related WHERE row_id % 113 = 0)"),
        ("all_exported", "altered", "(SELECT count(*) FROM pairs WHERE row_id % 109 = 0)"),
        ("conditional_anchored", "altered", """(SELECT count(*) FROM hits LEFT JOIN anchors USING (row_id) WHERE decision = 'conditional'
            AND (anchor_topics IS NULL OR (len(families) > 0 AND NOT list_has_any(families, anchor_topics))))"""),
        ("summary_recounted", "altered", "(SELECT count(*) FROM tc WHERE hit)"),
    ),
    "stage_checks": W._ALL + _rows(
        ("stages_agree", "as built", "(SELECT count(*) FROM (SELECT source, count(*) AS n FROM population GROUP BY ALL) WHERE n = 0)"),
        ("centres_sound", "as built", "(SELECT count(*) FROM cen WHERE abs(sqrt(list_dot_product(c, c)) - 1) > 1e-6)"),
        ("ranks_fall", "as built", "(SELECT count(*) FROM (SELECT cosine - lag(cosine) OVER (PARTITION BY vec_id ORDER BY rank) AS step FROM ranked WHERE vec_id % 100 = 0 AND rank <= 3) WHERE step > 0)"),
        ("ids_disjoint", "as built", "(SELECT count(*) FROM v WHERE vec_id % 5 <> 0 AND vec_id % 100 = 0)"),
        ("stages_agree", "altered", "(SELECT count(*) FROM (SELECT count(*) FILTER (WHERE row_id % 50 = 0) AS n FROM population WHERE source = 'policy' GROUP BY source) WHERE n > 0)"),
        ("centres_sound", "altered", "(SELECT count(*) FROM cen WHERE label % 3 = 0)"),
        ("ranks_fall", "altered", "(SELECT count(*) FROM (SELECT max(cosine) - min(cosine) AS d FROM ranked WHERE vec_id % 200 = 0 AND rank <= 3 GROUP BY vec_id) WHERE d > 0)"),
        ("ids_disjoint", "altered", "(SELECT count(*) FROM v WHERE vec_id % 100 = 0)"),
    ),
    "projection_sums": W._BASE + "SELECT count(*) AS queries, count(*) FILTER (WHERE abs(total - 1) > 2e-5) AS off FROM (SELECT query_id, sum(p) AS total FROM proj WHERE n = 10 GROUP BY ALL)",
}

QUERIES = {f.__name__: f for f in (scope_checks, keyword_checks, stage_checks, projection_sums)}
