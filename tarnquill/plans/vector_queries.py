"""Queries of the vector operators.

Geometry goes over all vectors. Where topics are transferred the roles are: vectors whose number five divides come from
other sources, the rest are papers; of the papers, those with remainder 4 calibrate and the others train. Searches take the
vectors whose number a hundred divides as queries, against all references.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnquill.operators import vectors as V
from tarnquill.sources import table


def _all(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings")


def _papers(spark: SparkSession, d: str) -> DataFrame:
    return _all(spark, d).where("vec_id % 5 <> 0")


def _others(spark: SparkSession, d: str) -> DataFrame:
    return _all(spark, d).where("vec_id % 5 = 0")


def _queries(spark: SparkSession, d: str) -> DataFrame:
    return _all(spark, d).where("vec_id % 100 = 0")


def centroids(spark: SparkSession, d: str) -> DataFrame:
    c = V.centroids(_all(spark, d))
    return c.select("label", "n", F.posexplode("centroid").alias("i", "x")).select("label", "n", "i", F.round("x", 6).alias("x"))


def nearest_centroid_top3(spark: SparkSession, d: str) -> DataFrame:
    found = V.nearest_centroids(_others(spark, d), V.centroids(_papers(spark, d)))
    return found.withColumn("cosine", F.round("cosine", 6))


def argmax_recheck(spark: SparkSession, d: str) -> DataFrame:
    """Assigned topics against an independent plan for the greatest cosine: differences beyond the tolerance."""
    centres = V.centroids(_papers(spark, d))
    best = V.nearest_centroids(_others(spark, d), centres, 1)
    few = F.broadcast(centres.limit(V.MOST_CENTRES).select(F.collect_list(F.struct("label", "centroid")).over(V.Window.partitionBy()).alias("all")).limit(1))
    again = _others(spark, d).crossJoin(few).select(
        "vec_id", F.array_max(F.transform("all", lambda c: V.dot(V.unit(F.col("embedding")), c["centroid"]))).alias("greatest")
    )
    return best.join(again, "vec_id").agg(
        F.count("*").alias("checked"), F.count_if(F.abs(F.col("cosine") - F.col("greatest")) > 2e-6).alias("mismatches")
    )


def center_separation(spark: SparkSession, d: str) -> DataFrame:
    return V.centre_separation(V.centroids(_all(spark, d))).select(*(F.round(c, 6).alias(c) for c in ("mean", "p90", "greatest")))


def simplified_silhouette(spark: SparkSession, d: str) -> DataFrame:
    found = V.simplified_silhouette(_all(spark, d), V.centroids(_all(spark, d)))
    return found.withColumn("silhouette", F.round("silhouette", 6))


def cosine_silhouette(spark: SparkSession, d: str) -> DataFrame:
    return V.cosine_silhouette(_all(spark, d)).withColumn("silhouette", F.round("silhouette", 6))


def loo_cosine(spark: SparkSession, d: str) -> DataFrame:
    return V.leave_one_out(_all(spark, d)).withColumn("cosine", F.round("cosine", 6))


def davies_bouldin(spark: SparkSession, d: str) -> DataFrame:
    return V.davies_bouldin(_all(spark, d)).select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


def knn10_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Share of the queries' ten nearest with the own label, as it is and adjusted for chance."""
    rows = _all(spark, d).select("vec_id", "label")
    near = V.neighbours(_queries(spark, d), _all(spark, d), 10)
    own = near.join(rows.select(F.col("vec_id").alias("query_id"), F.col("label").alias("own")), "query_id").join(rows, "vec_id")
    share = own.agg(F.avg((F.col("own") == F.col("label")).cast("double")).alias("agreement"))
    sizes = rows.groupBy("label").agg(F.count("*").alias("s"))
    chance = sizes.agg((F.sum(F.col("s") * (F.col("s") - 1)) / (F.sum("s") * (F.sum("s") - 1))).alias("chance"))
    both = share.crossJoin(chance)  # one row each
    return both.select(
        F.round("agreement", 6).alias("agreement"), F.round("chance", 6).alias("chance"),
        F.round((F.col("agreement") - F.col("chance")) / (1 - F.col("chance")), 6).alias("adjusted"),
    )


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """Reference shares: two topics for each paper vector."""
    label = F.col("label")
    return _papers(spark, d).select("vec_id", F.explode(F.array(
        F.struct(label.alias("topic_id"), F.lit(0.7).alias("p")), F.struct(((label + 1) % 10).alias("topic_id"), F.lit(0.3).alias("p"))
    )).alias("e")).select("vec_id", "e.*")


def _near(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    return V.neighbours(_queries(spark, d), _papers(spark, d), k)


def knn_projection(spark: SparkSession, d: str) -> DataFrame:
    found = V.projected(_near(spark, d, 10), _edges(spark, d), 10)
    return found.select("query_id", "topic_id", F.round("p", 6).alias("p"), F.round("s1", 6).alias("s1"))


NEIGHBOUR_NUMBERS, GATES, THRESHOLDS = (5, 10, 20), (0.0, 0.2, 0.4), (0.05, 0.1, 0.3)


def _grid(spark: SparkSession, d: str, *halves: str) -> DataFrame:
    """Micro counts and F1 of projected topics over neighbours, gates and thresholds, from one search."""
    near, edges = _near(spark, d), _edges(spark, d)
    numbers = F.explode(F.array(*map(F.lit, NEIGHBOUR_NUMBERS))).alias("n")
    parts = V.projected(near.select("*", numbers), edges, within=("n",))
    half = (F.pmod(F.col("query_id") / 100, F.lit(2))).cast("int").alias("half")
    truth = _queries(spark, d).select(F.col("vec_id").alias("query_id"), F.col("label").alias("topic_id"), F.lit(1).alias("actual"), numbers)
    both = parts.join(truth, ["query_id", "topic_id", "n"], "full_outer").select("*", half)
    grid = both.withColumn("gate", F.explode(F.array(*map(F.lit, GATES)))).withColumn("t", F.explode(F.array(*map(F.lit, THRESHOLDS))))
    predicted = F.coalesce((F.round("p", 6) >= F.col("t")) & (F.round("s1", 6) >= F.col("gate")), F.lit(False))
    actual = F.col("actual").isNotNull()
    sums = grid.groupBy(*halves, "n", "gate", "t").agg(
        F.count_if(predicted & actual).alias("tp"), F.count_if(predicted & ~actual).alias("fp"), F.count_if(~predicted & actual).alias("fn")
    )
    return sums.withColumn("f1", F.round(F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)), 6))


def projection_grid_f1(spark: SparkSession, d: str) -> DataFrame:
    """Micro precision, recall and F1 of projected topics over neighbours, gates and thresholds."""
    return _grid(spark, d)


def projection_confirmed(spark: SparkSession, d: str) -> DataFrame:
    """The setting with the best F1 on one half of the queries (equal ones: fewer neighbours, lower gate and threshold), with
    its F1 on the other half, which had no part in the choice."""
    grid = _grid(spark, d, "half")  # twice 27 rows
    best = grid.where("half = 0").agg(F.min(F.struct((-F.col("f1")).alias("less"), "n", "gate", "t")).alias("b")).select("b.n", "b.gate", "b.t", (-F.col("b.less")).alias("chosen_f1"))
    other = grid.where("half = 1").select("n", "gate", "t", F.col("f1").alias("confirmed_f1"))
    return best.join(other, ["n", "gate", "t"])


def _margins(side: DataFrame, centres: DataFrame) -> DataFrame:
    top = V.nearest_centroids(side, centres, 2)
    pick = lambda r: F.max(F.when(F.col("rank") == r, F.col("cosine")))
    return top.groupBy("vec_id").agg(pick(1).alias("cosine"), (pick(1) - pick(2)).alias("margin"))


def confidence_p10(spark: SparkSession, d: str) -> DataFrame:
    """Tenth percentiles of cosine and margin of papers that had no part in the centroids."""
    papers = _papers(spark, d)
    return _margins(papers.where("vec_id % 5 = 4"), V.centroids(papers.where("vec_id % 5 <> 4"))).agg(
        F.round(F.percentile("cosine", 0.1), 6).alias("cosine_p10"), F.round(F.percentile("margin", 0.1), 6).alias("margin_p10")
    )


def transfer_flags(spark: SparkSession, d: str) -> DataFrame:
    """Transferred vectors that fall below the calibrated thresholds; all need review."""
    limits = confidence_p10(spark, d).first()
    low_cosine, low_margin = F.round("cosine", 6) < limits.cosine_p10, F.round("margin", 6) < limits.margin_p10
    return _margins(_others(spark, d), V.centroids(_papers(spark, d))).select(
        "vec_id", low_cosine.alias("low_cosine"), low_margin.alias("low_margin"), (~low_cosine & ~low_margin).alias("filter_passed"),
        F.lit(True).alias("needs_review"),
    )


def ari_labels(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of the labels with the nearest centroids."""
    found = V.nearest_centroids(_all(spark, d), V.centroids(_papers(spark, d)), 1)
    pairs = _all(spark, d).select("vec_id", "label").join(found.select("vec_id", "topic_id"), "vec_id")
    return V.adjusted_rand(pairs, "label", "topic_id").select(F.round("ari", 6).alias("ari"))


def size_gini(spark: SparkSession, d: str) -> DataFrame:
    """Inequality of category sizes and their effective number."""
    sizes = table(spark, d, "population", "category_id").where("category_id <> ''").groupBy("category_id").agg(F.count("*").alias("x"))
    order = V.Window.orderBy("x", "category_id")  # one row per category
    ranked = sizes.withColumn("i", F.row_number().over(order))
    n, total = F.count("*"), F.sum("x")
    return ranked.agg(F.round((2 * F.sum(F.col("i") * F.col("x")) / total - n - 1) / n, 6).alias("gini"))


def effective_topics(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "population", "category_id").where("category_id <> ''").groupBy("category_id").agg(F.count("*").alias("x"))
    p = F.col("x") / F.sum("x").over(V.Window.partitionBy())  # one row per category
    return sizes.select(p.alias("p")).agg(F.round(F.exp(-F.sum(F.col("p") * F.log("p"))), 6).alias("effective_topics"))


_BASE = """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS u, embedding::DOUBLE[] AS e FROM embeddings),
papers AS (SELECT * FROM v WHERE vec_id % 5 <> 0), others AS (SELECT * FROM v WHERE vec_id % 5 = 0),
long AS (SELECT label, generate_subscripts(e, 1) - 1 AS i, unnest(e) AS x FROM papers),
means AS (SELECT label, i, count(*) AS n, avg(x) AS x FROM long GROUP BY ALL),
cent AS (SELECT label, max(n) AS n, list(x ORDER BY i) AS mean FROM means GROUP BY ALL),
cen AS (SELECT label, n, mean, list_transform(mean, lambda x: x / sqrt(list_dot_product(mean, mean))) AS c FROM cent),
cosines AS (SELECT vec_id, vec_id % 5 = 0 AS other, v.label AS own_label, cen.label AS topic_id, round(list_dot_product(u, c), 9) AS cosine FROM v, cen),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, topic_id) AS rank FROM cosines),
near AS (SELECT * FROM (SELECT q.vec_id AS query_id, r.vec_id, round(list_dot_product(q.u, r.u), 9) AS cosine,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(q.u, r.u), 9) DESC, r.vec_id) AS rank FROM v q, papers r WHERE q.vec_id % 100 = 0) WHERE rank <= 20),
edges AS (SELECT vec_id, label AS topic_id, 0.7::DOUBLE AS p FROM papers UNION ALL SELECT vec_id, (label + 1) % 10, 0.3::DOUBLE FROM papers),
ns AS (SELECT unnest([5, 10, 20]) AS n),
w AS (SELECT n, query_id, vec_id, s1, exp((cosine - s1) / 0.05) AS w FROM (SELECT n, near.*, max(cosine) OVER (PARTITION BY n, query_id) AS s1 FROM near, ns WHERE rank <= n)),
proj AS (SELECT n, query_id, topic_id, sum(w / total * p) AS p, max(s1) AS s1 FROM (SELECT *, sum(w) OVER (PARTITION BY n, query_id) AS total FROM w) JOIN edges USING (vec_id) GROUP BY ALL),
margins AS (SELECT vec_id, other, max(cosine) FILTER (WHERE rank = 1) AS cosine, max(cosine) FILTER (WHERE rank = 1) - max(cosine) FILTER (WHERE rank = 2) AS margin FROM ranked GROUP BY ALL),
tlong AS (SELECT label, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM papers WHERE vec_id % 5 <> 4),
tcen AS (SELECT label, list(x ORDER BY i) AS m FROM (SELECT label, i, avg(x) AS x FROM tlong GROUP BY ALL) GROUP BY label),
tcos AS (SELECT vec_id, round(list_dot_product(u, m) / sqrt(list_dot_product(m, m)), 9) AS cosine, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_dot_product(u, m) / sqrt(list_dot_product(m, m)), 9) DESC) AS r
         FROM papers, tcen WHERE vec_id % 5 = 4),
tmar AS (SELECT vec_id, max(cosine) FILTER (WHERE r = 1) AS cosine, max(cosine) FILTER (WHERE r = 1) - max(cosine) FILTER (WHERE r = 2) AS margin FROM tcos GROUP BY ALL),
limits AS (SELECT round(quantile_cont(cosine, 0.1), 6) AS cosine_p10, round(quantile_cont(margin, 0.1), 6) AS margin_p10 FROM tmar),
totals AS (SELECT label, count(DISTINCT vec_id) AS n, list(x ORDER BY i) AS total FROM (SELECT label, i, min(vec_id) AS vec_id, sum(x) AS x FROM (SELECT vec_id, label, generate_subscripts(u, 1) AS i, unnest(u) AS x FROM v) GROUP BY label, i) GROUP BY label),
sizes AS (SELECT label, count(*) AS s FROM v GROUP BY ALL)
"""

_SIZES = "WITH s AS (SELECT category_id, count(*) AS x FROM population WHERE category_id <> '' GROUP BY ALL)"

_GRID = """, truth AS (SELECT vec_id AS query_id, label AS topic_id, n FROM v, ns WHERE vec_id % 100 = 0),
        g AS (SELECT (query_id // 100) % 2 AS half, n, gate, t, coalesce(round(p, 6) >= t AND round(s1, 6) >= gate, false) AS predicted, tr.query_id IS NOT NULL AS actual
              FROM proj FULL JOIN truth tr USING (n, query_id, topic_id), (SELECT unnest([0.0, 0.2, 0.4])::DOUBLE AS gate), (SELECT unnest([0.05, 0.1, 0.3])::DOUBLE AS t)),
"""

#: queries over all vectors: nobody is transferred
_WHOLE = ("centroids", "center_separation", "simplified_silhouette", "davies_bouldin")
_ALL = _BASE.replace("papers AS (SELECT * FROM v WHERE vec_id % 5 <> 0)", "papers AS (SELECT * FROM v)")

SQL = {k: (_ALL if k in _WHOLE else _BASE) + s for k, s in {
    "centroids": "SELECT label, n, (unnest(range(len(c))))::INT AS i, round(unnest(c), 6) AS x FROM cen",
    "nearest_centroid_top3": "SELECT vec_id, rank::INT AS rank, topic_id, round(cosine, 6) AS cosine FROM ranked WHERE other AND rank <= 3",
    "argmax_recheck": """SELECT count(*) AS checked, count(*) FILTER (WHERE abs(c - g) > 2e-6) AS mismatches FROM (SELECT vec_id, max(cosine) FILTER (WHERE rank = 1) AS c, max(list_dot_product(o.u, cen.c)) AS g
        FROM ranked JOIN others o USING (vec_id) JOIN cen ON cen.label = ranked.topic_id GROUP BY vec_id)""",
    "center_separation": """SELECT round(avg(m), 6) AS mean, round(quantile_cont(m, 0.9), 6) AS p90, round(max(m), 6) AS greatest
        FROM (SELECT a.label, max(round(list_dot_product(a.c, b.c), 9)) AS m FROM cen a, cen b WHERE a.label <> b.label GROUP BY ALL)""",
    "simplified_silhouette": """, d AS (SELECT p.vec_id, p.label, max(list_dot_product(u, c)) FILTER (WHERE cen.label = p.label) AS own, max(list_dot_product(u, c)) FILTER (WHERE cen.label <> p.label) AS other,
        arg_max(cen.label, list_dot_product(u, c)) FILTER (WHERE cen.label <> p.label) AS other_id FROM papers p, cen GROUP BY ALL)
        SELECT vec_id, label, round(((1 - other) - (1 - own)) / greatest(1 - own, 1 - other, 1e-12), 6) AS silhouette, other_id FROM d""",
    "cosine_silhouette": """, pd AS (SELECT a.vec_id, a.label, b.label AS l, sum(1 - list_dot_product(a.u, b.u)) AS dist, count(*) AS n FROM v a, v b WHERE a.vec_id <> b.vec_id GROUP BY ALL),
        ab AS (SELECT vec_id, label, max(dist / n) FILTER (WHERE l = label) AS a, min(dist / n) FILTER (WHERE l <> label) AS b FROM pd GROUP BY ALL)
        SELECT vec_id, label, round(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b, 1e-12) END, 6) AS silhouette FROM ab""",
    "loo_cosine": """, p AS (SELECT a.vec_id, a.label, list_transform(generate_series(1, 64), lambda k: list_sum(list_transform(o, lambda y: y[k]))) AS rest, u FROM (SELECT a.vec_id, a.label, any_value(a.u) AS u, list(b.u) AS o FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY ALL) a)
        SELECT vec_id, label, round(list_dot_product(u, rest) / sqrt(list_dot_product(rest, rest)), 6) AS cosine FROM p""",
    "davies_bouldin": """, s AS (SELECT label, mean, avg(list_distance(e, mean)) AS s FROM papers JOIN cen USING (label) GROUP BY ALL)
        SELECT round(avg(r), 6) AS davies_bouldin FROM (SELECT a.label, max((a.s + b.s) / list_distance(a.mean, b.mean)) AS r FROM s a, s b WHERE a.label <> b.label GROUP BY ALL)""",
    "knn10_agreement": """, k AS (SELECT a.label AS own, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(a.u, b.u), 9) DESC, b.vec_id) AS r FROM v a, v b WHERE a.vec_id <> b.vec_id AND a.vec_id % 100 = 0),
        x AS (SELECT avg((own = label)::INT) AS agreement FROM k WHERE r <= 10), y AS (SELECT sum(s * (s - 1)) / (sum(s) * (sum(s) - 1))::DOUBLE AS chance FROM sizes)
        SELECT round(agreement, 6) AS agreement, round(chance, 6) AS chance, round((agreement - chance) / (1 - chance), 6) AS adjusted FROM x, y""",
    "knn_projection": "SELECT query_id, topic_id, round(p, 6) AS p, round(s1, 6) AS s1 FROM proj WHERE n = 10",
    "projection_grid_f1": _GRID + """c AS (SELECT n, gate, t, count(*) FILTER (WHERE predicted AND actual) AS tp, count(*) FILTER (WHERE predicted AND NOT actual) AS fp, count(*) FILTER (WHERE NOT predicted AND actual) AS fn FROM g GROUP BY ALL)
        SELECT *, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1 FROM c""",
    "projection_confirmed": _GRID + """c AS (SELECT half, n, gate, t, round(coalesce(2 * count(*) FILTER (WHERE predicted AND actual) / nullif(count(*) FILTER (WHERE predicted) + count(*) FILTER (WHERE actual), 0)::DOUBLE, 0), 6) AS f1 FROM g GROUP BY ALL),
        b AS (SELECT * FROM c WHERE half = 0 ORDER BY f1 DESC, n, gate, t LIMIT 1)
        SELECT b.n, b.gate, b.t, b.f1 AS chosen_f1, o.f1 AS confirmed_f1 FROM b JOIN c o ON o.half = 1 AND o.n = b.n AND o.gate = b.gate AND o.t = b.t""",
    "confidence_p10": "SELECT * FROM limits",
    "transfer_flags": """SELECT vec_id, round(cosine, 6) < cosine_p10 AS low_cosine, round(margin, 6) < margin_p10 AS low_margin,
        NOT (round(cosine, 6) < cosine_p10) AND NOT (round(margin, 6) < margin_p10) AS filter_passed, true AS needs_review FROM margins, limits WHERE other""",
    "ari_labels": """, cells AS (SELECT own_label, topic_id, count(*) AS n FROM ranked WHERE rank = 1 GROUP BY ALL),
        x AS (SELECT sum(n * (n - 1) / 2) AS ij, sum(n) AS total FROM cells), a AS (SELECT sum(n * (n - 1) / 2) AS i FROM (SELECT sum(n) AS n FROM cells GROUP BY own_label)),
        b AS (SELECT sum(n * (n - 1) / 2) AS j FROM (SELECT sum(n) AS n FROM cells GROUP BY topic_id))
        SELECT round((ij - i * j / (total * (total - 1) / 2)) / ((i + j) / 2 - i * j / (total * (total - 1) / 2)), 6) AS ari FROM x, a, b""",
}.items()} | {
    "size_gini": _SIZES + """ SELECT round((2 * sum(i * x) / sum(x)::DOUBLE - count(*) - 1) / count(*), 6) AS gini FROM (SELECT x, row_number() OVER (ORDER BY x, category_id) AS i FROM s)""",
    "effective_topics": _SIZES + " SELECT round(exp(-sum(p * ln(p))), 6) AS effective_topics FROM (SELECT x / (sum(x) OVER ())::DOUBLE AS p FROM s)",
}

QUERIES = {f.__name__: f for f in (
    centroids, nearest_centroid_top3, argmax_recheck, center_separation, simplified_silhouette, cosine_silhouette, loo_cosine,
    davies_bouldin, knn10_agreement, knn_projection, projection_grid_f1, projection_confirmed, confidence_p10, transfer_flags, ari_labels, size_gini,
    effective_topics,
)}
