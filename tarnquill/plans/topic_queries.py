"""Queries of multi-label shares, scope, model metrics, lexical operators, factorisation and review ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnquill.operators import factors as N
from tarnquill.operators import integrity as C
from tarnquill.operators import keywords as K
from tarnquill.operators import lexical as L
from tarnquill.operators import multilabel as M
from tarnquill.operators import selection as S
from tarnquill.operators import vectors as V
from tarnquill.plans.keyword_queries import _BASE as _KEYWORDS
from tarnquill.plans.keyword_queries import _Tables
from tarnquill.session import cut_lineage, numbered
from tarnquill.sources import table

#: Fixed value: our anchor words of a record's title.
ANCHOR = "energy|power|solar|wind|energi|энерг|能|chaleur|calor"


#: The fits of the queries: the operator's epochs and steps at least, several updates of the topics an epoch, until the
#: relative error falls by less than a thousandth of itself.
SETTLED = {"inner": 20, "settle": 1e-3}
#: Topics of the registered mini-batch fit.
TOPICS = 450


def _shares(t: _Tables) -> DataFrame:
    none = t.obs.select("row_id", "keyword_id").where("false")
    return M.topic_shares(K.candidate_hits(t.coded, t.rules, none))


def _ledger(spark: SparkSession) -> DataFrame:
    """The scope ledger of the queries: a fixed rule on the topic number."""
    states = F.element_at(F.array(*map(F.lit, ("keep_core", "keep_supporting", "review", "exclude"))), (F.col("topic_id") % 4 + 1).cast("int"))
    return spark.range(1, 100).select(F.col("id").cast("int").alias("topic_id")).withColumn("state", states)


def _rejected(shares: DataFrame) -> DataFrame:
    return shares.where("row_id % 53 = 0 AND topic_id % 5 = 0").select("row_id", "topic_id")


def _edges(spark: SparkSession, t: _Tables) -> DataFrame:
    shares = _shares(t)
    return M.qualified_edges(shares, t.population, _ledger(spark), _rejected(shares), F.col("title").rlike(f"(?iu){ANCHOR}"))


def multilabel_edges(spark: SparkSession, d: str) -> DataFrame:
    shares = _shares(_Tables(spark, d)).where(F.round("p", 9) >= M.FLOOR)
    return shares.select("row_id", "topic_id", F.round("p", 6).alias("p"))


def multilabel_lists(spark: SparkSession, d: str) -> DataFrame:
    lists = M.label_lists(_shares(_Tables(spark, d)))
    return lists.select("row_id", F.array_join(F.col("topic_ids").cast("array<string>"), "|").alias("topic_ids"), "topic_count", F.round("retained", 6).alias("retained"))


def list_checks(spark: SparkSession, d: str) -> DataFrame:
    """Violations of what label lists promise: lengths, distinct topics, threshold, sums."""
    lists = M.label_lists(_shares(_Tables(spark, d)))
    return C.violations(lists, {
        "length": F.size("topic_ids") != F.col("topic_count"), "repeated": F.size(F.array_distinct("topic_ids")) != F.size("topic_ids"),
        "below": F.array_min("contributions") < M.THRESHOLD,
        "sum": F.abs(F.aggregate("contributions", F.lit(0.0), lambda s, x: s + x) - F.col("retained")) > 1e-6,
    })


def hard_assign_margin(spark: SparkSession, d: str) -> DataFrame:
    found = M.hard_assignment(_shares(_Tables(spark, d)))
    return found.select("row_id", "topic_id", F.round("top1", 6).alias("top1"), F.round("margin", 6).alias("margin"))


def quality_by_topic(spark: SparkSession, d: str) -> DataFrame:
    rows = M.hard_assignment(_shares(_Tables(spark, d)))
    return rows.groupBy("topic_id").agg(
        F.count("*").alias("documents"), F.round(F.median("top1"), 6).alias("median_share"), F.round(F.median("margin"), 6).alias("median_margin"),
        F.round(F.avg((F.col("margin") < 0.05).cast("double")), 6).alias("small_margin_share"),
    )


def scope_apply(spark: SparkSession, d: str) -> DataFrame:
    t = _Tables(spark, d)
    return M.scope_status(t.population, _shares(t), M.scoped_edges(_edges(spark, t)))


def scope_reject_override(spark: SparkSession, d: str) -> DataFrame:
    """Edges that a review rejected, with the stage they would have had."""
    edges = _edges(spark, _Tables(spark, d))
    return M.scoped_edges(edges).where("rejected").select("row_id", "topic_id", "state", "stage")


def scope_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    t = _Tables(spark, d)
    records = t.population.groupBy("source").agg(F.count("*").alias("records"))
    return M.sensitivity(_edges(spark, t), records)


def threshold_metrics(spark: SparkSession, d: str) -> DataFrame:
    t = _Tables(spark, d)
    return M.threshold_metrics(_shares(t), t.papers)


def lookup_threshold(spark: SparkSession, d: str, t: float = 0.15) -> DataFrame:
    """Edges of every hundredth record at another threshold, the excluded ones marked, nothing normalised again."""
    found = M.scoped_edges(_edges(spark, _Tables(spark, d)), t).where("row_id % 100 = 0")
    return found.select("row_id", "topic_id", F.round("p", 6).alias("p"), "state", (F.col("stage") == "retained").alias("included"))


def topic_cards(spark: SparkSession, d: str) -> DataFrame:
    """Each topic's commonest 15 keywords and a name of the first three."""
    t = _Tables(spark, d)
    counts = t.hits.groupBy("topic_code", "canonical_name").agg(F.countDistinct("row_id").alias("n"))
    order = Window.partitionBy("topic_code").orderBy(F.desc("n"), "canonical_name")
    top = counts.withColumn("r", F.row_number().over(order)).where("r <= 15")
    words = F.transform(F.array_sort(F.collect_list(F.struct("r", "canonical_name"))), lambda x: x["canonical_name"])
    return top.groupBy("topic_code").agg(words.alias("w")).select(
        "topic_code", F.array_join(F.slice("w", 1, 3), " / ").alias("name"), F.array_join("w", " | ").alias("keywords")
    )


def cooccurrence_npmi(spark: SparkSession, d: str) -> DataFrame:
    """Coherence of each topic: mean NPMI over the pairs of its ten commonest keywords, -1 for pairs never together."""
    t = _Tables(spark, d)
    counts = t.hits.groupBy("topic_code", "keyword_code").agg(F.countDistinct("row_id").alias("n"))
    order = Window.partitionBy("topic_code").orderBy(F.desc("n"), "keyword_code")
    top = counts.withColumn("r", F.row_number().over(order)).where("r <= 10").select("topic_code", "keyword_code", "n")
    pairs = top.alias("a").join(top.alias("b"), "topic_code").where("a.keyword_code < b.keyword_code")
    pairs = pairs.select("topic_code", F.col("a.keyword_code").alias("ka"), F.col("b.keyword_code").alias("kb"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))
    seen = t.hits.select("row_id", "topic_code", "keyword_code").distinct().join(F.broadcast(top.select("topic_code", "keyword_code")), ["topic_code", "keyword_code"])
    both = seen.alias("x").join(seen.alias("y"), ["row_id", "topic_code"]).where("x.keyword_code < y.keyword_code")  # ten a topic
    both = both.groupBy("topic_code", F.col("x.keyword_code").alias("ka"), F.col("y.keyword_code").alias("kb")).agg(F.count("*").alias("nab"))
    rows = pairs.join(both, ["topic_code", "ka", "kb"], "left")
    p = lambda c: F.col(c) / t.papers
    npmi = F.when(F.col("nab").isNull(), -1.0).otherwise(F.log(p("nab") / (p("na") * p("nb"))) / F.greatest(-F.log(p("nab")), F.lit(1e-12)))
    return rows.groupBy("topic_code").agg(F.count("*").alias("pairs"), F.round(F.avg(npmi), 6).alias("npmi"))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidate metrics made from the tables at hand: one candidate per nation."""
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(
        F.round(F.avg("s_acctbal"), 2).alias("sampled_cosine_silhouette"), F.max("s_acctbal").cast("double").alias("simplified_silhouette_mean"),
        F.min("s_acctbal").cast("double").alias("davies_bouldin"), F.count("*").cast("double").alias("empty_topic_fraction"),
    )
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(
        F.count("*").cast("double").alias("nearest_center_cosine_mean"), F.round(F.avg("c_acctbal"), 2).alias("keyword_embedding_ari")
    )
    joined = s.join(c, s.s_nationkey == c.c_nationkey)
    return joined.withColumn("requested_k", (400 + F.col("s_nationkey") * 8).cast("int")).drop("s_nationkey", "c_nationkey")


def model_selection_rank(spark: SparkSession, d: str) -> DataFrame:
    return S.scored_candidates(_candidates(spark, d)).select(
        "requested_k", F.round("mean_metric_rank", 6).alias("mean_metric_rank"), F.round("selection_score", 6).alias("selection_score"),
        "within_practical_tie", "selected",
    )


#: The penalties and tolerances of the sensitivity grid.
PENALTIES, TOLERANCES = (0.0, 0.05, 0.15, 0.30), (0.0, 0.01, 0.02, 0.05, 0.10)


def selection_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    """The choice under four penalties and five tolerances, and without each metric in turn."""
    grid = [("preference_sensitivity", "", p, t) for p in PENALTIES for t in TOLERANCES]
    grid += [("selection_metric_ablation", name, 0.15, 0.05) for name in S.DIRECTIONS]
    settings = spark.createDataFrame(grid, "kind string, omitted_metric string, penalty double, tolerance double")  # 26 rows
    rows = _candidates(spark, d).crossJoin(F.broadcast(settings))
    scored = S.scored_candidates(rows, penalty=F.col("penalty"), tolerance=F.col("tolerance"), within=("kind", "omitted_metric", "penalty", "tolerance"), omitted=F.col("omitted_metric"))
    return scored.where("selected").select("kind", "omitted_metric", "penalty", "tolerance", F.col("requested_k").alias("selected_k"))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text", "source")


def bow_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Every word and word pair of each document, in any script, with its count."""
    return L.bag_of_words(_documents(spark, d), "doc_id", "source")


def bow_counts(spark: SparkSession, d: str) -> DataFrame:
    """Every word and word pair per source, in any script, with its count; documents without source under null."""
    return L.bag_of_words(_documents(spark, d), "source")


def ctfidf_top_words(spark: SparkSession, d: str) -> DataFrame:
    """Each source's 20 heaviest terms, weighed over all terms in any script; documents without source are a class."""
    counts = cut_lineage(bow_counts(spark, d))  # read by three groupings
    top = L.top_terms(L.class_tfidf(counts, "source"), "source")
    return top.select("source", "rank", "term", F.round("weight", 6).alias("weight"))


def text_view_head_mid_tail(spark: SparkSession, d: str) -> DataFrame:
    view = L.head_middle_tail(F.col("text"))
    return _documents(spark, d).where("text IS NOT NULL").select("doc_id", F.length(view).alias("n"), F.md5(view).alias("view_md5"))


def chunk_weights(spark: SparkSession, d: str) -> DataFrame:
    return L.chunks(_documents(spark, d)).select("doc_id", "chunk", "n_tokens", F.round("weight", 6).alias("weight"))


def source_weights(spark: SparkSession, d: str) -> DataFrame:
    return L.source_weights(table(spark, d, "population", "source")).withColumn("weight", F.round("weight", 6))


def _features(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    t = _Tables(spark, d)
    terms = cut_lineage(K.vocabulary(t.obs, t.papers))
    index = numbered(terms.select("keyword_id"), "keyword_id", "col")
    rows = N.sparse_rows(K.tfidf(t.obs, terms), index)
    # small rows, dear to solve: as many tasks as there are cores at least
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return cut_lineage(rows.repartition(tasks)), terms.count()


def nmf_fit_infer(spark: SparkSession, d: str) -> DataFrame:
    """Each record's hard topic, share and margin by a factorisation fitted on the same tables in mini-batches."""
    rows, n = _features(spark, d)
    return N.infer_hard(rows, N.fit_online(rows, n, TOPICS, measured=False).h)


def nmf_error(spark: SparkSession, d: str) -> DataFrame:
    """The relative error of a fit by whole passes, pass by pass, until it settles."""
    rows, n = _features(spark, d)
    _, errors = N.fit(rows, n, 10, **SETTLED)
    return spark.createDataFrame([(i, float(e)) for i, e in enumerate(errors, 1)], "epoch int, relative_error double")


def nmf_online_error(spark: SparkSession, d: str) -> DataFrame:
    """The relative error of the mini-batch fit after each epoch, and the visits of rows."""
    rows, n = _features(spark, d)
    found = N.fit_online(rows, n, TOPICS)
    return spark.createDataFrame([(i, float(e), found.visits) for i, e in enumerate(found.errors, 1)], "epoch int, relative_error double, visits bigint")


def component_matching(spark: SparkSession, d: str) -> DataFrame:
    """Topics of two fits with different seeds, matched."""
    rows, n = _features(spark, d)
    a, b = (N.fit(rows, n, 6, seed=s, **SETTLED)[0] for s in (17, 29))
    return spark.createDataFrame(N.matched_components(a, b), "topic_id int, other_id int, cosine double")


def component_stability(spark: SparkSession, d: str) -> DataFrame:
    """A fit against one from another seed and one on four fifths of the records: matched topics, mean and tenth percentile
    of their cosines, and agreement of the labels of all records."""
    rows, n = _features(spark, d)
    base = N.fit(rows, n, 6, **SETTLED)[0]
    out = None
    for variant, seed, part in (("seed", 29, rows), ("four_fifths", 17, rows.where(F.pmod(F.xxhash64("row_id"), F.lit(5)) != 0))):
        one = N.stability(rows, base, N.fit(part, n, 6, seed=seed, **SETTLED)[0]).withColumn("variant", F.lit(variant))
        out = one if out is None else out.unionByName(one)
    return out


def weighted_pca(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").withColumn("weight", F.when(F.col("vec_id") % 5 == 0, 2.0).otherwise(1.0))
    mean, axes = N.weighted_pca(rows, 4)
    lit = lambda x: F.array(*(F.lit(float(v)) for v in x))
    centred = F.zip_with(F.col("embedding"), lit(mean), lambda a, b: a.cast("double") - b)
    return rows.select("vec_id", *(F.round(F.abs(V.dot(centred, lit(a))), 5).alias(f"c{i}") for i, a in enumerate(axes, 1)))


def kmeans_assign(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").withColumn("weight", F.when(F.col("vec_id") % 5 == 0, 2.0).otherwise(1.0))
    return N.clusters(rows, 10)


def review_validation(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with the label ledger: labels missing, outside the list, contradicting, or of unknown documents."""
    labels, documents = table(spark, d, "quality_labels"), table(spark, d, "documents", "doc_id")
    per = labels.groupBy("doc_id").agg(F.countDistinct("label").alias("kinds"))
    a = C.violations(labels, {"missing_label": F.col("label").isNull(), "unknown_label": ~F.col("label").isin("prose", "list", "table", "junk")})
    b = C.violations(per, {"contradicting": F.col("kinds") > 1})
    c = labels.join(documents, "doc_id", "left_anti").agg(F.lit("unknown_document").alias("rule"), F.count("*").alias("violations"))
    return a.unionByName(b).unionByName(c)


def ledger_latest(spark: SparkSession, d: str) -> DataFrame:
    """The last event of each user, of equal times the greater number."""
    events = table(spark, d, "events", "event_id", "ts", "user_id", "event_type")
    last = F.max(F.struct("ts", "event_id", "event_type")).alias("last")
    return events.groupBy("user_id").agg(last).select("user_id", "last.event_id", "last.event_type")


_M = _KEYWORDS + f""", mass AS (SELECT row_id, regexp_extract(topic_code, '[0-9]+$')::INT AS topic_id, sum(score) AS mass FROM allhits GROUP BY ALL),
shares AS (SELECT *, mass / greatest(sum(mass) OVER (PARTITION BY row_id), 1e-12) AS p FROM mass),
ledger AS (SELECT topic_id::INT AS topic_id, ['keep_core', 'keep_supporting', 'review', 'exclude'][topic_id % 4 + 1] AS state FROM (SELECT unnest(range(1, 100)) AS topic_id)),
meta AS (SELECT row_id, source, usable AND NOT retracted AND NOT template_record AS gate, coalesce(regexp_matches(title, '{ANCHOR}', 'i'), false) AS anchor FROM population),
edges AS (SELECT *, row_id % 53 = 0 AND topic_id % 5 = 0 AS rejected, gate AND NOT (row_id % 53 = 0 AND topic_id % 5 = 0) AS qualified
          FROM shares JOIN meta USING (row_id) JOIN ledger USING (topic_id) WHERE round(p, 9) >= 0.05),
ts AS (SELECT unnest([0.05, 0.10, 0.15])::DOUBLE AS threshold),
ctx AS (SELECT edges.*, threshold, anchor OR bool_or(state = 'keep_core' AND qualified) OVER (PARTITION BY threshold, row_id) AS context FROM edges, ts WHERE round(p, 9) >= threshold),
scoped AS (SELECT *, CASE WHEN NOT qualified THEN 'unqualified' WHEN state = 'keep_core' OR (state = 'keep_supporting' AND context) THEN 'retained'
           WHEN state = 'review' OR state = 'keep_supporting' THEN 'pending' ELSE 'excluded' END AS stage FROM ctx),
ranked AS (SELECT row_id, topic_id, mass, round(p, 9) AS q, row_number() OVER (PARTITION BY row_id ORDER BY round(p, 9) DESC, topic_id) AS r, sum(mass) OVER (PARTITION BY row_id) AS total FROM shares),
hard AS (SELECT row_id, CASE WHEN max(total) > 1e-12 THEN max(topic_id) FILTER (WHERE r = 1) ELSE -1 END AS topic_id, CASE WHEN max(total) > 1e-12 THEN max(q) FILTER (WHERE r = 1) ELSE 0 END AS top1,
         CASE WHEN max(total) > 1e-12 THEN max(q) FILTER (WHERE r = 1) - coalesce(max(q) FILTER (WHERE r = 2), 0) ELSE 0 END AS margin FROM ranked GROUP BY ALL)
"""

_CAND = """
WITH m AS (SELECT (400 + s_nationkey * 8)::INT AS requested_k, a AS sampled_cosine_silhouette, b AS simplified_silhouette_mean, c AS davies_bouldin, e AS empty_topic_fraction, f AS nearest_center_cosine_mean, g AS keyword_embedding_ari
  FROM (SELECT s_nationkey, round(avg(s_acctbal), 2) AS a, max(s_acctbal) AS b, min(s_acctbal) AS c, count(*) AS e FROM supplier GROUP BY ALL)
  JOIN (SELECT c_nationkey AS s_nationkey, count(*) AS f, round(avg(c_acctbal), 2) AS g FROM customer GROUP BY ALL) USING (s_nationkey)),
k AS (SELECT * FROM m WHERE requested_k BETWEEN 450 AND 550),
r AS (SELECT requested_k, """ + ", ".join(
    f"(SELECT count(*) FILTER (WHERE o.{n} {'<' if low else '>'} k.{n}) + (count(*) FILTER (WHERE o.{n} = k.{n}) + 1) / 2.0 FROM k o) AS r_{n}" for n, low in S.DIRECTIONS.items()
) + """ FROM k),
g AS (SELECT 'preference_sensitivity' AS kind, '' AS omitted_metric, penalty, tolerance FROM (SELECT unnest([0.0, 0.05, 0.15, 0.3])::DOUBLE AS penalty), (SELECT unnest([0.0, 0.01, 0.02, 0.05, 0.1])::DOUBLE AS tolerance)
  UNION ALL SELECT 'selection_metric_ablation', unnest(""" + str(list(S.DIRECTIONS)) + """), 0.15, 0.05),
m2 AS (SELECT *, (""" + " + ".join(f"CASE WHEN omitted_metric = '{n}' THEN 0 ELSE r_{n} END" for n in S.DIRECTIONS) + """) / CASE WHEN omitted_metric = '' THEN 6 ELSE 5 END AS mean_metric_rank FROM r, g),
s AS (SELECT *, round(mean_metric_rank + penalty * abs(requested_k - 500) / 50, 9) AS selection_score FROM m2),
tied AS (SELECT *, selection_score <= min(selection_score) OVER (PARTITION BY kind, omitted_metric, penalty, tolerance) + tolerance + 1e-9 AS within_practical_tie FROM s),
o AS (SELECT *, row_number() OVER (PARTITION BY kind, omitted_metric, penalty, tolerance ORDER BY within_practical_tie DESC, abs(requested_k - 500), selection_score, requested_k) = 1 AS selected FROM tied)
"""

_WORDS = f"""
WITH s AS (SELECT doc_id, source, unnest(string_split_regex(lower(text), '[.!?;\\n。！？；]+')) AS s FROM documents WHERE text IS NOT NULL),
r AS (SELECT doc_id, source, regexp_extract_all(s, '[\\p{{L}}\\p{{N}}]+') AS r FROM s),
w AS (SELECT doc_id, source, list_filter(flatten(list_transform(r, lambda x: CASE WHEN regexp_full_match(x, '\\p{{Han}}+') AND length(x) > 1
    THEN list_transform(range(1, length(x)), lambda i: substr(x, i, 2)) ELSE [x] END)), lambda x: length(x) >= 2 AND NOT list_contains({L.STOP}, x)) AS w FROM r),
t AS (SELECT doc_id, source, unnest(w) AS term FROM w UNION ALL SELECT doc_id, source, unnest(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) FROM w WHERE len(w) >= 2),
c AS (SELECT source, term, count(*) AS n FROM t GROUP BY ALL)
"""

SQL = {k: _M + s for k, s in {
    "multilabel_edges": "SELECT row_id, topic_id, round(p, 6) AS p FROM shares WHERE round(p, 9) >= 0.05",
    "multilabel_lists": """SELECT row_id, string_agg(topic_id, '|' ORDER BY q DESC, topic_id) AS topic_ids, count(*)::INT AS topic_count, round(sum(p), 6) AS retained
        FROM (SELECT *, round(p, 9) AS q FROM shares) WHERE q >= 0.1 GROUP BY ALL""",
    "hard_assign_margin": "SELECT row_id, topic_id, round(top1, 6) AS top1, round(margin, 6) AS margin FROM hard",
    "quality_by_topic": """SELECT topic_id, count(*) AS documents, round(median(top1), 6) AS median_share, round(median(margin), 6) AS median_margin,
        round(avg((margin < 0.05)::INT), 6) AS small_margin_share FROM hard GROUP BY ALL""",
    "scope_apply": """, f AS (SELECT row_id, bool_or(stage = 'retained') AS kept, bool_or(stage = 'pending') AS waiting, bool_or(stage = 'excluded') AS outside, bool_or(rejected) AS refused,
        string_agg(topic_id, '|' ORDER BY topic_id) FILTER (WHERE stage = 'retained') AS retained_topics FROM scoped WHERE threshold = 0.1 GROUP BY ALL)
        SELECT row_id, source, CASE WHEN kept THEN CASE WHEN source = 'paper' THEN 'assigned' ELSE 'assigned_candidate' END WHEN refused THEN 'relation_review_rejected' WHEN NOT gate THEN 'quality_gate_abstained'
            WHEN waiting THEN 'scope_review_pending' WHEN outside THEN 'excluded_by_topic_scope' WHEN greatest IS NULL THEN 'no_features' ELSE 'below_contribution_threshold' END AS status,
            coalesce(retained_topics, '') AS retained_topics FROM meta LEFT JOIN f USING (row_id) LEFT JOIN (SELECT row_id, max(p) AS greatest FROM shares GROUP BY ALL) USING (row_id)""",
    "scope_reject_override": "SELECT row_id, topic_id, state, stage FROM scoped WHERE threshold = 0.1 AND rejected",
    "scope_sensitivity": """, st AS (SELECT *, unnest(list_filter(['raw', CASE WHEN qualified THEN 'quality_qualified' END, CASE WHEN stage <> 'unqualified' THEN stage END], lambda x: x IS NOT NULL)) AS s FROM scoped),
        dd AS (SELECT source, threshold, s AS stage, row_id, count(*) AS n, sum(p) AS mass FROM st GROUP BY ALL),
        a AS (SELECT source, threshold, stage, count(*) AS assigned_documents, count(*) FILTER (WHERE n > 1) AS multiple_topic_documents, sum(n)::BIGINT AS edges, round(sum(mass), 4) AS contribution_mass FROM dd GROUP BY ALL)
        SELECT *, round(assigned_documents / records::DOUBLE, 6) AS coverage, round(edges / assigned_documents::DOUBLE, 6) AS mean_topics_assigned FROM a JOIN (SELECT source, count(*) AS records FROM population GROUP BY ALL) USING (source)""",
    "threshold_metrics": """, tt AS (SELECT unnest([0.05, 0.10, 0.15, 0.30])::DOUBLE AS threshold),
        dd AS (SELECT threshold, row_id, count(*) FILTER (WHERE round(p, 9) >= threshold) AS n, coalesce(sum(round(p, 9)) FILTER (WHERE round(p, 9) >= threshold), 0) AS mass FROM shares, tt GROUP BY ALL)
        SELECT threshold, count(*) AS feature_documents, count(*) FILTER (WHERE dd.n > 0) AS covered, round(avg(dd.n), 6) AS mean_topics, quantile_cont(dd.n, 0.95) AS p95_topics, max(dd.n) AS most_topics, round(avg(mass), 6) AS retained_mass,
        round(count(*) FILTER (WHERE dd.n > 0) / any_value(papers.n)::DOUBLE, 6) AS coverage_all FROM dd, papers GROUP BY threshold""",
    "lookup_threshold": "SELECT row_id, topic_id, round(p, 6) AS p, state, stage = 'retained' AS included FROM scoped WHERE threshold = 0.15 AND row_id % 100 = 0",
    "topic_cards": """, kc AS (SELECT topic_code, canonical_name, count(DISTINCT row_id) AS n FROM hits GROUP BY ALL),
        kr AS (SELECT *, row_number() OVER (PARTITION BY topic_code ORDER BY n DESC, canonical_name) AS r FROM kc)
        SELECT topic_code, string_agg(canonical_name, ' / ' ORDER BY r) FILTER (WHERE r <= 3) AS name, string_agg(canonical_name, ' | ' ORDER BY r) AS keywords FROM kr WHERE r <= 15 GROUP BY ALL""",
    "cooccurrence_npmi": """, kc AS (SELECT topic_code, keyword_code, count(DISTINCT row_id) AS n FROM hits GROUP BY ALL),
        kr AS (SELECT *, row_number() OVER (PARTITION BY topic_code ORDER BY n DESC, keyword_code) AS r FROM kc),
        sn AS (SELECT DISTINCT row_id, h.topic_code, h.keyword_code FROM hits h JOIN kr USING (topic_code, keyword_code) WHERE r <= 10),
        ab AS (SELECT x.topic_code, x.keyword_code AS ka, y.keyword_code AS kb, count(*) AS nab FROM sn x JOIN sn y ON x.row_id = y.row_id AND x.topic_code = y.topic_code AND x.keyword_code < y.keyword_code GROUP BY ALL),
        pr AS (SELECT a.topic_code, a.keyword_code AS ka, b.keyword_code AS kb, a.n AS na, b.n AS nb FROM kr a JOIN kr b ON a.topic_code = b.topic_code AND a.keyword_code < b.keyword_code WHERE a.r <= 10 AND b.r <= 10)
        SELECT topic_code, count(*) AS pairs, round(avg(CASE WHEN nab IS NULL THEN -1 ELSE ln((nab / n::DOUBLE) / ((na / n::DOUBLE) * (nb / n::DOUBLE))) / greatest(-ln(nab / n::DOUBLE), 1e-12) END), 6) AS npmi
        FROM (pr LEFT JOIN ab USING (topic_code, ka, kb)), papers GROUP BY topic_code""",
}.items()} | {
    "list_checks": _M + """, ls AS (SELECT row_id, list(topic_id ORDER BY q DESC, topic_id) AS ids, list(q ORDER BY q DESC, topic_id) AS ws, count(*) AS n, sum(p) AS retained
        FROM (SELECT *, round(p, 9) AS q FROM shares) WHERE q >= 0.1 GROUP BY ALL),
        bad AS (SELECT unnest([{'rule': 'length', 'b': len(ids) <> n}, {'rule': 'repeated', 'b': len(list_distinct(ids)) <> len(ids)}, {'rule': 'below', 'b': list_min(ws) < 0.1},
        {'rule': 'sum', 'b': abs(list_sum(ws) - retained) > 1e-6}]) AS x FROM ls)
        SELECT x.rule AS rule, count(*) FILTER (WHERE x.b) AS violations FROM bad GROUP BY ALL""",
    "model_selection_rank": _CAND + """SELECT requested_k, round(mean_metric_rank, 6) AS mean_metric_rank, round(selection_score, 6) AS selection_score, within_practical_tie, selected
        FROM o WHERE omitted_metric = '' AND penalty = 0.15 AND tolerance = 0.05""",
    "selection_sensitivity": _CAND + "SELECT kind, omitted_metric, penalty, tolerance, requested_k AS selected_k FROM o WHERE selected",
    "bow_counts": _WORDS + "SELECT source, term, n FROM c",
    "bow_matrix": _WORDS + "SELECT doc_id, source, term, count(*) AS n FROM t GROUP BY ALL",
    "ctfidf_top_words": _WORDS + """, k AS (SELECT source, sum(n) AS words FROM c GROUP BY ALL), f AS (SELECT term, sum(n) AS frequency FROM c GROUP BY ALL),
        x AS (SELECT c.source, term, sqrt(n / words::DOUBLE) * ln(1 + (SELECT floor(avg(words)) FROM k) / greatest(frequency, 1)::DOUBLE) AS weight FROM c JOIN k ON c.source IS NOT DISTINCT FROM k.source JOIN f USING (term))
        SELECT source, rank::INT AS rank, term, round(weight, 6) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(weight, 9) DESC, term) AS rank FROM x) WHERE rank <= 20""",
    "text_view_head_mid_tail": """SELECT doc_id, length(v)::INT AS n, md5(v) AS view_md5 FROM (SELECT doc_id, CASE WHEN length(text) > 4000 THEN concat(left(text, 2000), chr(10),
        substr(text, ((length(text) - 1000) // 2 + 1)::INT, 1000), chr(10), right(text, 1000)) ELSE text END AS v FROM documents WHERE text IS NOT NULL)""",
    "chunk_weights": """WITH b AS (SELECT doc_id, source, len(list_filter(string_split_regex(text, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '')) AS total FROM documents WHERE text IS NOT NULL),
        k AS (SELECT *, unnest(range(0, (total + 124) // 125)) AS chunk FROM b WHERE total > 0), n AS (SELECT *, least(125, total - chunk * 125) AS n, greatest(0, least(4096 - chunk * 125, least(125, total - chunk * 125))) AS early FROM k)
        SELECT doc_id, chunk::INT AS chunk, n::INT AS n_tokens, round(CASE WHEN source = 'policy' THEN 0.4 * n / total + 0.6 * early / least(4096, total) ELSE n / total::DOUBLE END, 6) AS weight FROM n""",
    "source_weights": """WITH c AS (SELECT source, count(*) AS records, CASE source WHEN 'paper' THEN 0.7 WHEN 'patent' THEN 0.25 ELSE 0.05 END AS m FROM population WHERE source IN ('paper', 'patent', 'policy') GROUP BY ALL)
        SELECT source, records, round((m * (SELECT records FROM c WHERE source = 'paper') / (0.7 * records))::DOUBLE, 6) AS weight FROM c""",
    "review_validation": """SELECT 'missing_label' AS rule, count(*) FILTER (WHERE label IS NULL) AS violations FROM quality_labels
        UNION ALL SELECT 'unknown_label', count(*) FILTER (WHERE label NOT IN ('prose', 'list', 'table', 'junk')) FROM quality_labels
        UNION ALL SELECT 'contradicting', count(*) FILTER (WHERE n > 1) FROM (SELECT count(DISTINCT label) AS n FROM quality_labels GROUP BY doc_id)
        UNION ALL SELECT 'unknown_document', count(*) FROM quality_labels ANTI JOIN documents USING (doc_id)""",
    "ledger_latest": """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
}

QUERIES = {f.__name__: f for f in (
    multilabel_edges, multilabel_lists, list_checks, hard_assign_margin, quality_by_topic, scope_apply, scope_reject_override,
    scope_sensitivity, threshold_metrics, lookup_threshold, topic_cards, cooccurrence_npmi, model_selection_rank,
    selection_sensitivity, bow_counts, bow_matrix, ctfidf_top_words, text_view_head_mid_tail, chunk_weights, source_weights, nmf_fit_infer,
    nmf_error, nmf_online_error, component_matching, component_stability, weighted_pca, kmeans_assign, review_validation, ledger_latest,
)}
