"""Multi-label shares, reversible scope filtering and their metrics.

Shares are never normalised again after a filter, thresholds include their value, and no label is forced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

THRESHOLD = 0.10
FLOOR = 0.05
KEPT = ("keep_core", "keep_supporting")


def checked_threshold(t: float) -> float:
    if not 0 < t <= 1:
        raise ValueError(f"threshold {t} is outside (0, 1]")
    return t


def topic_shares(hits: DataFrame) -> DataFrame:
    """(row_id, topic_id, mass, p): each topic's summed score and its share of the record's total."""
    mass = hits.groupBy("row_id", F.regexp_extract("topic_code", r"([0-9]+)$", 1).cast("int").alias("topic_id")).agg(F.sum("score").alias("mass"))
    total = F.sum("mass").over(Window.partitionBy("row_id"))  # a record has few topics
    return mass.withColumn("p", F.col("mass") / F.greatest(total, F.lit(1e-12)))


def scale_invariant(weights: Column, norms: Column) -> Column:
    """Contributions of factors: weights times the lengths of the topics' rows."""
    return F.zip_with(weights, norms, lambda w, n: w * n)


def hard_assignment(shares: DataFrame) -> DataFrame:
    """(row_id, topic_id, top1, margin): the greatest share, ties to the lower topic; -1 where there is no mass."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.round("p", 9)).alias("less"), F.col("topic_id"))))
    rows = shares.groupBy("row_id").agg(ranked.alias("r"), F.sum("mass").alias("mass"))
    some = F.col("mass") > 1e-12
    second = F.coalesce(-F.get("r", F.lit(1))["less"], F.lit(0.0))
    first = -F.get("r", F.lit(0))["less"]
    return rows.select(
        "row_id", F.when(some, F.get("r", F.lit(0))["topic_id"]).otherwise(-1).alias("topic_id"),
        F.when(some, first).otherwise(0.0).alias("top1"), F.when(some, first - second).otherwise(0.0).alias("margin"),
    )


def label_lists(shares: DataFrame, t: float = THRESHOLD) -> DataFrame:
    """(row_id, topic_ids, contributions, topic_count, retained): every share of at least t, greatest first, no cap."""
    kept = shares.where(F.round("p", 9) >= checked_threshold(t))
    ordered = F.array_sort(F.collect_list(F.struct((-F.round("p", 9)).alias("less"), F.col("topic_id"))))
    lists = kept.groupBy("row_id").agg(ordered.alias("r"), F.sum("p").alias("retained"))
    return lists.select(
        "row_id", F.transform("r", lambda x: x["topic_id"]).alias("topic_ids"), F.transform("r", lambda x: -x["less"]).alias("contributions"),
        F.size("r").alias("topic_count"), "retained",
    )


def qualified_edges(shares: DataFrame, population: DataFrame, ledger: DataFrame, rejected: DataFrame, anchor: Column) -> DataFrame:
    """Edges with the record's gate, the topic's state and the review's rejections; the ledger is one row per topic."""
    gate = F.col("usable") & ~F.col("retracted") & ~F.col("template_record")
    meta = population.select("row_id", "source", gate.alias("gate"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    edges = shares.where(F.round("p", 9) >= FLOOR).join(meta, "row_id").join(ledger, "topic_id")
    edges = edges.join(rejected.withColumn("rejected", F.lit(True)), ["row_id", "topic_id"], "left").na.fill(False, ["rejected"])
    return edges.withColumn("qualified", F.col("gate") & ~F.col("rejected"))


def scoped_edges(edges: DataFrame, t: float = THRESHOLD) -> DataFrame:
    """Each edge of at least t with its stage: retained, pending, excluded, or unqualified. Supporting topics need a text
    anchor or a core topic at the same threshold in the same record."""
    return _staged(edges.where(F.round("p", 9) >= checked_threshold(t)), "row_id")


def _staged(at: DataFrame, *record: str) -> DataFrame:
    core = F.bool_or((F.col("state") == "keep_core") & F.col("qualified")).over(Window.partitionBy(*record))
    context = F.col("anchor") | core
    allowed = (F.col("state") == "keep_core") | ((F.col("state") == "keep_supporting") & context)
    pending = (F.col("state") == "review") | ((F.col("state") == "keep_supporting") & ~context)
    stage = F.when(~F.col("qualified"), "unqualified").when(allowed, "retained").when(pending, "pending").otherwise("excluded")
    return at.withColumn("stage", stage)


def scope_status(population: DataFrame, shares: DataFrame, scoped: DataFrame) -> DataFrame:
    """(row_id, source, status, retained_topics): the priority of statuses is fixed; raw statuses come last."""
    has = lambda s: F.bool_or(F.col("stage") == s)
    found = scoped.groupBy("row_id").agg(
        has("retained").alias("kept"), has("pending").alias("waiting"), has("excluded").alias("out"), F.bool_or("rejected").alias("refused"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("stage") == "retained", F.col("topic_id")))).cast("array<string>"), "|").alias("retained_topics"),
    )
    features = shares.groupBy("row_id").agg(F.max("p").alias("greatest"))
    gate = F.col("usable") & ~F.col("retracted") & ~F.col("template_record")
    rows = population.join(features, "row_id", "left").join(found, "row_id", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    status = (
        F.when(yes("kept"), F.when(F.col("source") == "paper", "assigned").otherwise("assigned_candidate"))
        .when(yes("refused"), "relation_review_rejected").when(~gate, "quality_gate_abstained")
        .when(yes("waiting"), "scope_review_pending").when(yes("out"), "excluded_by_topic_scope")
        .when(F.col("greatest").isNull(), "no_features").otherwise("below_contribution_threshold")
    )
    return rows.select("row_id", "source", status.alias("status"), F.coalesce("retained_topics", F.lit("")).alias("retained_topics"))


def sensitivity(edges: DataFrame, records: DataFrame, thresholds: tuple[float, ...] = (0.05, 0.10, 0.15)) -> DataFrame:
    """Per source, threshold and stage: documents with one, with several topics, edges and mass. Stages overlap."""
    levels = F.array(*(F.lit(checked_threshold(t)) for t in thresholds))
    at = edges.select("*", F.explode(F.filter(levels, lambda t: F.round("p", 9) >= t)).alias("threshold"))
    parts = _staged(at, "row_id", "threshold")  # the core context depends on the threshold
    stages = F.array_compact(F.array(
        F.lit("raw"), F.when(F.col("qualified"), F.lit("quality_qualified")), F.when(F.col("stage") != "unqualified", F.col("stage"))
    ))
    per = parts.select("source", "threshold", "row_id", "p", F.explode(stages).alias("stage"))
    docs = per.groupBy("source", "threshold", "stage", "row_id").agg(F.count("*").alias("n"), F.sum("p").alias("mass"))
    sums = docs.groupBy("source", "threshold", "stage").agg(
        F.count("*").alias("assigned_documents"), F.count_if(F.col("n") > 1).alias("multiple_topic_documents"),
        F.sum("n").alias("edges"), F.round(F.sum("mass"), 4).alias("contribution_mass"),
    )
    return sums.join(records, "source").select(
        "*", F.round(F.col("assigned_documents") / F.col("records"), 6).alias("coverage"),
        F.round(F.col("edges") / F.col("assigned_documents"), 6).alias("mean_topics_assigned"),
    )


def threshold_metrics(shares: DataFrame, documents: Column, thresholds: tuple[float, ...] = (0.05, 0.10, 0.15, 0.30)) -> DataFrame:
    """Coverage, mean, p95 and greatest number of topics, and retained mass at each threshold."""
    t = F.explode(F.array(*map(F.lit, thresholds))).alias("threshold")
    rows = shares.select("row_id", F.round("p", 9).alias("p"), t)
    docs = rows.groupBy("threshold", "row_id").agg(F.count_if(F.col("p") >= F.col("threshold")).alias("n"), F.sum(F.when(F.col("p") >= F.col("threshold"), F.col("p")).otherwise(0.0)).alias("mass"))
    return docs.groupBy("threshold").agg(
        F.count("*").alias("feature_documents"), F.count_if(F.col("n") > 0).alias("covered"),
        F.round(F.avg("n"), 6).alias("mean_topics"), F.percentile("n", 0.95).alias("p95_topics"), F.max("n").alias("most_topics"),
        F.round(F.avg("mass"), 6).alias("retained_mass"),
    ).withColumn("coverage_all", F.round(F.col("covered") / documents, 6))
