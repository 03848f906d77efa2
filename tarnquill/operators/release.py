"""Checks of exported tables against what they were made from.

Each returns one row (check, violations); a release has 0 of all. They go over whole tables by joins and aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnquill.operators.multilabel import KEPT, THRESHOLD
from tarnquill.operators.vectors import dot


def _count(name: str, rows: DataFrame, broken: Column | None = None) -> DataFrame:
    n = F.count("*") if broken is None else F.count_if(F.coalesce(broken, F.lit(False)))
    return rows.agg(n.alias("violations")).select(F.lit(name).alias("check"), "violations")


def stages_agree(stages: DataFrame, wanted: DataFrame) -> DataFrame:
    """C2. Stages (stage, source, records) whose number of records isn't that of the population (source, records)."""
    both = stages.join(wanted.withColumnRenamed("records", "wanted"), "source", "left")
    return _count("stages_agree", both, ~F.col("records").eqNullSafe(F.col("wanted")))


def lists_equal_edges(lists: DataFrame, edges: DataFrame, tolerance: float = 1e-7) -> DataFrame:
    """C5. Entries of lists (row_id, topic_ids, contributions) or edges (row_id, topic_id, p) without a partner of like weight."""
    cells = lists.select("row_id", F.explode(F.arrays_zip("topic_ids", "contributions")).alias("c"))
    cells = cells.select("row_id", F.col("c.topic_ids").alias("topic_id"), F.col("c.contributions").alias("listed"))
    both = cells.join(edges.select("row_id", "topic_id", "p"), ["row_id", "topic_id"], "full_outer")
    return _count("lists_equal_edges", both, F.col("p").isNull() | F.col("listed").isNull() | (F.abs(F.col("p") - F.col("listed")) > tolerance))


def raw_edges_kept(raw: DataFrame, edges: DataFrame) -> DataFrame:
    """C6. Raw edges that are missing, added or changed; two null weights are equal."""
    there = edges.select("row_id", "topic_id", F.col("p").alias("q"), F.lit(True).alias("there"))
    both = raw.select("row_id", "topic_id", "p", F.lit(True).alias("was")).join(there, ["row_id", "topic_id"], "full_outer")
    return _count("raw_edges_kept", both, F.col("was").isNull() | F.col("there").isNull() | ~F.col("p").eqNullSafe(F.col("q")))


def default_clean(scoped: DataFrame, t: float = THRESHOLD) -> DataFrame:
    """C7. Edges kept by default though their topic is not kept, their record is not fit, a review rejected them or they are light."""
    broken = ~F.col("state").isin(*KEPT) | ~F.col("gate") | F.col("rejected") | (F.round("p", 9) < t)
    return _count("default_clean", scoped.where("stage = 'retained'"), broken)


def evidence_observed(relations: DataFrame, eligible: DataFrame) -> DataFrame:
    """C8. Codes stated as evidence (matched_codes, by ``|``) that no eligible hit of the record and topic has."""
    stated = relations.select("row_id", "topic_code", F.explode(F.split("matched_codes", r"\|")).alias("keyword_code"))
    return _count("evidence_observed", stated.join(eligible, ["row_id", "topic_code", "keyword_code"], "left_anti"))


def all_exported(relations: DataFrame, eligible: DataFrame) -> DataFrame:
    """C8. Record and topic pairs on one side only."""
    expected = eligible.select("row_id", "topic_code").distinct().withColumn("a", F.lit(1))
    both = expected.join(relations.select("row_id", "topic_code", F.lit(1).alias("b")), ["row_id", "topic_code"], "full_outer")
    return _count("all_exported", both, F.col("a").isNull() | F.col("b").isNull())


def conditional_anchored(hits: DataFrame, anchors: DataFrame) -> DataFrame:
    """C9. Conditional hits whose record has no anchor, or none that suits their families."""
    rows = hits.where("decision = 'conditional'").select("row_id", "families").join(anchors, "row_id", "left")
    suits = (F.size("families") == 0) | F.arrays_overlap("families", "anchor_topics")
    return _count("conditional_anchored", rows, F.col("anchor_topics").isNull() | ~suits)


def summary_recounted(summary: DataFrame, rows: DataFrame, key: str, column: str) -> DataFrame:
    """C10. Groups whose stated number isn't the number of their rows."""
    counted = rows.groupBy(key).agg(F.count("*").alias("counted"))
    both = summary.select(key, F.col(column).alias("stated")).join(counted, key, "full_outer")
    return _count("summary_recounted", both, ~F.coalesce("stated", F.lit(0)).eqNullSafe(F.coalesce("counted", F.lit(0))))


def centres_sound(centres: DataFrame, column: str = "centroid", tolerance: float = 1e-6) -> DataFrame:
    """C13. Centres that are not finite or not of unit length."""
    norm = F.sqrt(dot(F.col(column), F.col(column)))
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return _count("centres_sound", centres, ~finite | (F.abs(norm - 1) > tolerance))


def ranks_fall(ranked: DataFrame) -> DataFrame:
    """C13. Vectors whose cosines don't fall with the rank (vec_id, rank, cosine)."""
    lists = ranked.groupBy("vec_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "cosine"))), lambda x: x["cosine"]).alias("c"))
    return _count("ranks_fall", lists, F.col("c") != F.sort_array("c", asc=False))


def model_sound(cells: DataFrame, masked: DataFrame) -> DataFrame:
    """C15. Cells (topic_id, col, weight) of a model that are negative or null, or stand in a masked column (col) with a weight."""
    rows = cells.join(masked.select("col", F.lit(True).alias("masked")), "col", "left")
    return _count("model_sound", rows, F.col("weight").isNull() | (F.col("weight") < 0) | (F.coalesce("masked", F.lit(False)) & (F.col("weight") != 0)))


def ids_disjoint(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """C16. Keys that two samples share."""
    return _count("ids_disjoint", a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi"))
