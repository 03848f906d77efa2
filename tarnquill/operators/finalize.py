"""Full assignment of a corpus: papers by their topics, other sources by transfer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnquill.functions.expressions import sample_order
from tarnquill.operators import vectors as V


def finalise(meta: DataFrame, labels: DataFrame, vectors: DataFrame) -> DataFrame:
    """(vec_id, source, topic_id, category_id, cosine, margin, status, needs_review) of every record.

    Centroids come from papers alone; the other sources take the nearest of them, and always need review. Records without
    a topic or without a usable vector keep topic -1. ``meta`` (vec_id, source), ``labels`` (vec_id, topic_id) of papers.
    """
    papers = meta.where("source = 'paper'").join(labels.where("topic_id >= 0"), "vec_id").join(vectors, "vec_id")
    centres = V.centroids(papers.select("vec_id", "embedding", F.col("topic_id").alias("label")))
    others = meta.where("source <> 'paper'").join(vectors, "vec_id").select("vec_id", "embedding")
    top = V.nearest_centroids(others, centres, 2)
    pick = lambda r, c: F.max(F.when(F.col("rank") == r, F.col(c)))
    moved = top.groupBy("vec_id").agg(
        pick(1, "topic_id").alias("moved_id"), pick(1, "cosine").alias("cosine"), (pick(1, "cosine") - pick(2, "cosine")).alias("margin")
    )
    rows = meta.join(labels, "vec_id", "left").join(moved, "vec_id", "left")
    paper = F.col("source") == "paper"
    topic = F.coalesce(F.when(paper, F.col("topic_id")).otherwise(F.col("moved_id")), F.lit(-1))
    status = (
        F.when(paper & (topic >= 0), "assigned").when(paper, "no_keyword_features").when(topic >= 0, "transferred").otherwise("unusable_text")
    )
    return rows.select(
        "vec_id", "source", topic.alias("topic_id"), F.when(topic >= 0, F.format_string("F%04d", topic + 1)).otherwise("").alias("category_id"),
        F.round("cosine", 6).alias("cosine"), F.round("margin", 6).alias("margin"), status.alias("status"), (~paper & (topic >= 0)).alias("needs_review"),
    )


def coverage(final: DataFrame) -> DataFrame:
    return final.groupBy("source").agg(
        F.count("*").alias("input_records"), F.count_if(F.col("topic_id") >= 0).alias("assigned_records"), F.count_if(F.col("topic_id") < 0).alias("unassigned_records")
    )


def projection_status(queries: DataFrame, projected: DataFrame, gate: float = 0.55, threshold: float = 0.10) -> DataFrame:
    """(vec_id, status, topic_ids) of transferred records: unusable, below the similarity gate, below the threshold, or
    assigned for review."""
    near = projected.groupBy(F.col("query_id").alias("vec_id")).agg(F.max("s1").alias("s1"), F.array_join(
        F.array_sort(F.collect_list(F.when((F.round("p", 6) >= threshold) & (F.round("s1", 6) >= gate), F.col("topic_id").cast("string")))), "|"
    ).alias("topic_ids"))
    rows = queries.select("vec_id").join(near, "vec_id", "left")
    status = (
        F.when(F.col("s1").isNull(), "unusable").when(F.round("s1", 6) < gate, "below_similarity_gate")
        .when(F.col("topic_ids") == "", "below_contribution_threshold").otherwise("assigned_candidate")
    )
    return rows.select("vec_id", status.alias("status"), F.coalesce("topic_ids", F.lit("")).alias("topic_ids"))


def review_packet(shares: DataFrame, best: int = 3, others: int = 5, salt: str = "tq-5") -> DataFrame:
    """Of each topic the records with the greatest shares and some more in reproducible order."""
    first = Window.partitionBy("topic_id").orderBy(F.desc(F.round("p", 9)), "row_id")
    # windows with a limit keep so many rows of a topic in each task before the exchange
    top = shares.withColumn("place", F.row_number().over(first)).where(F.col("place") <= best)
    top = top.select("topic_id", "row_id", F.lit("top").alias("kind"), "place")
    order = Window.partitionBy("topic_id").orderBy(sample_order(F.col("row_id").cast("string"), F.col("topic_id").cast("string"), salt), "row_id")
    drawn = shares.withColumn("drawn", F.row_number().over(order)).where(F.col("drawn") <= best + others)  # the top ones may be among them
    rest = drawn.join(F.broadcast(top.select("topic_id", "row_id")), ["topic_id", "row_id"], "left_anti")  # ``best`` rows a topic
    again = Window.partitionBy("topic_id").orderBy("drawn")
    rest = rest.withColumn("place", F.row_number().over(again)).where(F.col("place") <= others)
    return top.unionByName(rest.select("topic_id", "row_id", F.lit("sample").alias("kind"), "place"))


def agreement(a: DataFrame, b: DataFrame, key: str = "vec_id") -> DataFrame:
    """How far two vector tables agree: compared records, least and mean cosine, records on one side only."""
    left, right = a.select(key, F.col("embedding").alias("x")), b.select(key, F.col("embedding").alias("y"))
    cosine = V.dot(V.unit(F.col("x")), V.unit(F.col("y")))
    return left.join(right, key, "full_outer").select(cosine.alias("c"), F.col("x").isNull().alias("nx"), F.col("y").isNull().alias("ny")).agg(
        F.count("c").alias("compared"), F.round(F.min("c"), 6).alias("least"), F.round(F.avg("c"), 6).alias("mean"),
        F.count_if("nx").alias("only_b"), F.count_if("ny").alias("only_a"),
    )
