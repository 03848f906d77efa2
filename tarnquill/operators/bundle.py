"""Splits of a labelled corpus, and the metrics of one candidate model on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnquill.operators import vectors as V
from tarnquill.session import cut_lineage


def split_problems(rows: DataFrame, vectors: DataFrame, key: str = "vec_id") -> DataFrame:
    """(split, rows, vectors, shared): rows of each split, those with a vector, and keys that another split or row has too.
    A sound bundle has as many vectors as rows and nothing shared."""
    seen = rows.groupBy(key).agg(F.count("*").alias("times"))
    known = vectors.select(key).distinct().withColumn("known", F.lit(True))
    return rows.join(seen, key).join(known, key, "left").groupBy("split").agg(
        F.count("*").alias("rows"), F.count("known").alias("vectors"), F.count_if(F.col("times") > 1).alias("shared")
    )


def uniform_assignment(rows: DataFrame, topics: int) -> tuple[DataFrame, DataFrame]:
    """(topic sizes by split with the empty ones, rows with the activity of their topic): the same labels for every split; a
    topic is active if it wins a row of any split. ``rows`` has (vec_id, split, label)."""
    spark = rows.sparkSession
    counts = rows.where("label >= 0").groupBy("label", "split").agg(F.count("*").alias("n"))
    grid = spark.range(topics).select(F.col("id").cast("int").alias("label")).join(rows.select("split").distinct(), how="cross")  # topics x splits
    sizes = grid.join(counts, ["label", "split"], "left").na.fill(0, ["n"])
    sizes = sizes.withColumn("active", F.sum("n").over(Window.partitionBy("label")) > 0)  # splits of a topic
    active = sizes.where("active").select("label").distinct().withColumn("active", F.lit(True))
    return sizes, rows.join(active, "label", "left").na.fill(False, ["active"])


def candidate_metrics(train: DataFrame, validation: DataFrame, topics: int, error: float, relative_error: float) -> DataFrame:
    """One row of metrics of a candidate.

    ``train`` (vec_id, label, embedding) gives sizes and centroids; all geometry is measured on ``validation`` (vec_id, label,
    has_keywords, embedding), which had no part in them. Label -1 is no topic. Silhouettes are exact over all valid rows.
    """
    sizes = train.where("label >= 0").groupBy("label").agg(F.count("*").alias("n"))
    order = Window.orderBy("n", "label")  # one row per topic
    ranked = sizes.withColumn("i", F.row_number().over(order)).withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy()))
    total = F.count("*")
    of_sizes = ranked.agg(
        total.cast("int").alias("active_topics"), (topics - total).cast("int").alias("empty_topics"), ((topics - total) / topics).alias("empty_topic_fraction"),
        F.sum("n").alias("train_documents_assigned"), F.min("n").alias("train_topic_size_min"), F.percentile("n", 0.1).alias("train_topic_size_p10"),
        F.percentile("n", 0.5).alias("train_topic_size_median"), F.percentile("n", 0.9).alias("train_topic_size_p90"),
        F.count_if(F.col("n") < 20).cast("int").alias("train_topics_below_20"),
        ((2 * F.sum(F.col("i") * F.col("n")) / F.sum("n") - total - 1) / total).alias("train_topic_size_gini"),
        F.exp(-F.sum(F.col("p") * F.log("p"))).alias("effective_topic_count"),
    )
    centres = cut_lineage(V.centroids(train.where("label >= 0")))
    known = validation.join(centres.select("label", F.lit(True).alias("active")), "label", "left")
    known = cut_lineage(known.select("vec_id", "label", "embedding", "has_keywords", F.coalesce(F.col("has_keywords") & F.col("active"), F.lit(False)).alias("valid"), F.coalesce("active", F.lit(False)).alias("active")))
    valid = known.where("valid")
    coverage = known.agg(
        F.avg(F.col("has_keywords").cast("double")).alias("validation_keyword_coverage"), F.avg(F.col("valid").cast("double")).alias("validation_active_topic_coverage")
    )
    silhouette = V.cosine_silhouette(valid.select("vec_id", "label", "embedding")).agg(
        F.avg("silhouette").alias("sampled_cosine_silhouette"), F.count("*").cast("int").alias("sampled_silhouette_n")
    )
    simple = V.simplified_silhouette(known.where("active"), centres).agg(
        F.avg("silhouette").alias("simplified_silhouette_mean"), F.avg((F.col("silhouette") < 0).cast("double")).alias("simplified_silhouette_negative_fraction")
    )
    davies = V.davies_bouldin(valid)
    pick = lambda r, c: F.max(F.when(F.col("rank") == r, F.col(c)))
    near = V.nearest_centroids(valid, centres, 2).groupBy("vec_id").agg(pick(1, "topic_id").alias("near"), pick(1, "cosine").alias("c1"), pick(2, "cosine").alias("c2"))
    near = cut_lineage(near.join(valid.select("vec_id", "label"), "vec_id"))
    agreed = near.agg(
        F.avg((F.col("near") == F.col("label")).cast("double")).alias("keyword_embedding_top1_agreement"),
        F.avg("c1").alias("validation_nearest_centroid_cosine_mean"), F.avg(F.col("c1") - F.col("c2")).alias("validation_nearest_centroid_margin_mean"),
    )
    ari = V.adjusted_rand(near, "label", "near").withColumnRenamed("ari", "keyword_embedding_ari")
    apart = V.centre_separation(centres).toDF("nearest_center_cosine_mean", "nearest_center_cosine_p90", "nearest_center_cosine_max")
    out = of_sizes
    for one in (coverage, silhouette, simple, davies, agreed, ari, apart):
        out = out.crossJoin(one)  # one row each
    return out.select(
        F.lit(topics).alias("requested_k"), *out.columns, F.lit(error).alias("nmf_reconstruction_error"), F.lit(relative_error).alias("nmf_relative_reconstruction_error")
    )


def source_summary(transfer: DataFrame) -> DataFrame:
    """Transferred records by source (source, cosine, margin, filter_passed): how many, means, median, share passed."""
    return transfer.groupBy("source").agg(
        F.count("*").alias("documents"), F.avg("cosine").alias("mean_cosine"), F.median("cosine").alias("median_cosine"), F.avg("margin").alias("mean_margin"),
        F.stddev("cosine").alias("std_cosine"), F.stddev("margin").alias("std_margin"), F.avg(F.col("filter_passed").cast("double")).alias("passed_fraction"),
    )
