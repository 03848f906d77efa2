"""Curated-dictionary classification: observations to topics under same-document anchor rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnquill.functions.expressions import joined, quality_gate, sample_order
from tarnquill.operators.packed import split_packed

ACTIVE = ("direct", "conditional")


def observed(observations: DataFrame) -> DataFrame:
    """One row per record and keyword: the best score, 0 where none is stated; rows without either key are dropped."""
    rows = observations.where(F.col("row_id").isNotNull() & (F.trim("keyword_id") != ""))
    return rows.groupBy("row_id", "keyword_id").agg(F.max(F.coalesce("score", F.lit(0.0))).alias("score"))


def lookup_codes(aliases: DataFrame) -> DataFrame:
    """Each source identifier with the one dictionary code it belongs to."""
    ids = aliases.select(F.explode(F.split("source_keyword_ids", r" \| ")).alias("keyword_id"), "keyword_code")
    return ids.groupBy("keyword_id").agg(F.min("keyword_code").alias("keyword_code"))


def dictionary_rules(dictionary: DataFrame) -> DataFrame:
    """Active and inactive entries, the anchor topics as a list."""
    families = split_packed(dictionary, F.col("keyword_code"), F.col("conditional_anchor_topics"), codes=True)
    families = families.groupBy("record_key").agg(F.array_sort(F.collect_set("value")).alias("families"))
    joined_ = dictionary.join(families, dictionary.keyword_code == families.record_key, "left")
    none = F.array().cast("array<string>")
    return joined_.select(
        "keyword_code", "canonical_name", "decision", "topic_code", F.coalesce("families", none).alias("families")
    )


def withheld(observations: DataFrame) -> DataFrame:
    """The ledger of withheld (record, keyword) pairs used by the queries: a fixed rule on both keys."""
    return observations.where((F.col("row_id") % 97 == 0) & (F.md5("keyword_id") < "4")).select("row_id", "keyword_id")


def coded(observations: DataFrame, aliases: DataFrame) -> DataFrame:
    return observations.join(lookup_codes(aliases), "keyword_id")


def candidate_hits(coded_rows: DataFrame, rules: DataFrame, held_back: DataFrame) -> DataFrame:
    """Observations of active entries; withheld pairs leave before any anchor is looked at."""
    active = rules.where(F.col("decision").isin(*ACTIVE) & (F.col("topic_code") != ""))
    kept = coded_rows.join(held_back, ["row_id", "keyword_id"], "left_anti")
    return kept.join(active, "keyword_code")


def anchors(hits: DataFrame) -> DataFrame:
    """The topics each record has by direct hits."""
    direct = hits.where("decision = 'direct'")
    return direct.groupBy("row_id").agg(F.array_sort(F.collect_set("topic_code")).alias("anchor_topics"))


def eligible_hits(hits: DataFrame) -> DataFrame:
    """Hits of anchored records: direct ones, and conditional ones whose families are empty or meet the anchors."""
    compatible = (F.size("families") == 0) | F.arrays_overlap("families", "anchor_topics")
    return hits.join(anchors(hits), "row_id").where((F.col("decision") == "direct") | compatible)


def relations(hits: DataFrame) -> DataFrame:
    """(row_id, topic_code) with evidence."""
    return eligible_hits(hits).groupBy("row_id", "topic_code").agg(
        F.bool_or(F.col("decision") == "direct").alias("has_direct_hit"),
        joined(F.collect_set("keyword_code")).alias("matched_codes"),
        joined(F.collect_set("canonical_name")).alias("matched_names"),
    )


def assignments(population: DataFrame, coded_rows: DataFrame, observations: DataFrame, hits: DataFrame, related: DataFrame) -> DataFrame:
    """Every paper with its topics, counts and status; the quality gate is a column and drops nothing."""
    raw = observations.groupBy("row_id").agg(F.count("*").alias("raw_keyword_count"))
    codes = coded_rows.groupBy("row_id").agg(F.countDistinct("keyword_code").alias("canonical_keyword_count"))
    found = hits.groupBy("row_id").agg(F.bool_or(F.col("decision") == "conditional").alias("conditional"))
    topics = related.groupBy("row_id").agg(F.count("*").alias("topic_count"), joined(F.collect_set("topic_code")).alias("topic_codes"))
    out = population.where("source = 'paper'")
    for side in (raw, codes, found, topics):
        out = out.join(side, "row_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    status = (
        F.when(F.col("topic_count") > 0, "assigned").when(F.col("raw_keyword_count").isNull(), "no_keywords")
        .when(F.col("conditional"), "conditional_only_without_anchor").otherwise("no_active_dictionary_keyword")
    )
    return out.select(
        "row_id", "doc_id", zero("raw_keyword_count"), zero("canonical_keyword_count"), zero("topic_count"),
        F.coalesce("topic_codes", F.lit("")).alias("topic_codes"), quality_gate(strict=False).alias("quality_eligible"),
        status.alias("classification_status"),
    )


def topic_counts(related: DataFrame, assigned: DataFrame) -> DataFrame:
    gate = assigned.select("row_id", "quality_eligible")
    return related.join(gate, "row_id").groupBy("topic_code").agg(
        F.count("*").alias("documents"), F.count_if("has_direct_hit").alias("direct_documents"),
        F.count_if(~F.col("has_direct_hit")).alias("conditional_documents"),
        F.count_if("quality_eligible").alias("quality_eligible_documents"),
    )


def vocabulary(observations: DataFrame, n_documents: Column, least: int = 10, most: float = 0.5) -> DataFrame:
    """Terms in at least ``least`` records and at most the share ``most`` of all, with the smoothed idf."""
    counts = observations.groupBy("keyword_id").agg(F.countDistinct("row_id").alias("document_frequency"))
    kept = counts.where((F.col("document_frequency") >= least) & (F.col("document_frequency") <= most * n_documents))
    return kept.withColumn("idf", F.log((1 + n_documents) / (1 + F.col("document_frequency"))) + 1)


def tfidf(observations: DataFrame, terms: DataFrame) -> DataFrame:
    """Unit-length rows of score x idf; entries without a score stay out, empty rows stay empty."""
    weights = observations.where("score > 0").join(terms, "keyword_id").withColumn("w", F.col("score") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("row_id")))  # a record has few keywords
    return weights.select("row_id", "keyword_id", (F.col("w") / norm).alias("weight"))


def masked(weights: DataFrame, broad: DataFrame) -> DataFrame:
    """Without the broad terms, rows brought to unit length again."""
    kept = weights.join(broad, "keyword_id", "left_anti")
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("row_id")))
    return kept.select("row_id", "keyword_id", (F.col("weight") / norm).alias("weight"))


def canonical_snapshots(chosen: DataFrame) -> DataFrame:
    """The snapshot of each work that counts: with keywords first, then newest by text, then by file and content."""
    rows = chosen.withColumn("work", F.regexp_extract("work_id", r"(?i)(W[0-9]+)", 1)).where("work <> ''")
    valid = F.coalesce((
        # the parser stops after the first value, so the text has to end with the list
        F.try_variant_get(F.try_parse_json("raw_keywords"), "$[0]", "variant").isNotNull() & F.col("raw_keywords").rlike(r"\]\s*$")
    ), F.lit(False)) | (
        F.trim(F.coalesce("keywords", F.lit(""))) != ""
    )
    order = [
        valid.desc(), F.coalesce("raw_updated_date", F.lit("")).desc(), F.col("source_file").asc_nulls_last(),
        F.col("raw_keywords").asc_nulls_last(), F.col("snapshot_id"),
    ]
    first = F.row_number().over(Window.partitionBy(F.upper("work")).orderBy(*order))
    return rows.withColumn("rank", first).where("rank = 1").select(F.upper("work").alias("work"), "snapshot_id", valid.alias("has_valid_keywords"))


def md5_sample(rows: DataFrame, group: str, key: str, k: int, salt: str) -> DataFrame:
    """k rows of each group in reproducible order; the window keeps k rows per task before the exchange."""
    order = Window.partitionBy(group).orderBy(sample_order(F.col(key), F.col(group), salt), F.col(key))
    return rows.withColumn("sample_rank", F.row_number().over(order)).where(F.col("sample_rank") <= k)
