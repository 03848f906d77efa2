"""Review ledgers: validation, resolution, overrides, chained batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DECISIONS = ("include", "outside_scope", "insufficient_evidence")
SUPPORTING = ("supports", "supports_with_context")


def _rule(rows: DataFrame, rule: str, key: str = "doc_id") -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"))


def review_violations(reviews: DataFrame, documents: DataFrame) -> DataFrame:
    """(rule, key) of every breach: one decision per document, decisions from the list, inclusion if and only if topics are
    named, quotes that are in the named field, and texts that are those reviewed.

    ``reviews`` (doc_id, decision, topic_ids, quote_field, quote, title_sha, body_sha), ``documents`` (doc_id, title, body).
    """
    repeated = reviews.groupBy("doc_id").count().where("count > 1")
    missing = documents.select("doc_id").join(reviews, "doc_id", "left_anti")
    unknown = reviews.join(documents.select("doc_id"), "doc_id", "left_anti")
    both = reviews.join(documents, "doc_id")
    field = F.when(F.col("quote_field") == "title", F.col("title")).when(F.col("quote_field") == "body", F.col("body"))
    named = F.size("topic_ids") > 0
    rules = {
        "decision_not_listed": ~F.col("decision").isin(*DECISIONS), "include_without_topics": (F.col("decision") == "include") & ~named,
        "topics_without_include": (F.col("decision") != "include") & named,
        "quote_not_in_field": (F.col("quote") == "") | ~F.coalesce(F.contains(field, F.col("quote")), F.lit(False)),
        "text_changed": (F.sha2("title", 256) != F.col("title_sha")) | (F.sha2("body", 256) != F.col("body_sha")),
    }
    broken = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules.items())))
    found = both.select(F.explode(broken).alias("rule"), F.col("doc_id").cast("string").alias("key"))
    return found.unionByName(_rule(repeated, "repeated")).unionByName(_rule(missing, "missing")).unionByName(_rule(unknown, "unknown_document"))


def resolve_terms(samples: DataFrame, outcomes: DataFrame, proposals: DataFrame) -> DataFrame:
    """(term, decision, allowed, reason): a term may be activated when all its frozen samples were read and one at least
    supports it, or when it is remapped explicitly.

    ``samples`` (term, sample_id), ``outcomes`` (sample_id, outcome), ``proposals`` (term, decision, remapped).
    """
    read = samples.join(outcomes, "sample_id", "left").groupBy("term").agg(
        F.count_if(F.col("outcome").isNull()).alias("unread"), F.count_if(F.col("outcome").isin(*SUPPORTING)).alias("support")
    )
    rows = proposals.join(read, "term", "left").na.fill(0, ["unread", "support"])
    reason = (
        F.when(F.col("unread") > 0, "unread samples")
        .when((F.col("decision") == "active") & (F.col("support") == 0) & ~F.col("remapped"), "no support").otherwise("")
    )
    return rows.select("term", "decision", (reason == "").alias("allowed"), reason.alias("reason"))


def superseded(ledger: DataFrame) -> DataFrame:
    """Entries of (key, seq, decision, cites) with their hash, whether they are the latest of the key, and whether a
    correction cites the hash of the entry it replaces."""
    order = Window.partitionBy("key").orderBy("seq")  # corrections of one decision
    own = F.sha2(F.concat_ws("\x1f", "key", F.col("seq").cast("string"), "decision"), 256)
    rows = ledger.withColumn("sha", own).withColumn("before", F.lag("sha").over(order))
    return rows.select(
        "key", "seq", "decision", "sha", F.lead("seq").over(order).isNull().alias("latest"),
        F.coalesce(F.col("cites").eqNullSafe(F.col("before")), F.lit(False)).alias("cites_replaced"),
    )


def override_violations(overrides: DataFrame, observations: DataFrame) -> DataFrame:
    """Breaches of overrides (row_id, keyword_id, action): repeated pairs, unknown actions, pairs never observed."""
    pair = F.concat_ws("/", "row_id", "keyword_id")
    keyed = overrides.withColumn("pair", pair)
    repeated = keyed.groupBy("pair").count().where("count > 1")
    unknown = keyed.where(~F.col("action").isin("withhold_trigger", "needs_context"))
    unseen = keyed.join(observations.select("row_id", "keyword_id"), ["row_id", "keyword_id"], "left_anti")
    return _rule(repeated, "repeated", "pair").unionByName(_rule(unknown, "unknown_action", "pair")).unionByName(_rule(unseen, "never_observed", "pair"))


def disjoint(a: DataFrame, b: DataFrame, key: str) -> int:
    """How many keys two samples share; frozen splits share none."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi").count()
