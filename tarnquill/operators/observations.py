"""Keyword records to observations, and the build of a curated dictionary."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnquill.operators.integrity import ContractError
from tarnquill.operators.nested import opened
from tarnquill.session import numbered


def parse_record(raw: str | None, flat: str | None) -> dict[str, tuple[str, float]]:
    """identifier -> (name, score) of a record's top-level list.

    Only objects with a name count; a score counts if it is a finite number from 0 to 1, else it is 0; a later object of
    the same identifier replaces the earlier; the ';' list is used only if the JSON gave nothing, with scores of 0.
    """
    found: dict[str, tuple[str, float]] = {}
    value = opened(raw) if raw else None
    for item in value if isinstance(value, list) else []:
        name = item.get("display_name") if isinstance(item, dict) else None
        if not isinstance(name, str) or not name.strip():
            continue
        name, own, score = name.strip(), item.get("id"), item.get("score")
        good = isinstance(score, (int, float)) and math.isfinite(score) and 0 <= score <= 1
        found[str(own).strip() if own and str(own).strip() else f"label:{name.casefold()}"] = (name, float(score) if good else 0.0)
    if not found:
        for name in (flat or "").split(";"):
            if name.strip():
                found[f"label:{name.strip().casefold()}"] = (name.strip(), 0.0)
    return found


def parsed_observations(chosen: DataFrame) -> DataFrame:
    """(snapshot_id, keyword_id, raw_name, score) of every record."""
    import pyarrow as pa

    out = pa.schema([("snapshot_id", pa.int64()), ("keyword_id", pa.string()), ("raw_name", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = [
                (key, i, name, score)
                for key, raw, flat in zip(*(part.column(c).to_pylist() for c in range(3)))
                for i, (name, score) in parse_record(raw, flat).items()
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    return chosen.select("snapshot_id", "raw_keywords", "keywords").mapInArrow(
        run, "snapshot_id bigint, keyword_id string, raw_name string, score double"
    )


def build_dictionary(names: DataFrame, decided: DataFrame, patterns: list[tuple[str, str]], synonyms: DataFrame | None = None) -> DataFrame:
    """Dictionary entries of canonical names with code, decision and topic.

    ``names`` (name), ``decided`` (name, decision, topic_code, priority): the lowest priority decides; ``patterns`` exclude
    what nobody decided; the rest is unreviewed. A name with two topics at its deciding priority is an error. Codes follow
    the names' order.
    """
    clash = decided.groupBy("name", "priority").agg(F.countDistinct("decision", "topic_code").alias("n")).where("n > 1")
    if clash.limit(1).count():
        raise ContractError("a name is mapped to two topics")
    if synonyms is not None:
        names = names.join(synonyms, "name", "left").select(F.coalesce("canonical", "name").alias("name"))
    best = decided.groupBy("name").agg(F.min(F.struct("priority", "decision", "topic_code")).alias("d"))
    rows = names.where("name <> ''").distinct().join(best, "name", "left")
    excluded = F.lit(False)
    for _, pattern in patterns:
        excluded = excluded | F.col("name").rlike(pattern)
    decision = F.coalesce("d.decision", F.when(excluded, F.lit("excluded_rule")), F.lit("unreviewed"))
    return numbered(rows, "name", "number", 1).select(
        F.format_string("KW%05d", "number").alias("keyword_code"), F.col("name").alias("canonical_name"), decision.alias("decision"),
        F.coalesce("d.topic_code", F.lit("")).alias("topic_code"),
    )


def unobserved(decided: DataFrame, names: DataFrame) -> DataFrame:
    """Decided names that occur nowhere: listed, never activated."""
    return decided.join(names.select("name").distinct(), "name", "left_anti")


def anchor_families(rules: DataFrame, families: dict[str, list[str]], global_topics: list[str]) -> DataFrame:
    """The anchor topics of each conditional entry: none (any anchor will do) for global topics, else the listed family,
    else the topic itself."""
    own = F.col("topic_code")
    listed = F.create_map(*(x for k, v in families.items() for x in (F.lit(k), F.array(*map(F.lit, v))))) if families else None
    family = F.coalesce(listed[own], F.array(own)) if families else F.array(own)
    none = F.array().cast("array<string>")
    return rows_with(rules, F.when(own.isin(global_topics), none).otherwise(family))


def rows_with(rules: DataFrame, family) -> DataFrame:
    return rules.withColumn("families", F.when(F.col("decision") == "conditional", family).otherwise(F.array().cast("array<string>")))
