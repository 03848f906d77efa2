"""Checks over whole populations: each returns counts, of which the violations have to be 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """Rows that break a stated contract."""


def population_identity(population: DataFrame) -> DataFrame:
    """Dense row numbers from 0 and unique documents."""
    counted = population.agg(
        F.count("*").alias("records"), F.countDistinct("row_id").alias("distinct_rows"),
        F.countDistinct("doc_id").alias("distinct_documents"), F.min("row_id").alias("least_row"), F.max("row_id").alias("greatest_row"),
    )
    sound = (
        (F.col("least_row") == 0) & (F.col("greatest_row") == F.col("records") - 1)
        & (F.col("distinct_rows") == F.col("records")) & (F.col("distinct_documents") == F.col("records"))
    )
    return counted.withColumn("sound", sound)


def reconcile_lists(lists: DataFrame, edges: DataFrame, column: str, key: str = "row_id") -> DataFrame:
    """Two-way equality of a list column and its edge table."""
    exploded = lists.select(key, F.explode("topics").alias(column)).where(F.col(column) != "")
    left, right = exploded.withColumn("a", F.lit(1)), edges.select(key, column).withColumn("b", F.lit(1))
    return left.join(right, [key, column], "full_outer").agg(
        F.count_if(F.col("b").isNull()).alias("only_in_lists"), F.count_if(F.col("a").isNull()).alias("only_in_edges"),
        F.count("*").alias("pairs"),
    )


def join_checked(left: DataFrame, right: DataFrame, on: str, kind: str = "many_to_one", how: str = "left") -> DataFrame:
    """A join whose stated cardinality is checked first; raises on repeated keys."""
    for side, name in ((left, "left"), (right, "right")):
        if name == "right" or kind == "one_to_one":
            if side.groupBy(on).count().where("count > 1").limit(1).count():
                raise ContractError(f"{name} side repeats {on}")
    return left.join(right, on, how)


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations) of every rule in one pass."""
    counted = rows.agg(*(F.count_if(F.coalesce(broken, F.lit(False))).alias(name) for name, broken in rules.items()))
    return counted.select(F.expr(f"stack({len(rules)}, {', '.join(f"'{n}', `{n}`" for n in rules)}) AS (rule, violations)"))


def fingerprint(rows: DataFrame) -> DataFrame:
    """Rows and an order-free hash of a frame, to tell whether two outputs are the same."""
    hashed = F.xxhash64(*(F.col(c).cast("string") for c in sorted(rows.columns)))
    return rows.agg(F.count("*").alias("rows"), F.sum(hashed.cast("decimal(38,0)")).cast("string").alias("hash"))
