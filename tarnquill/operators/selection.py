"""Choosing among candidate models by averaged ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnquill.operators.integrity import ContractError

#: Metric -> whether a low value is good
DIRECTIONS = {
    "sampled_cosine_silhouette": False, "simplified_silhouette_mean": False, "davies_bouldin": True,
    "nearest_center_cosine_mean": True, "empty_topic_fraction": True, "keyword_embedding_ari": False,
}


def average_rank(value: Column, low_is_good: bool, within: list[str]) -> Column:
    """The rank of a value, equal values sharing the mean of their places."""
    order = Window.partitionBy(*within).orderBy(value.asc() if low_is_good else value.desc())
    return F.rank().over(order) + (F.count("*").over(Window.partitionBy(*within, value)) - 1) / 2


def scored_candidates(
    metrics: DataFrame, directions: dict[str, bool] | None = None, low: int = 450, high: int = 550, centre: int = 500,
    penalty: float | Column = 0.15, tolerance: float | Column = 0.05, within: tuple[str, ...] = (), omitted: Column | None = None,
) -> DataFrame:
    """Candidates in the window with mean rank, score and ``selected``. Within the tolerance of the best score the one
    nearest the centre is chosen. ``within`` names columns of independent selections; ``omitted`` names a metric that a
    selection leaves out ('' for none). Candidates are few."""
    directions = directions or DIRECTIONS
    within = list(within)
    rows = metrics.where(F.col("requested_k").between(low, high))
    for name, low_is_good in directions.items():
        rows = rows.withColumn(f"rank_{name}", average_rank(F.col(name), low_is_good, within))
    left_out = F.lit("") if omitted is None else omitted
    mean = sum((F.when(left_out == n, 0.0).otherwise(F.col(f"rank_{n}")) for n in directions), F.lit(0.0)) / F.when(left_out == "", len(directions)).otherwise(len(directions) - 1)
    away = F.abs(F.col("requested_k") - centre)
    penalty = penalty if isinstance(penalty, Column) else F.lit(penalty)
    tolerance = tolerance if isinstance(tolerance, Column) else F.lit(tolerance)
    rows = rows.withColumn("mean_metric_rank", mean).withColumn("selection_score", F.round(mean + penalty * away / 50, 9))
    best = F.min("selection_score").over(Window.partitionBy(*within))
    rows = rows.withColumn("within_practical_tie", F.col("selection_score") <= best + tolerance + 1e-9)
    order = Window.partitionBy(*within).orderBy(F.desc("within_practical_tie"), away, "selection_score", "requested_k")
    return rows.withColumn("selected", F.row_number().over(order) == 1)


def validate_candidates(metrics: DataFrame, directions: dict[str, bool] | None = None, low: int = 450, high: int = 550) -> None:
    """Raises unless the window holds a candidate, candidates are unique and their metrics finite."""
    names = list(directions or DIRECTIONS)
    inside = F.col("requested_k").between(low, high)
    bad = F.lit(False)
    for n in names:
        bad = bad | F.col(n).isNull() | F.isnan(n) | (F.abs(n) == float("inf"))
    row = metrics.agg(
        F.count_if(inside).alias("some"), F.count_if(inside & bad).alias("bad"), (F.count("*") - F.countDistinct("requested_k")).alias("repeated")
    ).first()
    if not row.some or row.bad or row.repeated:
        raise ContractError("candidates have to be unique and finite, one at least inside the window")
