"""Mixing sources to target shares of the total size, with capped repetition.

The weights are tempered: on the path from the sources' natural shares q to the targets t, w(a) is proportional to
q**(1-a) * t**a. The exponent is bisected to the least at which the weights meet the targets (their divergence falls to
``MET``); where a stated size asks more of a source than it may repeat, it is bisected back to the greatest at which no
source needs more passes than it may make. Without a stated size the mix is as large as the weights allow.
``tempered`` without targets flattens the natural shares to a target entropy the same way.

Weights become budgets in tokens. A source gives its budget in passes, each a permutation of blocks: documents fall into
blocks by a hash of pass and document. Whole blocks before the budget's end are taken from the running sum over blocks
(passes x blocks rows, a fixed number); the one block in which the budget ends is cut into blocks again, and only a block
of that block is put in order document by document.

Defined results: documents without a source, or of one without a target, are no part of the mix; documents without
tokens cost nothing and follow their block; a source without tokens gets no share and the others keep their proportion;
a target without a number of repeats allows one; targets of null or 0 are left out; repeated targets of a source add up.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCKS, LEVELS = 4096, 2
STEPS = 60
#: The divergence at which targets count as met: shares then differ by less than a ten-thousandth.
MET = 1e-9
MOST_PASSES = 500


def tempered(sizes: dict[str, float], exponent: float, targets: dict[str, float] | None = None) -> dict[str, float]:
    """Normalised weights at the exponent: natural shares to its power, or on the path from natural shares to targets."""
    total = sum(sizes.values())
    logs = {s: math.log(n / total) for s, n in sizes.items() if n > 0}
    if targets is None:
        raw = {s: math.exp(exponent * x) for s, x in logs.items()}
    else:
        raw = {s: math.exp((1 - exponent) * x + exponent * math.log(targets[s])) for s, x in logs.items() if targets.get(s, 0) > 0}
    whole = sum(raw.values())
    return {s: w / whole for s, w in raw.items()}


def entropy(weights: dict[str, float]) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def exponent_for_entropy(sizes: dict[str, float], wanted: float) -> float:
    """The exponent in [0, 1] whose weights have the wanted entropy (it falls as the exponent grows)."""
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        if entropy(tempered(sizes, middle)) > wanted:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def divergence(wanted: dict[str, float], weights: dict[str, float]) -> float:
    """How far the weights are from the wanted shares (Kullback-Leibler, both brought to a sum of 1 over the weights' sources)."""
    total = sum(wanted[s] for s in weights)
    return sum(wanted[s] / total * math.log(wanted[s] / total / w) for s, w in weights.items())


def _bisected(low: float, high: float, holds: Callable[[float], bool]) -> float:
    """The least number, to ``STEPS`` halvings, from which on ``holds`` is true; it is true of ``high``."""
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


def budgets(
    sizes: dict[str, float], targets: dict[str, float], repeats: dict[str, int], size: float | None = None
) -> tuple[float, dict[str, float]]:
    """(exponent, tokens of each source)."""
    sizes = {s: n for s, n in sizes.items() if n > 0 and targets.get(s, 0) > 0}
    if not sizes:
        return 1.0, {}
    weights = lambda a: tempered(sizes, a, targets)
    largest = lambda a: min(repeats[s] * sizes[s] / w for s, w in weights(a).items())
    # the divergence falls all along the path, so the exponent that meets the targets is found by bisection
    exponent = 0.0 if divergence(targets, weights(0.0)) <= MET else _bisected(0.0, 1.0, lambda a: divergence(targets, weights(a)) <= MET)
    if size is None:
        size = largest(exponent)
    elif largest(exponent) < size:  # too much is asked of some source: back towards the natural shares, as far as needed
        if largest(0.0) < size:
            exponent, size = 0.0, largest(0.0)
        else:
            fair = exponent
            exponent = fair - _bisected(0.0, fair, lambda back: largest(fair - back) >= size * (1 - 1e-12))
    return exponent, {s: w * size for s, w in weights(exponent).items()}


class Plan(NamedTuple):
    exponent: float
    sizes: dict[str, float]
    tokens: dict[str, float]

    @property
    def passes(self) -> list[tuple[str, int, float]]:
        """(source, pass, what the pass may hold) of every pass over a source."""
        return [
            (s, p, b - p * self.sizes[s]) for s, b in self.tokens.items() for p in range(math.ceil(b / self.sizes[s] - 1e-9))
        ]


def planned(counted: DataFrame, targets: DataFrame, size: float | None = None) -> Plan:
    """The exponent and each source's budget. Shares of repeated target rows add up, the greatest number of repeats counts."""
    rows = targets.where("source is not null and target_share > 0").groupBy("source").agg(
        F.sum("target_share").alias("share"), F.max("max_repeats").alias("repeats")
    ).limit(MOST_PASSES + 1).collect()  # one row for each source
    wanted = {r.source: (float(r.share), int(r.repeats or 1)) for r in rows}
    if len(rows) > MOST_PASSES or sum(r for _, r in wanted.values()) > MOST_PASSES:
        raise ValueError(f"more than {MOST_PASSES} passes over sources")
    sums = counted.where(F.col("source").isin(list(wanted))).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()
    sizes = {r.source: float(r.n or 0) for r in sums}
    exponent, tokens = budgets(sizes, {s: t for s, (t, _) in wanted.items()}, {s: r for s, (_, r) in wanted.items()}, size)
    return Plan(exponent, sizes, tokens)


def mix(counted: DataFrame, targets: DataFrame, size: float | None = None, blocks: int = BLOCKS, plan: Plan | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of all documents in the mix.

    ``counted`` (doc_id, source, n_tokens) is read several times, so it should be a table or a checkpoint.
    """
    plan = planned(counted, targets, size) if plan is None else plan
    passes = F.broadcast(counted.sparkSession.createDataFrame(plan.passes, "source string, pass int, room double"))  # MOST_PASSES rows
    columns = ["doc_id", "source", "n_tokens"]
    open_ = counted.select(*columns).join(passes, "source").withColumn("order", F.xxhash64("pass", "doc_id"))
    taken = None
    for level in range(LEVELS):  # the block at the border is cut into blocks again
        dealt = open_.withColumn("block", F.pmod(F.shiftright("order", 12 * level), F.lit(blocks)))
        block = dealt.groupBy("source", "pass", "block").agg(F.sum("n_tokens").alias("tokens"), F.first("room").alias("room"))
        running = Window.partitionBy("source", "pass").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # blocks
        cut = block.withColumn("before", F.coalesce(F.sum("tokens").over(running), F.lit(0))).where("before < room")
        # at most MOST_PASSES x blocks rows
        placed = dealt.drop("room").join(F.broadcast(cut), ["source", "pass", "block"])
        inside = placed.where("before + tokens <= room").select(*columns)
        taken = inside if taken is None else taken.unionByName(inside)
        open_ = placed.where("before + tokens > room").select(*columns, "pass", "order", (F.col("room") - F.col("before")).alias("room"))
    # a document belongs to the mix if most of it lies before the budget's end
    last = Window.partitionBy("source", "pass").orderBy("order", "doc_id")  # a block of a block of a source
    upto = F.sum("n_tokens").over(last.rowsBetween(Window.unboundedPreceding, 0))
    partly = open_.withColumn("upto", upto).where("upto - n_tokens / 2 <= room").select(*columns)
    return taken.unionByName(partly).groupBy(*columns).agg(F.count("*").cast("int").alias("copies"))


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Tokens and actual share of each source of the mix beside its target."""
    sums = mixed.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"),
        F.sum("copies").alias("occurrences"), F.max("copies").alias("most_copies"),
    )
    stated = targets.where("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    joined = stated.join(sums, "source", "left").na.fill(0, ["tokens", "documents", "occurrences", "most_copies"])
    total = F.sum("tokens").over(Window.partitionBy())  # one row per source
    return joined.withColumn("actual_share", F.try_divide("tokens", total))
