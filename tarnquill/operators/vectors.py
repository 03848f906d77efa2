"""Vector operators: centroids, nearest centroids, neighbours, cluster geometry, projection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MOST_CENTRES = 10_000
BLOCK = 2048
LEAST_NORM = 1e-12


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """The vector at length 1; the zero vector stays."""
    return F.transform(v, lambda x: x.cast("double") / F.greatest(F.sqrt(dot(v, v)), F.lit(LEAST_NORM)))


def usable(v: Column) -> Column:
    """Finite and not zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & (F.sqrt(dot(v, v)) > LEAST_NORM), F.lit(False))


def vector_sums(vectors: DataFrame, group: str = "label", weight: Column | None = None) -> DataFrame:
    """(group, n, mass, total) with the sum of each group's vectors; partial sums are made before the exchange."""
    w = F.lit(1.0) if weight is None else weight
    long = vectors.select(group, w.alias("w"), F.posexplode("embedding").alias("i", "x"))
    sums = long.groupBy(group, "i").agg(F.count("*").alias("n"), F.sum("w").alias("mass"), F.sum(F.col("w") * F.col("x").cast("double")).alias("x"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])
    return sums.groupBy(group).agg(F.max("n").alias("n"), F.max("mass").alias("mass"), ordered.alias("total"))


def centroids(vectors: DataFrame, group: str = "label") -> DataFrame:
    """(group, n, centroid): the mean of the usable vectors, at unit length."""
    sums = vector_sums(vectors.where(usable(F.col("embedding"))), group)
    mean = F.transform("total", lambda x: x / F.col("n"))
    return sums.select(group, "n", unit(mean).alias("centroid"))


def _matrix(centres: DataFrame, group: str) -> tuple[list, np.ndarray]:
    rows = centres.select(group, "centroid").orderBy(group).limit(MOST_CENTRES + 1).collect()
    if len(rows) > MOST_CENTRES:
        raise ValueError(f"more than {MOST_CENTRES} centres; use neighbours()")
    return [r[0] for r in rows], np.array([r[1] for r in rows], float)


def few(centres: DataFrame) -> DataFrame:
    """Centres to be broadcast, if they are not too many."""
    if centres.limit(MOST_CENTRES + 1).count() > MOST_CENTRES:
        raise ValueError(f"more than {MOST_CENTRES} centres")
    return F.broadcast(centres)


def nearest_centroids(vectors: DataFrame, centres: DataFrame, n: int = 3, group: str = "label") -> DataFrame:
    """(vec_id, rank, topic_id, cosine) of the n nearest centres; equal cosines go to the lower topic. Centres are few
    (checked), so they go to every task and vectors stay where they are."""
    ids, matrix = _matrix(centres, group)
    n = min(n, len(ids))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if part.empty:
                continue
            x = np.array(part["embedding"].tolist(), float)
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), LEAST_NORM)
            cosine = np.round(x @ matrix.T, 9)
            best = np.argsort(-cosine, axis=1, kind="stable")[:, :n]
            yield pd.DataFrame({
                "vec_id": np.repeat(part["vec_id"].to_numpy(), n), "rank": np.tile(np.arange(1, n + 1), len(part)),
                "topic_id": np.array(ids)[best].ravel(), "cosine": np.take_along_axis(cosine, best, 1).ravel(),
            })

    seen = vectors.where(usable(F.col("embedding"))).select("vec_id", "embedding")
    return seen.mapInPandas(run, "vec_id bigint, rank int, topic_id int, cosine double")


def neighbours(queries: DataFrame, references: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """(query_id, vec_id, cosine, rank) of the k nearest references of each query, itself excluded.

    A stated query set against all rows, in blocks: both sides are packed into blocks of about ``block`` vectors, each
    pair of blocks is one matrix product that leaves k candidates per query, and the last k are ranked per query.
    """

    def packed(side: DataFrame, name: str) -> DataFrame:
        seen = side.where(usable(F.col("embedding")))
        blocks = max(1, -(-seen.count() // block))
        at = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("at")
        return seen.groupBy(at).agg(F.collect_list(F.struct("vec_id", "embedding")).alias(name)).select(name)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def matrix(cells) -> tuple[np.ndarray, np.ndarray]:
            x = np.array([c["embedding"] for c in cells], float)
            return np.array([c["vec_id"] for c in cells]), x / np.linalg.norm(x, axis=1, keepdims=True)

        for part in parts:
            for left, right in zip(part["q"], part["r"]):
                (qi, q), (ri, r) = matrix(left), matrix(right)
                order = np.argsort(ri)
                ri, r = ri[order], r[order]
                cosine = np.round(q @ r.T, 9)
                cosine[qi[:, None] == ri[None, :]] = -np.inf
                best = np.argsort(-cosine, axis=1, kind="stable")[:, :k]
                found = pd.DataFrame({
                    "query_id": np.repeat(qi, best.shape[1]), "vec_id": ri[best].ravel(), "cosine": np.take_along_axis(cosine, best, 1).ravel()
                })
                yield found[np.isfinite(found["cosine"])]

    pairs = packed(queries, "q").crossJoin(packed(references, "r"))  # blocks, not rows
    found = pairs.mapInPandas(run, "query_id bigint, vec_id bigint, cosine double")
    order = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def projected(near: DataFrame, edges: DataFrame, n: int | None = None, temperature: float = 0.05, within: tuple[str, ...] = ()) -> DataFrame:
    """(query_id, topic_id, p, s1): neighbours' topic shares weighted by exp((s - s1) / temperature), weights summing to 1.
    The first ``n`` neighbours count; with ``within`` n is a column, and each n a projection of its own."""
    first = Window.partitionBy("query_id", *within)  # n rows each
    w = near.where(F.col("rank") <= (F.col("n") if within else n)).withColumn("s1", F.max("cosine").over(first))
    w = w.withColumn("w", F.exp((F.col("cosine") - F.col("s1")) / temperature))
    w = w.withColumn("w", F.col("w") / F.sum("w").over(first))
    return w.join(edges, "vec_id").groupBy("query_id", "topic_id", *within).agg(F.sum(F.col("w") * F.col("p")).alias("p"), F.max("s1").alias("s1"))


def projection_sums(projections: DataFrame, tolerance: float = 2e-5) -> DataFrame:
    """(queries, off): queries whose projected shares don't sum to 1 within the tolerance; references whose own shares do
    sum to 1 leave none."""
    sums = projections.groupBy("query_id").agg(F.sum("p").alias("total"))
    return sums.agg(F.count("*").alias("queries"), F.count_if(F.abs(F.col("total") - 1) > tolerance).alias("off"))


def own_and_other(vectors: DataFrame, centres: DataFrame, group: str = "label") -> DataFrame:
    """(vec_id, label, own, other, other_id): cosine to the own centre and to the nearest other one."""
    ids, matrix = _matrix(centres, group)
    at = {c: i for i, c in enumerate(ids)}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part = part[part[group].isin(at)]
            if part.empty:
                continue
            x = np.array(part["embedding"].tolist(), float)
            cosine = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ matrix.T
            mine = part[group].map(at).to_numpy()
            rows = np.arange(len(part))
            own = cosine[rows, mine].copy()
            cosine[rows, mine] = -np.inf
            other = cosine.argmax(axis=1)
            yield pd.DataFrame({"vec_id": part["vec_id"], "label": part[group], "own": own, "other": cosine[rows, other], "other_id": np.array(ids)[other]})

    seen = vectors.where(usable(F.col("embedding"))).select("vec_id", group, "embedding")
    return seen.mapInPandas(run, "vec_id bigint, label int, own double, other double, other_id int")


def simplified_silhouette(vectors: DataFrame, centres: DataFrame) -> DataFrame:
    """(vec_id, label, silhouette, other_id) from the distances to the own and to the nearest other centre."""
    a, b = 1 - F.col("own"), 1 - F.col("other")
    return own_and_other(vectors, centres).select(
        "vec_id", "label", ((b - a) / F.greatest(a, b, F.lit(LEAST_NORM))).alias("silhouette"), "other_id"
    )


def cosine_silhouette(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, silhouette) exactly, in linear time: for unit vectors the mean cosine distance to a cluster is
    1 minus the product with the cluster's sum over its size, so no pair is formed."""
    seen = vectors.where(usable(F.col("embedding"))).withColumn("embedding", unit(F.col("embedding")))
    sums = vector_sums(seen)
    rows = sums.select("label", "n", "total").orderBy("label").limit(MOST_CENTRES + 1).collect()
    if len(rows) > MOST_CENTRES:
        raise ValueError(f"more than {MOST_CENTRES} clusters")
    ids, sizes, totals = [r[0] for r in rows], np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
    at = {c: i for i, c in enumerate(ids)}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if part.empty:
                continue
            x = np.array(part["embedding"].tolist(), float)
            product = x @ totals.T
            mine = part["label"].map(at).to_numpy()
            rows_ = np.arange(len(part))
            size = sizes[mine]
            a = 1 - (product[rows_, mine] - 1) / np.maximum(size - 1, 1)
            other = 1 - product / sizes
            other[rows_, mine] = np.inf
            b = other.min(axis=1)
            s = np.where(size > 1, (b - a) / np.maximum(np.maximum(a, b), LEAST_NORM), 0.0)
            yield pd.DataFrame({"vec_id": part["vec_id"], "label": part["label"], "silhouette": s})

    return seen.select("vec_id", "label", "embedding").mapInPandas(run, "vec_id bigint, label int, silhouette double")


def leave_one_out(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, cosine) to the sum of the rest of the own cluster, in closed form; clusters of one give no row."""
    seen = vectors.where(usable(F.col("embedding"))).withColumn("embedding", unit(F.col("embedding")))
    sums = vector_sums(seen).where("n > 1").withColumn("square", dot(F.col("total"), F.col("total")))
    joined = seen.join(few(sums), "label").withColumn("vs", dot(F.col("embedding"), F.col("total")))
    return joined.select("vec_id", "label", ((F.col("vs") - 1) / F.sqrt(F.col("square") + 1 - 2 * F.col("vs"))).alias("cosine"))


def centre_separation(centres: DataFrame) -> DataFrame:
    """Nearest other centre of each: mean, 90th percentile and greatest cosine."""
    near = neighbours(centres.select(F.col("label").cast("bigint").alias("vec_id"), F.col("centroid").alias("embedding")),
                      centres.select(F.col("label").cast("bigint").alias("vec_id"), F.col("centroid").alias("embedding")), 1)
    return near.agg(F.avg("cosine").alias("mean"), F.percentile("cosine", 0.9).alias("p90"), F.max("cosine").alias("greatest"))


def davies_bouldin(vectors: DataFrame) -> DataFrame:
    """The Davies-Bouldin index by Euclidean scatter and distance of plain means."""
    seen = vectors.where(usable(F.col("embedding")))
    means = vector_sums(seen).select("label", F.transform("total", lambda x: x / F.col("n")).alias("mean"))
    apart = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    scatter = seen.join(few(means), "label").groupBy("label").agg(F.avg(apart(F.col("embedding"), F.col("mean"))).alias("s"))
    c = means.join(scatter, "label")
    left, right = c.select(*(F.col(x).alias(f"{x}1") for x in c.columns)), c.select(*(F.col(x).alias(f"{x}2") for x in c.columns))
    pairs = left.crossJoin(F.broadcast(right)).where("label1 <> label2")  # centres, checked above
    worst = pairs.groupBy("label1").agg(F.max((F.col("s1") + F.col("s2")) / apart(F.col("mean1"), F.col("mean2"))).alias("r"))
    return worst.agg(F.avg("r").alias("davies_bouldin"))


def adjusted_rand(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labellings, from the contingency counts."""
    two = lambda c: F.sum(c * (c - 1) / 2)
    cells = pairs.groupBy(a, b).agg(F.count("*").alias("n"))
    both = cells.agg(two(F.col("n")).alias("ij"), F.sum("n").alias("all"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(two(F.col("n")).alias("i"))
    columns = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(two(F.col("n")).alias("j"))
    one = both.crossJoin(rows).crossJoin(columns)  # one row each
    expected = F.col("i") * F.col("j") / (F.col("all") * (F.col("all") - 1) / 2)
    most = (F.col("i") + F.col("j")) / 2
    return one.select(F.coalesce(F.try_divide(F.col("ij") - expected, most - expected), F.lit(1.0)).alias("ari"))
