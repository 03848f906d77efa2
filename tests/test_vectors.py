import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnquill.functions.assignment import least_cost
from tarnquill.operators import factors as N
from tarnquill.operators import vectors as V
from tarnquill.operators.finalize import coverage, finalise


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")


def test_centroids_and_nearest(spark):
    df = _frame(spark, [(1, [1.0, 0.0], 0), (2, [0.8, 0.6], 0), (3, [0.0, 1.0], 1), (4, [0.0, 0.0], 1), (5, [float("nan"), 1.0], 0)])
    centres = V.centroids(df)
    assert {r.label: r.n for r in centres.collect()} == {0: 2, 1: 1}
    best = V.nearest_centroids(df, centres, 1)
    assert {r.vec_id: r.topic_id for r in best.collect()} == {1: 0, 2: 0, 3: 1}  # zero and NaN vectors have none
    tie = spark.createDataFrame([(1, [1.0, 0.0]), (0, [0.0, 1.0])], "label int, centroid array<double>")
    ranked = V.nearest_centroids(_frame(spark, [(9, [1.0, 1.0], 0)]), tie, 2).orderBy("rank").collect()
    assert [r.topic_id for r in ranked] == [0, 1]


def test_silhouettes(spark):
    df = _frame(spark, [(1, [1.0, 0.0], 0), (2, [0.99, 0.1], 0), (3, [0.0, 1.0], 1), (4, [0.1, 0.99], 1)])
    found = V.simplified_silhouette(df, V.centroids(df)).orderBy("vec_id").collect()
    assert all(r.silhouette > 0.9 for r in found) and [r.other_id for r in found] == [1, 1, 0, 0]
    exact = {r.vec_id: r.silhouette for r in V.cosine_silhouette(df).collect()}
    x = np.array([[1, 0], [0.99, 0.1], [0, 1], [0.1, 0.99]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = 1 - x[0] @ x[1], np.mean([1 - x[0] @ x[2], 1 - x[0] @ x[3]])
    assert exact[1] == pytest.approx((b - a) / max(a, b))


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6))
    df = _frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    found = {}
    for r in V.neighbours(df.where("vec_id < 20"), df, 5, block=64).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(20):
        c = u @ u[q]
        c[q] = -9
        assert found[q] == np.argsort(-c)[:5].tolist()


def test_rand_index(spark):
    same = spark.createDataFrame([(i % 3, (i + 1) % 3) for i in range(30)], "a int, b int")
    assert V.adjusted_rand(same, "a", "b").first().ari == pytest.approx(1.0)


def test_assignment():
    assert least_cost([[4, 1, 3], [2, 0, 5], [3, 2, 2]]) == [1, 0, 2]
    a = np.eye(3)
    assert all(c == pytest.approx(1.0) for _, _, c in N.matched_components(a, a[[2, 0, 1]]))
    with pytest.raises(ValueError):
        least_cost([[1.0], [2.0]])


def test_factorisation(spark):
    rng = np.random.default_rng(0)
    w, h = rng.random((80, 3)) ** 3, rng.random((3, 12)) ** 3
    x = w @ h
    df = spark.createDataFrame([(i, list(range(12)), r.tolist()) for i, r in enumerate(x)], "row_id bigint, cols array<int>, vals array<double>")
    fitted, errors = N.fit(df, 12, 3, epochs=6, steps=30)
    assert (fitted >= 0).all() and all(b <= a + 1e-9 for a, b in zip(errors, errors[1:]))
    again, _ = N.fit(df.repartition(7), 12, 3, epochs=6, steps=30)
    assert np.allclose(fitted, again)  # however the rows are spread
    a = {(r.row_id, r.topic_id): r.contribution for r in N.infer(df, fitted).collect()}
    b = {(r.row_id, r.topic_id): r.contribution for r in N.infer(df, fitted * np.array([[100.0], [0.01], [1.0]]), steps=400).collect()}
    assert {k[0]: max(range(3), key=lambda t: a[k[0], t]) for k in a} == {k[0]: max(range(3), key=lambda t: b[k[0], t]) for k in b}
    assert N.near_duplicates(np.array([[1.0, 0], [2.0, 0.01], [0, 1]])) and not N.near_duplicates(np.eye(3))


def test_pca_equals_numpy(spark):
    rng = np.random.default_rng(2)
    x, w = rng.normal(size=(200, 4)) * [5, 3, 1, 0.1], rng.random(200) + 0.5
    df = spark.createDataFrame([(v.tolist(), float(k)) for v, k in zip(x, w)], "embedding array<double>, weight double")
    mean, axes = N.weighted_pca(df, 2)
    m = (w[:, None] * x).sum(0) / w.sum()
    values, vectors = np.linalg.eigh(((x - m) * w[:, None]).T @ (x - m) / w.sum())
    assert np.allclose(mean, m) and np.allclose(np.abs(axes[0]), np.abs(vectors[:, -1]))


def test_finalise_mini_corpus(spark):
    meta = [(0, "paper"), (1, "paper"), (2, "paper"), (3, "paper"), (4, "paper"), (5, "patent"), (6, "patent"), (7, "policy"), (8, "policy")]
    x = {0: [1, 0, 0], 1: [1, 0, 0], 2: [0, 1, 0], 3: [0, 0, 1], 4: [1, 1, 1], 5: [0.9, 0.1, 0], 6: [0, 0.1, 0.9], 7: [0.1, 0.9, 0], 8: [0, 0, 0]}
    labels = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (3, 2), (4, -1)], "vec_id bigint, topic_id int")
    vectors = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in x.items()], "vec_id bigint, embedding array<double>")
    final = finalise(spark.createDataFrame(meta, "vec_id bigint, source string"), labels, vectors)
    assert [r.topic_id for r in final.orderBy("vec_id").collect()] == [0, 0, 1, 2, -1, 0, 2, 1, -1]
    assert {r.source: (r.assigned_records, r.unassigned_records) for r in coverage(final).collect()} == {"paper": (4, 1), "patent": (2, 0), "policy": (1, 1)}
