"""Mini-batch fits: visits, errors, sparse sums against dense ones, labels found in the pass."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnquill.operators import factors as N
from tarnquill.operators import multilabel as M
from tarnquill.operators.integrity import ContractError
from tarnquill.plans import topic_queries as Q


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    truth = rng.random((4, 60)) ** 6
    x = rng.dirichlet(np.full(4, 0.2), 700) @ truth
    x[x < 0.02] = 0
    cells = [(i, np.flatnonzero(r).tolist(), r[r > 0].tolist()) for i, r in enumerate(x)]
    cells += [(700, [], []), (701, [3], [0.0])]
    return spark.createDataFrame(cells, "row_id bigint, cols array<int>, vals array<double>").repartition(6).cache()


def _dense(rows):
    x = np.zeros((702, 60))
    for r in rows.collect():
        x[r.row_id, r.cols] = r.vals
    return x


def test_sums_equal_dense(rows):
    h = np.random.default_rng(1).random((4, 60))
    wx, ww, (square, cross, fitted), n = N._pass_sums(rows, h, 20, 0.0)
    x = _dense(rows)
    w = np.stack([N.solve(np.flatnonzero(r), r[r > 0], h, h @ h.T, 20) for r in x])
    assert n == 702 and np.allclose(wx, w.T @ x) and np.allclose(ww, w.T @ w)
    assert np.isclose(square - 2 * cross + fitted, ((x - w @ h) ** 2).sum())


def test_blocks_of_columns(rows, monkeypatch):
    h = np.random.default_rng(1).random((4, 60))
    whole = N._pass_sums(rows, h, 10, 0.0)[0]
    monkeypatch.setattr(N, "BLOCK_COLUMNS", 7)
    assert np.allclose(N._pass_sums(rows, h, 10, 0.0)[0], whole)


def test_every_row_once_an_epoch(rows):
    found = N.fit_online(rows, 60, 4, epochs=4, batches=5)
    assert found.visits == 4 * 702 and (found.h >= 0).all()
    assert all(b < a for a, b in zip(found.errors, found.errors[1:]))
    # the same by one process over dense rows
    x, batch = _dense(rows), {r.row_id: r.b for r in rows.select("row_id", F.pmod(F.xxhash64("row_id"), F.lit(5)).alias("b")).collect()}
    h, a, b = N._start(4, 60, 17), 0.0, 0.0
    for epoch in range(4):
        for at in np.random.default_rng([17, epoch]).permutation(5):
            part = x[[i for i in range(702) if batch[i] == at]]
            w = np.stack([N.solve(np.flatnonzero(r), r[r > 0], h, h @ h.T, 30) for r in part])
            a, b = a + h * (w.T @ part), b + (w.T @ w) @ h
            h = a / np.maximum(b, N.EPS)
    assert np.allclose(found.h, h, rtol=0.02, atol=1e-4)
    again = N.fit_online(rows.repartition(3), 60, 4, epochs=4, batches=5)
    assert np.allclose(found.h, again.h, rtol=1e-3, atol=1e-6)


def test_rows_settle_alone(rows):
    h = np.random.default_rng(2).random((4, 60))
    part = rows.toPandas()
    alone = [next(N.solve_rows(part.iloc[[i]], h, h @ h.T, 200, 1e-4))[0][0] for i in range(40)]
    together = np.concatenate([w for w, *_ in N.solve_rows(part, h, h @ h.T, 200, 1e-4)])
    assert np.allclose(alone, together[:40])


def test_labels_of_the_pass(spark, rows):
    h = N.fit(rows, 60, 4, epochs=3)[0]
    hard = {r.row_id: (r.topic_id, r.top1) for r in N.infer_hard(rows, h, 60, 0.0).collect()}
    shares = N.infer(rows, h).withColumnRenamed("contribution", "mass").createOrReplaceTempView("c")
    shares = spark.sql("SELECT *, mass / greatest(sum(mass) OVER (PARTITION BY row_id), 1e-12) AS p FROM c")
    other = {r.row_id: (r.topic_id, r.top1) for r in M.hard_assignment(shares).collect()}
    assert hard.keys() == other.keys() and all(hard[i][0] == other[i][0] and abs(hard[i][1] - other[i][1]) < 1e-4 for i in hard)
    assert hard[700] == (-1, 0.0)


def test_stability_of_a_permuted_model(rows):
    h = N.fit(rows, 60, 4, epochs=3)[0]
    r = N.stability(rows, h, h[[2, 0, 3, 1]] * 5).first()
    assert r.matched_topics == 4 and np.isclose(r.cosine_mean, 1) and np.isclose(r.cosine_p10, 1) and np.isclose(r.ari, 1)


def test_model_bound():
    with pytest.raises(ValueError):
        N._start(N.MOST_CELLS, 2, 1)
    assert issubclass(ContractError, ValueError)


@pytest.fixture
def spread(monkeypatch):
    """Nothing is held by the driver; blocks and groups are small."""
    for name, value in (("MOST_HELD", 0), ("MOST_CELLS", 100), ("SPREAD_COLUMNS", 7), ("GROUP_CELLS", 40)):
        monkeypatch.setattr(N, name, value)


def test_spread_fit_equals_held(rows, monkeypatch, request):
    held = N.fit_online(rows, 60, 4, epochs=3, batches=5)
    labels = {r.row_id: r for r in N.infer_hard(rows, held.h).collect()}
    request.getfixturevalue("spread")
    found = N.fit_online(rows, 60, 4, epochs=3, batches=5)
    cols, h = found.h.read(rows.sparkSession.range(60).selectExpr("CAST(id AS int) AS col"))
    assert found.visits == held.visits and cols.tolist() == list(range(60)) and np.allclose(found.errors, held.errors, rtol=1e-3)
    assert np.allclose(h, held.h, rtol=1e-2, atol=1e-4) and np.allclose(found.h.gram, h @ h.T)
    spread_labels = {r.row_id: r for r in N.infer_hard(rows, found.h).collect()}
    assert spread_labels.keys() == labels.keys()
    assert all(abs(spread_labels[i].top1 - r.top1) < 5e-3 and (spread_labels[i].topic_id == r.topic_id or r.margin < 1e-2) for i, r in labels.items())
    assert spread_labels[700].topic_id == -1


def test_spread_start_equals_start(spark, monkeypatch):
    whole = N._start(4, 60, 17)
    monkeypatch.setattr(N, "SPREAD_COLUMNS", 7)
    model, _ = N._spread_start(spark, 4, 60, 17)
    assert np.allclose(model.read(spark.range(60).selectExpr("CAST(id AS int) AS col"))[1], whole, rtol=1e-6)


@pytest.mark.parametrize("query", ["nmf_fit_infer", "nmf_online_error"])
def test_queries_beyond_the_drivers_bound(spark, spread, query):
    import __spark_entry__ as entry

    d = "/root/testdata/sf0.001"
    found = entry.queries()[query](spark, d).collect()
    assert len({r[0] for r in found}) == len(found) == (5 if query == "nmf_online_error" else Q._features(spark, d)[0].count())


def test_solver_works_in_place():
    """The steps make no copies of the weights: rows of one term each need their weights, numerators, products and little else."""
    import tracemalloc

    import pandas as pd

    part = pd.DataFrame({"cols": [[i % 90] for i in range(400)], "vals": [[1.0 + i] for i in range(400)]})
    h = np.random.default_rng(3).random((300, 90)).astype(np.float32)
    tracemalloc.start()
    w = next(N.solve_rows(part, h, h @ h.T, 30, 0.0))[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(w[7], N.solve(np.array([7]), np.array([8.0]), h.astype(float), (h @ h.T).astype(float), 30), rtol=1e-3)
    assert peak < 6 * w.nbytes


def test_labels_measure_no_errors(spark, monkeypatch):
    monkeypatch.setattr(N, "_error", lambda *_: pytest.fail("the labels need no errors"))
    assert Q.nmf_fit_infer(spark, "/root/testdata/sf0.001").count() > 0


@pytest.mark.parametrize("held", [True, False])
def test_errors_are_of_all_rows(spark, monkeypatch, held):
    """1,600 rows in two kinds of unlike size, so that any thousand of them have another error."""
    if not held:
        for name, value in (("MOST_HELD", 0), ("SPREAD_COLUMNS", 7), ("GROUP_CELLS", 400)):
            monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(7)
    cells = [(i, np.sort(rng.choice(40, 4, replace=False)).tolist(), (rng.random(4) * rng.choice([0.1, 5.0])).tolist()) for i in range(1600)]
    cells.append((1600, [], []))
    rows = spark.createDataFrame(cells, "row_id bigint, cols array<int>, vals array<double>").repartition(5)
    found = N.fit_online(rows, 40, 3, epochs=1, batches=2)
    h = found.h if held else found.h.read(spark.range(40).selectExpr("CAST(id AS int) AS col"))[1]
    x = np.zeros((1601, 40))
    for i, cols, vals in cells:
        x[i, cols] = vals
    w = np.stack([N.solve(np.flatnonzero(r), r[r > 0], h, h @ h.T, 400) for r in x])
    assert np.isclose(found.errors[0], np.sqrt(((x - w @ h) ** 2).sum() / (x * x).sum()), rtol=2e-4)
