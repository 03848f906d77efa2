"""Fits go on until the relative error has settled."""

import numpy as np

from tarnquill.operators import factors as N
from tarnquill.plans import topic_queries as Q


def test_batches_equal_rows(spark):
    import pandas as pd

    rng = np.random.default_rng(3)
    h = rng.random((4, 30))
    cells = [np.sort(rng.choice(30, rng.integers(1, 9), replace=False)) for _ in range(1500)]
    part = pd.DataFrame({"cols": cells, "vals": [rng.random(len(c)) for c in cells]})
    found = np.concatenate([w for w, *_ in N.solve_rows(part, h, h @ h.T, 30)])
    assert np.allclose(found, [N.solve(c, v, h, h @ h.T, 30) for c, v in zip(part["cols"], part["vals"])])


def test_registered_fit_has_settled(spark):
    d = "/root/testdata/sf0.001"
    errors = [r.relative_error for r in Q.nmf_error(spark, d).orderBy("epoch").collect()]
    assert len(errors) >= 5 and errors[-2] - errors[-1] <= 1e-3 * errors[-2]
    assert all(b <= a + 1e-9 for a, b in zip(errors, errors[1:]))
    rows, n = Q._features(spark, d)
    _, before = N.fit(rows, n, 10, epochs=4, steps=20)
    assert errors[-1] < before[-1]
