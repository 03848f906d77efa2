"""More centres than are broadcast raise; none is left out."""

import pytest

from tarnquill.operators import vectors as V


@pytest.mark.parametrize("operator", [V.leave_one_out, V.davies_bouldin])
def test_too_many_centres_raise(spark, monkeypatch, operator):
    rows = [(i, i % 3, [float(i % 3 == j) + 0.01 * i for j in range(3)]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    monkeypatch.setattr(V, "MOST_CENTRES", 3)
    assert operator(df).count() in (1, 9)
    monkeypatch.setattr(V, "MOST_CENTRES", 2)
    with pytest.raises(ValueError):
        operator(df).count()
