import math

import pytest

from tarnquill.llm.mixing import MET, budgets, divergence, entropy, exponent_for_entropy, mix, shares, tempered

TARGETS = [("a", 0.5, 1, "x"), ("b", 0.3, 4, "x"), ("c", 0.2, 3, "x")]
SCHEMA = "source string, target_share double, max_repeats int, tokens string"


@pytest.fixture
def counted(spark):
    rows = [(i, "a", 50 + i % 7) for i in range(4000)] + [(i, "b", 40 + i % 11) for i in range(4000, 4800)] + [(i, "c", 60) for i in range(5000, 5500)]
    rows += [(9001, None, 10), (9002, "other", 10), (9003, "a", 0)]
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id bigint, source string, n_tokens bigint, block int, pass int, room int")


def test_shares_and_repeats(spark, counted):
    targets = spark.createDataFrame(TARGETS, SCHEMA)
    mixed = mix(counted, targets, blocks=64).cache()
    for r in shares(mixed, targets).collect():
        assert abs(r.actual_share - r.target_share) < 0.002 and r.most_copies <= r.max_repeats
    assert mixed.count() == mixed.select("doc_id").distinct().count()
    assert mixed.where("source is null or source = 'other'").count() == 0
    again = mix(counted.repartition(5), targets, blocks=64)
    assert again.exceptAll(mixed).count() == 0


def test_a_size_too_large_for_the_targets_lowers_the_exponent():
    sizes, repeats = {"a": 1000.0, "b": 100.0}, {"a": 1, "b": 2}
    exponent, tokens = budgets(sizes, {"a": 0.5, "b": 0.5}, repeats, 700.0)
    assert 0 < exponent < 1 and tokens["b"] <= 200 + 1e-6 and math.isclose(sum(tokens.values()), 700.0)
    exponent, tokens = budgets(sizes, {"a": 0.5, "b": 0.5}, repeats)
    assert 0.99 < exponent < 1.0 and math.isclose(tokens["a"], tokens["b"], rel_tol=1e-3) and math.isclose(tokens["b"], 200.0)
    exponent, tokens = budgets(sizes, {"a": 0.5, "b": 0.5}, repeats, 5_000.0)  # more than there is: natural shares, as large as they allow
    assert exponent == 0.0 and math.isclose(tokens["a"], 1000.0) and math.isclose(tokens["b"], 100.0)


def test_the_exponent_meets_the_targets():
    sizes, targets, repeats = {"a": 800.0, "b": 150.0, "c": 50.0}, {"a": 0.2, "b": 0.3, "c": 0.5}, {"a": 3, "b": 3, "c": 3}
    exponent, tokens = budgets(sizes, targets, repeats)
    total = sum(tokens.values())
    assert all(abs(tokens[s] / total - targets[s]) < 1e-4 for s in sizes) and divergence(targets, tempered(sizes, exponent, targets)) <= MET
    assert divergence(targets, tempered(sizes, exponent - 1e-3, targets)) > MET
    assert budgets(sizes, {s: n / 1000 for s, n in sizes.items()}, repeats)[0] == 0.0  # natural shares are the targets


def test_repeated_targets_add_up(spark, counted):
    targets = spark.createDataFrame([("a", 0.25, 1, "x"), ("a", 0.25, None, "x"), ("b", 0.5, 4, "x")], SCHEMA)
    found = {r.source: r for r in shares(mix(counted, targets, blocks=16), targets).collect()}
    assert len(found) == 2 and math.isclose(found["a"].actual_share, 0.5, abs_tol=0.003)


def test_temperature():
    sizes = {"a": 900.0, "b": 90.0, "c": 10.0}
    assert math.isclose(tempered(sizes, 1.0)["a"], 0.9) and math.isclose(tempered(sizes, 0.0)["c"], 1 / 3)
    wanted = 0.9
    assert math.isclose(entropy(tempered(sizes, exponent_for_entropy(sizes, wanted))), wanted, rel_tol=1e-6)


def test_empty_and_missing(spark, counted):
    targets = spark.createDataFrame([*TARGETS, ("d", 0.1, 2, "x"), (None, 0.5, 1, "x"), ("e", None, None, "x")], SCHEMA)
    assert mix(counted.limit(0), targets).count() == 0
    assert mix(counted, targets.limit(0)).count() == 0
    found = {r.source: r for r in shares(mix(counted, targets, blocks=8), targets).where("source is not null").collect()}
    assert found["d"].tokens == 0 and math.isclose(found["a"].actual_share, 0.5, abs_tol=0.003)
