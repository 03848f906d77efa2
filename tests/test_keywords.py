import pytest
from pyspark.sql import functions as F

from tarnquill.operators import keywords as K
from tarnquill.operators.integrity import ContractError, join_checked, population_identity, violations
from tarnquill.operators.observations import anchor_families, build_dictionary, unobserved


@pytest.fixture
def tables(spark):
    rules = spark.createDataFrame([
        ("K1", "solar cell", "direct", "T1", []), ("K2", "hydrogen", "conditional", "T2", ["T1"]), ("K3", "storage", "conditional", "T3", []),
        ("K4", "grid", "conditional", "T4", ["T9"]), ("K5", "physics", "broad_auxiliary", "", []),
    ], "keyword_code string, canonical_name string, decision string, topic_code string, families array<string>")
    obs = spark.createDataFrame(
        [(1, "k1"), (1, "k2"), (1, "k4"), (2, "k2"), (3, "k1"), (3, "k3"), (4, "k5"), (5, "k1"), (5, "k2")], "row_id bigint, keyword_id string"
    ).withColumn("score", F.lit(0.5))
    aliases = spark.createDataFrame([(f"K{i}", f"k{i} | label:{i}") for i in range(1, 6)], "keyword_code string, source_keyword_ids string")
    population = spark.createDataFrame(
        [(i, f"d{i}", "paper", i == 3, False, True) for i in range(7)], "row_id bigint, doc_id string, source string, retracted boolean, template_record boolean, usable boolean"
    )
    held = spark.createDataFrame([(5, "k1")], "row_id bigint, keyword_id string")
    return population, obs, K.coded(obs, aliases), rules, held


def test_anchor_rules(tables):
    population, obs, coded, rules, held = tables
    hits = K.candidate_hits(coded, rules, held)
    related = K.relations(hits)
    # a conditional term needs an anchor of its family in the same record; withheld pairs anchor nothing
    assert {(r.row_id, r.topic_code, r.has_direct_hit) for r in related.collect()} == {(1, "T1", True), (1, "T2", False), (3, "T1", True), (3, "T3", False)}
    status = {r.row_id: r.classification_status for r in K.assignments(population, coded, obs, hits, related).collect()}
    assert status == {0: "no_keywords", 1: "assigned", 2: "conditional_only_without_anchor", 3: "assigned", 4: "no_active_dictionary_keyword", 5: "conditional_only_without_anchor", 6: "no_keywords"}
    counts = {r.topic_code: tuple(r)[1:] for r in K.topic_counts(related, K.assignments(population, coded, obs, hits, related)).collect()}
    assert counts["T1"] == (2, 2, 0, 1) and counts["T3"] == (1, 0, 1, 0)


def test_mask_renormalises(spark):
    w = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.8), (2, "a", 1.0)], "row_id bigint, keyword_id string, weight double")
    out = K.masked(w, spark.createDataFrame([("a",)], "keyword_id string")).collect()
    assert [(r.row_id, r.keyword_id, round(r.weight, 9)) for r in out] == [(1, "b", 1.0)]


def test_vocabulary_window(spark):
    obs = spark.createDataFrame([(i, "all") for i in range(40)] + [(i, "some") for i in range(15)] + [(i, "few") for i in range(9)], "row_id bigint, keyword_id string")
    found = {r.keyword_id: round(r.idf, 6) for r in K.vocabulary(obs, F.lit(40)).collect()}
    assert found == {"some": round(__import__("math").log(41 / 16) + 1, 6)}


def test_dictionary(spark):
    names = spark.createDataFrame([("b",), ("a",), ("tariff x",), ("c",), ("a",), ("",)], "name string")
    decided = spark.createDataFrame([("a", "direct", "T1", 1), ("a", "broad", "", 3), ("z", "direct", "T2", 1)], "name string, decision string, topic_code string, priority int")
    out = [tuple(r) for r in build_dictionary(names, decided, [("x", "tariff")]).orderBy("keyword_code").collect()]
    assert out == [("KW00001", "a", "direct", "T1"), ("KW00002", "b", "unreviewed", ""), ("KW00003", "c", "unreviewed", ""), ("KW00004", "tariff x", "excluded_rule", "")]
    assert [r.name for r in unobserved(decided, names).collect()] == ["z"]
    with pytest.raises(ContractError):
        build_dictionary(names, decided.unionByName(spark.createDataFrame([("a", "direct", "T9", 1)], decided.schema)), [])
    rules = spark.createDataFrame([("conditional", "T1"), ("conditional", "T2"), ("conditional", "T3"), ("direct", "T1")], "decision string, topic_code string")
    families = [r.families for r in anchor_families(rules, {"T1": ["T1", "T5"]}, ["T2"]).collect()]
    assert families == [["T1", "T5"], [], ["T3"], []]


def test_checks(spark):
    good = spark.createDataFrame([(0, "a"), (1, "b")], "row_id bigint, doc_id string")
    assert population_identity(good).first().sound
    assert not population_identity(good.unionByName(good)).first().sound
    assert {tuple(r) for r in violations(good, {"zero": F.col("row_id") == 0, "none": F.lit(None).cast("boolean")}).collect()} == {("zero", 1), ("none", 0)}
    with pytest.raises(ContractError):
        join_checked(good, good.unionByName(good), "row_id")
