from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnquill.llm.survivors import elect, json_form, moment, prepared, with_values

STATED = [
    ("2025-01-02", "2025-01-02 00:00:00"), ("2025-01-02T03:04:05", "2025-01-02 03:04:05"), ("2025-01-02 03:04:05", "2025-01-02 03:04:05"),
    ("2025-01-02T03:04:05Z", "2025-01-02 03:04:05"), ("2025-01-02T03:04:05+08:00", "2025-01-01 19:04:05"), ("2025-01-02T03:04:05-0500", "2025-01-02 08:04:05"),
    ("20250102", "2025-01-02 00:00:00"), ("2 Jan 2025", "2025-01-02 00:00:00"), ("02 Jan 2025", "2025-01-02 00:00:00"), ("2025/01/02", "2025-01-02 00:00:00"),
    ("1735786800", "2025-01-02 03:00:00"), ("1735786800000", "2025-01-02 03:00:00"), ("January 2, 2025", "2025-01-02 00:00:00"),
    ("", None), ("None", None), ("unknown", None), (None, None), ("2025-13-45", None), ("x" * 100_000, None),
]


def test_moments(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(STATED)], "i int, s string")
    found = [r.m for r in df.select("i", moment(F.col("s")).alias("m")).orderBy("i").collect()]
    assert found == [w and datetime.fromisoformat(w) for _, w in STATED]


NAMED, NONE = '[{"display_name":"a"}]', '[{"display_name":" "}]'
SCHEMA = "snapshot_id bigint, work_id string, raw_keywords string, keywords string, raw_updated_date string, source_file string, folder string"


@pytest.fixture
def trust(spark):
    return spark.createDataFrame([("data/a", 1, "x"), ("data/b", 2, "x")], "folder string, trust_rank int, moment string")


def test_precedence(spark, trust):
    rows = [
        (1, "W1", NONE, " ; ", "2026-01-01", "data/a/1.csv", "z"), (2, "paper:w1", NAMED, None, "2020-01-01", None, "z"),  # keywords before date
        (3, "W2", NAMED, None, "20250102", "data/a/x/1.csv", "z"), (4, "w2", NAMED, None, "2025-01-02T01:00:00+08:00", "data/a/1.csv", "z"),
        (5, "W3", None, "k", "2025-01-02", "data/b/1.csv", "z"), (6, " W3", None, "k", "2025-01-02", ".\\data\\a\\1.csv", "z"),
        (7, "W4", None, None, None, None, None), (8, "https://x/W4/", None, None, None, None, None),  # the lowest snapshot
        (9, "W5", NAMED, None, "2025-01-01", None, None), (10, None, NAMED, None, "2025-01-01", None, None), (11, "none", NAMED, None, None, None, None),
    ]
    found = elect(prepared(spark.createDataFrame(rows, SCHEMA), trust), {}).where("records >= 2")
    assert {(r.work_id, r.snapshot_id) for r in found.collect()} == {("W1", 2), ("W2", 3), ("W3", 6), ("W4", 7)}


def test_survivors_come_from_votes(spark, trust):
    rows = [(1, "W1", NAMED, None, "2026-01-01", "data/a/1.csv", "z"), (2, "W1", NAMED, None, "2020-01-01", "data/b/1.csv", "z")]
    rows = prepared(spark.createDataFrame(rows, SCHEMA), trust)
    assert elect(rows, {}).first().snapshot_id == 1
    assert elect(rows, {}, standing=(-F.year("moment")).cast("decimal(38,0)")).first().snapshot_id == 2  # other votes, other survivor


def _golden(spark, trust, rows):
    rows = prepared(spark.createDataFrame(rows, SCHEMA), trust)
    found = elect(rows, {"raw_keywords": json_form(F.col("raw_keywords")), "source_file": F.col("folder")})
    return {r.work_id: r for r in with_values(found, rows, ["raw_keywords", "source_file"]).collect()}


def test_votes_and_pivot(spark, trust):
    found = _golden(spark, trust, [
        (1, "W1", '["A"]', "k", "2025-01-01", "data/b/1.csv", "z"), (2, "W1", '[ "A" ]', "k", "2025-01-01", "data/b/2.csv", "z"),
        (3, "W1", '["B"]', "k", "2025-01-02", "data/b/3.csv", "z"), (4, "W2", None, None, None, None, None), (5, "W2", " ", None, None, None, None),
    ])
    assert (found["W1"].records, found["W1"].snapshot_id, found["W1"].raw_keywords) == (3, 3, '["A"]')  # two older votes outweigh one
    assert (found["W2"].records, found["W2"].snapshot_id, found["W2"].raw_keywords) == (2, 4, None)


def test_old_and_undated_votes_count(spark, trust):
    found = _golden(spark, trust, [
        (1, "W1", "a", "k", None, "data/a/1.csv", "z"), *((i, "W1", "b", "k", None, "data/a/1.csv", "z") for i in (2, 3, 4)),
        (5, "W2", "a", "k", "1990-01-01", "data/a/1.csv", "z"), *((i, "W2", "b", "k", "1989-06-01", "data/a/1.csv", "z") for i in (6, 7)),
        (8, "W3", "a", "k", "2025-01-01", "data/a/1.csv", "z"), (9, "W3", "b", "k", "2025-01-01", "data/a/1.csv", "z"), (10, "W3", "b", "k", None, "data/a/1.csv", "z"),
        *((i, "W4", "a", "k", None, "data/a/1.csv", "z") for i in (11, 12, 13)), (14, "W4", "b", "k", "1990-01-01", "data/b/1.csv", "z"),
    ])
    assert [found[w].raw_keywords for w in ("W1", "W2", "W3", "W4")] == ["b"] * 4


def test_repeated_records_stand_once(spark, trust):
    rows = [(1, "W1", NAMED, None, "2025-01-01", "data/b/1.csv", "z")] * 3 + [(2, "W1", NAMED, None, "2025-01-01", "data/a/1.csv", "z")]
    assert elect(prepared(spark.createDataFrame(rows, SCHEMA), trust), {}).first().asDict() == {"work_id": "W1", "records": 4, "snapshot_id": 2}


def test_empty(spark, trust):
    assert elect(prepared(spark.createDataFrame([], SCHEMA), trust.limit(0)), {"source_file": F.col("folder")}).count() == 0
