from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tarnquill.llm.term_counts import marked, term_frequencies


def _brute(rows):
    n, records = Counter(), defaultdict(set)
    for term, record in rows:
        if term is not None and term.strip():
            n[term] += 1
            records[term] |= {record} - {None}
    return {t: (n[t], len(records[t])) for t in n}


def test_counts_equal_brute_force_hot_or_not(spark):
    rows = [("hot", i % 9000) for i in range(20_000)] + [(f"t{i % 37}", i % 50) for i in range(5_000)]
    rows += [("hot", None), ("cold", None), (None, 1), ("", 2), ("  ", 3), (" hot", 5), ("neg", -1), ("neg", -1), ("neg", -5000)]
    df = spark.createDataFrame(rows, "t string, term bigint").repartition(7)  # a clashing name
    for support in (1 / 500, 1 / 5, 0.99):
        found = {r.term: (r.n_rows, r.n_records) for r in term_frequencies(df, F.col("t"), F.col("term"), support).collect()}
        assert found == _brute(rows)


def test_empty_and_marks(spark):
    empty = spark.createDataFrame([], "t string, r bigint")
    assert term_frequencies(empty, F.col("t"), F.col("r")).count() == 0
    rows = spark.createDataFrame([("a", 9), ("b", 10), ("c", 50), ("d", 51)], "term string, n_records bigint")
    assert [r.mark for r in marked(rows, F.lit(100)).orderBy("term").collect()] == ["rare", None, None, "common"]
