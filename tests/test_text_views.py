"""Encoder views, chunks behind titles, dashes, functions for SQL."""

from pyspark.sql import functions as F

from tarnquill.functions import text as X
from tarnquill.operators import lexical as L


def _view(spark, title, body, source, **how):
    df = spark.createDataFrame([(title, body, source)], "title string, body string, source string")
    return df.select(L.encoder_view(F.col("title"), F.col("body"), F.col("source"), **how).alias("v")).first().v


def test_encoder_view(spark):
    body = " ".join(f"b{i}" for i in range(100))
    assert tuple(_view(spark, "T", "x  y", "paper", budget=1)) == ("T\nx  y", False)
    assert tuple(_view(spark, "t1 t2 t3", "b0  b1", "patent", title_limit=2)) == ("t1 t2 b0 b1", False)
    view, cut = _view(spark, "t1 t2 t3", body, "policy", title_limit=2, budget=12)
    words = view.split()
    assert cut and words[:5] == ["t1", "t2", "b0", "b1", "b2"] and len(words) == 12 and words[-4:] == ["b96", "b97", "b98", "b99"] and words[5:8] == ["b49", "b50", "b51"]
    assert tuple(_view(spark, None, None, None)) == ("", False)


def _chunks(spark, title, body, source):
    df = spark.createDataFrame([(1, source, title, body)], "doc_id bigint, source string, title string, body string")
    return [tuple(r)[1:] for r in L.titled_chunks(df).orderBy("chunk").collect()]


def test_titled_chunks(spark):
    assert _chunks(spark, "a b", "c", "policy") == [(0, "a b c", 3, 3.0)]
    assert _chunks(spark, None, " ", "paper") == []
    found = _chunks(spark, " ".join(f"t{i}" for i in range(30)), " ".join(f"b{i}" for i in range(300)), "paper")
    assert all(text.split()[:24] == [f"t{i}" for i in range(24)] for _, text, _, _ in found)
    assert [w for _, text, _, _ in found for w in text.split()[24:]] == [f"t{i}" for i in range(24, 30)] + [f"b{i}" for i in range(300)]
    assert sum(n for _, _, n, _ in found) == 330 and found[0][2] == 125
    weights = [w for *_, w in _chunks(spark, "t", " ".join(["b"] * 9000), "policy")]
    assert abs(sum(weights) - 1) < 1e-9 and weights[0] > weights[-1]


def test_dashes_and_anchors(spark):
    pattern = X.any_dash("fuel[- ]cell")
    df = spark.createDataFrame([("fuel cell",), ("fuel\u2011cell",), ("fuel\u00a0cell",), ("fuelcell",)], "t string")
    assert [r[0] for r in df.select(F.col("t").rlike(pattern)).collect()] == [True, True, True, False]
    assert df.limit(1).select(X.anchor_words(F.lit("Wind and wind, Solar wind"), "(?i)(wind|solar)")).first()[0] == ["Wind", "wind", "Solar"]


def test_functions_for_sql(spark):
    X.register_functions(spark)
    row = spark.sql("""SELECT normal_name('Ａ–B  c') AS n, parse_keywords('[{"id":"k","display_name":"A","score":0.5}]', NULL) AS k, parse_keywords(NULL, 'x; y') AS f""").first()
    assert row.n == "a b c" and tuple(row.k[0]) == ("k", "A", 0.5) and len(row.f) == 2


def test_vocabulary_bounds(spark):
    rows = [(i, "solar power" if i % 2 else "wind power", "paper" if i < 8 else "other") for i in range(10)] + [(11, None, "paper")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r.term: (r.document_frequency, r.place) for r in L.sampled_vocabulary(df, least=4, most=3).collect()}
    assert found == {"power": (8, 1), "solar": (4, 2), "solar power": (4, 3)}
    assert L.sampled_vocabulary(df, {"paper": 5}, least=1).where("term = 'power'").first().document_frequency == 5
    assert L.fixed_counts(df, L.sampled_vocabulary(df, least=4, most=3)).where("doc_id = 9").count() == 3
