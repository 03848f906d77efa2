import json
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tarnquill.config import RuntimePaths, indices, signature, stage_done, write_json
from tarnquill.functions.expressions import cascade, quarter
from tarnquill.operators import lexical as L
from tarnquill.operators import multilabel as M
from tarnquill.operators import selection as S
from tarnquill.operators import titles as T
from tarnquill.operators.integrity import ContractError, fingerprint
from tarnquill.sources import cell_safe, read_csv_strings, typed_csv, write_parts
from tarnquill.streaming.incremental import keyword_counts_available_now, merged_counts


def _population(spark, rows):
    return spark.createDataFrame(
        [(i, f"d{i}", s, t, True, False, False) for i, (s, t) in enumerate(rows)],
        "row_id bigint, doc_id string, source string, title string, usable boolean, retracted boolean, template_record boolean",
    )


def _edges(spark, shares, rejected=()):
    population = _population(spark, [("paper", "Solar power"), ("paper", "x"), ("patent", None)])
    ledger = spark.createDataFrame([(1, "keep_core"), (2, "keep_supporting"), (3, "review"), (4, "exclude")], "topic_id int, state string")
    shares = spark.createDataFrame([(r, t, 1.0, p) for r, t, p in shares], "row_id bigint, topic_id int, mass double, p double")
    refused = spark.createDataFrame(list(rejected), "row_id bigint, topic_id int")
    return population, shares, M.qualified_edges(shares, population, ledger, refused, F.col("title").rlike("(?i)solar"))


def test_scope_filter_never_normalises(spark):
    population, shares, edges = _edges(spark, [(0, 4, 0.6), (0, 1, 0.25), (0, 2, 0.15), (1, 2, 0.5), (2, 3, 0.9), (2, 1, 0.09)])
    scoped = {(r.row_id, r.topic_id): (r.stage, r.p) for r in M.scoped_edges(edges).collect()}
    assert scoped[0, 1] == ("retained", 0.25) and scoped[0, 2] == ("retained", 0.15) and scoped[0, 4][0] == "excluded"
    assert scoped[1, 2][0] == "pending" and (2, 1) not in scoped  # supporting without context; below the threshold
    status = {r.row_id: r.status for r in M.scope_status(population, shares, M.scoped_edges(edges)).collect()}
    assert status == {0: "assigned", 1: "scope_review_pending", 2: "scope_review_pending"}


def test_rejection_and_thresholds(spark):
    population, shares, edges = _edges(spark, [(0, 1, 0.5), (1, 1, 0.2)], [(0, 1)])
    status = {r.row_id: r.status for r in M.scope_status(population, shares, M.scoped_edges(edges)).collect()}
    assert status == {0: "relation_review_rejected", 1: "assigned", 2: "no_features"}
    for bad in (0.0, -1.0, 1.5):
        with pytest.raises(ValueError):
            M.checked_threshold(bad)


def test_threshold_is_inclusive_and_uncapped(spark):
    shares = spark.createDataFrame([(1, t, 1.0, 0.125) for t in range(8)], "row_id bigint, topic_id int, mass double, p double")
    row = M.label_lists(shares, 0.125).first()
    assert row.topic_count == 8 and row.topic_ids == list(range(8))
    assert M.label_lists(shares, 0.126).count() == 0  # nothing is forced


def test_hard_assignment(spark):
    rows = [(1, 0, 0.1, 0.1), (1, 1, 0.9, 0.9), (2, 0, 0.0, 0.0), (2, 1, 0.0, 0.0), (3, 0, 0.5, 0.5), (3, 1, 0.5, 0.5)]
    found = M.hard_assignment(spark.createDataFrame(rows, "row_id bigint, topic_id int, mass double, p double"))
    assert {r.row_id: r.topic_id for r in found.collect()} == {1: 1, 2: -1, 3: 0}


#: Published metrics of five candidates, after requested_k in the order of DIRECTIONS.
CANDIDATES = [
    (400, -0.07107292115688324, -0.050431083887815475, 5.1041303802405045, 0.956156849861145, 0.0, 0.1621178334039124),
    (450, -0.07632716000080109, -0.054190635681152344, 4.941442042390339, 0.9553395509719849, 0.0, 0.15101520037036684),
    (500, -0.08662784844636917, -0.05706404149532318, 4.835183823096179, 0.9552890658378601, 0.0, 0.1503985197941117),
    (550, -0.09653808921575546, -0.05896146968007088, 4.716085515818754, 0.9547536373138428, 0.0, 0.14431658544155232),
    (600, -0.09576450288295746, -0.06137102097272873, 4.585985174268176, 0.9550294876098633, 0.0, 0.14061234915204343),
]


def _candidates(spark, rows):
    return spark.createDataFrame([(k, *map(float, m)) for k, *m in rows], "requested_k int, " + ", ".join(f"{n} double" for n in S.DIRECTIONS))


def test_selection(spark):
    metrics = _candidates(spark, CANDIDATES)
    found = {r.requested_k: r for r in S.scored_candidates(metrics).collect()}
    assert {k: round(r.selection_score, 4) for k, r in found.items()} == {450: 1.9833, 500: 2.0, 550: 2.3167}
    chosen = lambda **how: S.scored_candidates(metrics, **how).where("selected").first().requested_k
    assert (chosen(), chosen(tolerance=0.0)) == (500, 450)
    assert chosen(directions={n: d for n, d in S.DIRECTIONS.items() if n != "davies_bouldin"}) == 450
    inside = CANDIDATES[1]
    for bad in ([(450, float("nan"), *inside[2:])], [(450, float("inf"), *inside[2:])], [CANDIDATES[0]], [inside] * 2, []):
        with pytest.raises(ContractError):
            S.validate_candidates(_candidates(spark, bad))


@pytest.mark.parametrize("topic, title, hit", [
    ("B04", "A WIND farm", True), ("B04", "Window of a wind farm", False), ("B04", "电池风力机组", True), ("B11", "Policy plan for X after 2021", True),
    ("B11", "Policy plan for X", False), ("B12", "steam turbine", True), ("B12", "wind turbine", False), ("B03", "Солнечная батарея", True),
])
def test_title_rules(spark, topic, title, hit):
    df = _population(spark, [("paper", title), ("paper", None)]).withColumns({"date": F.lit("2025-01-01").cast("date"), "eligible": F.lit(True), "category_id": F.lit("")})
    assert (topic in {r.topic_id for r in T.memberships(df).collect()}) is hit


def test_trends(spark):
    quarters = [f"{y}Q{q}" for y, qs in ((2024, (3, 4)), (2025, (1, 2, 3, 4)), (2026, (1, 2))) for q in qs]
    rows = []
    for topic, counts in {"up": [10] * 4 + [20] * 4, "down": [20] * 4 + [10] * 4, "few": [1] * 8, "flat": [20] * 8}.items():
        rows += [(topic, q, n, 100, n / 100) for q, n in zip(quarters, counts)]
    shares = spark.createDataFrame(rows, "topic_id string, period string, papers bigint, denominator_papers bigint, share double")
    breadth = spark.createDataFrame([("up", "recent", 9), ("up", "previous", 3)], "topic_id string, window string, institutions bigint")
    found = {r.topic_id: r.tier for r in T.trends(shares, breadth).collect()}
    assert found == {"up": "priority", "down": "decline", "few": "observe", "flat": "flat"}
    assert {r.tier for r in T.trends(shares.withColumn("denominator_papers", F.lit(0)), breadth).where("topic_id = 'up'").collect()} == {None}


def test_tokens(spark):
    df = spark.createDataFrame([("The wind-farm, of Solar. Power 能源站",), ("",)], "text string")
    found = df.select(L.terms(F.col("text")).alias("t")).collect()
    assert found[0].t == ["wind", "farm", "solar", "wind farm", "farm solar", "power", "能源", "源站", "power 能源", "能源 源站"] and found[1].t == []


def test_class_tfidf_in_batches_equals_at_once(spark):
    rows = [(g, f"t{i % 5}", i + 1) for i, g in enumerate("aabbccaabb")]
    counts = spark.createDataFrame(rows, "g string, term string, n bigint")
    once = counts.groupBy("g", "term").agg(F.sum("n").alias("n"))
    halves = counts.limit(5).groupBy("g", "term").agg(F.sum("n").alias("n")).unionByName(counts.exceptAll(counts.limit(5))).groupBy("g", "term").agg(F.sum("n").alias("n"))
    get = lambda c: {(r.g, r.term): round(r.weight, 12) for r in L.class_tfidf(c, "g").collect()}
    assert get(once) == get(halves)


def test_views_chunks_and_pooling(spark):
    df = spark.createDataFrame([(1, "x" * 5000, "paper"), (2, "w " * 300, "policy"), (3, None, "paper"), (4, " ", "paper")], "doc_id bigint, text string, source string")
    assert [r.n for r in df.select(F.length(L.head_middle_tail(F.col("text"))).alias("n")).limit(2).collect()] == [4002, 600]
    found = L.chunks(df).where("doc_id = 2").orderBy("chunk").collect()
    assert [r.n_tokens for r in found] == [125, 125, 50] and math.isclose(sum(r.weight for r in found), 1.0)
    vectors = spark.createDataFrame([(1, 3.0, [1.0, 0.0]), (1, 4.0, [0.0, 1.0])], "doc_id bigint, weight double, embedding array<double>")
    assert [round(x, 9) for x in L.pooled(vectors).first().embedding] == [0.6, 0.8]


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"two\nlines, ""quoted"""\n', encoding="utf-8")
    row = read_csv_strings(spark, str(tmp_path / "a.csv"), ["id", "t", "missing"]).first()
    assert (row.id, row.t, row.missing) == ("1", 'two\nlines, "quoted"', None) and row.source_file.endswith("a.csv")
    df = spark.range(100).withColumn("a", F.array(F.lit(1)))
    write_parts(df, str(tmp_path / "p"), "id", 4)
    assert len(list(Path(tmp_path / "p").glob("*.parquet"))) == 4
    assert typed_csv(df).schema["a"].dataType.simpleString() == "string"
    cells = spark.createDataFrame([("=1+1",), ("a\x07b",), ("ok",), (None,)], "c string").select(cell_safe(F.col("c")).alias("c")).collect()
    assert [r.c for r in cells] == ["'=1+1", "ab", "ok", None]
    assert fingerprint(df).first() == fingerprint(df.repartition(3).orderBy(F.desc("id"))).first()


def test_expressions(spark):
    row = spark.sql("select date'2025-08-01' d, 'wind farm' t").select(quarter(F.col("d")).alias("q"), cascade(F.col("t"), [("a", "farm"), ("b", "wind")], "c").alias("r")).first()
    assert (row.q, row.r) == ("2025Q3", "a")


def test_incremental_counts(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "state"))
    make = lambda ids: spark.createDataFrame([(i,) for i in ids], "keyword_id string")
    make(["a", "a", "b", " "]).write.parquet(source)
    keyword_counts_available_now(spark, source, out, progress).awaitTermination()
    make(["b", "c"]).write.mode("append").parquet(source)
    for _ in range(2):  # the second run finds nothing new
        keyword_counts_available_now(spark, source, out, progress).awaitTermination()
    assert {r.keyword_id: r.n_rows for r in merged_counts(spark, out).collect()} == {"a": 2, "b": 2, "c": 1}


def test_config(tmp_path):
    paths = RuntimePaths({"root": str(tmp_path), "data": "{root}/data", "a": "{b}", "b": "{a}"}, environment={"TARNQUILL_DATA": "{root}/other"})
    assert paths["data"] == f"{tmp_path}/other" and paths.require("root", "folder") == tmp_path
    with pytest.raises(ValueError):
        paths["a"]
    with pytest.raises(FileNotFoundError):
        paths.require("data", "file")
    assert indices("1-3,7") == [1, 2, 3, 7]
    for bad in ("3-1", "1,1"):
        with pytest.raises(ValueError):
            indices(bad)
    write_json(tmp_path / "m.json", {"signature": signature("a", 1)})
    assert stage_done(tmp_path / "m.json", signature("a", 1)) and not stage_done(tmp_path / "m.json", signature("a", 2))
    with pytest.raises(ValueError):
        write_json(tmp_path / "n.json", {"x": float("nan")})
    assert json.loads((tmp_path / "m.json").read_text()) and not (tmp_path / "n.json").exists()
