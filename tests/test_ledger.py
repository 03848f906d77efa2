import hashlib
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnquill.config import frozen_sources, inventory_problems, stage_report, write_json
from tarnquill.functions.text import cleaned, iso_date, masked_mean, normalised
from tarnquill.operators import factors as N
from tarnquill.operators import ledger as G
from tarnquill.sources import docx_paragraphs, register_views


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_review_violations(spark):
    documents = spark.createDataFrame([(i, f"title {i}", "the body") for i in range(8)], "doc_id bigint, title string, body string")
    good = lambda i: (i, "include", ["B01"], "body", "body", _sha(f"title {i}"), _sha("the body"))
    rows = [
        good(0), good(1), good(1), (2, "maybe", [], "body", "body", *good(2)[5:]), (3, "include", [], "body", "body", *good(3)[5:]),
        (4, "outside_scope", ["B01"], "body", "body", *good(4)[5:]), (5, "include", ["B01"], "title", "body", *good(5)[5:]),
        (6, "include", ["B01"], "body", "body", _sha("other"), _sha("the body")), good(99),
    ]
    reviews = spark.createDataFrame(rows, "doc_id bigint, decision string, topic_ids array<string>, quote_field string, quote string, title_sha string, body_sha string")
    assert {tuple(r) for r in G.review_violations(reviews, documents).collect()} == {
        ("repeated", "1"), ("decision_not_listed", "2"), ("include_without_topics", "3"), ("topics_without_include", "4"),
        ("quote_not_in_field", "5"), ("text_changed", "6"), ("missing", "7"), ("unknown_document", "99"),
    }


def test_terms_and_corrections(spark):
    samples = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "term string, sample_id int")
    outcomes = spark.createDataFrame([(1, "supports"), (2, "contradicts"), (3, "contradicts")], "sample_id int, outcome string")
    proposals = spark.createDataFrame([("a", "active", False), ("b", "active", False), ("c", "active", False), ("d", "active", True)], "term string, decision string, remapped boolean")
    found = {r.term: r.reason for r in G.resolve_terms(samples, outcomes, proposals).collect()}
    assert found == {"a": "", "b": "no support", "c": "unread samples", "d": ""}
    ledger = spark.createDataFrame([("k", 1, "x", None), ("k", 2, "y", _sha("k\x1f1\x1fx")), ("k", 3, "z", "wrong")], "key string, seq int, decision string, cites string")
    rows = G.superseded(ledger).orderBy("seq").collect()
    assert [r.latest for r in rows] == [False, False, True] and [r.cites_replaced for r in rows] == [True, True, False]
    obs = spark.createDataFrame([(1, "k")], "row_id bigint, keyword_id string")
    overrides = spark.createDataFrame([(1, "k", "needs_context"), (1, "k", "needs_context"), (2, "k", "drop")], "row_id bigint, keyword_id string, action string")
    assert sorted(tuple(r) for r in G.override_violations(overrides, obs).collect()) == [("never_observed", "2/k"), ("repeated", "1/k"), ("unknown_action", "2/k")]
    assert G.disjoint(samples, samples.where("sample_id > 2"), "sample_id") == 2


def test_text_functions(spark):
    rows = [("Ｓolar–Ｃell  Straße",), ("Fuel-Cell \t Stack",), (None,), ("",)]
    df = spark.createDataFrame(rows, "t string")
    assert [r.t for r in df.select(normalised(F.col("t")).alias("t")).collect()] == ["solar cell strasse", "fuel cell stack", None, ""]
    assert [r.t for r in df.select(cleaned(F.col("t")).alias("t")).collect()] == ["Solar–Cell Straße", "Fuel-Cell Stack", None, ""]
    dates = spark.createDataFrame([("20250102",), ("2025-01-02T03:04",), (None,)], "d string").select(iso_date(F.col("d")).alias("d"))
    assert [r.d for r in dates.collect()] == ["2025-01-02", "2025-01-02", None]
    pool = spark.createDataFrame([([[3.0, 0.0], [0.0, 3.0], [9.0, 9.0]], [1, 1, 0]), ([[1.0, 1.0]], [0])], "x array<array<double>>, m array<int>")
    out = [r.v for r in pool.select(masked_mean(F.col("x"), F.col("m")).alias("v")).collect()]
    assert out[0] == pytest.approx([2**-0.5, 2**-0.5]) and out[1] == [0.0, 0.0]


def test_files(spark, tmp_path):
    path = tmp_path / "a.txt"
    path.write_text("x")
    stated = {str(path): {"size": 1, "mtime_ns": path.stat().st_mtime_ns}}
    assert frozen_sources(stated) == [] and frozen_sources({str(path): {"size": 2, "mtime_ns": 0}}) == [str(path)]
    assert inventory_problems(tmp_path, {"a.txt": _sha("x")}) == {}
    assert inventory_problems(tmp_path, {"a.txt": _sha("y"), "../b": "", "c": ""}) == {"a.txt": "changed", "../b": "unsafe", "c": "missing"}
    write_json(tmp_path / "fit_COMPLETE.json", {"rows": 3})
    assert stage_report(tmp_path) == {"fit": {"rows": 3}}
    space = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{space}"><w:p><w:t>One </w:t><w:t>two</w:t></w:p><w:p/><w:p><w:t>three</w:t></w:p></w:document>')
    (tmp_path / "bad.docx").write_text("no zip")
    assert [(r.pos, r.paragraph) for r in docx_paragraphs(spark, str(tmp_path)).orderBy("pos").collect()] == [(1, "One two"), (2, "three")]
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    register_views(spark, str(tmp_path), ["t"])
    assert spark.sql("SELECT count(*) AS n FROM t").first().n == 3


def test_models(spark, tmp_path):
    h = np.array([[0.0, 1.5], [2.0, 0.0]])
    N.save_model(spark, h, str(tmp_path / "h"))
    assert (N.load_model(spark, str(tmp_path / "h"), (2, 2)) == h).all()
    rows = spark.createDataFrame([(i, [0, 1, 2], [1.0 + i % 2, 0.5, 2.0 * (i % 3)]) for i in range(12)], "row_id bigint, cols array<int>, vals array<double>")
    grid = N.fit_grid(rows, 3, [1, 2], [17, 29], epochs=2, steps=10)
    assert len(grid) == 4 and grid[0]["cosine_to_first"] == pytest.approx(1.0)
