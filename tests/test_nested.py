import json

import pytest

from tarnquill.operators.nested import deep_json, emit_tagged, opened, flat_table, has_keyword, keyword_nodes, visit, write_tables
from tarnquill.operators.observations import parse_record, parsed_observations

LEAF = {"id": "k3", "display_name": " c ", "narrower": {"id": "", "display_name": "D É"}}
TREE = [
    {"id": "k1", "display_name": "a", "score": 0.5, "source": {"list": "author", "added": {"year": 2001, "by": None}}, "evidence": [{"field": "title", "spans": [[0, 5], [9, 14]]}, 7]},
    None, "text", 17, {"id": "k2", "display_name": " ", "narrower": [None, LEAF, "n/a"]}, {"display_name": "a"}, {}, {"id": 5, "display_name": "n"},
]
NODES = {("1", "", "k1", "a"), ("5.2", "5", "k3", "c"), ("5.2.1", "5.2", "label:d é", "D É"), ("6", "", "label:a", "a"), ("8", "", "5", "n")}


def _nodes(text):
    return {(path, parent, *payload[:2]) for _, path, parent, payload in visit(text, frozenset({"keyword"}))}


def test_wrappings():
    for wrapped in (TREE, {"keywords": TREE, "count": 3}, {"meta": {"v": 2}, "data": {"keywords": TREE}}, json.dumps(TREE), {"keywords": json.dumps(TREE)}):
        assert _nodes(json.dumps(wrapped)) == NODES
    assert _nodes(json.dumps(LEAF)) == {("1", "", "k3", "c"), ("1.1", "1", "label:d é", "D É")}


def test_no_rows():
    for text in (None, "", " ", "[", "[{]", '[{"display_name":"a"}]}', "[{}]", "{}", "null", '"x"', "7", "[NaN]", '{"keywords":null}', '[{"display_name":7}]', "[" * 100_000):
        assert _nodes(text) == set() and not has_keyword(text)


def test_depth():
    node = {"display_name": "x"}
    for _ in range(200):
        node = {"display_name": "x", "narrower": [node]}
    assert len(_nodes(json.dumps([node]))) == 201 and has_keyword(json.dumps([node]))


def test_any_depth():
    deep = '[{"display_name":"x","narrower":' * 4_000 + "null" + "}]" * 4_000
    assert len(_nodes(deep)) == 4_000
    far = '[{"narrower":' * 100_000 + '[{"display_name":"end"}]' + "}]" * 100_000
    rows = list(visit(far, frozenset({"keyword"})))
    assert [r[3][1] for r in rows] == ["end"] and rows[0][1].count(".") == 100_000 and has_keyword(far)
    assert not has_keyword(far[:-1]) and not has_keyword(far + "]") and opened("[" * 100_000 + "]" * 99_999) is None
    assert opened('[{"a":' + "1" * 5_000 + "}]") == [{"a": float("1" * 5_000) if len("1" * 5_000) < 309 else float("inf")}]


def test_parsers_agree():
    texts = [json.dumps(TREE), "[1, -0.5e3, true, null, \"a\\u00e9\\n\"]", " {} ", "[]", '{"a": {"b": [[], {}]}, "a": 2}']
    for text in texts:
        assert deep_json(text) == json.loads(text)
    for text in ("", "[1,]", "[1 2]", '{"a" 1}', '{"a":}', "{,}", "[01]", "[1]]", "nul", '{1:2}', '["a', "[NaN]", "[}", "{]", ",", '{"a":1,}', "١"):
        with pytest.raises(ValueError):
            deep_json(text)


def test_wrapper_beside_nothing():
    for text in ('{"keywords":null,"data":{"keywords":[{"display_name":"x"}]}}', '{"keywords":"","meta":{"tags":["a"]},"body":"{\\"keywords\\":[{\\"display_name\\":\\"x\\"}]}"}', '{"meta":[1,2],"data":{"list":[{"display_name":"x"}]}}'):
        assert [row[3][1] for row in visit(text, frozenset({"keyword"}))] == ["x"], text


def test_tables(spark, tmp_path):
    text = json.dumps(TREE)
    rows = [(1, text, "p"), (1, text, "p"), (2, None, "p"), (None, '[{"display_name":"\\ud800"}]', "p")]
    df = spark.createDataFrame(rows, "snapshot_id bigint, raw_keywords string, payload string")
    assert keyword_nodes(df).count() == 2 * len(NODES) + 1
    tagged = emit_tagged(df.limit(1))
    assert [tuple(r) for r in flat_table(tagged, "source").collect()] == [(1, "1", "1", "author", 2001, None)]
    assert [tuple(r) for r in flat_table(tagged, "span").orderBy("span_pos").collect()] == [(1, "1/e1/s1", "1/e1", 1, 0, 5), (1, "1/e1/s2", "1/e1", 2, 9, 14)]
    assert flat_table(tagged, "keyword").where("score = 0.5").count() == 1
    write_tables(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).where("tag = 'evidence'").count() == 2
    assert keyword_nodes(df.limit(0)).count() == 0


def test_parse_record(spark):
    raw = '[{"id":"k","display_name":"A","score":0.8},{"id":"u","display_name":"B"},{"id":"n","display_name":"C","score":7.5},{"display_name":"D"}]'
    assert parse_record(raw, "x") == {"k": ("A", 0.8), "u": ("B", 0.0), "n": ("C", 0.0), "label:d": ("D", 0.0)}
    assert parse_record("[broken", " Ä ;; b") == {"label:ä": ("Ä", 0.0), "label:b": ("b", 0.0)}
    assert parse_record('[{"id":"k","display_name":"A","score":0.1},{"id":"k","display_name":"B","score":true}]', None) == {"k": ("B", 1.0)}
    assert parse_record(None, None) == {}
    df = spark.createDataFrame([(1, raw, None), (2, None, None)], "snapshot_id bigint, raw_keywords string, keywords string")
    assert parsed_observations(df).count() == 4
