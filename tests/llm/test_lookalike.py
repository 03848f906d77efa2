import pytest

from tarnquill.llm.lookalike import Conflict, compile_mapping, consistent_form, lookalike_pairs, transducer


@pytest.mark.parametrize("text, form", [
    ("Ｗｉｄｅ　ｔｅｘｔ", "Wide text"), ("été", "été"), ("a​b­c", "abc"), ("no break here", "no break here"),
    ("сор", "cop"), ("Выход", "Выход"), ("ﬁlm", "film"), ("⽔", "水"), ("Low‑cost", "Low-cost"), ("  a  b ", "a b"), ("", ""), ("​", ""),
    ("a1l", "a1l"), ("Éte", "Éte"), ("ЕЛ", "ЕЛ"), ("e​́", "é"),
    ("αρ", "ap"), ("ӏong", "long"), ("ᴇnd", "End"), ("ı", "i"), ("Ꭰay", "Day"), ("𝐀𝒷", "Ab"), ("−1", "-1"), ("ⅷ", "viii"), ("ｶﾞ", "ガ"), ("ậ", "ậ"), ("각", "각"), ("ꓐox", "Box"),
    ("a \u200b b", "a b"), ("γλώσσα", "γλώσσα"),
])
def test_forms(text, form):
    assert transducer()(text) == form
    assert transducer()(form) == form


def test_keys_of_several_characters():
    keys = transducer().clusters
    assert keys["e\u0301"] == "é" and keys["カ\u3099"] == "ガ" and len(keys) > 500 and max(map(len, keys)) >= 3


def test_null():
    assert transducer()(None) is None


def test_visible_differences_stay():
    forms = {transducer()(t) for t in ("Resume", "resume", "résumé", "resumé", "resume.", "resume 1", "resume l")}
    assert len(forms) == 7


def test_conflicts_are_refused():
    with pytest.raises(Conflict):
        compile_mapping(iter([("a", "b"), ("a", "c")]))
    with pytest.raises(Conflict):
        compile_mapping(iter([("a", "b"), ("b", "c"), ("c", "d")]))


def test_long_text_is_linear():
    assert transducer()("Раѕѕ​іvе " * 50_000).count("Passive") == 50_000


def test_pairs(spark):
    rows = [
        ("t", "k1", "wind farm"), ("t", "k2", "wіnd farm"), ("t", "k3", "wind farm"), ("t", "k4", "wind farm"), ("t", "k5", "Wind farm"),
        ("u", "k6", "wіnd farm"), ("t", None, "wind fаrm"), ("t", "k7", None), ("t", "k8", "  "),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "field string, key string, text string, form string")
    found = sorted(map(tuple, lookalike_pairs(df, salts=3).collect()))
    assert found == [("t", "k1", "k2"), ("t", "k1", "k3"), ("t", "k2", "k3"), ("t", "k2", "k4"), ("t", "k3", "k4")]


def test_empty_table_and_column(spark):
    empty = spark.createDataFrame([], "field string, key string, text string")
    assert lookalike_pairs(empty).count() == 0
    assert empty.select(consistent_form(empty["text"])).count() == 0
