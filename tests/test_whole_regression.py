"""The regression of earlier relations goes over every paper."""

from tarnquill.plans import keyword_queries as Q

OBSERVATIONS = "row_id bigint, keyword_id string, score double"
ALIASES = "keyword_code string, source_keyword_ids string"
DICTIONARY = "keyword_code string, canonical_name string, decision string, topic_code string, conditional_anchor_topics string"
POPULATION = "row_id bigint, doc_id string, source string, title string, usable boolean, retracted boolean, template_record boolean"


def test_every_lost_relation_is_reported(spark, tmp_path):
    ids, rows = [f"k{i}" for i in range(12)], (1, 7, 10, 97, 970)
    tables = {
        "observations": ([(r, k, 1.0) for r in rows for k in ids], OBSERVATIONS),
        "keyword_aliases": ([(f"C{i}", k) for i, k in enumerate(ids)], ALIASES),
        "keyword_dictionary": ([(f"C{i}", k, "direct", f"KWD-T{i:02}", None) for i, k in enumerate(ids)], DICTIONARY),
        "population": ([(r, f"d{r}", "paper", "x", True, False, False) for r in rows], POPULATION),
    }
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    held = {(r.row_id, r.keyword_id) for r in Q.K.withheld(Q._Tables(spark, str(tmp_path)).obs).collect()}
    lost = {(r, f"KWD-T{i:02}") for i, k in enumerate(ids) for r in rows if (r, k) in held}
    assert {r for r, _ in lost} == {97, 970}
    found = {(r.row_id, r.topic_code): r.still_assigned for r in Q.QUERIES["kwd_regression"](spark, str(tmp_path)).collect()}
    assert found == {(r, f"KWD-T{i:02}"): (r, f"KWD-T{i:02}") not in lost for i in range(12) for r in rows}
