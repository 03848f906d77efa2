import numpy as np
import pytest

from tarnquill.llm.quality import FEATURES, case_expression, classified, kinds, learn_rules, statistics, text_statistics

PROSE = "The results show that the turbine works well in winter. We measured it every day and compared it with the plan."
LIST = "\n".join(f"- heat pump {i}" for i in range(20))
TABLE = "\n".join(f"A{i}\t{i * 3.5}\t{i * 7}\t{i}" for i in range(20))
JUNK = "\n".join("".join("}{=<>#@"[(i * j) % 7] for j in range(40)) for i in range(1, 9))


def _row(text):
    return dict(zip(FEATURES, text_statistics(text)))


def test_statistics():
    assert _row(LIST)["bullet_share"] == 1.0 and _row(TABLE)["cell_share"] == 1.0 and _row(JUNK)["code_ratio"] > 0.8
    assert _row(PROSE)["sentence_share"] == 1.0 and _row(PROSE)["common_share"] > 0.3
    assert _row("x\nx\nx")["distinct_line_share"] == pytest.approx(1 / 3)
    assert len(text_statistics("a")) == len(FEATURES) == len(text_statistics("·" * 300_000))


def test_rules_are_found_and_exported(spark):
    rng = np.random.default_rng(1)
    texts = [(PROSE + " It was found again. ") * int(rng.integers(1, 5)) for _ in range(120)] + [LIST[: int(rng.integers(60, 250))] for _ in range(40)]
    texts += [TABLE[: int(rng.integers(80, 300))] for _ in range(40)] + [JUNK[: int(rng.integers(80, 300))] for _ in range(40)]
    labels = np.array(["prose"] * 120 + ["list"] * 40 + ["table"] * 40 + ["junk"] * 40, object)
    noisy = labels.copy()
    noisy[::29] = "junk"
    x = np.array([text_statistics(t) for t in texts])
    rules = learn_rules(x, noisy)
    assert (classified(x, rules) == labels).mean() > 0.95
    df = spark.createDataFrame([(int(i), *map(float, r)) for i, r in enumerate(x)], "i bigint, " + ", ".join(f"{f} double" for f in FEATURES))
    native = [r.kind for r in df.withColumn("kind", case_expression(rules)).orderBy("i").collect()]
    assert native == list(classified(x, rules))


def test_documents(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n", "a"), (4, PROSE, "a"), (5, PROSE, "a"), (6, "word " * 50_000, "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    labels = spark.createDataFrame([], "doc_id bigint, label string")
    found = {r.doc_id: r.kind for r in kinds(df, labels).collect()}
    assert found == {4: "prose", 5: "prose", 6: "prose"}
    assert kinds(df.limit(0), labels).count() == 0
    labels = spark.createDataFrame([(4, None), (4, "list"), (4, "prose"), (99, "junk")], "doc_id bigint, label string")
    assert statistics(df, "doc_id").count() == 3 and kinds(df, labels).count() == 3
