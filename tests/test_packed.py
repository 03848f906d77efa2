from pyspark.sql import functions as F

from tarnquill.operators.packed import packed_fields, skeleton, split_packed

NAMES = [
    ("University of A", ["University of A"]), ("A, Institute of;B", ["A, Institute of", "B"]), ("A；B | C\nD\tE", ["A", "B", "C", "D", "E"]),
    ("A / B", ["A", "B"]), ("A Fuel/Heat Works", ["A Fuel/Heat Works"]), ('"A, B", "C; D"', ["A, B", "C; D"]), ('"A ""old"" B"', ['A "old" B']),
    ('["A","B \\"x\\" C","K\\u00fc"]', ["A", 'B "x" C', "Kü"]), ("['A', 'B, C']", ["A", "B, C"]), ("A\\; B; C", ["A; B", "C"]),
    ("A; ; B;", ["A", "B"]), ("A;A", ["A", "A"]), ("  A  ", ["A"]), ('A; "B; C"; D', ["A", "B; C", "D"]), ('"B; C"\tA', ["B; C", "A"]),
    ('A / "B; C / D"', ["A", "B; C / D"]), ('"A', ['"A']), ("[]", []), ("nan", []), ("None", []), (" ", []), ("", []), (";", []), (None, []), ('[""]', []),
    ("['A', \"B's\"]", ["A", "B's"]), ("A\\", ["A\\"]), ("[A, B]", ["A", "B"]), ('["A", null, "B"]', ["A", "B"]), ("[x] y", ["[x] y"]),
    ("AT|T Labs; CERN", ["AT|T Labs", "CERN"]), ("AT|T", ["AT", "T"]), ("A, Ltd; B|C Works", ["A, Ltd", "B|C Works"]), ("Alpha|Beta; Gamma", ["Alpha", "Beta", "Gamma"]),
    ('University, "Old" Campus; B', ['University, "Old" Campus', "B"]), ('"A", "B", C', ["A", "B", "C"]), ('Mill, Ltd; "B, C", D', ["Mill, Ltd", '"B, C", D']),
    ("Fuel/Heat / Gas", ["Fuel/Heat", "Gas"]), ("['K\\xfc']", ["Kü"]), ("A\r\nB", ["A", "B"]), ("Ａ　；B", ["Ａ", "B"]), ('["A;B","C"]', ["A;B", "C"]),
]


def _split(spark, rows, codes=False):
    df = spark.createDataFrame([(i, s, "x", 0) for i, (s, _) in enumerate(rows)], "id bigint, s string, value string, pos int")
    found = {}
    for r in split_packed(df, F.col("id"), F.col("s"), codes).orderBy("record_key", "pos").collect():
        found.setdefault(int(r.record_key), []).append((r.pos, r.value))
    return [[v for _, v in found.get(i, [])] for i in range(len(rows))], found


def test_names(spark):
    values, found = _split(spark, NAMES)
    assert values == [want for _, want in NAMES]
    assert all([p for p, _ in x] == list(range(1, len(x) + 1)) for x in found.values())


def test_codes(spark):
    rows = [("T1 | T2", ["T1", "T2"]), ("T1,T2，T3、T4", ["T1", "T2", "T3", "T4"]), ('T1  "T2" T3', ["T1", "T2", "T3"]), ("T1 / T2", ["T1", "T2"]), ('["T1","T2"]', ["T1", "T2"]), ("T1\r\nT2", ["T1", "T2"]), ('"T1","T2"', ["T1", "T2"])]
    assert _split(spark, rows, codes=True)[0] == [want for _, want in rows]


def test_round_trip_of_quoted_values(spark):
    names = ["A; B", "C, D", 'E "f" G', "H | I", "J / K", "L\\M", "N"]
    for by in (";", " | ", "\n", "\t", " / ", ", "):
        packed = by.join('"' + n.replace("\\", "\\\\").replace('"', '""') + '"' for n in names)
        assert _split(spark, [(packed, names)])[0] == [names], by


def test_long_texts(spark):
    rows = [("a;" * 100_000, ["a"] * 100_000), ('"' + "b;" * 50_000 + '"', ["b;" * 49_999 + "b;"]), ("x" * 200_000, ["x" * 200_000])]
    assert [len(v) for v in _split(spark, rows)[0]] == [100_000, 1, 1]


def test_skeletons_are_few(spark):
    rows = spark.createDataFrame([("; ".join(f"name {i} {j}" for j in range(1 + i % 9)),) for i in range(200)], "s string")
    assert rows.select(skeleton(F.col("s"))).distinct().count() <= 3


def test_skeleton_keeps_order(spark):
    rows = spark.createDataFrame([("A, Ltd; B",), ("A; B, Ltd",), ("\"A; B\" | C",), ("AT|T; C",)], "s string")
    assert [r[0] for r in rows.select(skeleton(F.col("s"))).collect()] == ["w, w; w", "w; w, w", "\ufdd0 | w", "w\ufdd2w; w"]


def test_stand_ins_of_each_field(spark):
    meta = spark.createDataFrame([(1, "Na"), (2, "unknown")], "meta_id bigint, institutions string")
    dictionary = spark.createDataFrame([("K", "nil")], "keyword_code string, conditional_anchor_topics string")
    aliases = spark.createDataFrame([("K", "Na"), ("L", "unknown"), ("M", "nan")], "keyword_code string, raw_names string")
    assert {(r.record_key, r.value) for r in packed_fields(meta, dictionary, aliases).collect()} == {("K", "Na"), ("L", "unknown")}


def test_empty_tables(spark):
    meta = spark.createDataFrame([], "meta_id bigint, institutions string")
    dictionary = spark.createDataFrame([], "keyword_code string, conditional_anchor_topics string")
    aliases = spark.createDataFrame([("K", None)], "keyword_code string, raw_names string")
    assert packed_fields(meta, dictionary, aliases).count() == 0
