from tarnquill.llm.variants import abbreviates, assigned, homes, initials, organisations, readings, shortened, swapped, variant_pairs


def test_abbreviations_and_initials():
    assert abbreviates("univ", "university") and abbreviates("natl", "national") and abbreviates("u", "university")
    assert not abbreviates("power", "power") and not abbreviates("lab", "national")
    assert "utib" in initials(["university", "tibipasa"])


def test_swaps():
    assert swapped("centre", "center") and not swapped("polar", "solar") and not swapped("centre", "centre") and not swapped("ab", "ba")


def test_assignment_is_optimal():
    # taken one after the other, 'res' would use up the only word that 'research' can match
    assert assigned(["res", "research"], ["research", "resources"]) > 1.7
    assert assigned(["a", "b", "c"], ["a"]) == 0.0
    assert assigned(["zzz"], ["university"]) == 0.0


NAMES = {
    1: ["University of Tibipasa", "university of tibipasa", "Tibipasa Univ.", "U. Tibipasa", "Tibipasa, University of", "Universiqy of Tibipasa", "University of Tibpasa", "University of Tibipasa (UTIB)", "UTIB"],
    2: ["Tibipasa Power Company Limited", "Tibipasa Power Co Ltd", "Tibipasa Power"],
    3: ["Ministry of Energy, Republic of Ragani", "Republic of Ragani, Ministry of Energy", "Min. of Energy, Rep. of Ragani", "Energy Ministry Ragani", "MERRAG"],
    4: ["National Laboratory of Grid Systems Hedahájo", "Nat. Laboratory Grid Systems, Hedahájo", "Laboratory of Grid Systems Hedahájo, National", "National Laboratory of Grid Systems Hedahajo"],
    5: ["National Laboratory of Solar Materials Hedahájo"],
    6: ['Batuzore "Old" Academy of Heat'], 7: ['Batuzore "New" Academy of Heat'],
}


#: Other organisations, which make the words for kinds of organisations common.
KINDS = ["University of {}", "{} Power Company Limited", "Ministry of Energy, Republic of {}", "National Laboratory of Grid Systems {}", "National Laboratory of Solar Materials {}", '{} "Old" Academy of Heat', '{} "New" Academy of Heat']
PLACES = ["Bokodulu", "Dazufeki", "Gopinare", "Hevolutu", "Kimaroso", "Nusagabe", "Pofetidu", "Rihozuma", "Tebulano", "Fagezimo", "Jitupare", "Lomavine", "Sebikoru", "Vutagepi", "Zadolume"]


def test_organisations(spark):
    truth = {n: k for k, names in NAMES.items() for n in names}
    truth |= {kind.format(place): (kind, place) for kind in KINDS for place in PLACES}
    rows = [(n, "x") for n in truth for _ in range(1 + any(n == names[0] for names in NAMES.values()) * 9)] + [(None, "x"), ("", "x"), ("  ", "x")]
    df = spark.createDataFrame(rows, "name string, organisation string")
    found = {tuple(r) for r in variant_pairs(df.repartition(3)).collect()}
    wanted = {(a, b) for a in truth for b in truth if a < b and truth[a] == truth[b]}
    assert found == wanted


def _pairs(spark, counted):
    df = spark.createDataFrame([(n,) for n, k in counted.items() for _ in range(k)], "name string")
    return {tuple(r) for r in variant_pairs(df).collect()}


def test_neighbours_of_like_frequency_stay_apart(spark):
    counted = {"University of Essex": 3, "University of Essen": 4, "Technical University of Marburg": 9, "Technical University of Warburg": 10}
    assert _pairs(spark, counted) == set()
    polar = {f"Institute of {k} Research {place}": 2 for k in ("Polar", "Solar") for place in PLACES} | {f"Solar Works {place}": 9 for place in PLACES}
    assert not any("Polar" in a and "Solar" in b for a, b in _pairs(spark, polar))


def test_readings(spark):
    rows = [("university", 900, 400), ("universyty", 9, 3), ("essex", 3, 1), ("essen", 4, 1), ("tibpasa", 6, 1), ("tibipasa", 7, 2), ("hedahajo", 1, 1), ("hedahájo", 5, 2), ("powr", 1, 1), ("power", 90, 40)]
    found = {r.word: r.reading for r in readings(spark.createDataFrame(rows, "word string, n bigint, names bigint")).collect()}
    assert found == {"universyty": "university", "tibpasa": "tibipasa", "hedahajo": "hedahájo", "powr": "power"}


def test_abbreviations_of_any_word(spark):
    # 400 kinds commoner than the one whose abbreviation is looked for
    rows = [(f"kind{chr(97 + i // 20)}{chr(97 + i % 20)}", 1000) for i in range(400)] + [("observatory", 8), ("obsv", 2), ("observ", 3), ("paris", 5), ("particles", 50)]
    found = {r.word for r in shortened(spark.createDataFrame(rows, "word string, names bigint")).where("shortened").collect()}
    assert {"obsv", "observ"} <= found and "paris" not in found and "observatory" not in found


def _brute(key, forms):
    """The grouping of one block form by form, from the fullest down."""
    rest = [list(w) for w, _ in forms]
    for words in rest:
        words.remove(key)
    order = sorted(range(len(forms)), key=lambda i: (-len(rest[i]), -sum(map(len, rest[i])), -forms[i][1], forms[i][0]))
    out, cores = {}, []
    for i in order:
        best, home = (0.0, 0), None
        for core in cores if rest[i] else ():
            share = assigned(rest[i], rest[core]) / len(rest[core])
            if share >= 1 / 3 - 1e-9 and (share, forms[core][1]) > best:
                best, home = (share, forms[core][1]), core
        if home is None:
            cores.append(i)
        else:
            out[i] = home
    return out


def test_rounds_equal_one_pass(spark):
    import random

    random.seed(5)
    words = ["university", "univ", "uni", "u", "technical", "tech", "t", "national", "natl", "nat", "laboratory", "lab", "of", "power", "pwr"]
    forms = sorted({tuple(sorted(["qq", *random.choices(words, k=random.randint(0, 5))])) for _ in range(150)})
    forms = [(list(w), random.randint(1, 9)) for w in forms]
    ids = {" ".join(w): i for i, (w, _) in enumerate(forms)}
    df = spark.createDataFrame([(["qq"], w, " ".join(w), n) for w, n in forms], "keys array<string>, words array<string>, id string, n bigint")
    assert {ids[r.id]: ids[r.home] for r in homes(df).collect()} == _brute("qq", forms)


def test_many_kinds_and_places(spark):
    """Thousands of kinds and places: recall of planted variants, other organisations of a place apart."""
    import random

    random.seed(3)
    sound = lambda k: "".join(random.choice("bdfgklmnprstvz") + random.choice("aeiou") for _ in range(k))
    kinds = [f"{sound(4)}ery of {sound(5)}ics" for _ in range(1_500)]
    places = [sound(5) for _ in range(1_500)]
    truth, rows = {}, []
    for i in range(3_000):
        kind, place = random.choice(kinds), random.choice(places)
        a, b = kind.split(" of ")
        full = f"{a} of {b} {place}"
        for k, name in enumerate((full, full.upper(), f"{place}, {a[:5]}. of {b[:6]}.", f"{a[:4]}. {b} {place}")):
            truth.setdefault(name, (kind, place))
            rows += [(name,)] * (4 if k == 0 else 1)
    found = {tuple(r) for r in variant_pairs(spark.createDataFrame(rows, "name string")).collect()}
    groups = {}
    for name, what in truth.items():
        groups.setdefault(what, []).append(name)
    wanted = {(a, b) for names in groups.values() for a in names for b in names if a < b}
    assert len(found & wanted) / len(wanted) >= 0.95 and len(found & wanted) / len(found) >= 0.95


def test_empty(spark):
    assert organisations(spark.createDataFrame([], "name string")).count() == 0
