"""Spellings of one organisation among names typed by people.

Only distinct names are worked on. Their words are looked up in a symmetric-delete index (each word under itself and its
spellings with one letter left out), which finds all words one edit or swap apart without comparing all with all; a word
of few names that is mistyped from a more frequent one is read as that. Names whose readings are the same words in any
order are one form. Forms are compared only within the blocks of their rarest words that abbreviate no commoner word (a
place, mostly; further words if about as rare), split by first letters of two further words. There the words of two forms are aligned by optimal
assignment: equal words, words with two letters swapped, abbreviations and initials may match, at different worth. A form joins the fullest form that
accounts for all its words. Names of one word join by their letters: initials
of an organisation's words, the last word giving up to three letters, a spelled-out definition in brackets first.

Defined results: null and blank names name nothing; names without letters stand alone; names that differ in letter case
only are different spellings; ambiguous short forms go to the organisation that they account for best, then to the
more frequent one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tarnquill.functions.assignment import least_cost
from tarnquill.llm.lookalike import consistent_form
from tarnquill.session import cut_lineage

#: Words that name nothing.
STOP = frozenset("of for the and at in de la le les du des der die das von und y et e & del di".split())
#: Letters that are often typed without their accents.
ACCENTED = ("áàâäãåāéèêëēíìîïīóòôöõøōúùûüūýçñšž", "aaaaaaaeeeeeiiiiiooooooouuuuuycnsz")
SHORTEST_CORRECTED = 4
FEW_NAMES, CLEAR_RATIO = 3, 2
#: A form opens blocks by its rarest words: this many at most, the further ones at most so many times as common as the first.
MOST_KEYS, NEAR_RARE = 3, 10
LEAST_SHARE = 1 / 3  # of a form's words that a shorter form has to account for
_WORDS = re.compile(r"[^\W\d_]+|\d+")
_BRACKET = re.compile(r"\s*\(([^()\s]{2,10})\)\s*$")


def initials(words: list[str]) -> list[str]:
    """What the words may be shortened to: their initials, of the last up to three letters."""
    head = "".join(w[0] for w in words[:-1])
    return [head + words[-1][:k] for k in (1, 2, 3) if len(words[-1]) >= k] if len(words) > 1 else []


def parsed(name: str, form: str) -> tuple[list[str], str | None, list[str]]:
    """Significant words, the abbreviation defined in brackets if any, possible abbreviations."""
    low = form.lower()
    bracket, defined = _BRACKET.search(low), None
    words = [w for w in _WORDS.findall(low) if w not in STOP]
    if bracket:
        rest = [w for w in _WORDS.findall(low[: bracket.start()]) if w not in STOP]
        if bracket.group(1) in initials(rest):
            words, defined = rest, bracket.group(1)
    return words or [low], defined, initials(words)


def abbreviates(short: str, full: str) -> bool:
    """Whether the word is a beginning of the other, or three and more of its letters in order from the first."""
    if len(short) >= len(full) or short[0] != full[0]:
        return False
    if full.startswith(short):
        return True
    rest = iter(full)
    return len(short) >= 3 and all(c in rest for c in short)


def swapped(a: str, b: str) -> bool:
    """Whether two neighbouring letters change places between the words (centre, center)."""
    differ = [i for i, (x, y) in enumerate(zip(a, b)) if x != y] if len(a) == len(b) >= 4 else []
    return len(differ) == 2 and differ[1] == differ[0] + 1 and a[differ[0]] == b[differ[1]] and a[differ[1]] == b[differ[0]]


def _worth(short: str, full: str) -> float:
    if short == full:
        return 1.0
    if swapped(short, full):
        return 0.9
    return 0.8 if abbreviates(short, full) or abbreviates(full, short) else 0.0


def assigned(few: list[str], many: list[str]) -> float:
    """The greatest total worth of matching every word of ``few`` to its own word of ``many``; 0 if one finds none."""
    if len(few) > len(many):
        return 0.0
    worth = [[_worth(a, b) for b in many] for a in few]
    if any(max(row) <= 0.0 for row in worth):
        return 0.0
    chosen = [row[j] for row, j in zip(worth, least_cost([[1.0 - w for w in row] for row in worth]))]
    return sum(chosen) if min(chosen) > 0 else 0.0


def _parse(names: DataFrame) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [parsed(n, f) for n, f in zip(part["name"], part["form"])]
            yield part[["name", "n"]].assign(
                words=[r[0] for r in rows], defined=[r[1] for r in rows], shortened=[r[2] for r in rows]
            )

    return names.mapInPandas(run, "name string, n bigint, words array<string>, defined string, shortened array<string>")


def readings(vocabulary: DataFrame) -> DataFrame:
    """(word, reading) of words (word, n, names) that are a mistyped or accentless form of a more frequent word one edit
    away. A word that occurs in more than ``FEW_NAMES`` names, or in more than a hundredth as many as the other, is a word
    of its own; a replaced letter makes a typing error only of a word less than half as frequent, as two places that
    differ in one letter are not rare. Abbreviations of words two letters longer and more are not corrected, nor corrected
    to. Of several the nearest, then the most frequent counts."""
    words = shortened(vocabulary, 2).where("NOT shortened").drop("shortened")
    long = words.where(F.length("word") >= SHORTEST_CORRECTED).withColumn("plain", F.translate("word", *ACCENTED))
    without = F.expr("transform(sequence(1, length(plain)), i -> concat(left(plain, i - 1), substring(plain, i + 1)))")
    index = long.select("word", "plain", "n", "names", F.explode(F.array_distinct(F.array_append(without, F.col("plain")))).alias("key"))
    other = index.select(F.col("word").alias("reading"), F.col("plain").alias("like"), F.col("n").alias("m"), F.col("names").alias("in_names"), "key")
    near = index.join(other, "key").where(
        (F.col("word") != F.col("reading")) & (F.col("names") <= F.greatest(F.lit(FEW_NAMES), F.col("in_names") / 100))
        & ((F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("word") > F.col("reading"))))
    )
    edits = F.levenshtein("plain", "like")
    letters = lambda c: F.array_sort(F.split(c, ""))
    same_length = F.length("plain") == F.length("like")
    swapped = (edits == 2) & same_length & (letters("plain") == letters("like"))
    replaced = (edits == 1) & same_length
    typed = (replaced & (F.col("m") >= CLEAR_RATIO * F.col("n"))) | ((edits <= 1) & ~replaced) | swapped
    return near.where(typed).groupBy("word").agg(F.max_by("reading", F.struct((edits == 0).alias("accent"), "m", "reading")).alias("reading"))


def shortened(spread: DataFrame, letters_less: int = 1) -> DataFrame:
    """Adds whether a word (word, names) may abbreviate a word in twice as many names, so that it is no block of its own.

    The words are indexed by what they may be shortened to: their beginnings, and three or four of their letters in order
    from the first. Each short form keeps the greatest number of names only, so nothing is compared with anything else.
    """
    letter = lambda at: F.substring("word", at, F.lit(1))
    n = F.length("word")
    upto = lambda low, high, make: F.when(high >= low, F.transform(F.sequence(low, high), make)).otherwise(F.array())
    one = F.lit(1)
    beginnings = upto(one, n - letters_less, lambda k: F.left("word", k))
    three = F.flatten(upto(F.lit(2), n - 1, lambda i: upto(i + 1, n, lambda j: F.concat(letter(one), letter(i), letter(j)))))
    four = F.flatten(upto(F.lit(2), n - 2, lambda i: F.flatten(upto(i + 1, n - 1, lambda j: upto(j + 1, n, lambda k: F.concat(
        letter(one), letter(i), letter(j), letter(k)
    ))))))
    letters_only = spread.where(F.col("word").rlike(r"^\p{L}{2,40}$"))
    short = F.filter(F.array_distinct(F.concat(beginnings, three, four)), lambda w: F.length(w) <= n - letters_less)
    index = letters_only.select("names", F.explode(short).alias("short"))
    index = index.groupBy(F.col("short").alias("word")).agg(F.max("names").alias("longer"))
    found = F.coalesce(F.col("longer") >= 2 * F.col("names"), F.lit(False))
    return spread.join(index, "word", "left").select(*spread.columns, found.alias("shortened"))


def _candidates(forms: DataFrame) -> DataFrame:
    """(id, full, share, n, place) of all pairs of forms (words, id, keys, n) of one block where the one accounts for a third
    of the other's words. A form is in the blocks of its keys.

    A block is split by the first letters of two further words: all words of the shorter form have to find their like,
    which begins with the same letter, so the pair meets under the letters of the shorter form's two longest words.
    """
    forms = forms.select("words", "id", "n", F.explode("keys").alias("key"))
    at = F.array_position("words", F.col("key")).cast("int")
    rest = F.concat(F.slice("words", F.lit(1), at - 1), F.slice("words", at + 1, F.size("words")))
    rows = forms.select("key", "id", "words", "n", rest.alias("rest")).where("size(rest) > 0")
    total = F.aggregate("rest", F.lit(0), lambda s, w: s + F.length(w))
    rows = rows.withColumn("place", F.struct((-F.size("rest")).alias("a"), (-total).alias("b"), (-F.col("n")).alias("c"), F.col("words").alias("d")))
    first = lambda w: F.left(w, F.lit(1))
    longest = F.transform(F.slice(F.array_sort(F.transform("rest", lambda w: F.struct((-F.length(w)).alias("k"), w.alias("w")))), 1, 2), lambda x: first(x["w"]))
    asked = rows.select("key", F.col("id"), F.col("rest").alias("few"), F.col("place").alias("late"), F.array_join(F.array_sort(longest), "").alias("letters"))
    all_letters = F.array_sort(F.transform("rest", first))
    pairs = F.flatten(F.transform(all_letters, lambda x, i: F.transform(F.slice(all_letters, i + 2, F.size(all_letters)), lambda y: F.concat(x, y))))
    offered = rows.select(
        "key", F.col("id").alias("full"), F.col("rest").alias("many"), "n", "place", F.explode(F.array_distinct(F.concat(all_letters, pairs))).alias("letters")
    )
    met = asked.join(offered, ["key", "letters"]).where(
        (F.size("few") <= F.size("many")) & (3 * F.size("few") >= F.size("many")) & (F.col("place") < F.col("late"))
    ).select("id", "full", "few", "many", "n", "place")
    # under whatever word a pair meets, that word counts as matched, so the share is the same
    met = met.groupBy("id", "full").agg(F.min(F.struct("few", "many", "n", "place")).alias("m")).select("id", "full", "m.*")
    return met.withColumn("share", _shares("few", "many")).where(F.col("share") >= LEAST_SHARE - 1e-9).select("id", "full", "share", "n", "place")


@lru_cache(maxsize=200_000)
def _share(few: tuple[str, ...], many: tuple[str, ...]) -> float:
    return assigned(list(few), list(many)) / len(many)


@F.pandas_udf(DoubleType())
def _shares(few: pd.Series, many: pd.Series) -> pd.Series:
    return pd.Series([_share(tuple(a), tuple(b)) for a, b in zip(few, many)], dtype=float)


def homes(forms: DataFrame) -> DataFrame:
    """(id, home) of the forms that belong to a fuller one; the others are organisations of their own.

    Going from the fullest form down, a form that no organisation accounts for is one itself. That order needs no single
    task: a form is decided once all fuller candidates are, in as many rounds as candidates follow each other.
    """
    edges = cut_lineage(_candidates(forms))
    decided = edges.select(F.col("full").alias("at")).distinct().join(edges.select(F.col("id").alias("at")).distinct(), "at", "left_anti")
    decided = cut_lineage(decided.withColumn("core", F.lit(True)))
    waiting = edges.select("id", "full")
    while True:
        seen = waiting.join(decided.withColumnRenamed("at", "full"), "full", "left")
        told = seen.groupBy("id").agg(
            F.coalesce(F.bool_or("core"), F.lit(False)).alias("found"), F.count_if(F.col("core").isNull()).alias("open")
        )
        fresh = cut_lineage(told.where("found OR open = 0").select(F.col("id").alias("at"), (~F.col("found")).alias("core")))
        if not fresh.limit(1).count():
            break
        decided = decided.unionByName(fresh)
        waiting = waiting.join(fresh.select(F.col("at").alias("id")), "id", "left_anti")
    cores = edges.join(decided.where("core").select(F.col("at").alias("full")), "full", "left_semi")
    return cores.join(decided.where("NOT core").select(F.col("at").alias("id")), "id", "left_semi").groupBy("id").agg(
        F.min_by("full", F.struct(-F.col("share"), -F.col("n"), "place")).alias("home")
    )


def organisations(values: DataFrame) -> DataFrame:
    """(name, organisation) of every distinct value of ``values`` (name)."""
    names = values.where(F.trim("name") != "").groupBy("name").agg(F.count("*").alias("n"))
    # distinct names only; kept, as four branches read them
    read = cut_lineage(_parse(names.withColumn("form", consistent_form(F.col("name")))))
    # an abbreviation alone (one short word in capitals) has no words to align
    letters = (F.size("words") == 1) & F.col("name").rlike(r"^\p{Lu}{3,10}$")
    alone, read_words = read.where(letters), read.where(~letters)

    each = read_words.select("name", "n", F.posexplode("words").alias("pos", "word"))
    vocabulary = cut_lineage(each.groupBy("word").agg(F.sum("n").alias("n"), F.countDistinct("name").alias("names")))
    each = each.join(readings(vocabulary), "word", "left").select("name", "n", "pos", F.coalesce("reading", "word").alias("word"))
    each = cut_lineage(each)
    spread = shortened(each.groupBy("word").agg(F.count("*").alias("names")))
    ranked = F.array_sort(F.collect_set(F.struct("shortened", "names", (-F.length("word")).alias("k"), "word")))
    shaped = each.join(spread, "word").groupBy("name", "n").agg(F.array_sort(F.collect_list("word")).alias("words"), ranked.alias("ranked"))
    rarest = F.get("ranked", F.lit(0))
    keys = F.filter(F.slice("ranked", 1, MOST_KEYS), lambda w: (w["shortened"] == rarest["shortened"]) & (w["names"] <= NEAR_RARE * rarest["names"]))
    shaped = cut_lineage(shaped.select("name", "n", "words", F.array_join("words", " ").alias("id"), F.transform(keys, lambda w: w["word"]).alias("keys")))
    forms = shaped.groupBy("words", "id", "keys").agg(F.sum("n").alias("n"))
    found = homes(forms)
    full = shaped.join(found, "id", "left").select("name", F.coalesce("home", "id").alias("organisation"))

    hints = read.join(full, "name").select(
        "organisation", "n", F.explode(F.array_union(
            F.transform("shortened", lambda s: F.struct(s.alias("letters"), F.lit(False).alias("said"))),
            F.when(F.col("defined").isNotNull(), F.array(F.struct(F.col("defined").alias("letters"), F.lit(True).alias("said"))))
            .otherwise(F.array().cast("array<struct<letters:string,said:boolean>>")),
        )).alias("hint"),
    )
    hints = hints.groupBy("hint.letters", "organisation").agg(F.max("hint.said").alias("said"), F.sum("n").alias("n"))
    owners = hints.groupBy("letters").agg(F.max_by("organisation", F.struct("said", "n", "organisation")).alias("organisation"))
    short = alone.select("name", F.lower(F.element_at("words", 1)).alias("letters")).join(owners, "letters", "left")
    short = short.select("name", F.coalesce("organisation", F.concat(F.lit("\t"), "name")).alias("organisation"))
    return full.unionByName(short)


def variant_pairs(values: DataFrame, salts: int = 8) -> DataFrame:
    """(name_a, name_b) of all pairs of each organisation's spellings; spellings are spread over salts on one side."""
    found = cut_lineage(organisations(values))
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    left = found.select(F.col("name").alias("name_a"), "organisation", F.pmod(F.xxhash64("name"), F.lit(salts)).cast("int").alias("salt"))
    right = found.select(F.col("name").alias("name_b"), "organisation", spread)
    return left.join(right, ["organisation", "salt"]).where("name_a < name_b").select("name_a", "name_b")
