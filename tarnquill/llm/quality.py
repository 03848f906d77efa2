"""Per-document text statistics, and the kind of a text by rules learnt on them.

The statistics cover the whole text: words, characters by class, lines by shape (weighted by length, so that a heading or
a short list doesn't outweigh the prose around it), common words, repetition. They share one pass over Arrow batches:
built-in expressions would go over the text anew for each statistic (measured: 30 of them took ten times as long). An
ordered rule list is induced on a bounded sample of labelled documents by incremental reduced-error pruning: for each class, from
the rarest, a rule is grown test by test on two thirds of the rows by information gain, cut back on the last third while
that helps, kept while it is right more often than not, and its rows leave. The thresholds become one CASE expression.

Defined results: null, empty and blank texts have no row; without labels every text is prose;
documents with contradicting labels take the most frequent, ties none.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Frequent function words of six languages (Chinese: characters).
COMMON = (
    "the of and to in is that for it as was with be by on not this are or at from which has have been its an we can "
    "der die das und ist von mit den des ein eine zu im auf für nicht sich wird werden dem bei "
    "le la les des est et un une du dans pour sur par qui avec ne pas que ce sont au aux "
    "el los las del en que se con una por para es al como más su sin "
    "и в на с по не за от для что как из при это к был также"
).split()
COMMON_HAN = "的了是在和与对为不有以及可中等从被将"
MAX_LABELLED = 20_000
GROW_SHARE, HELD_SHARE = 2 / 3, 1 / 5
CLASSES = ("junk", "table", "list")

_BULLET = re.compile(r"\s*(?:[-*+•◦▪■□●○–—·»]\s|[（(]?(?:\d{1,3}|[a-zA-Zа-я]|[ivxIVX]{1,4})[.)）、]|\[\d+\]|[①-⑳])")
_LEADER = re.compile(r"(?:(?<!\.)\.{3,}+|…|\. \. \. )\s*+\d++\s*+$")
_CELL = re.compile(r"\t|\||;(?=\S)|&|,(?=[^\s,])|(?<! ) {2,}+(?=\S)")
_PAIR = re.compile(r"[^:=]{2,60}[:=]\s*[-+]?\d[\d.,]*\s?\S{0,5}$")
_ENDS = re.compile(r"[.!?…。！？][\"'»”)\]]*\s*$")
_NUMBER = re.compile(r"\d[\d.,:]*+")
_NUMERIC = re.compile(r"(?<!\S)[-+(\[]?\d[\d.,:/%-]*[^\d\s]{0,3}(?!\S)")
_HAN_SENTENCE = re.compile(f"[{COMMON_HAN}，。]")
_PIECES = re.compile(r"(?<=[.!?。！？])\s*|[\n\r]++|(?<!\s)\s++[|>;]\s++")
_STOPS = re.compile(r"[.!?](?=\s|$)|[。！？]")
_SEPARATORS = re.compile(r"[;|•·/>,](?=\s)|\t")
_DAMAGE = re.compile("[\u0080-\u009f\ufffd]|[ÂÃÐÑâãäåæçèéêï][\u0080-\u00bf]")
_LETTERS = re.compile(r"[^\W\d_]+")
_LINES = re.compile(r"\r\n|[\n\r\u2028]")


class _Kinds(dict):
    """For str.translate: one letter for the kind of each character."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if char.isspace():
            kind = "s"
        elif char in "aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýÿаеёиоуыэюя":
            kind = "v"
        elif 0x4E00 <= code <= 0x9FFF:
            kind = "H" if char in COMMON_HAN else "h"
        elif char.isalpha():
            kind = "c" if char.isascii() or "À" <= char <= "ÿ" or "Ѐ" <= char <= "ӿ" else "l"
        elif char.isdigit():
            kind = "d"
        elif char in "{}<>=\\@#$^&*_~+|/":
            kind = "x"
        else:
            kind = "m" if unicodedata.category(char)[0] == "M" else "p"
        self[code] = kind
        return kind


_KINDS, _COMMON_SET = _Kinds(), frozenset(COMMON)
_ASCII_KINDS = bytes(ord(_KINDS[i]) for i in range(128)) + bytes(128)
_KIND_LETTERS = "svHhcldxmp"
_ONLY_LETTERS = bytes(i if chr(i).isalpha() else 32 for i in range(128)) + b" " * 128
_COMMON_BYTES = frozenset(w.encode() for w in COMMON if w.isascii())


def _kind_counts(low: str) -> dict[str, int]:
    """How many characters there are of each kind; ASCII goes by a table of bytes."""
    if low.isascii():
        kinds = low.encode().translate(_ASCII_KINDS)
        return {k: kinds.count(ord(k)) for k in _KIND_LETTERS}
    kinds = low.translate(_KINDS)
    return {k: kinds.count(k) for k in _KIND_LETTERS}


def text_statistics(text: str) -> list[float]:
    """The statistics of one text, in the order of FEATURES."""
    low = text.lower()
    many = _kind_counts(low)
    ascii_ = text.isascii()
    chars = max(len(text), 1)
    lines = [x for x in _LINES.split(text) if not x.isspace() and x]
    tokens = text.split()
    pieces = [x for x in map(str.strip, _PIECES.split(text)) if x]
    words, n_lines, lengths = max(len(tokens), 1), max(len(lines), 1), [len(x) for x in tokens]
    han = many["h"] + many["H"]
    units = max(len(tokens) + han / 2, 1.0)
    if ascii_:
        common = sum(map(_COMMON_BYTES.__contains__, low.encode().translate(_ONLY_LETTERS).split()))
    else:
        common = sum(map(_COMMON_SET.__contains__, _LETTERS.findall(low)))
    shape = dict.fromkeys(("sentence", "bullet", "leader", "cell", "pair", "number"), 0)
    ended = 0
    for line in lines:
        size = len(line)
        if size >= 40 and any(m.group() in _COMMON_SET for m in _LETTERS.finditer(line.lower())) or (
            not ascii_ and size >= 12 and sum(1 for _ in islice(_HAN_SENTENCE.finditer(line), 2)) == 2
        ):
            shape["sentence"] += size
        if _BULLET.match(line):
            shape["bullet"] += size
        if _LEADER.search(line):
            shape["leader"] += size
        if sum(1 for _ in islice(_CELL.finditer(line), 2)) == 2 or "<td" in line:
            shape["cell"] += size
        if _PAIR.match(line):
            shape["pair"] += size
        if sum(1 for _ in islice(_NUMBER.finditer(line), 2)) == 2:
            shape["number"] += size
        ended += bool(_ENDS.search(line))
    whole = max(sum(map(len, lines)), 1)
    spelled = many["v"] + many["c"]
    return [
        len(tokens), len(lines), sum(lengths) / words, max(lengths, default=0), sum(n <= 2 for n in lengths) / words,
        len(tokens) / n_lines, len(text) / n_lines, (spelled + many["l"] + han) / chars, many["d"] / chars,
        (many["p"] + many["x"]) / chars, many["x"] / chars, many["s"] / chars, 0.0 if ascii_ else len(_DAMAGE.findall(text)) / chars,
        many["v"] / spelled if spelled else 0.4, han / chars, (common + many["H"] / 2) / units,
        shape["sentence"] / whole, shape["bullet"] / whole, shape["leader"] / whole, shape["cell"] / whole,
        shape["pair"] / whole, shape["number"] / whole, ended / n_lines, len(_STOPS.findall(text)) / units,
        len(_SEPARATORS.findall(text)) / units, len(_NUMERIC.findall(text)) / words,
        len(set(tokens)) / words, len(set(lines)) / n_lines, 1 - len(set(pieces)) / max(len(pieces), 1),
        len(text) / max(len(pieces), 1),
    ]


FEATURES = (
    "n_words n_lines mean_word_length longest_word short_word_share words_per_line chars_per_line letter_ratio digit_ratio "
    "symbol_ratio code_ratio blank_ratio damage_ratio vowel_ratio han_ratio common_share sentence_share bullet_share "
    "leader_share cell_share pair_share number_line_share ended_share sentence_ends separator_rate number_share "
    "distinct_word_share distinct_line_share repeated_share mean_piece_length"
).split()



def statistics(documents: DataFrame, *keep: str) -> DataFrame:
    """Statistics of the documents with text; the columns of ``keep`` stay. One Arrow pass, no shuffle."""
    import pyarrow as pa

    seen = documents.where(F.col("text").rlike(r"(?U)\S")).select(*keep, "text")
    fields = [*seen.schema.fields[:-1], *(StructField(f, DoubleType()) for f in FEATURES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = np.array([text_statistics(t) for t in part.column(part.num_columns - 1).to_pylist()], float)
            rows = rows.reshape(-1, len(FEATURES))
            kept = [part.column(i) for i in range(part.num_columns - 1)]
            found = [pa.array(rows[:, i]) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(kept + found, names=[f.name for f in fields])

    return seen.mapInArrow(run, StructType(fields))


Rule = list[tuple[int, bool, float]]  # feature, at most?, threshold


def _covered(x: np.ndarray, rule: Rule) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for feature, at_most, limit in rule:
        hit &= x[:, feature] <= limit if at_most else x[:, feature] > limit
    return hit


def _grow(x: np.ndarray, y: np.ndarray, longest: int = 6) -> Rule:
    """Tests added by information gain until only the class is covered."""
    rule: Rule = []
    rows = np.ones(len(x), bool)
    while len(rule) < longest:
        p0, n0 = int(y[rows].sum()), int((~y[rows]).sum())
        if not p0 or not n0:
            break
        base, best = math.log2(p0 / (p0 + n0)), (1e-9, None)
        xs, ys = x[rows], y[rows]
        for feature in range(x.shape[1]):
            order = np.argsort(xs[:, feature], kind="stable")
            values, hits = xs[order, feature], ys[order]
            ends = np.flatnonzero(values[1:] > values[:-1])
            if not len(ends):
                continue
            below = np.cumsum(hits)[ends]
            p = np.stack([below, p0 - below]).astype(float)
            size = np.stack([ends + 1, len(hits) - ends - 1]).astype(float)
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1e-12) / size) - base), -1)
            side, at = divmod(int(gain.argmax()), gain.shape[1])
            if gain[side, at] > best[0]:
                limit = float((values[ends[at]] + values[ends[at] + 1]) / 2)
                best = (float(gain[side, at]), (feature, side == 0, limit))
        if best[1] is None:
            break
        rule.append(best[1])
        rows &= _covered(x, rule[-1:])
    return rule


def _prune(rule: Rule, x: np.ndarray, y: np.ndarray) -> tuple[Rule, float]:
    """The shortest beginning of the rule with the greatest (p - n) / (p + n) on rows it wasn't grown on, and its precision."""
    best = (-2.0, rule, 0.0)
    for length in range(1, len(rule) + 1):
        hit = _covered(x, rule[:length])
        p, n = int((hit & y).sum()), int((hit & ~y).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[0] + 1e-9:
            best = (worth, rule[:length], (p + 1) / (p + n + 2))
    return best[1], best[2]


def _rule_list(x: np.ndarray, labels: np.ndarray, seed: int) -> list[tuple[str, Rule]]:
    rules: list[tuple[str, Rule]] = []
    left = np.ones(len(x), bool)
    random = np.random.default_rng(seed)
    for kind in sorted(CLASSES, key=lambda k: (int((labels == k).sum()), k)):
        failures = 0
        while failures < 10:
            rows = np.flatnonzero(left)
            y = labels[rows] == kind
            if y.sum() < 3:
                break
            grow = random.random(len(rows)) < GROW_SHARE
            rule = _grow(x[rows[grow]], y[grow])
            if not rule:
                break
            rule, precision = _prune(rule, x[rows[~grow]], y[~grow])
            hit = _covered(x[rows], rule)
            if precision < 0.6 or y[hit].mean() < 0.75 or y[hit].sum() < max(2, 0.001 * len(x)):
                failures += 1
                continue
            rules.append((kind, rule))
            left[rows[hit]] = False
    return rules


def classified(x: np.ndarray, rules: list[tuple[str, Rule]]) -> np.ndarray:
    """The kind of each row by the first rule that covers it."""
    out, free = np.full(len(x), "prose", object), np.ones(len(x), bool)
    for kind, rule in rules:
        hit = _covered(x, rule) & free
        out[hit] = kind
        free &= ~hit
    return out


def learn_rules(x: np.ndarray, labels: np.ndarray, tries: int = 6) -> list[tuple[str, Rule]]:
    """The ordered rule list; what no rule covers is prose. A fifth of the rows is held out from learning; of several
    divisions of the others into growing and pruning rows the list counts that is right most often on the rows held out,
    each test costing a tenth of a row; ties go to the list that is right more often on the others."""
    held = np.random.default_rng(2).random(len(x)) < HELD_SHARE
    lists = [_rule_list(x[~held], labels[~held], seed) for seed in range(tries)]
    right = lambda rules, rows: int((classified(x[rows], rules) == labels[rows]).sum())
    worth = lambda rules: (right(rules, held) - 0.1 * sum(len(r) for _, r in rules), right(rules, ~held))
    return max(lists, key=worth)


def case_expression(rules: list[tuple[str, Rule]]) -> Column:
    """The rule list as one CASE expression."""
    if not rules:
        return F.lit("prose")
    whens = []
    for kind, rule in rules:
        tests = " AND ".join(f"{FEATURES[f]} {'<=' if low else '>'} {limit!r}D" for f, low, limit in rule)
        whens.append(f"WHEN {tests} THEN '{kind}'")
    return F.expr(f"CASE {' '.join(whens)} ELSE 'prose' END")


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """At most ``most`` labelled documents with statistics, chosen by a hash of their number."""
    votes = labels.where("label is not null").groupBy("doc_id", "label").agg(F.count("*").alias("n"))
    votes = votes.groupBy("doc_id").agg(
        F.max_by("label", "n").alias("label"), F.max("n").alias("top"), F.sum("n").alias("all"), F.count("*").alias("kinds")
    ).where("kinds = 1 or 2 * top > all")
    chosen = votes.select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    joined = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return statistics(joined, "doc_id", "label")


def learnt_kind(documents: DataFrame, labels: DataFrame) -> tuple[Column, list[tuple[str, Rule]]]:
    sample = labelled_sample(documents, labels).toPandas().sort_values("doc_id")
    rules = learn_rules(sample[FEATURES].to_numpy(float), sample["label"].to_numpy(object)) if len(sample) else []
    return case_expression(rules), rules


def kinds(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and kind of every document with text; ``kind`` is prose, list, table or junk."""
    kind, _ = learnt_kind(documents, labels)
    return statistics(documents, "doc_id").withColumn("kind", kind)
