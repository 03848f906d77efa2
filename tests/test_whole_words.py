"""Words of every script, against brute force."""

import math
import re
import sys
import unicodedata
from collections import Counter

from tarnquill.operators.lexical import STOP
from tarnquill.plans import topic_queries as Q

TEXTS = [
    (1, "The réseau de chaleur, Straße. Énergie solaire", "paper"), (2, "能源站 энергия ветра。储能", "paper"), (3, "Solar power; solar power! x 能", "patent"),
    (4, "Энергия ветра", None), (5, None, "paper"), (6, "", "policy"), (7, "储能 2025 réseau", "policy"),
]
WORD = re.compile("[" + "".join(re.escape(chr(c)) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "LN") + "]+")
HAN = re.compile("[一-鿿]+")


def _terms(text):
    for sentence in re.split(r"[.!?;\n。！？；]+", text.lower()):
        words = [w for r in WORD.findall(sentence) for w in ([r[i : i + 2] for i in range(max(1, len(r) - 1))] if HAN.fullmatch(r) else [r])]
        words = [w for w in words if len(w) >= 2 and w not in STOP]
        yield from words
        yield from (f"{a} {b}" for a, b in zip(words, words[1:]))


def _folder(spark, tmp_path):
    spark.createDataFrame(TEXTS, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_counts_equal_brute_force(spark, tmp_path):
    d = _folder(spark, tmp_path)
    matrix = Counter((i, s, t) for i, text, s in TEXTS if text for t in _terms(text))
    assert {(r.doc_id, r.source, r.term): r.n for r in Q.QUERIES["bow_matrix"](spark, d).collect()} == matrix
    counts = Counter()
    for (_, s, t), n in matrix.items():
        counts[s, t] += n
    assert {(r.source, r.term): r.n for r in Q.QUERIES["bow_counts"](spark, d).collect()} == counts
    assert {("paper", "énergie solaire"), ("paper", "能源 源站"), (None, "энергия ветра"), ("policy", "储能")} <= set(counts)
    words, frequency = Counter(), Counter()
    for (s, t), n in counts.items():
        words[s] += n
        frequency[t] += n
    mean = math.floor(sum(words.values()) / len(words))
    weight = {(s, t): math.sqrt(n / words[s]) * math.log(1 + mean / frequency[t]) for (s, t), n in counts.items()}
    best = {}
    for s in words:
        order = sorted((t for c, t in weight if c == s), key=lambda t: (-round(weight[s, t], 9), t.encode()))
        best |= {(s, r): (t, round(weight[s, t], 6)) for r, t in enumerate(order[:20], 1)}
    assert {(r.source, r["rank"]): (r.term, r.weight) for r in Q.QUERIES["ctfidf_top_words"](spark, d).collect()} == best
