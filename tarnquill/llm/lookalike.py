"""Visually identical text in one consistent form.

A mapping is compiled once, by rules over the Unicode character data and lists of look-alike letters: widths, fonts,
presentation forms and radicals by their decompositions, white space to one blank, invisible characters to nothing,
look-alike letters and signs to one of them, and letters with their accents, in whatever notation, to one letter. Keys
have one character or several (a letter with its marks). Compilation fails on a conflict: a key with two results, or a
result that the mapping would change again. The transducer goes over a text once, word by word: characters are mapped, and
over each grapheme cluster (a character with its marks) the longest key is taken; words once seen are kept. Letter case,
accents, digits and punctuation stay different.

A word that keeps a letter of another alphabet is written wholly in it (its Latin look-alikes become, say, Cyrillic); a
word of look-alikes only is written in Latin. The form of a text depends on its look alone and is its own form.

Defined results: null stays null; blank text becomes empty; joiners between letters of scripts that need them stay.
Records without a key or text are in no pair; several records of one text are in no pair with each other.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tarnquill.session import cut_lineage

#: Letters of other alphabets, and the Latin letters they look like, in the same order.
CYRILLIC = ("АВЕЅІЈКМНОРСТУХԜԚҮӀЅѴԌаеѕіјһоԛрсԁԝхуѵүӏ", "ABESIJKMHOPCTYXWQYlSVGaesijhoqpcdwxyvyl")
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹαγινορυϲϳ", "ABEZHIKMNOPTYXCayivopucj")
ARMENIAN = ("ՕՍԼօսոհցզյ", "OULounhgqj")
CHEROKEE = ("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏳᏴ", "DRTiyAJEWMHYGZbRWSVSLCPKdGB")
LISU = ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU")
#: Latin letters of other kinds, and dashes, points and strokes that look like a common sign.
OTHER = (
    "ɡɑıᴀʙᴄᴅᴇɢʜɪᴊᴋʟᴍɴᴏᴘʀꜱᴛᴜᴠᴡʏᴢµ‐‑−⁃˗∶․⁄∕∗∼∣ǀ∙⋅ʼ",
    "gaiABcDEGHIJKLMNoPRsTUvwYzμ-----:.//*~||··’",
)
#: Format characters that are seen.
SEEN = set("؀؁؂؃؄؅۝܏࢐࢑࣢\U000110bd\U000110cd")
INVISIBLE_MARKS = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10)]
JOINING = "؀-ࣿऀ-෿က-႟ក-៿\U0001f000-\U0001faff️♀♂❤"


#: Planes that hold letters, marks and format characters.
CODES = [*range(0x20000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE0200)]
MOST_KEPT, LONGEST_KEPT = 200_000, 64


class Conflict(ValueError):
    """The mapping sends one key to two results, or a result further on."""


def _entries() -> Iterator[tuple[str, str]]:
    for letters, latin in (CYRILLIC, GREEK, ARMENIAN, CHEROKEE, LISU, OTHER):
        yield from zip(letters, latin, strict=True)
    for code in CODES:
        char = chr(code)
        kind = unicodedata.category(char)
        if kind in ("Zs", "Zl", "Zp") or char in "\t\n\v\f\r\x85":
            yield char, " "
        elif kind == "Cf" and char not in SEEN or code in INVISIBLE_MARKS:
            yield char, ""
        else:
            tag, _, _ = unicodedata.decomposition(char).partition(" ")
            compatible = tag == "<compat>" and (0x2160 <= code < 0x2180 or 0x2E80 <= code < 0x2FE0 or 0xFB00 <= code <= 0xFB06)
            if tag in ("<wide>", "<narrow>", "<font>") or compatible:
                yield char, unicodedata.normalize("NFKD", char)


def compile_mapping(entries: Iterator[tuple[str, str]] | None = None) -> dict[str, str]:
    """The mapping of single characters, closed and free of conflicts; of a look-alike of a look-alike the last result."""
    table: dict[str, str] = {}
    for key, result in _entries() if entries is None else entries:
        if table.setdefault(key, result) != result:
            raise Conflict(f"{key!r} to {table[key]!r} and {result!r}")
    closed = {key: "".join(table.get(c, c) for c in result) for key, result in table.items()}
    for key, result in closed.items():
        if any(closed.get(c, c) != c for c in result):
            raise Conflict(f"{key!r} to {result!r}, which changes further")
    return closed


def compile_clusters(table: dict[str, str]) -> dict[str, str]:
    """The keys of several characters: every letter with its marks, as mapped characters, to the composed letter."""
    keys: dict[str, str] = {}
    for code in CODES:
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and not 0xAC00 <= code < 0xD7A4:  # syllables of Hangul are composed by rule
            key = "".join(table.get(c, c) for c in parts)
            result = unicodedata.normalize("NFC", key)
            if len(result) < len(key) and keys.setdefault(key, result) != result:
                raise Conflict(f"{key!r} to {keys[key]!r} and {result!r}")
    return keys


class Transducer:
    def __init__(self) -> None:
        self.table = compile_mapping()
        self.single = str.maketrans(self.table)
        self.clusters = compile_clusters(self.table)
        self.longest = max(map(len, self.clusters))
        self.opening = {key[0] for key in self.clusters}
        self.joiner = re.compile(f"(?<=[{JOINING}])[\u200c\u200d]")
        self.hangul = re.compile("[\u1100-\u11ff\uac00-\ud7a3]")
        self.run = re.compile(r"[^\W\d_]+")
        back = lambda pair: {ord(b): a for a, b in reversed(list(zip(*pair)))}
        self.scripts = [
            (re.compile("[Ѐ-ԯ]"), back(CYRILLIC)), (re.compile("[Ͱ-Ͽ]"), back(GREEK)), (re.compile("[԰-֏]"), back(ARMENIAN)),
        ]
        self.known: dict[str, str] = {}

    def _composed(self, text: str) -> str:
        """The longest key at each place of the mapped characters."""
        out, at, clusters, longest = [], 0, self.clusters, self.longest
        while at < len(text):
            if text[at] in self.opening:
                for end in range(min(at + longest, len(text)), at + 1, -1):
                    result = clusters.get(text[at:end])
                    if result is not None:
                        out.append(result)
                        at = end
                        break
                else:
                    out.append(text[at])
                    at += 1
            else:
                out.append(text[at])
                at += 1
        return "".join(out)

    def _script(self, match: re.Match) -> str:
        run = match.group()
        for letters, back in self.scripts:
            if letters.search(run):
                run = self._composed(unicodedata.normalize("NFD", unicodedata.normalize("NFD", run).translate(back)))
                return unicodedata.normalize("NFC", run)
        return run

    def word(self, word: str) -> str:
        """The form of a piece without blanks."""
        form = self.known.get(word)
        if form is None:
            held = self.joiner.sub(lambda m: "\ufdd0" if m.group() == "\u200c" else "\ufdd1", word)
            mapped = unicodedata.normalize("NFD", unicodedata.normalize("NFD", held).translate(self.single))
            form = self._composed(mapped).replace("\ufdd0", "\u200c").replace("\ufdd1", "\u200d")
            if self.hangul.search(form):
                form = unicodedata.normalize("NFC", form)
            form = self.run.sub(self._script, form)
            if len(word) <= LONGEST_KEPT:
                if len(self.known) >= MOST_KEPT:
                    self.known.clear()
                self.known[word] = form
        return form

    def __call__(self, text: str | None) -> str | None:
        """The consistent form of a text."""
        if text is None:
            return None
        word = self.word
        pieces = [w if w.isascii() else word(w) for w in text.split()]
        return " ".join(p for p in pieces if p)


@lru_cache(maxsize=1)
def transducer() -> Transducer:
    return Transducer()


@F.pandas_udf(StringType())
def _forms(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    form = transducer()
    for part in texts:
        yield part.map(form, na_action="ignore")


PLAIN = r"^(?:[!-~]+(?: [!-~]+)*+)?$"  # printable ASCII with single blanks


def consistent_form(text: Column) -> Column:
    """The consistent form; printable ASCII with single blanks is its own form and isn't sent to Python."""
    plain = text.rlike(PLAIN)
    return F.when(plain, text).otherwise(_forms(F.when(~plain, text)))


def lookalike_pairs(rows: DataFrame, salts: int = 16) -> DataFrame:
    """(field, key_a, key_b) of all records of ``rows`` (field, key, text) whose texts differ and look the same.

    Only forms that a text differs from can have two texts, so the rest leaves early. Pairs are formed between the
    distinct texts of a form and then given their records, once on either side; hot texts are spread over salts.
    """
    seen = rows.select("field", "key", "text").where(F.col("key").isNotNull() & F.col("text").rlike(r"(?U)\S"))
    # the transducer runs once over each text that isn't plain; plain texts are their own form
    odd = cut_lineage(seen.where(~F.col("text").rlike(PLAIN)).withColumn("form", _forms("text")).where("form <> ''"))
    formed = seen.where(F.col("text").rlike(PLAIN)).withColumn("form", F.col("text")).unionByName(odd)
    dirty = odd.where("text <> form").select("field", "form").distinct()
    # only records whose form some text differs from; kept, as four branches read them
    records = cut_lineage(formed.join(dirty, ["field", "form"], "left_semi"))
    texts = records.select("field", "form", "text").distinct()
    pairs = texts.withColumnRenamed("text", "text_a").join(texts.withColumnRenamed("text", "text_b"), ["field", "form"])
    pairs = pairs.where("text_a < text_b").drop("form")
    salted = records.select("field", "key", "text", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int").alias("salt"))
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    left = pairs.select("*", spread).join(
        salted.select("field", "salt", F.col("text").alias("text_a"), F.col("key").alias("key_1")), ["field", "salt", "text_a"]
    )
    both = left.select("field", "text_b", "key_1", spread).join(
        salted.select("field", "salt", F.col("text").alias("text_b"), F.col("key").alias("key_2")), ["field", "salt", "text_b"]
    )
    return both.select("field", F.least("key_1", "key_2").alias("key_a"), F.greatest("key_1", "key_2").alias("key_b"))
