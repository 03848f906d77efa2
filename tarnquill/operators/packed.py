"""Several values packed in one field: one row per value with its position.

Ordinary characters are masked, which leaves a skeleton: the separators and protected values of a text in their order, with
the blanks beside them; repetitions are folded. From each distinct skeleton it is resolved once which of its signs separate
and which belong to values, and each text is cut by the rule of its skeleton. Rules are broadcast if there are at most
``MOST_RULES`` of them (counted), else joined by a shuffle.

A sign separates by these rules: semicolons, bars, tabs and line ends always, but a bar inside initials (``AT|T``: one or
two capitals on either side, one at least alone) only if nothing else separates; a slash between blanks; commas in lists,
and where one stands beside a quoted value, unless semicolons or the like separate already and bare commas remain. In
fields of codes each of these separates, and blanks too.

Defined results: null, blank and stand-in fields (``none``, ``nan``, ``[]`` ..., as the field's list has them) have no
values; blank pieces are no values and take no position; repeated values stay, each at its position; a quote without its
partner is an ordinary character; a bracketed text that is not a list of strings is cut at commas inside its brackets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnquill.session import cut_lineage

#: Whole fields that stand for nothing, lower case; in names, "Na" or "unknown" may be a name.
NO_NAME = ["", "none", "nan", "null", "n/a", "<na>", "-", "--", "[]", "{}", "()"]
NOTHING = [*NO_NAME, "na", "nil", "unknown"]
QUOTED, SLASH, INNER = "\ufdd0", "\ufdd1", "\ufdd2"  # noncharacters: never in interchanged text
MOST_RULES = 50_000
_HARD_CLASS = r";；|\n\r\t"
_COMMAS = ",，、"
_SIGNS = _HARD_CLASS + _COMMAS + "/"
_QUOTE = r'"[^"\\]*+(?:(?:""|\\.)[^"\\]*+)*+"'
_EDGE = r"(?U)^\s+|\s+$"
_SHORT_BAR = rf"(?<![^\s{_SIGNS}])(?!\p{{Lu}}{{2}}\|\p{{Lu}}{{2}})(\p{{Lu}}{{1,2}})\|(\p{{Lu}}{{1,2}})(?![\p{{L}}\p{{N}},])"


def skeleton(text: Column) -> Column:
    """The signs of the text that could separate or protect values, in order, with ``w`` for what lies between."""
    plain = F.regexp_replace(text, r"(?s)\\.", "w")
    whole = rf"(?s)(?<=^|[{_SIGNS}])(\s*+){_QUOTE}(?=\s*+(?:$|[{_SIGNS}]))"
    plain = F.regexp_replace(plain, whole, f"$1{QUOTED}")
    plain = F.regexp_replace(plain, _SHORT_BAR, f"w{INNER}w")
    ordinary = rf"[^{_SIGNS}\s{QUOTED}{INNER}]++"
    masked = F.regexp_replace(plain, rf"(?U){ordinary}(?:[^\S\n\r\t]++{ordinary})*+", "w")
    masked = F.regexp_replace(masked, r"(?U)[^\S\n\r\t]++", " ")
    for _ in range(2):
        masked = F.regexp_replace(masked, r"(?s)(.{1,8}?)\1{2,}+", "$1$1")
    bracketed = text.startswith("[") & text.endswith("]")
    some = text.rlike(rf'[{_SIGNS}"\\]')
    return F.concat(F.when(bracketed, F.lit("[")).otherwise(F.lit("")), F.when(some, masked).otherwise(F.lit("w")))


def _rules(skeletons: DataFrame) -> DataFrame:
    """For each (codes, skeleton) what separates: the pattern of one value and how the text is marked before."""
    sign, codes = F.col("skeleton"), F.col("codes")
    is_list = sign.startswith("[")
    slash = sign.rlike(r"(?:^|\s|\[)/(?:\s|$)")
    beside = sign.rlike(f"{QUOTED}\\s*+[{_COMMAS}]|[{_COMMAS}]\\s*+{QUOTED}")
    bare = sign.rlike(rf"(?:^|[w{_COMMAS}])\s*+[{_COMMAS}]\s*+(?:w|$)")
    hard = sign.rlike(f"[{_HARD_CLASS}]")
    commas = codes | is_list | (beside & ~(hard & bare))
    kept_bar = ~codes & sign.contains(INNER) & (hard | slash | (commas & sign.rlike(f"[{_COMMAS}]")))
    separators = F.concat(
        F.lit(_HARD_CLASS + SLASH), F.when(commas, F.lit(_COMMAS)).otherwise(F.lit("")), F.when(codes, F.lit(r"\s")).otherwise(F.lit(""))
    )
    plain = F.concat(
        F.lit(r"(?:\\.|[^"), separators, F.lit(r"])[^\\"), separators, F.lit(r"]*+(?:\\.?[^\\"), separators, F.lit(r"]*+)*+")
    )
    value = F.concat(F.lit(r"(?s)\s*+(?:" + _QUOTE + r"(?=\s*(?:$|["), separators, F.lit("]))|"), plain, F.lit(")"))
    return skeletons.select("codes", "skeleton", value.alias("pattern"), is_list.alias("is_list"), slash.alias("slash"), kept_bar.alias("kept_bar"))


def _value(piece: Column) -> Column:
    """A piece without its blanks, the quotes around it and the escapes that only protect."""
    bare = F.regexp_replace(F.translate(piece, SLASH + INNER, "/|"), _EDGE, "")
    whole = (F.length(bare) >= 2) & bare.startswith('"') & bare.endswith('"')
    inner = F.replace(F.substring(bare, F.lit(2), F.length(bare) - 2), F.lit('""'), F.lit('"'))
    plain = F.when(whole, inner).otherwise(bare)
    return F.regexp_replace(F.regexp_replace(plain, r'\\([;；|,，、"\'/\\\n\r\t])', "$1"), _EDGE, "")


def _texts(df: DataFrame, key: Column, packed: Column, codes: bool, nothing: list[str]) -> DataFrame:
    rows = df.select(key.cast("string").alias("record_key"), F.regexp_replace(packed, _EDGE, "").alias("text"), F.lit(codes).alias("codes"))
    return rows.where(F.col("text").isNotNull() & ~F.lower("text").isin(nothing))


def _cut(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, record_key, pos, value) of rows (keep, record_key, text, codes)."""
    rows = rows.withColumn("skeleton", skeleton(F.col("text")))
    rules = cut_lineage(_rules(rows.select("codes", "skeleton").distinct()))
    rows = rows.join(F.broadcast(rules) if rules.count() <= MOST_RULES else rules, ["codes", "skeleton"])
    # lists in JSON or in the notation of a script language; \xNN is the one escape that JSON lacks
    listed = F.from_json(
        F.regexp_replace(F.col("text"), r"\\x([0-9a-fA-F]{2})", r"\\u00$1"), "array<string>",
        {"allowBackslashEscapingAnyCharacter": "true", "allowSingleQuotes": "true"},
    )
    body = F.when(F.col("is_list"), F.expr("substring(text, 2, length(text) - 2)")).otherwise(F.col("text"))
    body = F.when(F.col("slash"), F.regexp_replace(body, r"(?<=^|\s)/(?=\s|$)", SLASH)).otherwise(body)
    body = F.when(F.col("kept_bar"), F.regexp_replace(body, _SHORT_BAR, f"$1{INNER}$2")).otherwise(body)
    pieces = F.transform(F.regexp_extract_all(body, F.col("pattern"), F.lit(0)), _value)
    pieces = F.coalesce(F.when(F.col("is_list"), F.transform(listed, lambda v: F.regexp_replace(v, _EDGE, ""))), pieces)
    values = F.filter(pieces, lambda v: v.isNotNull() & (v != ""))
    return rows.select(*keep, "record_key", F.posexplode(values).alias("pos", "value")).select(
        *keep, "record_key", (F.col("pos") + 1).alias("pos"), "value"
    )


def split_packed(df: DataFrame, key: Column, packed: Column, codes: bool = False, nothing: list[str] = NOTHING) -> DataFrame:
    """Rows (record_key, pos, value) of the packed field; ``codes`` says that values hold neither blanks nor commas."""
    return _cut(_texts(df, key, packed, codes, nothing))


def institution_values(df: DataFrame, key: str = "meta_id") -> DataFrame:
    return split_packed(df, F.col(key), F.col("institutions"))


def packed_fields(metadata: DataFrame, dictionary: DataFrame, aliases: DataFrame) -> DataFrame:
    """The values of all three packed fields as (field, record_key, pos, value); one set of rules serves all."""
    parts = {
        "institutions": _texts(metadata, F.col("meta_id"), F.col("institutions"), False, NOTHING),
        "conditional_anchor_topics": _texts(dictionary, F.col("keyword_code"), F.col("conditional_anchor_topics"), True, NOTHING),
        "raw_names": _texts(aliases, F.col("keyword_code"), F.col("raw_names"), False, NO_NAME),
    }
    united = None
    for field, part in parts.items():
        part = part.withColumn("field", F.lit(field))
        united = part if united is None else united.unionByName(part)
    return _cut(united, "field")
