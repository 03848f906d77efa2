"""Text functions without a built-in counterpart."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DASHES = re.compile("[-‐‑‒–—−]")
_ASCII = r"^[\x00-\x7f]*$"


def normal_name(text: str) -> str:
    """Compatibility form, folded case, dashes as blanks, single blanks."""
    return " ".join(DASHES.sub(" ", unicodedata.normalize("NFKC", text).casefold()).split())


@F.pandas_udf(StringType())
def _names(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield part.map(normal_name, na_action="ignore")


@F.pandas_udf(StringType())
def _compatible(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield part.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def normalised(text: Column) -> Column:
    """``normal_name``; ASCII, which has no other forms, stays in built-in expressions."""
    plain = text.rlike(_ASCII)
    built_in = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), "-", " "), r"\s+", " "))
    return F.when(plain, built_in).otherwise(_names(F.when(~plain, text)))


def cleaned(text: Column) -> Column:
    """Compatibility form with single blanks."""
    plain = text.rlike(_ASCII)
    return F.trim(F.regexp_replace(F.when(plain, text).otherwise(_compatible(F.when(~plain, text))), r"(?U)\s+", " "))


def iso_date(text: Column) -> Column:
    """The first ten characters; eight digits as an ISO date."""
    return F.left(F.regexp_replace(F.trim(text), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"), F.lit(10))


def any_dash(pattern: str) -> str:
    """A pattern whose ``[- ]`` takes any dash, blank or non-breaking blank."""
    return pattern.replace("[- ]", "[-\u2010\u2011\u2012\u2013\u2014\u2212\u00a0 ]")


def anchor_words(text: Column, pattern: str) -> Column:
    """The different words a pattern hits, in their order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def register_functions(spark: SparkSession) -> None:
    """The text functions for SQL at will: normal_name, compatible_text, parse_keywords."""
    from tarnquill.operators.observations import parse_record

    def parsed(raw: pd.Series, flat: pd.Series) -> pd.Series:
        return pd.Series([[{"keyword_id": i, "raw_name": n, "score": s} for i, (n, s) in parse_record(a, b).items()] for a, b in zip(raw, flat)])

    spark.udf.register("normal_name", _names)
    spark.udf.register("compatible_text", _compatible)
    spark.udf.register("parse_keywords", F.pandas_udf(parsed, "array<struct<keyword_id:string,raw_name:string,score:double>>"))


def masked_mean(rows: Column, mask: Column) -> Column:
    """The mean of the vectors whose mask is 1, at unit length; the zero vector if there is none."""
    kept = F.filter(F.zip_with(rows, mask, lambda r, m: F.when(m > 0, r)), lambda r: r.isNotNull())
    zero = F.transform(F.get(rows, F.lit(0)), lambda _: F.lit(0.0))
    total = F.aggregate(kept, zero, lambda s, r: F.zip_with(s, r, lambda a, b: a + b.cast("double")))
    norm = F.sqrt(F.aggregate(total, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(total, lambda x: x / F.greatest(norm, F.lit(1e-12)))
