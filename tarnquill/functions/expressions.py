"""Column expressions used across operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(values: Column, by: str = "|") -> Column:
    """A list as sorted text, '' for none."""
    return F.array_join(F.array_sort(values), by)


def quarter(date: Column) -> Column:
    """2025Q3 and so on."""
    return F.concat(F.year(date), F.lit("Q"), F.quarter(date))


def sample_order(key: Column, group: Column, salt: str) -> Column:
    """The order of a reproducible sample: md5 of key, group and salt."""
    return F.md5(F.concat(key, group, F.lit(salt)))


def quality_gate(strict: bool = True) -> Column:
    """Usable, neither retracted nor of a template; the lenient gate leaves usability aside."""
    gate = ~F.col("retracted") & ~F.col("template_record")
    return F.col("usable") & gate if strict else gate


def ratio(part: Column, whole: Column) -> Column:
    """Null where the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def code(template: str, number: Column) -> Column:
    """An identifier such as F0007 from its number."""
    return F.format_string(template, number)


def cascade(text: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The name of the first pattern that the text matches."""
    out = F.lit(otherwise)
    for name, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out
