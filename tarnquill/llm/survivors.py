"""One surviving record for each group of duplicates, chosen or built field by field.

Fields are unpivoted to long rows. A value of a field collects votes: for each record that states it, the trust in the
record's source times a decay by the record's age. The votes are summed by normalised value (its hash; texts don't move),
the winner of each field is taken by ``max_by``, and the winners are pivoted back to one row per group. The surviving
snapshot is a field among them: its votes are trust times recency as well, with so short a half-life that they follow the
stated order (keywords, moment, trust). Every step is a grouping with partial aggregation, so a group that holds a third
of all rows is reduced before it moves; no group is collected. ``with_values`` fetches the texts of the winners.

Defined results: records without a group key belong to no group; null and blank values get no votes; a field nobody
states is null; ties go to the record that stands higher, last to the lowest snapshot; a record that is there twice counts
twice for its values and once for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tarnquill.operators.nested import has_keyword

#: Notations of moments after ISO 8601, tried in this order.
NOTATIONS = ["d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy HH:mm:ss", "d.M.yyyy", "yyyyMMddHHmmss"]
HALF_LIFE_DAYS = 365.0
LATEST_DAY, OLDEST = 29_220, 80  # 2050-01-01, and how many half-lives before it are told apart


def moment(text: Column) -> Column:
    """The moment a text states, whatever its notation; null if it states none. No zone is UTC, no time is midnight."""
    s = F.regexp_replace(F.trim(text), r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})", "$1-$2-$3")
    s = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})(?=$|T)", "$1-$2-$3")
    zoned = F.when(s.rlike(r"(?i)\d:\d.*(?:Z|UTC|[+-]\d{2}:?\d{2})$"), s).otherwise(
        F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d"), F.concat(s, F.lit("Z"))).otherwise(s)
    )
    zoned = F.regexp_replace(zoned, r"([+-]\d{2})(\d{2})$", "$1:$2")
    iso = F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.concat(s, F.lit("T00:00:00Z"))).otherwise(
        F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}[T ]"), zoned)
    )
    epoch = F.when(s.rlike(r"^\d{9,10}$"), F.timestamp_seconds(s.try_cast("bigint"))).when(
        s.rlike(r"^\d{13}$"), F.timestamp_millis(s.try_cast("bigint"))
    )
    worded = F.when(s.rlike(r"[A-Za-z]{3}|^\d{1,2}\.\d|^\d{14}$"), F.lit(True))
    other = [F.when(worded, F.try_to_timestamp(F.concat(s, F.lit(" +00:00")), F.lit(f"{n} XXX"))) for n in NOTATIONS]
    return F.coalesce(iso.try_cast("timestamp"), epoch, *other)


@F.pandas_udf(BooleanType())
def _nested_name(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield part.map(has_keyword).astype(bool)


def prepared(chosen: DataFrame, trust: DataFrame) -> DataFrame:
    """Snapshots with the group key and all that precedence and votes need; the trust table is small and fixed."""
    flat = F.coalesce(F.col("keywords").rlike(r"(?U)[^;\s]"), F.lit(False))
    # only texts whose flat list is empty are opened
    nested = _nested_name(F.when(~flat, F.col("raw_keywords")))
    path = F.regexp_replace(F.translate(F.trim("source_file"), "\\", "/"), r"^(?:\./)+", "")
    rows = chosen.select(
        F.upper(F.regexp_extract("work_id", r"(?i)(W\d+)(?:\D|$)", 1)).alias("work_id"), "snapshot_id",
        "raw_keywords", "raw_updated_date", "source_file", (flat | nested).alias("has_keywords"),
        moment(F.col("raw_updated_date")).alias("moment"), F.regexp_extract(path, r"^([^/]+/[^/]+)/", 1).alias("folder"),
    ).where("work_id <> ''")
    ranks = trust.groupBy("folder").agg(F.min("trust_rank").alias("trust_rank"))
    return rows.join(ranks, "folder", "left")


def _standing() -> Column:
    """The vote of a record for its own snapshot: trust times recency, on a logarithmic scale, with a half-life of one
    microsecond, so that no trust outweighs a later moment; records with keywords vote a tier above the others."""
    recency = F.coalesce(F.unix_micros("moment") + F.lit(2**60), F.lit(0)).cast("decimal(20,0)")
    trust = (F.lit(2**31 - 1) - F.coalesce("trust_rank", F.lit(2**31 - 1))).cast("decimal(10,0)")
    tier = F.col("has_keywords").cast("int").cast("decimal(1,0)")
    return (tier * F.lit(Decimal(2**95)) + recency * F.lit(Decimal(2**32)) + trust).cast("decimal(38,0)")


def _support(half_life_days: float) -> Column:
    """The vote of a record for a value it states: trust times a decay by age, as a whole number. Age counts in half-lives
    before 2050, ``OLDEST`` at most; undated records vote as one half-life older than that. Sums of whole numbers are
    exact, so no vote is rounded away beside a greater one."""
    lives = (F.lit(LATEST_DAY) - F.unix_micros("moment") / 86_400_000_000) / half_life_days
    dated = F.when(lives.isNotNull(), F.least(F.greatest(F.lit(0.0), lives), F.lit(float(OLDEST))))
    whole = F.ceil(dated)
    step = F.coalesce(F.lit(OLDEST + 1) - whole, F.lit(0)).cast("int")
    powers = F.array(*(F.lit(Decimal(2**k)).cast("decimal(25,0)") for k in range(OLDEST + 2)))
    part = F.coalesce(F.pow(F.lit(2.0), whole - dated), F.lit(1.0))
    trust = F.round(4096 * part / (1 + F.coalesce(F.col("trust_rank"), F.lit(99)))).cast("decimal(5,0)")
    return (F.get(powers, step) * trust).cast("decimal(38,0)")


def elect(
    rows: DataFrame, voted: dict[str, Column], identity: str = "snapshot_id", half_life_days: float = HALF_LIFE_DAYS, standing: Column | None = None
) -> DataFrame:
    """One row per work: its number of records, the surviving ``identity``, and of each voted field the record that states
    the winning value (``field_snapshot``; null where nobody states one).

    ``voted`` maps a field to its normalised form; equal forms add their votes, and the record that stands highest speaks
    for a form. The identity is a field of the same long rows, whose only voter is the record itself (``standing``); a
    record that is there twice gains nothing by it.
    """
    none, own = F.lit(None).cast("binary"), _standing() if standing is None else standing
    one = rows.select("work_id", identity, own.alias("standing"), _support(half_life_days).alias("support"), *(
        F.when(F.trim(f) != "", F.unhex(F.md5(form))).alias(f"form_{f}") for f, form in voted.items()
    ))
    # a record's vote for itself is its standing, so only the other fields carry a vote; fields go by number
    cells = [F.struct(F.lit(0).cast("tinyint").alias("field"), F.coalesce(F.unhex(F.hex(identity)), F.lit(b"")).alias("form"), F.lit(None).cast("decimal(38,0)").alias("vote"))]
    cells += [F.struct(F.lit(i).cast("tinyint").alias("field"), F.col(f"form_{f}").alias("form"), F.col("support").alias("vote")) for i, f in enumerate(voted, 1)]
    long = one.select(
        "work_id", F.struct("standing", (-F.col(identity)).alias("behind")).alias("record"), F.explode(F.array(*cells)).alias("cell")
    ).select("work_id", "record", "cell.*").where("form IS NOT NULL")
    votes = long.groupBy("work_id", "field", "form").agg(F.sum("vote").alias("votes"), F.max("record").alias("record"), F.count("*").alias("n"))
    vote = F.when(F.col("field") == 0, F.col("record.standing")).otherwise(F.col("votes"))
    of = lambda i: F.max_by("record.behind", F.when(F.col("field") == i, F.struct(vote, "record")))
    return votes.groupBy("work_id").agg(
        F.sum(F.when(F.col("field") == 0, F.col("n"))).alias("records"), (-of(0)).alias(identity), *((-of(i)).alias(f"{f}_snapshot") for i, f in enumerate(voted, 1))
    )


def with_values(elected: DataFrame, rows: DataFrame, fields: list[str], identity: str = "snapshot_id") -> DataFrame:
    """The elected works with the winning values: only the records that won are asked for their texts."""
    asked = elected.select("work_id", "records", F.col(identity).alias("survivor"), F.explode(F.array(
        *(F.struct(F.lit(f).alias("field"), F.col(f"{f}_snapshot").alias(identity)) for f in fields)
    )).alias("cell")).select("work_id", "records", "survivor", "cell.*")
    value = F.coalesce(*(F.when(F.col("field") == f, F.col(f)) for f in fields))
    found = asked.join(rows.select(identity, *fields), identity, "left").select("work_id", "records", "survivor", "field", value.alias("value"))
    return found.groupBy("work_id").agg(
        F.max("records").alias("records"), F.max("survivor").alias(identity), *(F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields)
    )


def json_form(text: Column) -> Column:
    """JSON in one notation (blanks, escapes and the order of names don't count); other text without outer blanks."""
    whole = text.rlike(r"[\]}]\s*+$")
    return F.coalesce(F.to_json(F.try_parse_json(F.when(whole, text))), F.trim(text))
