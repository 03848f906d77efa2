"""Title rules to business topics, quarterly shares and trend tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnquill.functions.expressions import quarter, ratio
from tarnquill.operators.packed import institution_values

#: Our rules as (topic, category, patterns that all have to match, pattern that forbids).
RULES = [
    ("B01", "storage", ["batter|batería|Speicher|锂离子|储能"], "fuel"),
    ("B02", "storage", ["pumped storage|насосная|hydraulique"], ""),
    ("B03", "sun", ["solar|photovolt|光伏|солнечн"], ""),
    ("B04", "wind", ["wind|风力|ветров|éolien"], "window"),
    ("B05", "hydrogen", ["fuel cell|electrolys|pile à combustible|Brennstoffzelle|Elektrolyse"], ""),
    ("B06", "heat", ["heat pump|热泵|pompe à chaleur|Wärmepumpe"], ""),
    ("B07", "heat", ["boiler|burner|chaudière|锅炉|Kessel"], "gas"),
    ("B08", "heat", ["district heating|тепловая сеть|réseau de chaleur"], ""),
    ("B09", "grid", ["grid|inverter|transformer|Netz|сеть"], "heating network"),
    ("B10", "method", ["^(effect|modelling|on the) ", "(of|the) "], ""),
    ("B11", "policy", ["policy plan", "after (19|20)[0-9][0-9]"], ""),
    ("B12", "engine", ["turbine|турбин|turbina"], "wind|ветров"),
]
#: The named windows, both days included.
WINDOWS = {
    "history": ("2021-07-01", "2026-06-30"), "core": ("2023-07-01", "2026-06-30"), "recent": ("2025-07-01", "2026-06-30"),
    "previous": ("2024-07-01", "2025-06-30"), "baseline": ("2022-07-01", "2025-06-30"), "cross_source": ("2026-01-01", "2026-06-30"),
}
RECENT, PREVIOUS = WINDOWS["recent"], WINDOWS["previous"]
FIRST_QUARTER, LAST_QUARTER = "2021-07-01", "2026-04-01"


def _matches(title: Column, patterns: list[str], negative: str) -> Column:
    hit = F.lit(True)
    for pattern in patterns:
        hit = hit & title.rlike(f"(?iu){pattern}")
    return hit & ~title.rlike(f"(?iu){negative}") if negative else hit


def memberships(population: DataFrame, rules: list = RULES) -> DataFrame:
    """(doc_id, topic_id) of usable records; one scan tests all rules."""
    title = F.col("title")
    tests = F.array(*(F.when(_matches(title, patterns, negative), F.lit(topic)) for topic, _, patterns, negative in rules))
    rows = population.where(F.col("usable") & title.isNotNull())
    return rows.select("doc_id", "source", "date", "eligible", "category_id", F.explode(F.array_compact(tests)).alias("topic_id"))


def match_evidence(population: DataFrame, rules: list = RULES) -> DataFrame:
    """The words each pattern of a matched rule hit."""
    title = F.col("title")
    cells = [
        F.when(_matches(title, patterns, negative), F.struct(
            F.lit(topic).alias("topic_id"), F.array_join(F.array(*(F.regexp_extract(title, f"(?iu){p}", 0) for p in patterns)), "|").alias("evidence")
        ))
        for topic, _, patterns, negative in rules
    ]
    rows = population.where(F.col("usable") & title.isNotNull())
    return rows.select("doc_id", F.explode(F.array_compact(F.array(*cells))).alias("m")).select("doc_id", "m.*")


def quarter_population(population: DataFrame) -> DataFrame:
    """Eligible papers per quarter, whatever their topics."""
    papers = population.where("source = 'paper' AND eligible").where(F.col("date").between(FIRST_QUARTER, RECENT[1]))
    return papers.groupBy(quarter(F.col("date")).alias("period")).agg(F.countDistinct("doc_id").alias("denominator_papers"))


def dense_shares(members: DataFrame, denominators: DataFrame, topics: DataFrame) -> DataFrame:
    """Each topic in each quarter, with 0 where it has no paper."""
    spark = members.sparkSession
    quarters = spark.sql(f"SELECT explode(sequence(date'{FIRST_QUARTER}', date'{LAST_QUARTER}', interval 3 months)) AS q")
    grid = quarters.select(quarter(F.col("q")).alias("period")).crossJoin(F.broadcast(topics))  # 20 quarters x rules
    papers = members.where("source = 'paper' AND eligible").groupBy("topic_id", quarter(F.col("date")).alias("period"))
    counts = papers.agg(F.countDistinct("doc_id").alias("papers"))
    out = grid.join(counts, ["topic_id", "period"], "left").join(F.broadcast(denominators), "period", "left")
    out = out.na.fill(0, ["papers", "denominator_papers"])
    return out.withColumn("share", F.coalesce(F.try_divide("papers", "denominator_papers"), F.lit(0.0)))


def window_label(date: Column) -> Column:
    return F.when(date.between(*RECENT), "recent").when(date.between(*PREVIOUS), "previous")


def in_windows(records: DataFrame) -> DataFrame:
    """(window, source, documents): each record counts in every window its date is in."""
    names = F.array_compact(F.array(*(F.when(F.col("date").between(*days), F.lit(name)) for name, days in WINDOWS.items())))
    return records.select("source", "doc_id", F.explode(names).alias("window")).groupBy("window", "source").agg(F.countDistinct("doc_id").alias("documents"))


def institutions(members: DataFrame, metadata: DataFrame) -> DataFrame:
    """Distinct institutions per topic and window; stand-ins for nothing don't count."""
    papers = members.where("source = 'paper' AND eligible").select("doc_id", "topic_id", window_label(F.col("date")).alias("window"))
    named = institution_values(metadata, "doc_id").select(F.col("record_key").alias("doc_id"), F.lower("value").alias("institution"))
    named = named.where(~F.col("institution").isin("none", "nan"))
    joined = papers.where("window IS NOT NULL").join(named, "doc_id")
    return joined.groupBy("topic_id", "window").agg(F.countDistinct("institution").alias("institutions"))


def trends(shares: DataFrame, breadth: DataFrame, least: int = 30) -> DataFrame:
    """Trend tier of each topic from the last eight quarters: a small base is only observed; growth has to be broad."""
    year = F.when(F.col("period") >= "2025Q3", "recent").when(F.col("period") >= "2024Q3", "previous")
    rows = shares.withColumn("window", year).where("window IS NOT NULL")
    before = F.lag("share", 4).over(Window.partitionBy("topic_id").orderBy("period"))
    rows = rows.withColumn("grown", F.coalesce(((F.col("share") > before) & (F.col("window") == "recent")).cast("int"), F.lit(0)))
    pick = lambda w, c: F.sum(F.when(F.col("window") == w, F.col(c)).otherwise(0))
    sums = rows.groupBy("topic_id").agg(
        pick("recent", "papers").alias("recent_papers"), pick("previous", "papers").alias("previous_papers"),
        pick("recent", "denominator_papers").alias("rd"), pick("previous", "denominator_papers").alias("pd"),
        F.sum("grown").alias("growing_quarters"),
    )
    wide = breadth.groupBy("topic_id").agg(
        F.sum(F.when(F.col("window") == "recent", F.col("institutions")).otherwise(-F.col("institutions"))).alias("institution_growth")
    )
    out = sums.join(wide, "topic_id", "left").na.fill(0, ["institution_growth"])
    change = ratio(ratio(F.col("recent_papers"), F.col("rd")), ratio(F.col("previous_papers"), F.col("pd")))
    few = (F.col("recent_papers") < least) | (F.col("previous_papers") < least)
    strong = F.col("ratio") >= 1.2
    tier = (
        F.when(few, "observe").when(F.col("ratio").isNull(), None)
        .when(strong & (F.col("growing_quarters") >= 3) & (F.col("institution_growth") >= 1), "priority")
        .when(F.col("ratio") < 0.8, "decline").when(strong, "rising_unsteady").otherwise("flat")
    )
    return out.withColumn("ratio", change).select(
        "topic_id", "recent_papers", "previous_papers", "growing_quarters", "institution_growth", F.round("ratio", 6).alias("ratio"), tier.alias("tier")
    )
