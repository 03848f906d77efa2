"""Queries of title topics, quarters and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnquill.functions.expressions import sample_order
from tarnquill.operators import titles as T
from tarnquill.plans.datasets import PACKED_CTES, PACKED_ROWS
from tarnquill.sources import cell_safe, table


def _population(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "population")


def _members(spark: SparkSession, d: str) -> DataFrame:
    return T.memberships(_population(spark, d))


def _topics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t, *_ in T.RULES], "topic_id string")


def title_rule_membership(spark: SparkSession, d: str) -> DataFrame:
    return _members(spark, d).select("doc_id", "topic_id")


def title_match_evidence(spark: SparkSession, d: str) -> DataFrame:
    return T.match_evidence(_population(spark, d))


def quarter_population(spark: SparkSession, d: str) -> DataFrame:
    return T.quarter_population(_population(spark, d))


def quarter_dense_share(spark: SparkSession, d: str) -> DataFrame:
    shares = T.dense_shares(_members(spark, d), T.quarter_population(_population(spark, d)), _topics(spark))
    return shares.withColumn("share", F.round("share", 6)).select("topic_id", "period", "papers", "denominator_papers", "share")


def institution_breadth(spark: SparkSession, d: str) -> DataFrame:
    return T.institutions(_members(spark, d), table(spark, d, "recent_metadata", "doc_id", "institutions"))


def trend_tiers(spark: SparkSession, d: str) -> DataFrame:
    shares = T.dense_shares(_members(spark, d), T.quarter_population(_population(spark, d)), _topics(spark))
    return T.trends(shares, institution_breadth(spark, d))


def metadata_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Papers of the recent windows without metadata, with empty, and with named institutions."""
    papers = _population(spark, d).where("source = 'paper' AND eligible").withColumn("window", T.window_label(F.col("date")))
    named = table(spark, d, "recent_metadata", "doc_id", "institutions").groupBy("doc_id").agg(
        F.bool_or(F.trim(F.coalesce("institutions", F.lit(""))) != "").alias("named")
    )
    joined = papers.where("window IS NOT NULL").join(named, "doc_id", "left")
    return joined.groupBy("window").agg(
        F.count("*").alias("papers"), F.count_if(F.col("named").isNull()).alias("missing"),
        F.count_if(~F.col("named")).alias("empty"), F.count_if("named").alias("named"),
    )


def source_window_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = _members(spark, d).where("eligible")
    return rows.groupBy("topic_id", "source").agg(
        F.countDistinct("doc_id").alias("documents"),
        F.count_if(F.col("date").between(*T.RECENT)).alias("recent_documents"),
    )


def window_counts(spark: SparkSession, d: str) -> DataFrame:
    """Eligible records of each source in the named windows."""
    return T.in_windows(_population(spark, d).where("eligible"))


def topic_bridge(spark: SparkSession, d: str) -> DataFrame:
    """Older categories against title topics: matched and unresolved records."""
    base = _population(spark, d).where("usable AND category_id <> ''").select("doc_id", "category_id")
    members = _members(spark, d).groupBy("doc_id").agg(F.count("*").alias("topics"))
    return base.join(members, "doc_id", "left").groupBy("category_id").agg(
        F.count("*").alias("records"), F.count("topics").alias("matched"), F.count_if(F.col("topics").isNull()).alias("unresolved"),
        F.coalesce(F.sum("topics"), F.lit(0)).alias("links"),
    )


def strata_sample(spark: SparkSession, d: str) -> DataFrame:
    """Three records of each topic and stratum in reproducible order."""
    stratum = F.coalesce(T.window_label(F.col("date")), F.lit("earlier"))
    rows = _members(spark, d).withColumn("stratum", stratum)
    order = Window.partitionBy("topic_id", "stratum").orderBy(sample_order(F.col("doc_id"), F.col("topic_id"), "tq-3"), "doc_id")
    ranked = rows.withColumn("sample_rank", F.row_number().over(order)).where("sample_rank <= 3")
    return ranked.select("topic_id", "stratum", "doc_id", "sample_rank")


#: The queries' own terms to sample titles for.
TERMS = ["wind farm", "heat pump", "salt cavern", "fuel cell stack", "carbon filter", "flywheel"]


def targeted_sample(spark: SparkSession, d: str) -> DataFrame:
    """For each term the titles that hold it, exact titles first, three of each."""
    title = F.lower(F.trim("title"))
    found = F.array_compact(F.array(*(F.when(title.contains(t), F.lit(t)) for t in TERMS)))
    hits = _population(spark, d).where("title IS NOT NULL").select("doc_id", title.alias("title"), F.explode(found).alias("term"))
    exact = F.when(F.col("title") == F.col("term"), 0).otherwise(1)
    order = Window.partitionBy("term").orderBy(exact, sample_order(F.col("doc_id"), F.col("term"), "tq-4"), "doc_id")
    return hits.withColumn("sample_rank", F.row_number().over(order)).where("sample_rank <= 3").select("term", "doc_id", "sample_rank")


def coverage_by_source(spark: SparkSession, d: str) -> DataFrame:
    rows = _population(spark, d).withColumn("assigned", F.coalesce("category_id", F.lit("")) != "")
    return rows.groupBy("source").agg(
        F.count("*").alias("input_records"), F.count_if("assigned").alias("assigned_records"), F.count_if(~F.col("assigned")).alias("unassigned_records")
    )


def safe_export_cells(spark: SparkSession, d: str) -> DataFrame:
    return _population(spark, d).where("title IS NOT NULL").select("doc_id", cell_safe(F.col("title")).alias("cell"))


def label_change_audit(spark: SparkSession, d: str) -> DataFrame:
    """Category against the first title topic's category per source: compared, changed, share."""
    names = {t: c for t, c, *_ in T.RULES}
    first = _members(spark, d).groupBy("doc_id").agg(F.min("topic_id").alias("topic_id"))
    kind = F.create_map(*(x for t, c in names.items() for x in (F.lit(t), F.lit(c))))[F.col("topic_id")]
    rows = _population(spark, d).join(first, "doc_id").select("source", (F.substring("category_id", 2, 1) != F.substring(kind, 1, 1)).cast("int").alias("changed"))
    return rows.groupBy("source").agg(
        F.count("*").alias("size"), F.sum("changed").alias("changed"), F.round(F.avg("changed"), 6).alias("mean")
    )


def browse_titles(spark: SparkSession, d: str, text: str = "turbine", page: int = 2, size: int = 8) -> DataFrame:
    """A page of records whose title holds a text, newest first (the feature is the page)."""
    rows = _population(spark, d).where(F.lower("title").contains(text.lower()) & F.col("eligible"))
    return rows.orderBy(F.col("date").desc_nulls_last(), "doc_id").select("doc_id", "source", "title").offset(size * (page - 1)).limit(size)


def _matched(patterns: list[str], negative: str) -> str:
    tests = [f"regexp_matches(title, '{p}', 'i')" for p in patterns] + ([f"NOT regexp_matches(title, '{negative}', 'i')"] if negative else [])
    return " AND ".join(tests)


_BASE = (
    PACKED_CTES + ", packed AS (" + PACKED_ROWS + "), members AS (" + " UNION ALL ".join(
        f"SELECT doc_id, source, date, eligible, category_id, '{t}' AS topic_id, concat_ws('|', {', '.join(f"regexp_extract(title, '{p}', 0, 'i')" for p in ps)}) AS evidence "
        f"FROM population WHERE usable AND {_matched(ps, neg)}" for t, _, ps, neg in T.RULES
    ) + f"""), topics AS (SELECT unnest({[t for t, *_ in T.RULES]}) AS topic_id),
labelled AS (SELECT *, CASE WHEN date BETWEEN '{T.RECENT[0]}' AND '{T.RECENT[1]}' THEN 'recent' WHEN date BETWEEN '{T.PREVIOUS[0]}' AND '{T.PREVIOUS[1]}' THEN 'previous' END AS win FROM members),
den AS (SELECT concat(year(date), 'Q', quarter(date)) AS period, count(DISTINCT doc_id) AS denominator_papers FROM population
        WHERE source = 'paper' AND eligible AND date BETWEEN '{T.FIRST_QUARTER}' AND '{T.RECENT[1]}' GROUP BY ALL),
grid AS (SELECT topic_id, concat(year(q), 'Q', quarter(q)) AS period FROM topics, (SELECT unnest(generate_series(DATE '{T.FIRST_QUARTER}', DATE '{T.LAST_QUARTER}', INTERVAL 3 MONTH)) AS q)),
counts AS (SELECT topic_id, concat(year(date), 'Q', quarter(date)) AS period, count(DISTINCT doc_id) AS papers FROM members WHERE source = 'paper' AND eligible GROUP BY ALL),
dense AS (SELECT topic_id, period, coalesce(papers, 0) AS papers, coalesce(denominator_papers, 0) AS denominator_papers,
          coalesce(papers, 0) / nullif(coalesce(denominator_papers, 0), 0)::DOUBLE AS share FROM grid LEFT JOIN counts USING (topic_id, period) LEFT JOIN den USING (period)),
breadth AS (SELECT topic_id, win, count(DISTINCT lower(value)) AS institutions FROM labelled
            JOIN (SELECT doc_id, value FROM packed JOIN recent_metadata ON field = 'institutions' AND record_key = meta_id::VARCHAR) USING (doc_id)
            WHERE source = 'paper' AND eligible AND win IS NOT NULL AND lower(value) NOT IN ('none', 'nan') GROUP BY ALL)
""")  # fmt: skip

SQL = {k: _BASE + v for k, v in {
    "title_rule_membership": "SELECT doc_id, topic_id FROM members",
    "title_match_evidence": "SELECT doc_id, topic_id, evidence FROM members",
    "quarter_population": "SELECT * FROM den",
    "quarter_dense_share": "SELECT topic_id, period, papers, denominator_papers, round(coalesce(share, 0), 6) AS share FROM dense",
    "institution_breadth": "SELECT topic_id, win AS window, institutions FROM breadth",
    "trend_tiers": """, y AS (SELECT *, CASE WHEN period >= '2025Q3' THEN 'recent' ELSE 'previous' END AS win, coalesce(share, 0) AS s FROM dense WHERE period >= '2024Q3'),
        grown AS (SELECT *, lag(s, 4) OVER (PARTITION BY topic_id ORDER BY period) AS before FROM y),
        sums AS (SELECT topic_id, sum(papers) FILTER (WHERE win = 'recent')::BIGINT AS recent_papers, sum(papers) FILTER (WHERE win = 'previous')::BIGINT AS previous_papers,
              sum(denominator_papers) FILTER (WHERE win = 'recent') AS rd, sum(denominator_papers) FILTER (WHERE win = 'previous') AS pd,
              count(*) FILTER (WHERE win = 'recent' AND s > before) AS growing_quarters FROM grown GROUP BY ALL),
        b AS (SELECT topic_id, sum(CASE WHEN win = 'recent' THEN institutions ELSE -institutions END)::BIGINT AS growth FROM breadth GROUP BY ALL),
        c AS (SELECT *, coalesce(growth, 0) AS institution_growth, (recent_papers / nullif(rd, 0)::DOUBLE) / nullif(previous_papers / nullif(pd, 0)::DOUBLE, 0) AS r FROM sums LEFT JOIN b USING (topic_id))
        SELECT topic_id, recent_papers, previous_papers, growing_quarters, institution_growth, round(r, 6) AS ratio,
               CASE WHEN recent_papers < 30 OR previous_papers < 30 THEN 'observe' WHEN r IS NULL THEN NULL WHEN r >= 1.2 AND growing_quarters >= 3 AND institution_growth >= 1 THEN 'priority'
                    WHEN r < 0.8 THEN 'decline' WHEN r >= 1.2 THEN 'rising_unsteady' ELSE 'flat' END AS tier FROM c""",
    "metadata_coverage": f"""SELECT win AS window, count(*) AS papers, count(*) FILTER (WHERE named IS NULL) AS missing, count(*) FILTER (WHERE NOT named) AS empty,
        count(*) FILTER (WHERE named) AS named FROM (SELECT doc_id, CASE WHEN date BETWEEN '{T.RECENT[0]}' AND '{T.RECENT[1]}' THEN 'recent'
        WHEN date BETWEEN '{T.PREVIOUS[0]}' AND '{T.PREVIOUS[1]}' THEN 'previous' END AS win FROM population WHERE source = 'paper' AND eligible)
        LEFT JOIN (SELECT doc_id, bool_or(trim(coalesce(institutions, '')) <> '') AS named FROM recent_metadata GROUP BY ALL) USING (doc_id) WHERE win IS NOT NULL GROUP BY ALL""",
    "source_window_counts": f"""SELECT topic_id, source, count(DISTINCT doc_id) AS documents, count(*) FILTER (WHERE date BETWEEN '{T.RECENT[0]}' AND '{T.RECENT[1]}') AS recent_documents
        FROM members WHERE eligible GROUP BY ALL""",
    "topic_bridge": """SELECT p.category_id, count(*) AS records, count(n) AS matched, count(*) FILTER (WHERE n IS NULL) AS unresolved, coalesce(sum(n), 0)::BIGINT AS links
        FROM population p LEFT JOIN (SELECT doc_id, count(*) AS n FROM members GROUP BY ALL) USING (doc_id) WHERE usable AND p.category_id <> '' GROUP BY ALL""",
    "strata_sample": """SELECT topic_id, stratum, doc_id, r::INT AS sample_rank FROM (SELECT *, coalesce(win, 'earlier') AS stratum, row_number() OVER (PARTITION BY topic_id, coalesce(win, 'earlier')
        ORDER BY md5(concat(doc_id, topic_id, 'tq-3')), doc_id) AS r FROM labelled) WHERE r <= 3""",
    "label_change_audit": "SELECT source, count(*) AS size, sum(changed)::BIGINT AS changed, round(avg(changed), 6) AS mean FROM (SELECT p.source, (substr(p.category_id, 2, 1) <> substr(CASE topic_id "
        + " ".join(f"WHEN '{t}' THEN '{c}'" for t, c, *_ in T.RULES)
        + " END, 1, 1))::INT AS changed FROM population p JOIN (SELECT doc_id, min(topic_id) AS topic_id FROM members GROUP BY ALL) USING (doc_id)) GROUP BY ALL",
}.items()} | {
    "window_counts": " UNION ALL ".join(f"SELECT '{n}' AS window, source, count(DISTINCT doc_id) AS documents FROM population WHERE eligible AND date BETWEEN '{a}' AND '{b}' GROUP BY ALL" for n, (a, b) in T.WINDOWS.items()),
    "targeted_sample": f"""SELECT term, doc_id, r::INT AS sample_rank FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY CASE WHEN t = term THEN 0 ELSE 1 END,
        md5(concat(doc_id, term, 'tq-4')), doc_id) AS r FROM (SELECT doc_id, lower(trim(title)) AS t, term FROM population, (SELECT unnest({TERMS}) AS term)
        WHERE contains(lower(trim(title)), term))) WHERE r <= 3""",
    "coverage_by_source": """SELECT source, count(*) AS input_records, count(*) FILTER (WHERE coalesce(category_id, '') <> '') AS assigned_records,
        count(*) FILTER (WHERE coalesce(category_id, '') = '') AS unassigned_records FROM population GROUP BY ALL""",
    "safe_export_cells": """SELECT doc_id, CASE WHEN regexp_matches(c, '^[=+\\-@]') THEN concat('''', c) ELSE c END AS cell
        FROM (SELECT doc_id, left(regexp_replace(title, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g'), 32000) AS c FROM population WHERE title IS NOT NULL)""",
    "browse_titles": """SELECT doc_id, source, title FROM population WHERE contains(lower(title), 'turbine') AND eligible
        ORDER BY date DESC NULLS LAST, doc_id LIMIT 8 OFFSET 8""",
}

QUERIES = {f.__name__: f for f in (
    title_rule_membership, title_match_evidence, quarter_population, quarter_dense_share, institution_breadth, trend_tiers,
    metadata_coverage, source_window_counts, window_counts, topic_bridge, strata_sample, targeted_sample, coverage_by_source,
    safe_export_cells, label_change_audit, browse_titles,
)}
