"""Queries of text views, vocabularies, anchors, names, aliases and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarnquill.functions import text as X
from tarnquill.operators import integrity as C
from tarnquill.operators import ledger as G
from tarnquill.operators import lexical as L
from tarnquill.operators import observations as O
from tarnquill.operators import vectors as V
from tarnquill.plans.keyword_queries import _BASE as _KEYWORDS
from tarnquill.plans.keyword_queries import _Tables
from tarnquill.plans.topic_queries import _WORDS
from tarnquill.sources import table

#: Our anchor words, and a two-word term in any notation.
ANCHOR = "(?i)(energy|power|solar|wind|heat)"
FUEL_CELL = "fuel[- ]cell"


def _records(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the title of the record they belong to."""
    titles = table(spark, d, "population", "doc_id", "title").withColumnRenamed("doc_id", "record_id")
    documents = table(spark, d, "documents", "doc_id", "text", "source", "record_id").withColumnRenamed("text", "body")
    return documents.join(titles, "record_id", "left").select("doc_id", "source", "title", "body")


def encoder_views(spark: SparkSession, d: str) -> DataFrame:
    rows = _records(spark, d).select("doc_id", L.encoder_view(F.col("title"), F.col("body"), F.col("source")).alias("v"))
    return rows.select("doc_id", F.length("v.view").alias("n"), F.md5("v.view").alias("view_md5"), "v.truncated")


def titled_chunks(spark: SparkSession, d: str) -> DataFrame:
    found = L.titled_chunks(_records(spark, d))
    return found.select("doc_id", "chunk", F.md5("text").alias("text_md5"), "n_new", F.round("weight", 6).alias("weight"))


def excerpts(spark: SparkSession, d: str, limit: int = 600) -> DataFrame:
    rows = table(spark, d, "documents", "doc_id", "text").where("text IS NOT NULL").select("doc_id", L.excerpt(F.col("text"), limit).alias("e"))
    return rows.select("doc_id", F.md5("e.excerpt").alias("excerpt_md5"), "e.truncated")


def anchor_lists(spark: SparkSession, d: str) -> DataFrame:
    """The anchor words in title and body of each document, in their order."""
    both = F.concat_ws(" ", "title", "body")
    return _records(spark, d).select("doc_id", F.array_join(X.anchor_words(both, ANCHOR), "|").alias("anchors")).where("anchors <> ''")


def sampled_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return L.sampled_vocabulary(table(spark, d, "documents", "doc_id", "text", "source"))


def fixed_vocabulary_counts(spark: SparkSession, d: str) -> DataFrame:
    return L.fixed_counts(table(spark, d, "documents", "doc_id", "text", "source"), sampled_vocabulary(spark, d))


def normal_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of the vocabulary in normal form, and cleaned."""
    return table(spark, d, "vocab").select("keyword_id", X.normalised(F.col("raw_name")).alias("name"), X.cleaned(F.col("raw_name")).alias("cleaned"))


def stated_dates(spark: SparkSession, d: str) -> DataFrame:
    """The day of each snapshot's stated time where the notation begins with it; null elsewhere."""
    day = X.iso_date(F.col("raw_updated_date"))
    return table(spark, d, "chosen").select("snapshot_id", F.when(day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), day.try_cast("date").cast("string")).alias("day"))


def any_dash_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "population", "doc_id", "title").where(F.col("title").rlike("(?i)" + X.any_dash(FUEL_CELL))).select("doc_id")


def first_alias(spark: SparkSession, d: str) -> DataFrame:
    """The name a keyword was first seen under: of the lowest batch, of equals the first by text."""
    rows = table(spark, d, "alias_fragments").where("trim(keyword_id) <> '' AND trim(raw_name) <> ''")
    first = F.min(F.struct(F.col("batch_id").isNull().alias("a"), F.col("batch_id").alias("b"), F.trim("raw_name").alias("name"))).alias("f")
    return rows.groupBy("keyword_id").agg(first).select("keyword_id", "f.name")


def topic_maps(spark: SparkSession, d: str) -> DataFrame:
    """Each record's topics as a map to whether a direct hit states them, and what the map has for one topic."""
    related = _Tables(spark, d).related
    maps = related.groupBy("row_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("topic_code", "has_direct_hit")))).alias("m"))
    entries = F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return maps.select("row_id", F.array_join(entries, "|").alias("topics"), F.try_element_at("m", F.lit("KWD-T0001")).alias("first_topic"))


def weighted_centroids(spark: SparkSession, d: str) -> DataFrame:
    """Weighted means of the vectors of each label, not normalised."""
    weight = F.when(F.col("vec_id") % 5 == 0, 2.0).otherwise(1.0)
    sums = V.vector_sums(table(spark, d, "embeddings"), "label", weight)
    long = sums.select("label", "mass", F.posexplode("total").alias("i", "x"))
    return long.select("label", "i", F.round(F.col("x") / F.col("mass"), 6).alias("x"))


def browse_facets(spark: SparkSession, d: str, text: str = "turbine") -> DataFrame:
    """How many eligible records whose title holds a text there are, by source and by year."""
    rows = table(spark, d, "population").where(F.lower("title").contains(text) & F.col("eligible"))
    facets = F.explode(F.array(F.struct(F.lit("source").alias("facet"), F.col("source").alias("value")), F.struct(F.lit("year").alias("facet"), F.year("date").cast("string").alias("value")))).alias("f")
    return rows.select(facets).groupBy("f.facet", "f.value").agg(F.count("*").alias("records"))


def anchor_families(spark: SparkSession, d: str) -> DataFrame:
    """The anchor topics of conditional entries: any for two global topics, a family for one, else the topic itself."""
    rules = table(spark, d, "keyword_dictionary", "keyword_code", "decision", "topic_code")
    found = O.anchor_families(rules, {"KWD-T0003": ["KWD-T0003", "KWD-T0004"]}, ["KWD-T0001", "KWD-T0002"])
    return found.where("decision = 'conditional'").select("keyword_code", "topic_code", F.array_join("families", "|").alias("families"))


def ledger_superseded(spark: SparkSession, d: str) -> DataFrame:
    """The labels as a ledger of corrections: every odd document cites the entry it replaces, the others cite nothing."""
    order = Window.partitionBy("key").orderBy("labelled_by", "decision")  # labels of one document
    rows = table(spark, d, "quality_labels").where("label IS NOT NULL").select(F.col("doc_id").cast("string").alias("key"), "doc_id", F.col("label").alias("decision"), "labelled_by").distinct()
    rows = rows.withColumn("seq", F.row_number().over(order)).withColumn("cites", F.lit(None).cast("string"))
    hashed = G.superseded(rows).select("key", "seq", "sha")
    before = hashed.select("key", (F.col("seq") + 1).alias("seq"), F.col("sha").alias("cites"))
    cited = rows.drop("cites").join(before, ["key", "seq"], "left").withColumn("cites", F.when(F.col("doc_id") % 2 == 1, F.col("cites")))
    return G.superseded(cited)


def override_violations(spark: SparkSession, d: str) -> DataFrame:
    """Breaches, by rule, in a ledger made of observed pairs (withheld), some repeated, of unknown action, or never observed."""
    obs = _Tables(spark, d).obs.select("row_id", "keyword_id")
    base = obs.where("row_id % 211 = 0").withColumn("action", F.when(F.col("row_id") % 422 == 0, "withhold_trigger").otherwise("drop"))
    more = base.where("row_id % 633 = 0").unionByName(base.where("row_id % 844 = 0").withColumn("keyword_id", F.lit("nowhere")).distinct())
    return G.override_violations(base.unionByName(more), obs).groupBy("rule").agg(F.count("*").alias("breaches"))


def checked_join(spark: SparkSession, d: str) -> DataFrame:
    """Papers with the number of their snapshots, joined under a checked contract of one row each."""
    papers = table(spark, d, "population", "row_id", "doc_id", "source").where("source = 'paper'").drop("source")
    counts = table(spark, d, "chosen", "row_id").where("row_id IS NOT NULL").groupBy("row_id").agg(F.count("*").alias("snapshots"))
    return C.join_checked(papers, counts, "row_id", "one_to_one").select("doc_id", F.coalesce("snapshots", F.lit(0)).alias("snapshots"))


_SPLIT = "list_filter(string_split_regex(coalesce({}, ''), '[\\s\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}\\x{{85}}\\v]+'), lambda x: x <> '')"
_RECORDS = f"WITH rec AS (SELECT d.doc_id, d.source, p.title, d.text AS body, {_SPLIT.format('p.title')} AS t, {_SPLIT.format('d.text')} AS b FROM documents d LEFT JOIN population p ON d.record_id = p.doc_id)"
_VOCABULARY = _WORDS + """, smp AS (SELECT doc_id FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) AS r FROM documents WHERE text IS NOT NULL AND source IN ('paper', 'patent', 'policy'))
    WHERE r <= CASE source WHEN 'paper' THEN 100000 WHEN 'patent' THEN 40000 ELSE 8000 END),
voc AS (SELECT term, count(DISTINCT doc_id) AS document_frequency FROM t SEMI JOIN smp USING (doc_id) GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3),
vp AS (SELECT term, document_frequency, row_number() OVER (ORDER BY document_frequency DESC, term)::INT AS place FROM voc QUALIFY place <= 120000)
"""

SQL = {
    "encoder_views": _RECORDS + """, x AS (SELECT *, t[1:192] AS h, 2044 - len(t[1:192]) AS l, (2044 - len(t[1:192])) // 3 AS a, len(b) AS n FROM rec),
        y AS (SELECT doc_id, source, l, n, CASE WHEN source = 'paper' THEN concat(coalesce(title, ''), chr(10), coalesce(body, '')) ELSE array_to_string(list_concat(h, CASE WHEN n > l
            THEN list_concat(list_concat(b[1:a], b[n // 2 - a // 2 + 1:n // 2 - a // 2 + a]), b[n - (l - 2 * a) + 1:n]) ELSE b END), ' ') END AS v FROM x)
        SELECT doc_id, length(v)::INT AS n, md5(v) AS view_md5, coalesce(source <> 'paper', true) AND n > l AS truncated FROM y""",
    "titled_chunks": _RECORDS + """, x AS (SELECT *, list_concat(t, b) AS w, len(t) + len(b) AS total, CASE WHEN len(t) + len(b) <= 125 THEN [] ELSE t[1:24] END AS f FROM rec WHERE len(t) + len(b) > 0),
        y AS (SELECT *, w[len(f) + 1:total] AS r, 125 - len(f) AS step FROM x), z AS (SELECT *, unnest(range(0, greatest((len(r) + step - 1) // step, 1))) AS chunk FROM y),
        q AS (SELECT *, r[chunk * step + 1:chunk * step + step] AS piece, CASE WHEN chunk = 0 THEN 0 ELSE len(f) + chunk * step END AS before FROM z), k AS (SELECT *, len(piece) + CASE WHEN chunk = 0 THEN len(f) ELSE 0 END AS new, least(total, 4096) AS main FROM q)
        SELECT doc_id, chunk::INT AS chunk, md5(array_to_string(list_concat(f, piece), ' ')) AS text_md5, new::INT AS n_new,
        round(CASE WHEN source = 'policy' AND total > 125 THEN 0.4 * new / total::DOUBLE + 0.6 * least(new, greatest(0, main - before)) / main::DOUBLE ELSE new::DOUBLE END, 6) AS weight FROM k""",
    "excerpts": "SELECT doc_id, md5(left(text, 600)) AS excerpt_md5, length(text) > 600 AS truncated FROM documents WHERE text IS NOT NULL",
    "anchor_lists": """SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(a, range(1, len(a) + 1)), lambda x: list_position(a, x[1]) = x[2]), lambda x: x[1]), '|') AS anchors FROM
        (SELECT d.doc_id, regexp_extract_all(concat_ws(' ', p.title, d.text), '(?i)(energy|power|solar|wind|heat)') AS a FROM documents d LEFT JOIN population p ON d.record_id = p.doc_id) WHERE len(a) > 0""",
    "sampled_vocabulary": _VOCABULARY + "SELECT * FROM vp",
    "fixed_vocabulary_counts": _VOCABULARY + "SELECT doc_id, place, count(*) AS n FROM t JOIN vp USING (term) GROUP BY ALL",
    "stated_dates": """SELECT snapshot_id, CASE WHEN regexp_matches(d, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN try_cast(d AS DATE)::VARCHAR END AS day
        FROM (SELECT snapshot_id, left(regexp_replace(trim(raw_updated_date), '^([0-9]{4})([0-9]{2})([0-9]{2})$', '\\1-\\2-\\3'), 10) AS d FROM chosen)""",
    "any_dash_titles": "SELECT doc_id FROM population WHERE regexp_matches(title, 'fuel[-\u2010\u2011\u2012\u2013\u2014\u2212\u00a0 ]cell', 'i')",
    "first_alias": """SELECT keyword_id, name FROM (SELECT keyword_id, trim(raw_name) AS name, row_number() OVER (PARTITION BY keyword_id ORDER BY batch_id NULLS LAST, trim(raw_name)) AS r
        FROM alias_fragments WHERE trim(keyword_id) <> '' AND trim(raw_name) <> '') WHERE r = 1""",
    "topic_maps": _KEYWORDS + """SELECT row_id, string_agg(concat(topic_code, '=', has_direct_hit), '|' ORDER BY topic_code) AS topics, max(has_direct_hit::INT) FILTER (WHERE topic_code = 'KWD-T0001')::BOOLEAN AS first_topic FROM related GROUP BY ALL""",
    "weighted_centroids": """SELECT label, i::INT AS i, round(sum(w * x) / sum(w), 6) AS x FROM (SELECT label, CASE WHEN vec_id % 5 = 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL""",
    "browse_facets": """WITH r AS (SELECT source, year(date)::VARCHAR AS y FROM population WHERE contains(lower(title), 'turbine') AND eligible)
        SELECT 'source' AS facet, source AS value, count(*) AS records FROM r GROUP BY ALL UNION ALL SELECT 'year', y, count(*) FROM r GROUP BY ALL""",
    "anchor_families": """SELECT keyword_code, topic_code, CASE WHEN topic_code IN ('KWD-T0001', 'KWD-T0002') THEN '' WHEN topic_code = 'KWD-T0003' THEN 'KWD-T0003|KWD-T0004' ELSE coalesce(topic_code, '') END AS families
        FROM keyword_dictionary WHERE decision = 'conditional'""",
    "ledger_superseded": """WITH l AS (SELECT DISTINCT doc_id, label AS decision, labelled_by FROM quality_labels WHERE label IS NOT NULL),
        n AS (SELECT *, doc_id::VARCHAR AS key, row_number() OVER (PARTITION BY doc_id ORDER BY labelled_by NULLS FIRST, decision) AS seq FROM l), h AS (SELECT *, sha256(concat_ws(chr(31), key, seq, decision)) AS sha FROM n)
        SELECT key, seq::INT AS seq, decision, sha, seq = max(seq) OVER (PARTITION BY key) AS latest, seq = 1 OR doc_id % 2 = 1 AS cites_replaced FROM h""",
    "override_violations": _KEYWORDS + """, b AS (SELECT row_id, keyword_id, CASE WHEN row_id % 422 = 0 THEN 'withhold_trigger' ELSE 'drop' END AS action FROM obs WHERE row_id % 211 = 0),
        o AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE row_id % 633 = 0 UNION ALL SELECT DISTINCT row_id, 'nowhere', action FROM b WHERE row_id % 844 = 0),
        z AS (SELECT 'repeated' AS rule, count(*) AS breaches FROM (SELECT 1 FROM o GROUP BY row_id, keyword_id HAVING count(*) > 1) UNION ALL SELECT 'unknown_action', count(*) FROM o WHERE action = 'drop'
        UNION ALL SELECT 'never_observed', count(*) FROM o WHERE keyword_id = 'nowhere') SELECT * FROM z WHERE breaches > 0""",
    "checked_join": """SELECT doc_id, coalesce(n, 0) AS snapshots FROM population LEFT JOIN (SELECT row_id, count(*) AS n FROM chosen WHERE row_id IS NOT NULL GROUP BY ALL) USING (row_id) WHERE source = 'paper'""",
}

QUERIES = {f.__name__: f for f in (
    encoder_views, titled_chunks, excerpts, anchor_lists, sampled_vocabulary, fixed_vocabulary_counts, normal_names, stated_dates,
    any_dash_titles, first_alias, topic_maps, weighted_centroids, browse_facets, anchor_families, ledger_superseded, override_violations,
    checked_join,
)}
