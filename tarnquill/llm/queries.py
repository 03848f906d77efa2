"""Queries of the language-model operators and their SQL counterparts."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnquill.llm.lookalike import consistent_form, lookalike_pairs
from tarnquill.llm.mixing import mix, planned, shares
from tarnquill.llm.quality import kinds
from tarnquill.llm.survivors import elect, json_form, prepared, with_values
from tarnquill.llm.term_counts import marked, term_frequencies, updated_frequencies
from tarnquill.llm.tokens import token_counts, token_ids
from tarnquill.llm.variants import organisations, variant_pairs
from tarnquill.operators.packed import institution_values
from tarnquill.plans.datasets import NODES
from tarnquill.session import cut_lineage
from tarnquill.sources import table


def _visible(spark: SparkSession, d: str) -> DataFrame:
    titles = table(spark, d, "population", "doc_id", "title").select(
        F.lit("title").alias("field"), F.col("doc_id").alias("key"), F.col("title").alias("text")
    )
    names = table(spark, d, "vocab", "keyword_id", "raw_name", "normalized_name").select(
        F.col("keyword_id").alias("key"), F.expr("stack(2, 'raw_name', raw_name, 'normalized_name', normalized_name)").alias("field", "text")
    )
    return titles.unionByName(names)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike_pairs(_visible(spark, d))


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every text of the three fields with its consistent form."""
    return _visible(spark, d).withColumn("form", consistent_form(F.col("text")))


def _institutions(spark: SparkSession, d: str) -> DataFrame:
    return institution_values(table(spark, d, "recent_metadata", "meta_id", "institutions")).select(F.col("value").alias("name"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return variant_pairs(_institutions(spark, d))


def p2_organisations(spark: SparkSession, d: str) -> DataFrame:
    """Every spelling with the organisation it names."""
    return organisations(_institutions(spark, d))


def _papers(spark: SparkSession, d: str):
    return table(spark, d, "population", "source").where("source = 'paper'").agg(F.count("*")).scalar()


def p3_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows, papers and mark of every keyword."""
    counts = term_frequencies(table(spark, d, "observations", "keyword_id", "row_id"), F.col("keyword_id"), F.col("row_id"))
    return marked(counts, _papers(spark, d)).withColumnRenamed("term", "keyword_id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_counts(spark, d).where("mark is not null").select("keyword_id", "mark")


def p3_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return updated_frequencies(
        table(spark, d, "observations", "keyword_id", "row_id"),
        table(spark, d, "keyword_dictionary", "keyword_code", "canonical_name", "document_frequency"),
        table(spark, d, "keyword_aliases", "keyword_code", "source_keyword_ids"),
    )


def _snapshots(spark: SparkSession, d: str) -> DataFrame:
    columns = ["snapshot_id", "work_id", "raw_keywords", "keywords", "raw_updated_date", "source_file"]
    return prepared(table(spark, d, "chosen", *columns), table(spark, d, "source_trust"))


def _elected(rows: DataFrame) -> DataFrame:
    """Survivors, and the fields by votes, from the same long rows."""
    return elect(rows, {
        "raw_keywords": json_form(F.col("raw_keywords")), "raw_updated_date": F.date_format("moment", "yyyy-MM-dd"), "source_file": F.col("folder"),
    })


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _elected(_snapshots(spark, d)).where("records >= 2").select("work_id", "snapshot_id")


def p4_golden(spark: SparkSession, d: str) -> DataFrame:
    """One built record per work: the surviving snapshot, and each field by votes of all its records."""
    chosen = table(spark, d, "chosen", "snapshot_id", "raw_keywords", "raw_updated_date", "source_file")
    return with_values(_elected(_snapshots(spark, d)), chosen, ["raw_keywords", "raw_updated_date", "source_file"])


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return token_ids(table(spark, d, "documents", "doc_id", "text"))


def _counted(spark: SparkSession, d: str) -> DataFrame:
    return cut_lineage(token_counts(table(spark, d, "documents", "doc_id", "source", "text")))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix(_counted(spark, d), table(spark, d, "mix_targets"))


def _shares_of(counted: DataFrame, targets: DataFrame, times: float | None = None) -> DataFrame:
    plan = planned(counted, targets)
    if times is not None:
        plan = planned(counted, targets, times * sum(plan.tokens.values()))
    return shares(mix(counted, targets, plan=plan), targets).withColumn("exponent", F.lit(plan.exponent))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The sources' shares beside their targets, with the exponent that met them."""
    return _shares_of(_counted(spark, d), table(spark, d, "mix_targets"))


def p8_shares_larger(spark: SparkSession, d: str) -> DataFrame:
    """The same of a mix a tenth larger than the targets allow: the exponent goes back as far as the repeats demand."""
    return _shares_of(_counted(spark, d), table(spark, d, "mix_targets"), 1.1)


def _kinds(spark: SparkSession, d: str) -> DataFrame:
    return kinds(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "quality_labels", "doc_id", "label"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _kinds(spark, d).where("kind <> 'prose'").select("doc_id", "kind")


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    """All statistics and the kind of every document with text."""
    return _kinds(spark, d)


#: For the SQL, listed apart from the operator's own: what looks like each letter or sign.
LOOKS = {
    "A": "АΑᎪ", "B": "ВΒᏴ", "C": "СϹᏟ", "E": "ЕΕᎬ", "G": "ԌᏀ", "H": "НΗᎻ", "I": "ІΙ", "J": "ЈᎫ", "K": "КΚᏦ", "L": "ԼᏞ", "M": "МΜᎷ",
    "N": "Ν", "O": "ОΟՕ", "P": "РΡᏢ", "Q": "Ԛ", "S": "ЅᏚ", "T": "ТΤᎢ", "V": "ѴᏙ", "W": "ԜᎳ", "X": "ХΧ", "Y": "ҮΥ", "Z": "ΖᏃ",
    "a": "аαɑ", "c": "сϲᴄ", "d": "ԁ", "e": "е", "g": "ցɡ", "h": "һհ", "i": "іιı", "j": "јϳյ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ",
    "q": "ԛզ", "s": "ѕ", "u": "սυ", "v": "ѵν", "w": "ԝ", "x": "х", "y": "уүγ", "-": "‐‑−",
}


def _lookalike_sql() -> str:
    """Pairs by a plainer form: translation of single characters, composition, one kind of blank."""
    pairs = [(c, latin) for latin, likes in LOOKS.items() for c in likes] + [(chr(0xFF00 + i), chr(0x20 + i)) for i in range(1, 95)]
    pairs += [(chr(c), unicodedata.normalize("NFKC", chr(c))) for c in range(0x2F00, 0x2FD6)]
    quoted = lambda i: "".join(p[i] for p in pairs).replace("'", "''")
    form = f"translate(t, '{quoted(0)}', '{quoted(1)}')"
    for ligature in "ﬀﬁﬂﬃﬄﬅﬆ":
        form = f"replace({form}, '{ligature}', '{unicodedata.normalize('NFKC', ligature)}')"
    form = f"regexp_replace({form}, '[\\x{{AD}}\\x{{34F}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}-\\x{{2064}}\\x{{FEFF}}]', '', 'g')"
    form = f"trim(regexp_replace(nfc_normalize({form}), '[\\s\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}]+', ' ', 'g'))"
    return f"""WITH r AS (SELECT 'title' AS field, doc_id AS k, title AS t FROM population UNION ALL SELECT 'raw_name', keyword_id, raw_name FROM vocab
        UNION ALL SELECT 'normalized_name', keyword_id, normalized_name FROM vocab), f AS (SELECT field, k, t, {form} AS form FROM r WHERE t IS NOT NULL)
        SELECT a.field, least(a.k, b.k) AS key_a, greatest(a.k, b.k) AS key_b FROM f a JOIN f b ON a.field = b.field AND a.form = b.form AND a.t < b.t WHERE a.form <> ''"""


QUERIES = {
    "p1_found": p1_found, "p1_forms": p1_forms,
    "p2_found": p2_found, "p2_organisations": p2_organisations,
    "p3_found": p3_found, "p3_counts": p3_counts, "p3_dictionary": p3_dictionary,
    "p4_found": p4_found, "p4_golden": p4_golden,
    "p7_ids": p7_ids,
    "p8_mix": p8_mix, "p8_shares": p8_shares, "p8_shares_larger": p8_shares_larger,
    "p9_found": p9_found, "p9_statistics": p9_statistics,
}

_COUNTS = """
SELECT keyword_id, count(*) AS n_rows, count(DISTINCT row_id) AS n_records,
       CASE WHEN count(DISTINCT row_id) < 10 THEN 'rare'
            WHEN count(DISTINCT row_id) > 0.5 * (SELECT count(*) FROM population WHERE source = 'paper') THEN 'common' END AS mark
FROM observations WHERE trim(keyword_id) <> '' GROUP BY keyword_id"""

SQL = {
    "p1_found": _lookalike_sql(),
    "p3_counts": _COUNTS,
    "p3_found": f"SELECT keyword_id, mark FROM ({_COUNTS}) WHERE mark IS NOT NULL",
    "p3_dictionary": """
WITH ids AS (SELECT DISTINCT keyword_code, unnest(string_split(source_keyword_ids, ' | ')) AS keyword_id FROM keyword_aliases),
     fresh AS (SELECT keyword_code, count(DISTINCT row_id) AS n FROM ids JOIN observations USING (keyword_id) GROUP BY keyword_code)
SELECT keyword_code, canonical_name, coalesce(document_frequency, -1) AS stale_frequency, coalesce(n, 0) AS document_frequency,
       document_frequency IS DISTINCT FROM coalesce(n, 0) AS changed
FROM keyword_dictionary LEFT JOIN fresh USING (keyword_code)""",
    "p4_found": (_RECORDS := NODES + """, r AS (SELECT upper(regexp_extract(work_id, '(?i)(W[0-9]+)(?:[^0-9]|$)', 1)) AS work_id, snapshot_id,
        snapshot_id IN (SELECT snapshot_id FROM keywords) OR regexp_matches(coalesce(keywords, ''), '[^;\\s]') AS has_keywords, trim(raw_updated_date) AS s,
        regexp_extract(regexp_replace(replace(trim(source_file), chr(92), '/'), '^(\\./)+', ''), '^([^/]+/[^/]+)/', 1) AS folder FROM chosen),
    m AS (SELECT *, CASE WHEN regexp_matches(s, '^[0-9]{9,10}$') THEN to_timestamp(s::BIGINT) AT TIME ZONE 'UTC' ELSE coalesce(try_strptime(s, '%Y%m%d'), try_strptime(s, '%d %b %Y'), try_strptime(s, '%Y/%m/%d'),
            CASE WHEN regexp_matches(s, '[0-9]T[0-9:]+(Z|[+-][0-9:]+)$') THEN try_cast(s AS TIMESTAMPTZ) AT TIME ZONE 'UTC' ELSE try_cast(s AS TIMESTAMP) END) END AS moment FROM r WHERE work_id <> ''),
    o AS (SELECT *, count(*) OVER (PARTITION BY work_id) AS n, row_number() OVER (PARTITION BY work_id ORDER BY has_keywords DESC, moment DESC NULLS LAST,
            coalesce(trust_rank, 999) , snapshot_id) AS k FROM m LEFT JOIN source_trust USING (folder))
    """) + "SELECT work_id, snapshot_id FROM o WHERE k = 1 AND n >= 2",
    "p4_golden": _RECORDS + """, x AS (SELECT *, least(greatest(0.0, (29220 - epoch_us(moment) / 86400000000::DOUBLE) / 365.0), 80.0) AS age FROM o),
    v AS (SELECT *, CASE WHEN moment IS NULL THEN 1::HUGEINT ELSE (1::HUGEINT << (81 - ceil(age))::INT) END * round(4096 * CASE WHEN moment IS NULL THEN 1 ELSE pow(2, ceil(age) - age) END / (1 + coalesce(trust_rank, 99)))::HUGEINT AS vote FROM x),
    l AS (SELECT work_id, k, vote, snapshot_id, unnest([{'f': 'k', 'v': form}, {'f': 'd', 'v': strftime(moment, '%Y-%m-%d')}, {'f': 's', 'v': folder}]) AS c
        FROM v JOIN (SELECT snapshot_id, CASE WHEN trim(raw_keywords) = '' THEN NULL WHEN json_valid(raw_keywords) THEN json(raw_keywords)::VARCHAR ELSE trim(raw_keywords) END AS form FROM chosen) USING (snapshot_id)),
    f AS (SELECT l.work_id, c.f AS f, sum(vote) AS votes, min(k) AS k, arg_min(snapshot_id, k) AS snapshot_id FROM l LEFT JOIN chosen USING (snapshot_id)
        WHERE c.v IS NOT NULL AND CASE c.f WHEN 'd' THEN trim(raw_updated_date) <> '' WHEN 's' THEN trim(source_file) <> '' ELSE true END GROUP BY l.work_id, c.f, c.v),
    w AS (SELECT work_id, f, snapshot_id FROM (SELECT *, row_number() OVER (PARTITION BY work_id, f ORDER BY votes DESC, k) AS r FROM f) WHERE r = 1),
    p AS (SELECT w.work_id, max(raw_keywords) FILTER (WHERE f = 'k') AS raw_keywords, max(raw_updated_date) FILTER (WHERE f = 'd') AS raw_updated_date, max(source_file) FILTER (WHERE f = 's') AS source_file
        FROM w JOIN chosen USING (snapshot_id) GROUP BY w.work_id)
    SELECT o.work_id, n AS records, snapshot_id, raw_keywords, raw_updated_date, source_file FROM (SELECT work_id, n, snapshot_id FROM o WHERE k = 1) o LEFT JOIN p USING (work_id)""",
}
