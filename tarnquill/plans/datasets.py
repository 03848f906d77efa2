"""Queries of the general data-set operators (packed fields, nested records)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnquill.operators.nested import read_tables, write_tables
from tarnquill.operators.packed import packed_fields
from tarnquill.session import kept_folder
from tarnquill.sources import table


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return packed_fields(
        table(spark, d, "recent_metadata", "meta_id", "institutions"),
        table(spark, d, "keyword_dictionary", "keyword_code", "conditional_anchor_topics"),
        table(spark, d, "keyword_aliases", "keyword_code", "raw_names"),
    )


def p5_identity_counts(spark: SparkSession, d: str) -> DataFrame:
    """Names packed in each alias record against the count the record states."""
    aliases = table(spark, d, "keyword_aliases", "keyword_code", "raw_names", "source_identity_count")
    named = p5_found(spark, d).where("field = 'raw_names'").groupBy("record_key").agg(F.count("*").alias("names"))
    joined = aliases.join(named, aliases.keyword_code == named.record_key, "left")
    return joined.select(
        "keyword_code", "source_identity_count", F.coalesce("names", F.lit(0)).alias("names"),
        (F.coalesce("source_identity_count", F.lit(0)) < F.coalesce("names", F.lit(0))).alias("understated"),
    )


def _chosen(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chosen", "snapshot_id", "raw_keywords")


def nested_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The four tables of the nested records. One pass writes them all; queries of one application over one state of the
    input (files, sizes, times) read what the first has written."""
    rows = _chosen(spark, d)
    state = rows.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    files = state.agg(F.sort_array(F.collect_list(F.concat_ws(" ", "file_path", "file_size", "file_modification_time")))).first()[0]
    key = (spark.sparkContext.applicationId, d, tuple(files))
    if key not in _WRITTEN:
        _WRITTEN[key] = kept_folder(spark, "nested")
        write_tables(rows, _WRITTEN[key])
    return read_tables(spark, _WRITTEN[key])


_WRITTEN: dict[tuple, str] = {}


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nested_tables(spark, d)["keyword"].drop("score")


def p6_sources(spark: SparkSession, d: str) -> DataFrame:
    return nested_tables(spark, d)["source"]


def p6_evidence(spark: SparkSession, d: str) -> DataFrame:
    return nested_tables(spark, d)["evidence"]


def p6_spans(spark: SparkSession, d: str) -> DataFrame:
    return nested_tables(spark, d)["span"]


QUERIES = {
    "p5_found": p5_found, "p5_identity_counts": p5_identity_counts,
    "p6_found": p6_found, "p6_sources": p6_sources, "p6_evidence": p6_evidence, "p6_spans": p6_spans,
}

NODES = """
WITH RECURSIVE texts AS (SELECT snapshot_id, CASE WHEN json_type(j) = 'VARCHAR' THEN j ->> '$' ELSE j END AS j
    FROM (SELECT snapshot_id, CASE WHEN json_valid(raw_keywords) THEN raw_keywords END AS j FROM chosen) WHERE j IS NOT NULL),
lists AS (SELECT snapshot_id, CASE json_type(j) WHEN 'ARRAY' THEN j::JSON WHEN 'OBJECT' THEN coalesce(j -> '$.keywords', j -> '$.data.keywords') END AS l
    FROM (SELECT snapshot_id, CASE WHEN json_valid(j) THEN j END AS j FROM texts) WHERE j IS NOT NULL),
nodes AS (
    SELECT snapshot_id, i::VARCHAR AS node_path, '' AS parent_path, l -> (i - 1) AS node
    FROM (SELECT snapshot_id, l, unnest(range(1, json_array_length(l)::BIGINT + 1)) AS i FROM lists WHERE json_type(l) = 'ARRAY')
    UNION ALL
    SELECT snapshot_id, concat(node_path, '.', i), node_path, CASE WHEN json_type(n) = 'ARRAY' THEN n -> (i - 1) ELSE n END
    FROM (SELECT snapshot_id, node_path, n, unnest(range(1, CASE json_type(n) WHEN 'ARRAY' THEN json_array_length(n)::BIGINT WHEN 'OBJECT' THEN 1 ELSE 0 END + 1)) AS i
          FROM (SELECT snapshot_id, node_path, node -> '$.narrower' AS n FROM nodes WHERE json_type(node) = 'OBJECT') WHERE n IS NOT NULL)),
objects AS (SELECT * FROM nodes WHERE json_type(node) = 'OBJECT'),
found AS (SELECT snapshot_id, node_path, parent_path, trim(node ->> '$.display_name') AS raw_name, node ->> '$.id' AS id FROM nodes
    WHERE json_type(node) = 'OBJECT' AND json_type(node -> '$.display_name') = 'VARCHAR' AND trim(node ->> '$.display_name') <> ''),
keywords AS (SELECT snapshot_id, node_path, parent_path, CASE WHEN trim(coalesce(id, '')) = '' THEN concat('label:', lower(raw_name)) ELSE id END AS keyword_id, raw_name FROM found)
"""

# a plainer reading than the operator's, with the separators of these tables
PACKED_CTES = r"""
WITH f AS (SELECT 'institutions' AS field, meta_id::VARCHAR AS record_key, trim(institutions, E' \t\r\n') AS t, false AS codes FROM recent_metadata
    UNION ALL SELECT 'conditional_anchor_topics', keyword_code, trim(conditional_anchor_topics, E' \t\r\n'), true FROM keyword_dictionary
    UNION ALL SELECT 'raw_names', keyword_code, trim(raw_names, E' \t\r\n'), false FROM keyword_aliases),
g AS (SELECT *, regexp_replace(regexp_replace(t, '\\.', 'x', 'g'), '"(?:[^"]|"")*"', 'Q', 'g') AS m FROM f WHERE t IS NOT NULL AND lower(t) NOT IN ('', 'none', 'nan', '[]')),
p AS (SELECT field, record_key, t LIKE '[%]' AS is_list, CASE
    WHEN t LIKE '[%]' THEN from_json(CASE WHEN t LIKE '[''%' THEN replace(t, '''', '"') ELSE t END, '["VARCHAR"]')
    WHEN codes THEN regexp_extract_all(t, '[A-Za-z0-9-]+')
    WHEN regexp_matches(m, 'Q\s*,|,\s*Q') AND NOT (regexp_matches(m, '[;；|\n\r\t]') AND regexp_matches(m, '[^Q\s]\s*,\s*([^Q\s]|$)')) THEN regexp_extract_all(t, '\s*"(?:[^"]|"")*"|(?:\\.|[^;；|\n\r\t,])+')
    ELSE regexp_extract_all(replace(t, ' / ', ';'), '\s*"(?:[^"]|"")*"|(?:\\.|[^;；|\n\r\t])+') END AS v FROM g),
q AS (SELECT field, record_key, list_filter(list_transform(v, lambda x: CASE WHEN is_list THEN trim(x) WHEN trim(x, E' \t\r\n') LIKE '"%"'
    THEN replace(trim(x, E' \t\r\n')[2:-2], '""', '"') ELSE replace(trim(x, E' \t\r\n'), '\;', ';') END), lambda x: trim(x) <> '') AS v FROM p)
"""
PACKED_ROWS = "SELECT field, record_key, generate_subscripts(v, 1)::INT AS pos, unnest(v) AS value FROM q"
_PACKED = PACKED_CTES + PACKED_ROWS

_EVIDENCE = NODES + """, ev AS (SELECT snapshot_id, node_path AS parent_path, i AS evidence_pos, e -> (i - 1) AS item FROM
    (SELECT snapshot_id, node_path, e, unnest(range(1, json_array_length(e)::BIGINT + 1))::INT AS i FROM (SELECT *, node -> '$.evidence' AS e FROM objects) WHERE json_type(e) = 'ARRAY')),
evidence AS (SELECT snapshot_id, concat(parent_path, '/e', evidence_pos) AS node_path, parent_path, evidence_pos, item ->> '$.field' AS field, item -> '$.spans' AS spans FROM ev WHERE json_type(item) = 'OBJECT')
"""

SQL = {
    "p5_found": _PACKED,
    "p5_identity_counts": _PACKED.replace("SELECT field, record_key, generate_subscripts", "SELECT keyword_code, source_identity_count, coalesce(names, 0) AS names, coalesce(source_identity_count, 0) < coalesce(names, 0) AS understated FROM keyword_aliases LEFT JOIN (SELECT record_key, count(*) AS names FROM (SELECT field, record_key, generate_subscripts")
    + ") WHERE field = 'raw_names' GROUP BY ALL) ON keyword_code = record_key",
    "p6_found": NODES + "SELECT * FROM keywords",
    "p6_sources": NODES + """SELECT snapshot_id, node_path, node_path AS parent_path, s ->> '$.list' AS list, try_cast(s ->> '$.added.year' AS INT) AS year, s ->> '$.added.by' AS added_by
        FROM (SELECT *, node -> '$.source' AS s FROM objects) WHERE json_type(s) = 'OBJECT'""",
    "p6_evidence": _EVIDENCE + "SELECT snapshot_id, node_path, parent_path, evidence_pos, field FROM evidence",
    "p6_spans": _EVIDENCE + """SELECT snapshot_id, concat(node_path, '/s', i) AS node_path, node_path AS parent_path, i AS span_pos, try_cast(s ->> 0 AS INT) AS span_start, try_cast(s ->> 1 AS INT) AS span_end
        FROM (SELECT snapshot_id, node_path, i, spans -> (i - 1) AS s FROM (SELECT *, unnest(range(1, json_array_length(spans)::BIGINT + 1))::INT AS i FROM evidence WHERE json_type(spans) = 'ARRAY'))
        WHERE json_type(s) = 'ARRAY' AND json_array_length(s) = 2""",
}
