"""Queries of the dictionary classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnquill.functions.expressions import cascade
from tarnquill.operators import keywords as K
from tarnquill.operators.integrity import population_identity, reconcile_lists
from tarnquill.operators.nested import keyword_nodes
from tarnquill.plans.datasets import NODES
from tarnquill.sources import table


class _Tables:
    """The frames that the queries share, built when asked for."""

    def __init__(self, spark: SparkSession, d: str) -> None:
        read = lambda name, *c: table(spark, d, name, *c)
        self.population = read("population")
        self.obs = K.observed(read("observations"))
        self.aliases = read("keyword_aliases", "keyword_code", "source_keyword_ids")
        self.dictionary = read("keyword_dictionary")
        self.rules = K.dictionary_rules(self.dictionary)
        self.coded = K.coded(self.obs, self.aliases)
        self.hits = K.candidate_hits(self.coded, self.rules, K.withheld(self.obs))
        self.papers = self.population.where("source = 'paper'").agg(F.count("*")).scalar()

    @property
    def related(self) -> DataFrame:
        return K.relations(self.hits)

    @property
    def assigned(self) -> DataFrame:
        return K.assignments(self.population, self.coded, self.obs, self.hits, self.related)


def kwd_candidate_hits(spark: SparkSession, d: str) -> DataFrame:
    return _Tables(spark, d).hits.select("row_id", "keyword_id", "keyword_code", "decision", "topic_code")


def kwd_anchors(spark: SparkSession, d: str) -> DataFrame:
    return K.anchors(_Tables(spark, d).hits).select("row_id", F.array_join("anchor_topics", "|").alias("anchor_topics"))


def kwd_eligible(spark: SparkSession, d: str) -> DataFrame:
    return K.eligible_hits(_Tables(spark, d).hits).select("row_id", "keyword_id", "decision", "topic_code")


def kwd_relations(spark: SparkSession, d: str) -> DataFrame:
    return _Tables(spark, d).related


def kwd_assignments(spark: SparkSession, d: str) -> DataFrame:
    return _Tables(spark, d).assigned


def kwd_topic_counts(spark: SparkSession, d: str) -> DataFrame:
    t = _Tables(spark, d)
    return K.topic_counts(t.related, t.assigned)


def kwd_topics_per_doc(spark: SparkSession, d: str) -> DataFrame:
    return _Tables(spark, d).assigned.groupBy("topic_count").agg(F.count("*").alias("papers"))


def kwd_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return _Tables(spark, d).assigned.groupBy("classification_status").agg(F.count("*").alias("papers"))


def kwd_version_compare(spark: SparkSession, d: str) -> DataFrame:
    """Documents per topic with the ledger of withheld pairs against those without."""
    t = _Tables(spark, d)
    none = t.obs.select("row_id", "keyword_id").where("false")
    old = K.relations(K.candidate_hits(t.coded, t.rules, none)).groupBy("topic_code").agg(F.count("*").alias("documents_before"))
    new = t.related.groupBy("topic_code").agg(F.count("*").alias("documents"))
    both = old.join(new, "topic_code", "full_outer").na.fill(0, ["documents", "documents_before"])
    return both.withColumn("document_delta", F.col("documents") - F.col("documents_before"))


def kwd_list_edge_reconcile(spark: SparkSession, d: str) -> DataFrame:
    t = _Tables(spark, d)
    return reconcile_lists(t.assigned.select("row_id", F.split("topic_codes", r"\|").alias("topics")), t.related, "topic_code")


def kwd_md5_sample(spark: SparkSession, d: str) -> DataFrame:
    t = _Tables(spark, d)
    rows = t.related.join(t.population.select("row_id", "doc_id"), "row_id")
    return K.md5_sample(rows, "topic_code", "doc_id", 5, "tq-1").select("topic_code", "doc_id", "sample_rank")


def kwd_regression(spark: SparkSession, d: str) -> DataFrame:
    """All relations of the version before (by direct hits, nothing withheld) and whether they are still assigned."""
    t = _Tables(spark, d)
    none = t.obs.select("row_id", "keyword_id").where("false")
    before = K.relations(K.candidate_hits(t.coded, t.rules, none)).where("has_direct_hit")
    now = t.related.select("row_id", "topic_code", F.lit(True).alias("found"))
    return before.select("row_id", "topic_code").join(now, ["row_id", "topic_code"], "left").select(
        "row_id", "topic_code", F.col("found").isNotNull().alias("still_assigned")
    )


def kwd_withheld_check(spark: SparkSession, d: str) -> DataFrame:
    """Withheld pairs, those really observed, and those that still trigger."""
    t = _Tables(spark, d)
    held = K.withheld(t.obs)
    seen = held.join(t.obs, ["row_id", "keyword_id"], "left_semi").select(F.count("*").alias("observed_pairs"))
    active = held.join(t.hits, ["row_id", "keyword_id"], "left_semi").select(F.count("*").alias("still_triggering"))
    return held.agg(F.count("*").alias("withheld_pairs")).crossJoin(seen).crossJoin(active)  # one row each


def vocabulary_idf(spark: SparkSession, d: str) -> DataFrame:
    t = _Tables(spark, d)
    return K.vocabulary(t.obs, t.papers).withColumn("idf", F.round("idf", 6))


def tfidf_l2(spark: SparkSession, d: str) -> DataFrame:
    t = _Tables(spark, d)
    return K.tfidf(t.obs, K.vocabulary(t.obs, t.papers)).withColumn("weight", F.round("weight", 6))


def feature_mask_renorm(spark: SparkSession, d: str) -> DataFrame:
    """The 20 commonest terms masked."""
    t = _Tables(spark, d)
    terms = K.vocabulary(t.obs, t.papers)
    broad = terms.orderBy(F.desc("document_frequency"), "keyword_id").limit(20).select("keyword_id")
    return K.masked(K.tfidf(t.obs, terms), broad).withColumn("weight", F.round("weight", 6))


def snapshot_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return K.canonical_snapshots(table(spark, d, "chosen"))


def alias_counts(spark: SparkSession, d: str) -> DataFrame:
    """Fragments of all batches summed by keyword and name."""
    rows = table(spark, d, "alias_fragments").where("trim(keyword_id) <> '' AND trim(raw_name) <> ''")
    return rows.groupBy("keyword_id", F.trim("raw_name").alias("raw_name")).agg(F.sum("occurrences").alias("occurrences"))


def preferred_alias(spark: SparkSession, d: str) -> DataFrame:
    """The most frequent name of each keyword, of equals the first."""
    first = F.min(F.struct((-F.col("occurrences")).alias("less"), F.col("raw_name"))).alias("first")
    return alias_counts(spark, d).groupBy("keyword_id").agg(first).select(
        "keyword_id", "first.raw_name", (-F.col("first.less")).alias("occurrences")
    )


def keyword_parse_json(spark: SparkSession, d: str) -> DataFrame:
    """Observations parsed from the nested records, every level."""
    nodes = keyword_nodes(table(spark, d, "chosen", "snapshot_id", "raw_keywords"))
    return nodes.groupBy("snapshot_id").agg(F.count("*").alias("keywords"), F.countDistinct("keyword_id").alias("distinct_keywords"))


def obs_integrity(spark: SparkSession, d: str) -> DataFrame:
    """Orphans, repeated pairs and missing keys of the observations."""
    obs = table(spark, d, "observations")
    known = table(spark, d, "population", "row_id")
    orphans = obs.join(known, "row_id", "left_anti").agg(F.count("*").alias("orphans"))
    pairs = obs.groupBy("row_id", "keyword_id").agg(F.count("*").alias("n"))
    repeated = pairs.agg(F.count_if(F.col("n") > 1).alias("repeated_pairs"), F.sum("n").alias("observations"))
    missing = obs.agg(F.count_if(F.coalesce(F.trim("keyword_id"), F.lit("")) == "").alias("without_keyword"))
    return orphans.crossJoin(repeated).crossJoin(missing)  # one row each


def population_check(spark: SparkSession, d: str) -> DataFrame:
    return population_identity(table(spark, d, "population", "row_id", "doc_id"))


#: The queries' own patterns for names that no topic lists, tried in order.
NAME_RULES = [("material", "film|membrane|coating|fluid"), ("machine", "turbine|burner|converter|reactor|valve"), ("policy", "tariff|offset|market|policy")]


def dict_decision_cascade(spark: SparkSession, d: str) -> DataFrame:
    t = _Tables(spark, d).dictionary
    rule = F.when(F.col("decision").isin(*K.ACTIVE), F.col("decision")).otherwise(cascade(F.col("canonical_name"), NAME_RULES, "other"))
    return t.groupBy(rule.alias("rule"), "decision").agg(F.count("*").alias("entries"))


def synonym_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Names of the vocabulary brought to the first identifier of the same normalised name."""
    vocab = table(spark, d, "vocab").withColumn("name", F.lower(F.trim(F.regexp_replace("raw_name", "[-]+| +", " "))))
    first = vocab.groupBy("name").agg(F.min("keyword_id").alias("canonical_id"))
    return vocab.join(first, "name").select("keyword_id", "canonical_id")


def unobserved_terms(spark: SparkSession, d: str) -> DataFrame:
    t = _Tables(spark, d)
    return t.dictionary.join(t.coded, "keyword_code", "left_anti").select("keyword_code", "canonical_name", "decision")


def lookup_document(spark: SparkSession, d: str, doc_id: str | None = None) -> DataFrame:
    """Status, topics and evidence of one document, or of every hundredth paper."""
    t = _Tables(spark, d)
    wanted = t.population.where(F.col("doc_id") == doc_id) if doc_id else t.population.where("row_id % 100 = 0")
    few = t.assigned.join(wanted.select("row_id"), "row_id", "left_semi")
    return few.join(t.related, "row_id", "left").select(
        "doc_id", "classification_status", "quality_eligible", "topic_code", F.coalesce("has_direct_hit", F.lit(False)).alias("has_direct_hit"), "matched_codes"
    )


def stratified_context_queue(spark: SparkSession, d: str) -> DataFrame:
    """Conditional observations by whether other anchors of the record suit them, two or one of each stratum by md5."""
    from pyspark.sql.window import Window

    t = _Tables(spark, d)
    direct = t.hits.where("decision = 'direct'").select("row_id", F.col("keyword_code").alias("other"), F.col("topic_code").alias("topic"))
    conditional = t.hits.where("decision = 'conditional'").select("row_id", "keyword_code", "families")
    tied = conditional.join(direct, "row_id", "left").groupBy("row_id", "keyword_code").agg(
        F.coalesce(F.bool_or(F.col("other").isNotNull() & (F.col("other") != F.col("keyword_code"))
        & ((F.size("families") == 0) | F.array_contains("families", F.col("topic")))), F.lit(False)).alias("compatible")
    )
    rows = tied.join(t.population.select("row_id", "doc_id"), "row_id")
    order = Window.partitionBy("keyword_code", "compatible").orderBy(F.md5(F.concat("doc_id", "keyword_code", F.lit("tq-2"))), "doc_id")
    ranked = rows.withColumn("sample_rank", F.row_number().over(order))
    return ranked.where(F.col("sample_rank") <= F.when(F.col("compatible"), 2).otherwise(1)).select("keyword_code", "compatible", "doc_id", "sample_rank")


_BASE = """
WITH obs AS (SELECT row_id, keyword_id, max(coalesce(score, 0)) AS score FROM observations
             WHERE row_id IS NOT NULL AND trim(keyword_id) <> '' GROUP BY ALL),
lookup AS (SELECT keyword_id, min(keyword_code) AS keyword_code
           FROM (SELECT unnest(string_split(source_keyword_ids, ' | ')) AS keyword_id, keyword_code FROM keyword_aliases) GROUP BY ALL),
rules AS (SELECT keyword_code, canonical_name, decision, topic_code,
                 coalesce(regexp_extract_all(conditional_anchor_topics, 'KWD-T[0-9]+'), []) AS families FROM keyword_dictionary),
held AS (SELECT row_id, keyword_id FROM obs WHERE row_id % 97 = 0 AND md5(keyword_id) < '4'),
coded AS (SELECT * FROM obs JOIN lookup USING (keyword_id)),
allhits AS (SELECT * FROM coded JOIN rules USING (keyword_code) WHERE decision IN ('direct', 'conditional') AND topic_code <> ''),
hits AS (SELECT * FROM allhits ANTI JOIN held USING (row_id, keyword_id)),
anchors AS (SELECT row_id, list(DISTINCT topic_code ORDER BY topic_code) AS anchor_topics FROM hits WHERE decision = 'direct' GROUP BY ALL),
eligible AS (SELECT * FROM hits JOIN anchors USING (row_id)
             WHERE decision = 'direct' OR len(families) = 0 OR list_has_any(families, anchor_topics)),
related AS (SELECT row_id, topic_code, bool_or(decision = 'direct') AS has_direct_hit,
                   string_agg(DISTINCT keyword_code, '|' ORDER BY keyword_code) AS matched_codes,
                   string_agg(DISTINCT canonical_name, '|' ORDER BY canonical_name) AS matched_names FROM eligible GROUP BY ALL),
assigned AS (SELECT row_id, doc_id, coalesce(raw_keyword_count, 0) AS raw_keyword_count,
                    coalesce(canonical_keyword_count, 0) AS canonical_keyword_count, coalesce(topic_count, 0) AS topic_count,
                    coalesce(topic_codes, '') AS topic_codes, NOT retracted AND NOT template_record AS quality_eligible,
                    CASE WHEN topic_count > 0 THEN 'assigned' WHEN raw_keyword_count IS NULL THEN 'no_keywords'
                         WHEN conditional THEN 'conditional_only_without_anchor' ELSE 'no_active_dictionary_keyword' END AS classification_status
             FROM population
             LEFT JOIN (SELECT row_id, count(*) AS raw_keyword_count FROM obs GROUP BY ALL) USING (row_id)
             LEFT JOIN (SELECT row_id, count(DISTINCT keyword_code) AS canonical_keyword_count FROM coded GROUP BY ALL) USING (row_id)
             LEFT JOIN (SELECT row_id, bool_or(decision = 'conditional') AS conditional FROM hits GROUP BY ALL) USING (row_id)
             LEFT JOIN (SELECT row_id, count(*) AS topic_count, string_agg(topic_code, '|' ORDER BY topic_code) AS topic_codes
                        FROM related GROUP BY ALL) USING (row_id)
             WHERE source = 'paper'),
papers AS (SELECT count(*) AS n FROM population WHERE source = 'paper'),
terms AS (SELECT keyword_id, df AS document_frequency, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf
          FROM (SELECT keyword_id, count(DISTINCT row_id) AS df FROM obs GROUP BY ALL), papers WHERE df >= 10 AND df <= 0.5 * n),
w AS (SELECT row_id, keyword_id, score * idf AS w FROM obs JOIN terms USING (keyword_id) WHERE score > 0),
unit AS (SELECT row_id, keyword_id, w / sqrt(sum(w * w) OVER (PARTITION BY row_id)) AS weight FROM w),
allrelated AS (SELECT row_id, topic_code, bool_or(decision = 'direct') AS has_direct_hit FROM
               (SELECT h.*, anchor_topics FROM allhits h JOIN (SELECT row_id, list(DISTINCT topic_code) AS anchor_topics FROM allhits
                WHERE decision = 'direct' GROUP BY ALL) USING (row_id)
                WHERE decision = 'direct' OR len(families) = 0 OR list_has_any(families, anchor_topics)) GROUP BY ALL)
"""

SQL = {k: _BASE + v for k, v in {
    "kwd_candidate_hits": "SELECT row_id, keyword_id, keyword_code, decision, topic_code FROM hits",
    "kwd_anchors": "SELECT row_id, array_to_string(anchor_topics, '|') AS anchor_topics FROM anchors",
    "kwd_eligible": "SELECT row_id, keyword_id, decision, topic_code FROM eligible",
    "kwd_relations": "SELECT * FROM related",
    "kwd_assignments": "SELECT * FROM assigned",
    "kwd_topic_counts": """SELECT topic_code, count(*) AS documents, count(*) FILTER (WHERE has_direct_hit) AS direct_documents,
        count(*) FILTER (WHERE NOT has_direct_hit) AS conditional_documents,
        count(*) FILTER (WHERE quality_eligible) AS quality_eligible_documents FROM related JOIN assigned USING (row_id) GROUP BY ALL""",
    "kwd_topics_per_doc": "SELECT topic_count, count(*) AS papers FROM assigned GROUP BY ALL",
    "kwd_status_counts": "SELECT classification_status, count(*) AS papers FROM assigned GROUP BY ALL",
    "kwd_version_compare": """SELECT topic_code, coalesce(a, 0) AS documents_before, coalesce(b, 0) AS documents, coalesce(b, 0) - coalesce(a, 0) AS document_delta
        FROM (SELECT topic_code, count(*) AS a FROM allrelated GROUP BY ALL) FULL JOIN (SELECT topic_code, count(*) AS b FROM related GROUP BY ALL) USING (topic_code)""",
    "kwd_list_edge_reconcile": """SELECT count(*) FILTER (WHERE e.topic_code IS NULL) AS only_in_lists, count(*) FILTER (WHERE l.topic_code IS NULL) AS only_in_edges,
        count(*) AS pairs FROM (SELECT row_id, unnest(string_split(topic_codes, '|')) AS topic_code FROM assigned WHERE topic_codes <> '') l
        FULL JOIN related e USING (row_id, topic_code)""",
    "kwd_md5_sample": """SELECT topic_code, doc_id, sample_rank::INT AS sample_rank FROM (SELECT topic_code, doc_id, row_number() OVER
        (PARTITION BY topic_code ORDER BY md5(concat(doc_id, topic_code, 'tq-1')), doc_id) AS sample_rank FROM related JOIN population USING (row_id)) WHERE sample_rank <= 5""",
    "kwd_regression": """SELECT a.row_id, a.topic_code, r.row_id IS NOT NULL AS still_assigned FROM allrelated a LEFT JOIN related r USING (row_id, topic_code)
        WHERE a.has_direct_hit""",
    "kwd_withheld_check": """SELECT (SELECT count(*) FROM held) AS withheld_pairs, (SELECT count(*) FROM held SEMI JOIN obs USING (row_id, keyword_id)) AS observed_pairs,
        (SELECT count(*) FROM held SEMI JOIN hits USING (row_id, keyword_id)) AS still_triggering""",
    "vocabulary_idf": "SELECT keyword_id, document_frequency, round(idf, 6) AS idf FROM terms",
    "tfidf_l2": "SELECT row_id, keyword_id, round(weight, 6) AS weight FROM unit",
    "feature_mask_renorm": """SELECT row_id, keyword_id, round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY row_id)), 6) AS weight FROM unit
        WHERE keyword_id NOT IN (SELECT keyword_id FROM terms ORDER BY document_frequency DESC, keyword_id LIMIT 20)""",
    "unobserved_terms": "SELECT keyword_code, canonical_name, decision FROM keyword_dictionary ANTI JOIN coded USING (keyword_code)",
    "lookup_document": """SELECT doc_id, classification_status, quality_eligible, topic_code, coalesce(has_direct_hit, false) AS has_direct_hit, matched_codes
        FROM assigned LEFT JOIN related USING (row_id) WHERE row_id % 100 = 0""",
    "stratified_context_queue": """, tied AS (SELECT c.row_id, c.keyword_code, coalesce(bool_or(a.keyword_code IS NOT NULL AND a.keyword_code <> c.keyword_code
            AND (len(c.families) = 0 OR list_contains(c.families, a.topic_code))), false) AS compatible
        FROM (SELECT * FROM hits WHERE decision = 'conditional') c LEFT JOIN (SELECT * FROM hits WHERE decision = 'direct') a USING (row_id) GROUP BY ALL)
        SELECT keyword_code, compatible, doc_id, r::INT AS sample_rank FROM (SELECT *, row_number() OVER (PARTITION BY keyword_code, compatible
            ORDER BY md5(concat(doc_id, keyword_code, 'tq-2')), doc_id) AS r FROM tied JOIN population USING (row_id)) WHERE r <= CASE WHEN compatible THEN 2 ELSE 1 END""",
}.items()} | {
    "keyword_parse_json": NODES + "SELECT snapshot_id, count(*) AS keywords, count(DISTINCT keyword_id) AS distinct_keywords FROM keywords GROUP BY snapshot_id",
    "alias_counts": """SELECT keyword_id, trim(raw_name) AS raw_name, sum(occurrences)::BIGINT AS occurrences FROM alias_fragments
        WHERE trim(keyword_id) <> '' AND trim(raw_name) <> '' GROUP BY ALL""",
    "preferred_alias": """SELECT keyword_id, raw_name, occurrences FROM (SELECT *, row_number() OVER (PARTITION BY keyword_id ORDER BY occurrences DESC, raw_name) AS r FROM
        (SELECT keyword_id, trim(raw_name) AS raw_name, sum(occurrences)::BIGINT AS occurrences FROM alias_fragments
        WHERE trim(keyword_id) <> '' AND trim(raw_name) <> '' GROUP BY ALL)) WHERE r = 1""",
    "obs_integrity": """SELECT (SELECT count(*) FROM observations ANTI JOIN population USING (row_id)) AS orphans,
        (SELECT count(*) FROM (SELECT 1 FROM observations GROUP BY row_id, keyword_id HAVING count(*) > 1)) AS repeated_pairs,
        (SELECT count(*) FROM observations) AS observations, (SELECT count(*) FROM observations WHERE coalesce(trim(keyword_id), '') = '') AS without_keyword""",
    "population_check": """SELECT count(*) AS records, count(DISTINCT row_id) AS distinct_rows, count(DISTINCT doc_id) AS distinct_documents,
        min(row_id) AS least_row, max(row_id) AS greatest_row, min(row_id) = 0 AND max(row_id) = count(*) - 1 AND count(DISTINCT row_id) = count(*)
        AND count(DISTINCT doc_id) = count(*) AS sound FROM population""",
    "dict_decision_cascade": """SELECT CASE WHEN decision IN ('direct', 'conditional') THEN decision WHEN regexp_matches(canonical_name, 'film|membrane|coating|fluid') THEN 'material'
        WHEN regexp_matches(canonical_name, 'turbine|burner|converter|reactor|valve') THEN 'machine' WHEN regexp_matches(canonical_name, 'tariff|offset|market|policy') THEN 'policy'
        ELSE 'other' END AS rule, decision, count(*) AS entries FROM keyword_dictionary GROUP BY ALL""",
    "synonym_canonical": """WITH v AS (SELECT keyword_id, lower(trim(regexp_replace(raw_name, '[-]+| +', ' ', 'g'))) AS name FROM vocab)
        SELECT keyword_id, min(keyword_id) OVER (PARTITION BY name) AS canonical_id FROM v WHERE name IS NOT NULL""",
    "snapshot_dedupe": """WITH r AS (SELECT *, upper(regexp_extract(work_id, '(?i)(W[0-9]+)', 1)) AS work,
        (json_valid(raw_keywords) AND coalesce(json_type(CASE WHEN json_valid(raw_keywords) THEN raw_keywords END) = 'ARRAY', false)
         AND coalesce(json_array_length(CASE WHEN json_valid(raw_keywords) THEN raw_keywords END), 0) > 0) IS TRUE OR trim(coalesce(keywords, '')) <> '' AS valid FROM chosen)
        SELECT work, snapshot_id, valid AS has_valid_keywords FROM (SELECT *, row_number() OVER (PARTITION BY work ORDER BY valid DESC, coalesce(raw_updated_date, '') DESC,
        source_file NULLS LAST, raw_keywords NULLS LAST, snapshot_id) AS k FROM r WHERE work <> '') WHERE k = 1""",
}

QUERIES = {f.__name__: f for f in (
    kwd_candidate_hits, kwd_anchors, kwd_eligible, kwd_relations, kwd_assignments, kwd_topic_counts, kwd_topics_per_doc,
    kwd_status_counts, kwd_version_compare, kwd_list_edge_reconcile, kwd_md5_sample, kwd_regression,
    kwd_withheld_check, vocabulary_idf, tfidf_l2, feature_mask_renorm, snapshot_dedupe, alias_counts, preferred_alias, keyword_parse_json,
    obs_integrity, population_check, dict_decision_cascade, synonym_canonical, unobserved_terms, lookup_document,
    stratified_context_queue,
)}
