"""Tokens, counts, class TF-IDF, text views and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: English words that carry no topic.
STOP = ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "this", "are", "at", "from", "or", "an"]
SENTENCE = r"[.!?;\n。！？；]+"


def sentences_tokens(text: Column) -> Column:
    """Sentences as lists of words; hyphens separate, stop words and single letters leave. Chinese runs give their pairs
    of neighbouring characters in place of dictionary words."""
    words = lambda s: F.filter(
        F.flatten(F.transform(F.regexp_extract_all(s, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), _pieces)), lambda w: (F.length(w) >= 2) & ~w.isin(STOP)
    )
    return F.transform(F.split(F.lower(text), SENTENCE), words)


def _pieces(run: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(run) - 1, F.lit(1))), lambda i: F.substring(run, i, F.lit(2)))
    return F.when(run.rlike(r"^\p{IsHan}+$"), pairs).otherwise(F.array(run))


def terms(text: Column) -> Column:
    """Words and pairs of neighbouring words inside a sentence."""
    pairs = lambda s: F.when(
        F.size(s) >= 2, F.zip_with(F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s) - 1), lambda a, b: F.concat_ws(" ", a, b))
    ).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(sentences_tokens(text), lambda s: F.concat(s, pairs(s))))


def bag_of_words(documents: DataFrame, *keep: str) -> DataFrame:
    """(keep, term, n)."""
    long = documents.where("text IS NOT NULL").select(*keep, F.explode(terms(F.col("text"))).alias("term"))
    return long.groupBy(*keep, "term").agg(F.count("*").alias("n"))


def class_tfidf(counts: DataFrame, group: str) -> DataFrame:
    """(group, term, weight): root of the share of the class's words, times ln(1 + words of a mean class / frequency). A null
    group is a class too."""
    classes = counts.groupBy(F.col(group).alias("class")).agg(F.sum("n").alias("words"))
    mean = classes.agg(F.floor(F.avg("words")).alias("mean"))
    frequency = counts.groupBy("term").agg(F.sum("n").alias("frequency"))
    rows = counts.join(frequency, "term").join(classes, F.col(group).eqNullSafe(F.col("class"))).crossJoin(mean)  # one row
    idf = F.log(1 + F.col("mean") / F.greatest("frequency", F.lit(1)))
    return rows.select(group, "term", (F.sqrt(F.col("n") / F.col("words")) * idf).alias("weight"))


def top_terms(weights: DataFrame, group: str, k: int = 20) -> DataFrame:
    order = Window.partitionBy(group).orderBy(F.desc(F.round("weight", 9)), "term")
    return weights.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def head_middle_tail(text: Column, limit: int = 4000) -> Column:
    """Long texts as their first half, a quarter from the middle and a quarter from the end of the limit."""
    half, quarter = limit // 2, limit // 4
    n = F.length(text)
    start = F.floor((n - quarter) / 2).cast("int") + 1
    parts = F.concat(F.left(text, F.lit(half)), F.lit("\n"), F.substring(text, start, F.lit(quarter)), F.lit("\n"), F.right(text, F.lit(quarter)))
    return F.when(n > limit, parts).otherwise(text)


def chunks(documents: DataFrame, width: int = 125, head: int = 4096) -> DataFrame:
    """(doc_id, source, chunk, n_tokens, weight): pieces of white-space tokens without overlap. A chunk weighs by its
    tokens; in policies the first ``head`` tokens count 0.6 and the whole 0.4."""
    tokens = F.filter(F.split("text", r"\s+"), lambda t: t != "")
    base = documents.where("text IS NOT NULL").select("doc_id", "source", F.size(tokens).alias("total")).where("total > 0")
    last = F.ceil(F.col("total") / width).cast("int") - 1
    rows = base.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    start = F.col("chunk") * width
    n = F.least(F.lit(width), F.col("total") - start)
    early = F.greatest(F.lit(0), F.least(F.lit(head) - start, n))
    weight = F.when(F.col("source") == "policy", 0.4 * n / F.col("total") + 0.6 * early / F.least(F.lit(head), F.col("total"))).otherwise(n / F.col("total"))
    return rows.select("doc_id", "source", "chunk", n.alias("n_tokens"), weight.alias("weight"))


def tokens(text: Column) -> Column:
    """White-space tokens; of null none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda t: t != "")


def encoder_view(title: Column, body: Column, source: Column, title_limit: int = 192, budget: int = 2044) -> Column:
    """What an encoder sees of a record, as (view, truncated): papers whole, title and body on lines of their own; of other
    sources the title's first tokens and, where the body is longer than the rest of the budget, its beginning, middle and
    end. Tokens are white-space tokens."""
    head, all_ = F.slice(tokens(title), 1, title_limit), tokens(body)
    left, n = budget - F.size(head), F.size(all_)
    third = F.floor(left / 3).cast("int")
    start = F.floor(n / 2).cast("int") - F.floor(third / 2).cast("int")
    end = left - 2 * third
    cut = F.concat(F.slice(all_, F.lit(1), third), F.slice(all_, start + 1, third), F.slice(all_, n - end + 1, end))
    long = n > left
    view = F.array_join(F.concat(head, F.when(long, cut).otherwise(all_)), " ")
    whole = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit("")))
    paper = source.eqNullSafe("paper")
    return F.struct(F.when(paper, whole).otherwise(view).alias("view"), (~paper & long).alias("truncated"))


def titled_chunks(records: DataFrame, width: int = 125, prefix: int = 24, head: int = 4096) -> DataFrame:
    """(doc_id, chunk, text, n_new, weight) of records (doc_id, source, title, body): short records whole; of others, pieces
    without overlap, each behind the title's first tokens. A chunk weighs by its new tokens; in policies the first ``head``
    tokens count 0.6 and the whole 0.4."""
    rows = records.select("doc_id", "source", tokens(F.col("title")).alias("t"), tokens(F.col("body")).alias("b"))
    rows = rows.select("*", F.concat("t", "b").alias("all")).withColumn("total", F.size("all")).where("total > 0")
    short = F.col("total") <= width
    rows = rows.withColumn("front", F.when(short, F.array().cast("array<string>")).otherwise(F.slice("t", 1, prefix)))
    rows = rows.withColumn("rest", F.slice("all", F.size("front") + 1, F.col("total"))).withColumn("step", width - F.size("front"))
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.size("rest") / F.col("step")).cast("int") - 1, F.lit(0)))))
    piece = F.slice("rest", F.col("chunk") * F.col("step") + 1, F.col("step"))
    new = F.size(piece) + F.when(F.col("chunk") == 0, F.size("front")).otherwise(0)
    before = F.when(F.col("chunk") == 0, 0).otherwise(F.size("front") + F.col("chunk") * F.col("step"))
    main = F.least(F.col("total"), F.lit(head))
    early = F.least(new, F.greatest(F.lit(0), main - before))
    policy = F.col("source").eqNullSafe("policy") & ~short
    weight = F.when(policy, 0.4 * new / F.col("total") + 0.6 * early / main).otherwise(new.cast("double"))
    return rows.select("doc_id", "chunk", F.array_join(F.concat("front", piece), " ").alias("text"), new.alias("n_new"), weight.alias("weight"))


def excerpt(text: Column, limit: int) -> Column:
    """(excerpt, truncated)."""
    return F.struct(F.left(text, F.lit(limit)).alias("excerpt"), (F.length(text) > limit).alias("truncated"))


#: How many documents of each source the vocabulary is drawn from.
QUOTAS = {"paper": 100_000, "patent": 40_000, "policy": 8_000}


def sampled_vocabulary(documents: DataFrame, quotas: dict[str, int] = QUOTAS, least: int = 3, most: int = 120_000) -> DataFrame:
    """(term, document_frequency, place) of the ``most`` most frequent terms in at least ``least`` of the sampled documents;
    the sample is its source's quota in md5 order."""
    limit = F.create_map(*(F.lit(x) for pair in quotas.items() for x in pair))[F.col("source")]
    order = Window.partitionBy("source").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
    drawn = documents.where(F.col("source").isin(list(quotas)) & F.col("text").isNotNull()).withColumn("drawn", F.row_number().over(order)).where(F.col("drawn") <= limit)
    counts = drawn.select("doc_id", F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("document_frequency"))
    top = counts.where(F.col("document_frequency") >= least).orderBy(F.desc("document_frequency"), "term").limit(most)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("document_frequency"), "term")))  # at most ``most`` rows


def fixed_counts(documents: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, place, n) of every document's terms that the vocabulary has."""
    return bag_of_words(documents, "doc_id").join(vocabulary.select("term", "place"), "term").select("doc_id", "place", "n")


def pooled(chunk_vectors: DataFrame) -> DataFrame:
    """(doc_id, embedding) at unit length from (doc_id, weight, embedding) of its chunks."""
    from tarnquill.operators.vectors import unit, vector_sums

    sums = vector_sums(chunk_vectors, "doc_id", F.col("weight"))
    return sums.select("doc_id", unit(F.col("total")).alias("embedding"))


#: Shares of influence that the sources are given.
SOURCE_MASS = {"paper": 0.70, "patent": 0.25, "policy": 0.05}


def source_weights(population: DataFrame) -> DataFrame:
    """(source, records, weight) so that the sources have their shares of mass and a paper weighs 1."""
    counts = population.where(F.col("source").isin(list(SOURCE_MASS))).groupBy("source").agg(F.count("*").alias("records"))
    mass = F.create_map(*(F.lit(x) for pair in SOURCE_MASS.items() for x in pair))[F.col("source")]
    papers = F.max(F.when(F.col("source") == "paper", F.col("records"))).over(Window.partitionBy())  # one row per source
    return counts.withColumn("weight", mass * papers / (SOURCE_MASS["paper"] * F.col("records")))
