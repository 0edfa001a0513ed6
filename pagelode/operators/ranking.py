"""Text index and ranked, typo-tolerant search for a table of queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.functions import edits, text, urls
from pagelode.operators import spread
from pagelode.options import SearchOptions

FIELDS = ("title", "content")


def token_rows(docs: DataFrame, key: str = "url", fields=FIELDS) -> DataFrame:
    """One row per token: key, field, length of the field in tokens, position, term."""
    parts = docs.select(key, F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), text.tokens(F.col(f)).alias("terms")) for f in fields
    ])).alias("p"))
    return parts.select(key, "p.field", F.size("p.terms").alias("dl"), F.posexplode("p.terms").alias("pos", "term"))


# Text per task that counts tokens: its counts are some 20 to 40 times as large in memory.
PART_BYTES = 8 * 2**20
# Text per task that puts documents in order.
DOC_BYTES = 64 * 2**20
# Hits per task where they meet by document.
HIT_ROWS = 500_000


def text_bytes(docs: DataFrame, fields=FIELDS) -> int:
    """Bytes of the fields, from a scan of the documents."""
    size = sum((F.coalesce(F.octet_length(f), F.lit(0)).cast("long") for f in fields), F.lit(0).cast("long"))
    return docs.agg(F.sum(size)).first()[0] or 0


def postings(docs: DataFrame, key: str = "url", fields=FIELDS, n_bytes: int | None = None) -> DataFrame:
    """Term counts per document and field.

    Documents are dealt out by their key before they are cut into tokens. The counts need the
    same partitioning, so it is the text that is shuffled, once, and not the tokens. There are as many
    parts as the text needs (`n_bytes`, summed up here unless it is known), so that the counts of one task do
    not grow with the corpus.
    `opens` marks the posting of a field's first token: exactly one per document and field.
    """
    n_bytes = text_bytes(docs, fields) if n_bytes is None else n_bytes
    dealt = docs.repartition(max(1, -(-n_bytes // PART_BYTES)), key)
    return token_rows(dealt, key, fields).groupBy(key, "field", "dl", "term").agg(
        F.count(F.lit(1)).alias("tf"), (F.min("pos") == 0).alias("opens"))


def field_stats(postings: DataFrame) -> DataFrame:
    """Documents that have the field and their mean length: one row per field. Documents are
    counted by their opening posting, so no distinct count is needed."""
    return postings.groupBy("field").agg(
        F.count_if(F.col("opens")).alias("n_docs"), F.sum("tf").alias("n_tokens"),
    ).withColumn("avgdl", F.col("n_tokens") / F.col("n_docs"))


def vocabulary(postings: DataFrame) -> DataFrame:
    """Document frequency and total count per field and term; a hot term combines early."""
    return postings.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total_tf"))


def query_terms(queries: DataFrame) -> DataFrame:
    """Terms of each query with their count. Empty and blank queries give none."""
    return queries.select("query_id", F.explode(text.tokens(F.col("q"))).alias("qterm")).groupBy(
        "query_id", "qterm").agg(F.count(F.lit(1)).alias("qtf"))


# Up to this many terms, their keys (some 300 per term at most) are a few ten MB and may be broadcast.
SMALL_QUERY_TERMS = 2000
# Up to this many terms are compared with the vocabulary of their lengths; beyond, keys are cheaper.
FEW_TERMS = 100
# Up to this many terms are also written into the plan, so that the scans skip what has none of them.
LITERAL_TERMS = 500
# Terms of more letters count as of that many where the vocabulary is kept by length.
LONGEST = 100


def bucket_of(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def few_terms(terms: DataFrame, vocab: DataFrame) -> DataFrame:
    """Vocabulary terms within the allowed edits of a few query terms, per field.

    One scan of the vocabulary, in which a term meets the query terms of about its length. `terms`
    has distinct `qterm`, at most `FEW_TERMS`; `vocab` has the `size` of its terms.
    """
    most = edits.allowed_edits(F.col("qterm"))
    sizes = F.transform(F.sequence(F.length("qterm") - most, F.length("qterm") + most), lambda n: F.least(n, F.lit(LONGEST)))
    asked = terms.select("qterm", most.alias("_most"), F.explode(F.array_distinct(sizes)).alias("size"))
    met = vocab.join(F.broadcast(asked), "size").where(F.levenshtein("term", "qterm", 4).between(0, 2 * F.col("_most")))
    return met.withColumn("edits", edits.edits(F.col("qterm"), F.col("term"))).where(F.col("edits") <= F.col("_most")) \
        .select("field", "qterm", "term", "df", "edits")


def fuzzy_terms(terms: DataFrame, vocab: DataFrame, small: bool = False) -> DataFrame:
    """Vocabulary terms within the allowed edits of each query term, per field.

    `terms` has distinct `qterm`. Both sides emit keys that any two terms within reach
    share, so candidates come from an equality join and only they are measured. With `small`
    the query side is broadcast and the vocabulary is not shuffled.
    """
    give = F.broadcast if small else (lambda df: df)
    exact = vocab.join(give(terms), vocab.term == terms.qterm).select(
        "field", "qterm", "term", "df", F.lit(0).alias("edits"))
    wide = terms.withColumn("qlen", F.length("qterm")).where(F.col("qlen") > 2)
    asked = edits.match_keys(
        wide.select("qterm", edits.key_class(F.col("qlen")).alias("cls")), "qterm", True)
    # Distinct lengths of query terms: one short array.
    sizes = wide.agg(F.collect_set("qlen")).scalar()
    # A term of both fields is offered twice; that is cheaper than a shuffle of the vocabulary.
    words = vocab.select("term").withColumn("sizes", sizes).select(
        "term", F.explode(edits.reachable_classes(F.col("term"), F.col("sizes"))).alias("cls"))
    offered = edits.match_keys(words, "term", False)
    pairs = offered.join(give(asked), ["cls", "key"]).where(F.col("term") != F.col("qterm")) \
        .where(F.levenshtein("term", "qterm", 4) >= 0).select("qterm", "term").distinct()
    measured = pairs.withColumn("edits", edits.edits(F.col("qterm"), F.col("term"))) \
        .where(F.col("edits") <= edits.allowed_edits(F.col("qterm")))
    fuzzy_hits = measured.join(vocab, "term").select("field", "qterm", "term", "df", "edits")
    return exact.unionByName(fuzzy_hits)


def expansions(matches: DataFrame, options: SearchOptions = SearchOptions()) -> DataFrame:
    """At most 50 terms per query term and field, nearest first, with their weight and the
    largest document frequency among them."""
    shorter = F.least(F.length("term"), F.length("qterm"))
    weight = F.lit(1.0) - F.col("edits") / shorter
    nearest = W.partitionBy("field", "qterm").orderBy("edits", F.desc("weight"), "term")
    kept = matches.withColumn("weight", weight).where(F.col("weight") > 0) \
        .withColumn("_place", F.row_number().over(nearest)).where(F.col("_place") <= options.max_expansions)
    return kept.withColumn("shared_df", F.max("df").over(W.partitionBy("field", "qterm"))).drop("_place")


def asked_terms(expanded: DataFrame, terms: DataFrame) -> DataFrame:
    """Expanded terms of every query: what is looked up in the postings. Their `df` adds up to the hits."""
    return expanded.join(terms, "qterm").select(
        "query_id", "qterm", "qtf", "field", "term", "weight", "df", "shared_df")


def postings_join(postings: DataFrame, asked: DataFrame, small: bool = False) -> DataFrame:
    """Postings of every asked term, once per query that asks for it. With `small` the asked
    terms are broadcast; a `term_bucket` column in both also prunes what is read."""
    on = ["field", "term"] + (["term_bucket"] if "term_bucket" in asked.columns else [])
    return postings.join(F.broadcast(asked) if small else asked, on)


def bm25(options: SearchOptions = SearchOptions()) -> Column:
    n, df, f = F.col("n_docs"), F.col("shared_df"), F.col("tf")
    idf = F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))
    length = F.lit(1.0 - options.b) + F.lit(options.b) * F.col("dl") / F.col("avgdl")
    return F.lit(options.k1 + 1) * F.col("qtf") * F.col("weight") * idf * f / (f + F.lit(options.k1) * length)


def document_scores(hits: DataFrame, stats: DataFrame, options: SearchOptions = SearchOptions(),
                    key: str = "url", n_hits: int = 0) -> DataFrame:
    """Best field per document: twice the title score or the content score. `n_hits`, if known, bounds the hits of
    a task."""
    # One row per field, so this join is on a constant-size table.
    parts = hits.join(F.broadcast(stats), "field").select("query_id", key, "field", bm25(options).alias("part"))
    rows = spread.dealt(parts, n_hits, HIT_ROWS, "query_id", key)
    by_field = [F.sum(F.when(F.col("field") == f, F.col("part")).otherwise(0.0)).alias(f"_{f}") for f in FIELDS]
    best = F.greatest(F.lit(options.title_boost) * F.col("_title"), F.col("_content"))
    return rows.groupBy("query_id", key).agg(*by_field).select(
        "query_id", key, F.round(best, 6).alias("score"))


def search_rank(scores: DataFrame, size: int, key: str = "url") -> DataFrame:
    """The `size` best documents per query. The cut is also made before the shuffle, so even
    a query that hits every document sends `size` rows per task."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), key)
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def result_dedupe(hits: DataFrame) -> DataFrame:
    """First hit per URL without its fragment. Expects at most a pool of hits per query."""
    bare = hits.withColumn("url", F.split_part("url", F.lit("#"), F.lit(1))).where(F.col("url") != "")
    return bare.groupBy("query_id", "url").agg(
        *[F.min_by(c, "rank").alias(c) for c in bare.columns if c not in ("query_id", "url", "rank")],
        F.min("rank").alias("rank"))


def search_top(pool: DataFrame, options: SearchOptions = SearchOptions()) -> DataFrame:
    """Of the pool of 50: trusted ones, each URL once, the first 10. Hits outside the pool
    never move up."""
    trusted = pool.where(urls.trusted_url(F.split_part("url", F.lit("#"), F.lit(1)), options.trusted_domains))
    unique = result_dedupe(trusted)
    place = W.partitionBy("query_id").orderBy("rank")
    return unique.withColumn("position", F.row_number().over(place)).where(
        F.col("position") <= options.result_size)


def result_projection(title: Column, content: Column, chars: int = 200) -> list[Column]:
    return [F.coalesce(title, F.lit("No Title")).alias("title"), text.preview(content, chars).alias("preview")]
