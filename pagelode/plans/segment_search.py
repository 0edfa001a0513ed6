"""Search over a segmented index: blocks by their largest scores, then the hits of those that matter.

Queries with the same words are searched once. For every query, the largest count and shortest field of each
block of postings bound what a document there can score. The best-bounded blocks are scored first; the score
of their last result in the pool is what a block's bound has to reach for its hits to be read at all.
Hits travel as one row per query, term and block, and are scored where those rows meet, so no hit
is shuffled by its document. Results are those of a search of a fresh index over the live documents.

What is brought to the driver or broadcast is counted in rows first, whatever the number of queries and of
distinct terms; beyond the bound the same plan goes on with stored tables and ordinary joins.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.functions import text
from pagelode.operators import ranking, spread, vocabulary
from pagelode.options import SearchOptions
from pagelode.plans.segments import SegmentIndex, shard_of
from pagelode.session import shuffles_released, through_table, workdir

# Distinct query terms that walk the vocabulary; more are matched by keys.
FEW_TERMS = 100
# Rows that are brought to the driver and go on inside the plan.
HELD_ROWS = 5000
# Values written into a plan, so that the scans skip what has none of them.
LITERALS = 500
# Blocks per query that are scored before the others are judged.
SEED_BLOCKS = 4
# Up to so many blocks of all queries are scored at once, without judging them.
DIRECT_BLOCKS = 64


@dataclass(frozen=True)
class Held:
    """Rows worked out once: in the plan and at hand if they are few, else a stored table."""

    rows: DataFrame
    listed: pa.Table | None
    among: int = 0  # how many rows these were chosen from

    def count(self) -> int:
        return self.rows.count() if self.listed is None else self.listed.num_rows

    @property
    def side(self) -> DataFrame:
        """For a join: broadcast if few."""
        return self.rows if self.listed is None else F.broadcast(self.rows)

    def values(self, column: str, most: int = LITERALS) -> list | None:
        """Its distinct values, sorted, if they are at most that many."""
        if self.listed is None:
            return None
        found = sorted(set(self.listed.column(column).to_pylist()))
        return found if len(found) <= most else None


def held(rows: DataFrame, label: str, bound: int | None = None, among: int = 0) -> Held:
    spark, bound = rows.sparkSession, HELD_ROWS if bound is None else bound
    with shuffles_released(spark):
        got = rows.limit(bound + 1).toArrow()
        if got.num_rows > bound:
            return Held(through_table(rows, workdir(spark, label)), None, among)
    return Held(spark.createDataFrame(got, rows.schema), got, among)


def distinct_queries(queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`queries` (query_id, q) with `words`, their sorted terms, and the terms of each distinct `words`
    (as query_id): query_id, qterm, qtf. Queries without a term have no words."""
    words = F.array_join(F.array_sort(text.tokens(F.col("q"))), " ")
    named = queries.select("query_id", words.alias("words")).where("words <> ''")
    terms = named.select("words").distinct().select(F.col("words").alias("query_id"), F.explode(F.split("words", " ")).alias("qterm"))
    return named, terms.groupBy("query_id", "qterm").agg(F.count(F.lit(1)).alias("qtf"))


def found_terms(index: SegmentIndex, terms: Held) -> DataFrame:
    """Vocabulary terms near the distinct `qterm`s: field, qterm, term, df, edits."""
    few = terms.values("qterm", FEW_TERMS)
    if few is not None:
        return vocabulary.near_terms(few, index.vocab, index.prefixes)
    live = through_table(index.vocabulary(), workdir(index.spark, "vocabulary"))
    return ranking.fuzzy_terms(terms.rows.select("qterm").distinct(), live)


def bucket_sizes(index: SegmentIndex) -> list[int]:
    return sorted({s.buckets for s in index.segments})


def asked_terms(index: SegmentIndex, terms: Held, options: SearchOptions) -> Held:
    """What distinct queries look up: query_id, qterm, qtf, field, term, weight, shared_df, and the term's
    bucket for every number of buckets that segments have."""
    expanded = ranking.expansions(found_terms(index, terms), options)
    buckets = [ranking.bucket_of(F.col("term"), n).alias(f"_in_{n}") for n in bucket_sizes(index)]
    return held(ranking.asked_terms(expanded, terms.rows).select("*", *buckets), "asked")


def asked_postings(index: SegmentIndex, asked: Held, columns: list[str]) -> DataFrame:
    """Blocks of postings of the asked terms, once per query that asks; folders and row groups without one of
    a few terms are skipped."""
    rows, words = index.postings.select("segment", "bucket", "field", "term", "block", *columns), asked.values("term")
    if words is not None:
        inside = F.lit(False)
        for n in bucket_sizes(index):
            numbers = [s.number for s in index.segments if s.buckets == n]
            inside = inside | (F.col("segment").isin(numbers) & F.col("bucket").isin(asked.values(f"_in_{n}")))
        rows = rows.where(F.col("term").isin(words) & inside)
    return rows.join(asked.side, ["field", "term"])


def _best(rows: DataFrame, stats: DataFrame, options: SearchOptions, keys: list[str]) -> DataFrame:
    """Per key, twice the title's sum or the content's, the larger one, as `best`."""
    # One row per field, so this join is on a constant-size table.
    parts = rows.join(F.broadcast(stats), "field").withColumn("part", ranking.bm25(options))
    sums = [F.sum(F.when(F.col("field") == f, F.col("part")).otherwise(0.0)).alias(f"_{f}") for f in ranking.FIELDS]
    best = F.greatest(F.lit(options.title_boost) * F.col("_title"), F.col("_content"))
    return parts.groupBy(*keys).agg(*sums).select(*keys, best.alias("best"))


def block_bounds(index: SegmentIndex, asked: Held, stats: DataFrame, options: SearchOptions) -> DataFrame:
    """query_id, segment, block, best: no document of the block scores more for the query. The score of a hit
    rises with its count and falls with the field's length. No hits are read."""
    rows = asked_postings(index, asked, ["max_tf", "min_dl"]).withColumnsRenamed({"max_tf": "tf", "min_dl": "dl"})
    return _best(rows, stats, options, ["query_id", "segment", "block"])


def scored_blocks(index: SegmentIndex, asked: Held, stats: DataFrame, options: SearchOptions, blocks: Held | None = None) -> DataFrame:
    """Scores of live documents, query_id, segment, doc, score, in the given (query_id, segment, block) or
    in all. Rows of a query and block meet in one task, with at most a block's documents per term; how many
    tasks there are follows the number of given blocks."""
    rows, on = asked_postings(index, asked, ["hits"]), ["query_id", "segment", "block"]
    n_blocks = 0 if blocks is None else blocks.count()
    size = max([min(2 ** s.block_bits, s.n_docs) for s in index.segments], default=0)
    if blocks is not None and blocks.listed is not None:
        met = spread.dealt(rows.join(blocks.side, on), n_blocks * size, ranking.HIT_ROWS, *on, always=True)
    else:
        # A join that shuffles meets all blocks, those that are not needed too.
        met = spread.dealt(rows, max(n_blocks, blocks.among if blocks else 0) * size, ranking.HIT_ROWS, *on, always=True)
        met = met if blocks is None else met.join(blocks.rows, on)
    best = _best(index.hits(met.select(*on, "field", "qtf", "weight", "shared_df", "hits")), stats, options, [*on, "doc"])
    return index.without_dead(best.select("query_id", "segment", "doc", F.round("best", 6).alias("score")), n_blocks * size)


def needed_blocks(index: SegmentIndex, asked: Held, stats: DataFrame, options: SearchOptions,
                  seeds: int = SEED_BLOCKS, direct: int = DIRECT_BLOCKS) -> Held | None:
    """The (query_id, segment, block) whose hits have to be read; None for all."""
    bounds = held(block_bounds(index, asked, stats, options), "bounds")
    if bounds.listed is not None and bounds.listed.num_rows <= direct:
        return None
    order = W.partitionBy("query_id").orderBy(F.desc("best"), "segment", "block")
    first = bounds.rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= seeds).select("query_id", "segment", "block")
    n_blocks = bounds.count()
    first = held(first, "first", among=n_blocks)
    pool = ranking.search_rank(scored_blocks(index, asked, stats, options, first), options.pool_size, "doc")
    # Fewer results than the pool holds say nothing about the other blocks.
    last = pool.where(F.col("rank") == options.pool_size).select("query_id", F.col("score").alias("_last"))
    reach = F.col("best") * (1 + 1e-9) + 1e-6 >= F.coalesce("_last", F.lit(0.0))
    return held(bounds.rows.join(last, "query_id", "left").where(reach).select("query_id", "segment", "block"), "blocks", among=n_blocks)


def with_docs(rows: Held, index: SegmentIndex, columns: list[str]) -> DataFrame:
    """Join rows (segment, shard, doc, ...) to columns of their documents; few rows are looked up by value."""
    docs, numbers = index.docs.select("segment", "shard", "doc", *columns), rows.values("doc")
    if numbers is not None:
        docs = docs.where(F.col("segment").isin(rows.values("segment")) & F.col("shard").isin(rows.values("shard")) & F.col("doc").isin(numbers))
    return docs.join(rows.side, ["segment", "shard", "doc"])


def search_pool(index: SegmentIndex, queries: DataFrame, options: SearchOptions = SearchOptions(),
                seeds: int = SEED_BLOCKS, direct: int = DIRECT_BLOCKS) -> tuple[DataFrame, DataFrame, bool]:
    """The queries' words; the best documents per distinct words (as query_id): query_id, segment, shard, doc,
    score, url, rank; and whether they are few, in which case they have title and content too.

    Numbers of documents rise with the URL inside a segment, so the best of each segment need no URL; ties
    between segments are told apart by it.
    """
    named, terms = distinct_queries(queries)
    terms = held(terms, "terms")
    asked = asked_terms(index, terms, options)
    stats = index.field_stats().select("field", "n_docs", "avgdl")
    scores = scored_blocks(index, asked, stats, options, needed_blocks(index, asked, stats, options, seeds, direct))
    inside = W.partitionBy("query_id", "segment").orderBy(F.desc("score"), "doc")
    best = held(scores.withColumn("_place", F.row_number().over(inside)).where(F.col("_place") <= options.pool_size).select(
        "query_id", "segment", shard_of(F.col("doc")).alias("shard"), "doc", "score"), "best")
    few = best.listed is not None
    found = with_docs(best, index, ["url", "title", "content"] if few else ["url"])
    return named, ranking.search_rank(found, options.pool_size, "url"), few


def search(index: SegmentIndex, queries: DataFrame, options: SearchOptions = SearchOptions(),
           seeds: int = SEED_BLOCKS, direct: int = DIRECT_BLOCKS) -> DataFrame:
    """Results as shown: `query_id, position, url, title, preview, score`."""
    named, pool, few = search_pool(index, queries, options, seeds, direct)
    top = ranking.search_top(pool, options)
    if not few:
        top = with_docs(Held(top, None), index, ["title", "content"])
    title, shown = ranking.result_projection(F.col("title"), F.col("content"), options.preview_chars)
    top = top.select(F.col("query_id").alias("words"), "position", "url", title, shown, "score")
    # A query that is asked many times is joined to its few results.
    return named.join(F.broadcast(top) if few else top, "words").drop("words")
