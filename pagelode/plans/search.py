"""Search: a table of queries against the stored index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.operators import ranking, spread
from pagelode.options import SearchOptions
from pagelode.plans.index_build import TextIndex, doc_shard
from pagelode.session import through_table, workdir


def found_terms(index: TextIndex, terms: DataFrame) -> tuple[DataFrame, bool]:
    """Vocabulary terms of the distinct query terms, `field, qterm, term, df, edits`, and whether the
    terms are few.

    Terms are counted against a bound by reading one more than it. A few are compared with the
    vocabulary of their lengths, the only part that is read; more are found by keys.
    """
    spark = terms.sparkSession
    asked = [r.qterm for r in terms.limit(ranking.SMALL_QUERY_TERMS + 1).collect()]
    if len(asked) > ranking.SMALL_QUERY_TERMS:
        return ranking.fuzzy_terms(terms, index.vocab), False
    known = spark.createDataFrame([(t,) for t in asked], "qterm string")
    if len(asked) > ranking.FEW_TERMS:
        return ranking.fuzzy_terms(known, index.vocab, True), True
    sizes = sorted({min(n, ranking.LONGEST) for t in asked for n in range(len(t) - 2, len(t) + 3)})
    return ranking.few_terms(known, index.vocab.where(F.col("size").isin(sizes))), True


def looked_up(rows: DataFrame, words: list[str], buckets: list[int]) -> DataFrame:
    """Rows of a table by term bucket that may have the words: buckets are pruned, words pushed."""
    return rows.where(F.col("term_bucket").isin(buckets) & F.col("term").isin(words))


def asked_terms(index: TextIndex, queries: DataFrame,
                options: SearchOptions = SearchOptions(), path: str | None = None) -> tuple[DataFrame, bool]:
    """What the queries look up, stored, and whether it is small enough to be broadcast: a row per query,
    term and expansion, which are counted, since many queries may share few terms. The table is written to
    `path` (a new folder if none is given); it is of no use once the results are read."""
    terms = ranking.query_terms(queries)
    found, small = found_terms(index, terms.select("qterm").distinct())
    asked = ranking.asked_terms(ranking.expansions(found, options), terms).withColumn(
        "term_bucket", ranking.bucket_of(F.col("term"), index.buckets))
    # All weights are above 0; the filter lets the planner prune term buckets by this table.
    asked = through_table(asked, path or workdir(queries.sparkSession, "asked"))
    return asked.where(F.col("weight") > 0), small and spread.is_small(asked)


def term_hits(index: TextIndex, asked: DataFrame, small: bool) -> DataFrame:
    """Postings of the asked terms. A few are looked up by value."""
    if small:
        words = asked.select("term", "term_bucket").distinct().limit(ranking.LITERAL_TERMS + 1).collect()
        if len(words) <= ranking.LITERAL_TERMS:
            kept = looked_up(index.postings, sorted(r.term for r in words), sorted({r.term_bucket for r in words}))
            return ranking.postings_join(kept, asked, True)
    return ranking.postings_join(index.postings, asked, small)


def hit_count(asked: DataFrame) -> int:
    """How many rows `term_hits` has, from the document frequencies of the (stored) asked terms."""
    return asked.agg(F.sum("df")).first()[0] or 0


def search_pool(index: TextIndex, queries: DataFrame,
                options: SearchOptions = SearchOptions(), path: str | None = None) -> tuple[DataFrame, bool]:
    """The 50 best documents per query, `query_id, doc, score, rank`, and whether they are few enough to
    be broadcast: rows are counted by queries, 50 for each."""
    asked, small = asked_terms(index, queries, options, path)
    scores = ranking.document_scores(term_hits(index, asked, small), index.stats, options, "doc", hit_count(asked))
    few = small and spread.is_small(asked.select("query_id").distinct(), spread.SMALL_ROWS // options.pool_size)
    return ranking.search_rank(scores, options.pool_size, "doc"), few


def with_docs(rows: DataFrame, index: TextIndex, columns: tuple[str, ...], small: bool, n_rows: int = 0) -> DataFrame:
    """Join rows to columns of their documents. Few rows are broadcast, and then only the
    shards they point to are read. Many are dealt by their number `n_rows`, if it is known."""
    keyed = spread.dealt(rows.withColumn("shard", doc_shard(F.col("doc"))), n_rows, ranking.HIT_ROWS, "shard", "doc")
    docs = index.docs.select("doc", "shard", *columns)
    return docs.join(F.broadcast(keyed) if small else keyed, ["shard", "doc"]).drop("shard")


def search(index: TextIndex, queries: DataFrame, options: SearchOptions = SearchOptions(),
           path: str | None = None) -> DataFrame:
    """Results as shown: `query_id, position, url, title, preview, score`.

    URLs are fetched for the pool, titles and contents for the final rows only.
    """
    pool, small = search_pool(index, queries, options, path)
    top = ranking.search_top(with_docs(pool, index, ("url",), small), options)
    title, shown = ranking.result_projection(F.col("title"), F.col("content"), options.preview_chars)
    return with_docs(top, index, ("title", "content"), small).select(
        "query_id", "position", "url", title, shown, "score")
