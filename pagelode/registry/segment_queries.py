"""The segmented index: documents as a base, then batches that overwrite, add and delete, and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.operators import ranking, spread
from pagelode.plans import segment_search, segments
from pagelode.registry import derived as D
from pagelode.registry import query
from pagelode.registry import sql as S
from pagelode.session import shuffles_released, through_table, workdir

ITEM = "https://en.wikipedia.org/wiki/Item_"

# What the index holds after the batches of `changed_index`.
CHANGED_DOCS = f"""sdocs AS (
  SELECT doc_id, {S.DOC_URL} AS url, CASE WHEN revised THEN 'Revised ' || title ELSE title END AS title,
    CASE WHEN revised THEN replace(text, 'e', 'ee') ELSE text END AS content
  FROM (SELECT *, split_part(text, chr(10), 1) AS title, doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS revised
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL))
  UNION ALL
  SELECT -1 - item_id, '{ITEM}' || item_id || '#0', split_part(text, chr(10), 1), text FROM benchmark)"""


def changed(sql: str) -> str:
    """The same query over the documents after the batches."""
    return sql.replace(S.SEARCH_DOCS, CHANGED_DOCS)


def base_index(spark: SparkSession, sf_dir: str) -> segments.SegmentIndex:
    empty = segments.create(spark, workdir(spark, "segments"))
    return segments.upsert(empty, D.search_docs(spark, sf_dir))


def changed_index(spark: SparkSession, sf_dir: str) -> segments.SegmentIndex:
    """All documents; those labelled bad are written again with other texts, benchmark items come as new
    pages, those labelled toxic are deleted."""
    labels = D.table(spark, sf_dir, "labels")
    documents = D.table(spark, sf_dir, "documents")
    index = base_index(spark, sf_dir)
    n_bytes = sum(s.n_bytes for s in index.segments)

    def labelled(which) -> DataFrame:
        ids = labels.where(which).select("doc_id").distinct()
        if spread.is_small(ids):
            return documents.join(F.broadcast(ids), "doc_id", "left_semi")
        return spread.dealt(documents, n_bytes, ranking.DOC_BYTES, "doc_id").join(ids, "doc_id", "left_semi")

    revised = D.as_search_docs(labelled(F.col("quality") == 0)).select(
        "url", F.concat(F.lit("Revised "), "title").alias("title"), F.replace("content", F.lit("e"), F.lit("ee")).alias("content"))
    items = D.table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit(ITEM), F.col("item_id").cast("string"), F.lit("#0")).alias("url"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.col("text").alias("content"))
    # Stored, since a segment reads its documents more than once.
    with shuffles_released(spark):
        revised = through_table(revised, workdir(spark, "revised"))
    index = segments.upsert(index, revised)
    index = segments.upsert(index, items)
    return segments.delete(index, D.as_search_docs(labelled(F.col("toxic") == 1)).select("url"))


@query("segment_documents", f"WITH {CHANGED_DOCS} SELECT url, title, length(content) AS n_chars FROM sdocs")
def segment_documents(spark, sf_dir):
    return changed_index(spark, sf_dir).live_docs().select("url", "title", F.length("content").cast("long").alias("n_chars"))


@query("segment_vocabulary", changed(f"WITH {S.POSTINGS} SELECT field, term, df, total_tf FROM vocab"))
def segment_vocabulary(spark, sf_dir):
    return changed_index(spark, sf_dir).vocabulary()


@query("segment_stats", changed(f"WITH {S.POSTINGS} SELECT field, n_docs, n_tokens, round(n_tokens::DOUBLE / n_docs, 6) AS avgdl FROM stats"))
def segment_stats(spark, sf_dir):
    return changed_index(spark, sf_dir).field_stats().withColumn("avgdl", F.round("avgdl", 6))


@query("segment_postings", changed(f"WITH {S.POSTINGS} SELECT url, field, term, tf, dl::INTEGER AS dl FROM post"))
def segment_postings(spark, sf_dir):
    index = segments.merge(changed_index(spark, sf_dir), [1, 2, 3])
    n_hits = index.postings.agg(F.sum("n")).first()[0] or 0
    hits = index.without_dead(index.hits(index.postings.select("segment", "block", "field", "term", "hits")), n_hits)
    return hits.join(index.docs.select("segment", "doc", "url"), ["segment", "doc"]).select("url", "field", "term", "tf", "dl")


@query("segment_near_terms", f"WITH {S.EXPANDED} SELECT field, qterm, term, df, edits::INTEGER AS edits FROM fuzzy")
def segment_near_terms(spark, sf_dir):
    index = base_index(spark, sf_dir)
    terms = ranking.query_terms(D.search_queries(index.vocabulary())).select("qterm").distinct()
    return segment_search.found_terms(index, segment_search.held(terms, "terms"))


@query("segment_pool", changed(f"WITH {S.SCORES} SELECT query_id, url, score, rank::INTEGER AS rank FROM ranked"))
def segment_pool(spark, sf_dir):
    """After a merge of all segments; every block is judged by its bound."""
    index = changed_index(spark, sf_dir)
    index = segments.merge(index, [s.number for s in index.segments], block_bits=6)
    segments.vacuum(index)  # the index is this query's own
    named, pool, _ = segment_search.search_pool(index, D.search_queries(index.vocabulary()), direct=0)
    return named.join(pool.withColumnRenamed("query_id", "words"), "words").select("query_id", "url", "score", "rank")


@query("segment_search", changed(f"""WITH {S.DEDUPED} SELECT query_id, position::INTEGER AS position, t.url, title,
  CASE WHEN length(content) > 200 THEN substr(content, 1, 200) || '...' ELSE content END AS preview, score
FROM top t JOIN sdocs d ON d.url = t.doc_url"""))
def segment_search_query(spark, sf_dir):
    index = changed_index(spark, sf_dir)
    return segment_search.search(index, D.search_queries(index.vocabulary()))
