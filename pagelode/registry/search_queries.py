"""Text index and search over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelode.operators import ranking
from pagelode.plans import index_build, search as search_plan
from pagelode.registry import derived as D
from pagelode.registry import query
from pagelode.registry import sql as S
from pagelode.session import through_table, workdir


@query("tokens", f"""SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({S.tokens('text')}) AS term FROM documents) GROUP BY doc_id, term""")
def tokens(spark, sf_dir):
    return ranking.postings(D.table(spark, sf_dir, "documents"), "doc_id", ("text",)).select("doc_id", "term", "tf")


@query("corpus_stats", f"""WITH {S.POSTINGS} SELECT s.field, n_docs, n_tokens, round(n_tokens::DOUBLE / n_docs, 6) AS avgdl, n_terms
FROM stats s JOIN (SELECT field, count(*) AS n_terms FROM vocab GROUP BY field) v USING (field)""")
def corpus_stats(spark, sf_dir):
    posted = ranking.postings(D.search_docs(spark, sf_dir))
    sizes = ranking.vocabulary(posted).groupBy("field").agg(F.count(F.lit(1)).alias("n_terms"))
    return ranking.field_stats(posted).join(sizes, "field").withColumn("avgdl", F.round("avgdl", 6))


@query("vocabulary", f"WITH {S.POSTINGS} SELECT field, term, df, total_tf FROM vocab")
def vocabulary(spark, sf_dir):
    return ranking.vocabulary(ranking.postings(D.search_docs(spark, sf_dir)))


@query("build_index", f"""WITH {S.DOCS}, toks AS (
  SELECT {S.norm('url')} AS url, page_id, 'title' AS field, {S.tokens('title')} AS ts FROM docs UNION ALL
  SELECT {S.norm('url')}, page_id, 'content', {S.tokens('content')} FROM docs),
newest AS (SELECT * FROM toks WHERE page_id IN (SELECT max(page_id) FROM toks GROUP BY url))
SELECT url, field, term, count(*) AS tf, any_value(dl)::INTEGER AS dl FROM (
  SELECT url, field, len(ts) AS dl, unnest(ts) AS term FROM newest) GROUP BY url, field, term""")
def build_index(spark, sf_dir):
    from pagelode.registry.page_queries import fetched_docs
    from pagelode.sources import index

    # Stored, since pages are parsed on the way and an index reads its documents more than once.
    docs = through_table(index.upsert(fetched_docs(spark, sf_dir), ["fetched_at", "page_id"]), workdir(spark, "docs"))
    built = index_build.build_index(docs, workdir(spark, "index"))
    n_postings = built.vocab.agg(F.sum("df")).first()[0] or 0
    return search_plan.with_docs(built.postings, built, ("url",), False, n_postings).select("url", "field", "term", "tf", "dl")


@query("fuzzy_term_join", f"WITH {S.EXPANDED} SELECT field, qterm, term, df, edits::INTEGER AS edits FROM fuzzy")
def fuzzy_term_join(spark, sf_dir):
    index = D.search_index(spark, sf_dir)
    terms = ranking.query_terms(D.search_queries(index.vocab)).select("qterm").distinct()
    return search_plan.found_terms(index, terms)[0]


@query("term_expansions", f"""WITH {S.EXPANDED} SELECT field, qterm, term, edits::INTEGER AS edits, round(weight, 9) AS weight, shared_df FROM expanded""")
def term_expansions(spark, sf_dir):
    found = ranking.expansions(fuzzy_term_join(spark, sf_dir))
    return found.select("field", "qterm", "term", "edits", F.round("weight", 9).alias("weight"), "shared_df")


@query("postings_join", f"""WITH {S.HITS} SELECT query_id, qterm, field, term, url, tf, dl::INTEGER AS dl, shared_df FROM hits""")
def postings_join(spark, sf_dir):
    index = D.search_index(spark, sf_dir)
    asked, small = search_plan.asked_terms(index, D.search_queries(index.vocab))
    hits = search_plan.term_hits(index, asked, small)
    return search_plan.with_docs(hits, index, ("url",), False, search_plan.hit_count(asked)).select(
        "query_id", "qterm", "field", "term", "url", "tf", "dl", "shared_df")


def _pool(spark, sf_dir):
    index = D.search_index(spark, sf_dir)
    pool, small = search_plan.search_pool(index, D.search_queries(index.vocab))
    return search_plan.with_docs(pool, index, ("url",), small)


@query("search_rank", f"WITH {S.SCORES} SELECT query_id, url, score, rank::INTEGER AS rank FROM ranked")
def search_rank(spark, sf_dir):
    return _pool(spark, sf_dir).drop("doc")


@query("result_dedupe", f"WITH {S.SCORES}, r AS (SELECT query_id, split_part(url, '#', 1) AS url, score, rank FROM ranked) "
       "SELECT query_id, url, arg_min(score, rank) AS score, min(rank)::INTEGER AS rank FROM r GROUP BY query_id, url")
def result_dedupe(spark, sf_dir):
    return ranking.result_dedupe(_pool(spark, sf_dir).drop("doc"))


@query("search_top", f"WITH {S.DEDUPED} SELECT query_id, position::INTEGER AS position, url, score, rank::INTEGER AS rank FROM top")
def search_top(spark, sf_dir):
    return ranking.search_top(_pool(spark, sf_dir)).select("query_id", "position", "url", "score", "rank")


@query("search", f"""WITH {S.DEDUPED} SELECT query_id, position::INTEGER AS position, t.url, title,
  CASE WHEN length(content) > 200 THEN substr(content, 1, 200) || '...' ELSE content END AS preview, score
FROM top t JOIN sdocs d ON d.url = t.doc_url""")
def search(spark, sf_dir):
    index = D.search_index(spark, sf_dir)
    return search_plan.search(index, D.search_queries(index.vocab))
