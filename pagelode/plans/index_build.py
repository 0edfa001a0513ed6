"""Building the text index: documents, postings by term bucket, vocabulary by length, field statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.operators import ranking, spread

# Text per bucket of terms; postings have about the size of their text.
BUCKET_BYTES = 32 * 2**20
LEAST_BUCKETS = 16
# Folders do not grow with the corpus: beyond these numbers, what lies in them does.
MOST_BUCKETS = 1024
SHARDS = 1024

_DOCS = "doc long, url string, title string, content string, shard int"
_POSTINGS = "doc long, field string, dl int, term string, tf long, opens boolean, term_bucket int"
_VOCAB = "field string, term string, df long, total_tf long, size int"
_STATS = "field string, n_docs long, n_tokens long, avgdl double"


@dataclass(frozen=True)
class TextIndex:
    """Stored tables of an index. `doc` numbers rise with the URL."""

    docs: DataFrame
    postings: DataFrame
    vocab: DataFrame
    stats: DataFrame
    buckets: int


def doc_shard(doc: Column) -> Column:
    """The folder of a document: numbers given out by one task share their upper bits."""
    return F.pmod(F.shiftright(doc, 33), F.lit(SHARDS)).cast("int")


def build_index(docs: DataFrame, path: str, buckets: int | None = None) -> TextIndex:
    """Write the index of `docs` (one row per URL; see `sources.index.upsert`). They are read three times: for the
    bytes of their text, for the ranges of URLs, and to be written.

    Documents are stored in URL order, `ranking.DOC_BYTES` of text per task at most, and numbered on the way: postings carry a number instead
    of a URL, equal scores are told apart by it as they would be by the URL, and a search reads
    the text of its results from the shards that hold them. Postings are partitioned by a hash of
    the term and sorted by term inside, so a search reads the buckets of its terms alone; the
    number of buckets follows the size of the text up to `MOST_BUCKETS`, unless it is given. The rebalance splits a
    bucket that a frequent term has made large. The vocabulary is partitioned by the length of its
    terms, since typos change it by two letters at most. Vocabulary and statistics come from the
    stored postings, so documents are cut into tokens once.
    """
    spark = docs.sparkSession
    n_bytes = ranking.text_bytes(docs)
    ordered = spread.ranged(docs.select("url", "title", "content"), n_bytes, ranking.DOC_BYTES, "url").sortWithinPartitions("url")
    ordered.withColumn("doc", F.monotonically_increasing_id()).withColumn("shard", doc_shard(F.col("doc"))) \
        .write.mode("overwrite").partitionBy("shard").parquet(f"{path}/docs")
    buckets = buckets or min(max(LEAST_BUCKETS, -(-n_bytes // BUCKET_BYTES)), MOST_BUCKETS)

    rows = ranking.postings(spark.read.schema(_DOCS).parquet(f"{path}/docs"), "doc", n_bytes=n_bytes)
    (
        rows.withColumn("term_bucket", ranking.bucket_of(F.col("term"), buckets))
        .hint("rebalance", "term_bucket")
        .sortWithinPartitions("term_bucket", "term", "field")
        .write.mode("overwrite").partitionBy("term_bucket").parquet(f"{path}/postings")
    )
    posted = spark.read.schema(_POSTINGS).parquet(f"{path}/postings")
    ranking.vocabulary(posted).withColumn("size", F.least(F.length("term"), F.lit(ranking.LONGEST))).sortWithinPartitions("size") \
        .write.mode("overwrite").partitionBy("size").parquet(f"{path}/vocab")
    ranking.field_stats(posted).withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(f"{path}/stats")
    return open_index(spark, path, buckets)


def open_index(spark: SparkSession, path: str, buckets: int | None = None) -> TextIndex:
    """A stored index. Its number of buckets is read from it, unless it is given."""
    def stored(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    if buckets is None:
        kept = stored("stats", f"{_STATS}, buckets int").agg(F.max("buckets").alias("n")).first()
        buckets = kept.n or LEAST_BUCKETS
    return TextIndex(stored("docs", _DOCS), stored("postings", _POSTINGS), stored("vocab", _VOCAB),
                     stored("stats", _STATS), buckets)
