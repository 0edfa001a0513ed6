"""The page store, which stands in for fetching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode import schemas
from pagelode.functions import urls


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages, as they lie. Splits follow `spark.sql.files.maxPartitionBytes` and the store's
    row groups; HTML is never dealt out anew."""
    return spark.read.schema(schemas.PAGES).parquet(path)


def latest_page_ids(pages: DataFrame) -> DataFrame:
    """Id of the newest copy per normalised URL, without touching the HTML."""
    return pages.select("page_id", urls.normalize_url(F.col("url")).alias("url")).groupBy("url").agg(
        F.max("page_id").alias("page_id"))


def fetched(frontier: DataFrame, pages: DataFrame) -> DataFrame:
    """Frontier rows with the HTML of their page; null HTML is a failed fetch.

    Ids are matched first, on narrow columns and once: both parts below read the same exchanges. The
    HTML is joined to the matched rows only, as an inner join, so that a small frontier is
    broadcast and the store is not shuffled.
    """
    matched = frontier.join(latest_page_ids(pages), "url", "left")
    hits = pages.select("page_id", "html").join(matched.where(F.col("page_id").isNotNull()), "page_id")
    misses = matched.where(F.col("page_id").isNull()).withColumn("html", F.lit(None).cast("string"))
    return hits.unionByName(misses)
