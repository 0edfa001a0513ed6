"""URL batches: the messages that announce queued URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode import options as O
from pagelode import schemas
from pagelode.operators import spread


def batch_number(rows: DataFrame, order: list[str], size: int = O.CrawlOptions.url_batch_size,
                 target: int = spread.BUCKET_ROWS) -> DataFrame:
    """Dense `seq` and the `batch` it falls in, in publishing order."""
    return spread.numbered(rows, order, "seq", target).withColumn(
        "batch", F.floor((F.col("seq") - 1) / size).cast("long"))


def url_batches(rows: DataFrame, published_at: Column, order: list[str],
                size: int = O.CrawlOptions.url_batch_size, target: int = spread.BUCKET_ROWS) -> DataFrame:
    """JSON messages of `size` URLs each; only the last may be short. Expects `url`, `depth`
    (a missing depth is 0)."""
    item = F.struct(F.col("seq"), F.struct(
        F.col("url"), F.coalesce(F.col("depth"), F.lit(0)).cast("int").alias("depth")).alias("item"))
    packed = batch_number(rows, order, size, target).groupBy("batch").agg(
        F.array_sort(F.collect_list(item)).alias("_items"))
    message = F.struct(
        F.transform("_items", lambda x: x["item"]).alias("items"),
        F.size("_items").alias("batch_size"), published_at.alias("published_at"))
    return packed.select("batch", F.to_json(message).alias("value"))


def read_url_batches(messages: DataFrame) -> DataFrame:
    """The items of the messages, in order. Works on batch and streaming frames alike."""
    parsed = messages.withColumn("m", F.from_json("value", schemas.URL_BATCH))
    keep = [c for c in messages.columns if c != "value"]
    return parsed.select(*keep, "m.published_at", "m.batch_size", F.posexplode("m.items").alias("pos", "item")).select(
        *keep, "published_at", "batch_size", (F.col("pos") + 1).alias("pos"), "item.url", "item.depth")
