"""The document index: one row per URL, the last write wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode import schemas
from pagelode.operators import spread


def latest(docs: DataFrame, order: list[str]) -> DataFrame:
    """One row per URL, the one that is last in `order`.

    An aggregate rather than a sorted window: copies of a hot URL are combined before the
    shuffle. Other columns are carried along.
    """
    rest = [c for c in docs.columns if c != "url"]
    best = docs.groupBy("url").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_d"))
    return best.select("url", "_d.*")


def is_bad() -> Column:
    return F.coalesce(F.col("url"), F.lit("")) == ""


def quarantined(docs: DataFrame) -> DataFrame:
    """Rows that cannot be keyed. They are kept aside, not lost."""
    return docs.where(is_bad())


def upsert(docs: DataFrame, order: list[str]) -> DataFrame:
    return latest(docs.where(~is_bad()), order)


def marked_latest(docs: DataFrame, order: list[str]) -> DataFrame:
    """The newest row per URL and every row that cannot be keyed, told apart by `bad`, in one pass:
    a row of the second kind goes through the same aggregate as a group of its own."""
    marked = docs.withColumn("bad", is_bad()).withColumn(
        "_apart", F.when(F.col("bad"), F.monotonically_increasing_id()))
    rest = [c for c in marked.columns if c not in ("url", "_apart")]
    best = marked.groupBy("url", "_apart").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_d"))
    return best.select("url", "_d.*")


def write_index(docs: DataFrame, path: str, order: list[str], observation: Observation | None = None) -> DataFrame:
    """Write the index and its quarantine in one pass; returns the stored documents.

    An observation gets `bulk_size`, `indexed_count` and `failed_count` of the write.
    """
    if observation is not None:
        docs = docs.observe(
            observation, F.count(F.lit(1)).alias("bulk_size"), F.count_if(~is_bad()).alias("indexed_count"),
            F.count_if(is_bad()).alias("failed_count"))
    marked_latest(docs, order).select(*[f.name for f in schemas.DOCS], "bad") \
        .write.mode("overwrite").partitionBy("bad").parquet(path)
    return read_index(docs.sparkSession, path)


def _stored(spark: SparkSession, path: str, bad: bool) -> DataFrame:
    schema = T.StructType([*schemas.DOCS, T.StructField("bad", T.BooleanType())])
    return spark.read.schema(schema).parquet(path).where(F.col("bad") == bad).drop("bad")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, False)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, True)


def bulk_summary(docs: DataFrame, order: list[str], chunk: int = 500, target: int = spread.BUCKET_ROWS) -> DataFrame:
    """Size, indexed and failed rows of every chunk of writes, in arrival order."""
    rows = spread.numbered(docs.withColumn("_bad", is_bad()).select(*order, "_bad"), order, "_seq", target)
    number = F.floor((F.col("_seq") - 1) / chunk).cast("long")
    return rows.groupBy(number.alias("chunk")).agg(
        F.count(F.lit(1)).alias("bulk_size"),
        F.count_if(~F.col("_bad")).alias("indexed_count"),
        F.count_if(F.col("_bad")).alias("failed_count"))
