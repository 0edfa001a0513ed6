"""Explicit schemas of every stored or streamed table."""

from pyspark.sql import types as T

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

DOCS = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("links", T.ArrayType(T.StringType())),
    T.StructField("fetched_at", T.TimestampType()),
])

PAYLOAD = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("depth", T.IntegerType()),
])

LEASE_META = T.StructType([
    T.StructField("worker_id", T.StringType()),
    T.StructField("reserved_at", T.DoubleType()),
    T.StructField("lease_seconds", T.IntegerType()),
])

URL_BATCH = T.StructType([
    T.StructField("items", T.ArrayType(PAYLOAD)),
    T.StructField("batch_size", T.IntegerType()),
    T.StructField("published_at", T.StringType()),
])
