"""Structured log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The extras that the log keeps, in the order written. Others are left out.
CRAWL_KEYS = (
    "worker_id", "url", "depth", "queue_size", "inflight_size", "indexed_rate", "batch_size",
    "pages_crawled",
)
WRITE_KEYS = (
    "bulk_size", "indexed_count", "failed_count", "bulk_latency_ms", "exception_type",
    "exception_msg", "retry_attempt",
)


def log_lines(rows: DataFrame, keys=CRAWL_KEYS) -> DataFrame:
    """One JSON text per row: `ts` to the second, `level`, `message`, then the known extras
    that are not null."""
    extras = [F.col(k) for k in keys if k in rows.columns]
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts")
    return rows.select(F.to_json(F.struct(stamp, "level", "message", *extras)).alias("value"))
