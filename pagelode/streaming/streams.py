"""Continuous forms of the operators on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pagelode import options as O
from pagelode.functions import urls
from pagelode.operators import frontier, metrics
from pagelode.session import path_exists
from pagelode.sources import index, url_batches
from pagelode.streaming import leases


# Files of one micro-batch: a backlog is taken in steps, so that its state and its shuffles are.
MAX_FILES = 1000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state on disk (RocksDB) and not in the heap. A session that
    has the setting from the start, as `local_session` does, needs no such block."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def file_stream(spark: SparkSession, directory: str, name: str, schema, max_files: int = MAX_FILES) -> DataFrame:
    """One table in a directory as a stream, at most `max_files` of its files in a micro-batch. `name` is that of
    a file or of a folder of files, or a pattern for either; the braces make it a pattern in any case, since the source
    takes a single file only by one."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{directory}/{{{name}}}")


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet",
             **options) -> StreamingQuery:
    """Drain what is there now into files. Restart with the same checkpoint to go on."""
    return (
        stream.writeStream.format(fmt).options(**options).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )


def stream_discovered(stream: DataFrame, watermark: str | None = None, time: str = "ts") -> DataFrame:
    """Each normalised URL once. Without a watermark its memory is as long as the stream's, as
    a set has it; with one, a URL may come again after that time."""
    keyed = stream.withColumn("url", urls.normalize_url(F.col("url"))).where(F.col("url") != "")
    if watermark is None:
        return keyed.dropDuplicates(["url"])
    return keyed.withWatermark(time, watermark).dropDuplicatesWithinWatermark(["url"])


def stream_domain_counts(stream: DataFrame) -> DataFrame:
    """Running acknowledgements and last access per domain; use with update or complete mode."""
    return stream.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_access"))


def keep_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the changed rows of each micro-batch as a generation. A batch that is run again
    replaces its own generation, so nothing counts twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/generation={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_top_domains(counts: DataFrame, path: str, checkpoint: str, size: int = 5) -> StreamingQuery:
    """The domains with most acknowledgements so far, written after every micro-batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        frontier.top_domains(batch, size).write.mode("overwrite").parquet(f"{path}/generation={batch_id}")

    return (
        counts.writeStream.foreachBatch(write).outputMode("complete")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _generations(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, int]:
    """Rows since the last compaction and those it left, and the generation it reached (-1: none).
    Older generations are not read: `generation` is their folder."""
    rows = spark.read.schema(f"{schema}, generation long").parquet(path)
    if not path_exists(spark, f"{path}-base"):
        return rows, -1
    bases = spark.read.schema(f"{schema}, generation long").parquet(f"{path}-base")
    upto = bases.agg(F.max("generation")).first()[0]
    if upto is None:
        return rows, -1
    return rows.where(F.col("generation") > upto).unionByName(bases.where(F.col("generation") == upto)), upto


def compact(spark: SparkSession, path: str, schema: str, merge) -> int:
    """Merge all generations so far into one; readers then begin there. `merge` takes rows with their
    `generation` and keeps what counts. Run now and then; returns the generation reached. A run that
    breaks off leaves the last base as it was."""
    rows, upto = _generations(spark, path, schema)
    last = rows.agg(F.max("generation")).first()[0]
    if last is None or last == upto:
        return upto
    merge(rows.where(F.col("generation") <= last)).drop("generation") \
        .write.mode("overwrite").parquet(f"{path}-base/generation={last}")
    return last


def newest(rows: DataFrame, key: str) -> DataFrame:
    """Newest generation of each key."""
    rest = [c for c in rows.columns if c not in (key, "generation")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "generation").alias("_r")).select(key, "_r.*")


def read_updates(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """Newest generation of each key, from the last compaction on."""
    return newest(_generations(spark, path, schema)[0], key)


def read_latest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest generation as a whole."""
    rows = spark.read.schema(f"{schema}, generation long").parquet(path)
    return rows.where(F.col("generation") == rows.agg(F.max("generation")).scalar()).drop("generation")


def stream_index_upsert(docs: DataFrame, path: str, checkpoint: str, order: list[str]) -> StreamingQuery:
    """Index writes per micro-batch: the newest copy per URL within the batch and rows without a URL,
    written as a generation in one pass. `read_index_stream` merges generations."""
    def write(batch: DataFrame, batch_id: int) -> None:
        index.marked_latest(batch, order).write.mode("overwrite").partitionBy("bad").parquet(f"{path}/docs/generation={batch_id}")

    return (
        docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_index_stream(spark: SparkSession, path: str, schema: str, order: list[str]) -> DataFrame:
    rows = _generations(spark, f"{path}/docs", f"{schema}, bad boolean")[0]
    return index.latest(rows.where(~F.col("bad")).drop("bad", "generation"), order)


def read_index_quarantine(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = _generations(spark, f"{path}/docs", f"{schema}, bad boolean")[0]
    return rows.where("bad").drop("bad", "generation")


def compact_index_stream(spark: SparkSession, path: str, schema: str, order: list[str]) -> int:
    return compact(spark, f"{path}/docs", f"{schema}, bad boolean",
                   lambda rows: index.marked_latest(rows.drop("bad", "generation"), order))


def stream_url_batches(items: DataFrame, path: str, checkpoint: str, published_at: Column, order: list[str],
                       size: int = O.CrawlOptions.url_batch_size) -> StreamingQuery:
    """Publish each micro-batch of `url, depth` rows as JSON messages, one per line. Numbering looks at
    the rows more than once, so the micro-batch is kept on the executors' disks meanwhile."""
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.DISK_ONLY)
        try:
            messages = url_batches.url_batches(kept, published_at, order, size)
            messages.select("value").write.mode("overwrite").text(f"{path}/generation={batch_id}")
        finally:
            kept.unpersist()

    return (
        items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_url_batch_stream(spark: SparkSession, path: str) -> DataFrame:
    """Published messages back as a stream of items."""
    messages = spark.readStream.schema("value string").text(path)
    return url_batches.read_url_batches(messages.select("value"))


class StateSteps(StatefulProcessor):
    """The state of each URL; a change leaves one row that takes one from the old state and adds one to the new.

    A key is a bucket of URLs (see `leases.LeaseTracker`). Events of a URL are taken in time order within a
    micro-batch, so they have to come in order from one micro-batch to the next."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.states = handle.getValueState("states", "url array<string>, state array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values(["at_micros", "event_id", "state"])
        kept = self.states.get()
        held = {} if kept is None else dict(zip(*kept))
        before = []
        for url, state in zip(events["url"], events["state"]):
            before.append(held.get(url))
            held[url] = state
        self.states.update((list(held), list(held.values())))
        was = pd.Series(before, index=events.index, dtype=object)
        nets = {f"net_{s}": (events["state"] == s).astype("int64") - (was == s).astype("int64") for s in metrics.STATES}
        yield pd.DataFrame({"at_micros": events["at_micros"], **nets})

    def close(self) -> None:
        pass


_NETS = "tick long, " + ", ".join(f"net_{s} long" for s in metrics.STATES)


def stream_gauges(events: DataFrame, path: str, checkpoint: str, seconds: int = 5,
                  buckets: int = leases.BUCKETS) -> StreamingQuery:
    """What every tick adds to the sizes of queue, inflight and visited: state per URL, then sums per tick,
    written as a generation per micro-batch. Expects `url, ts, event_id, action`; `read_gauges` adds them up.
    The session needs the RocksDB state store; state is kept in `buckets` of URLs, which a checkpoint is bound to."""
    steps = events.withColumn("state", metrics.state_after(F.col("action"))).where(F.col("state").isNotNull()).select(
        "url", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_micros"), "event_id", "state")
    schema = "at_micros long, " + ", ".join(f"net_{s} long" for s in metrics.STATES)
    changes = steps.withColumn("bucket", leases.url_bucket(buckets)).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=StateSteps(), outputStructType=schema, outputMode="Append", timeMode="None")

    def write(batch: DataFrame, batch_id: int) -> None:
        tick = F.floor(F.col("at_micros") / (seconds * 1_000_000)).alias("tick")
        nets = batch.groupBy(tick).agg(*[F.sum(f"net_{s}").alias(f"net_{s}") for s in metrics.STATES])
        nets.write.mode("overwrite").parquet(f"{path}/generation={batch_id}")

    return (
        changes.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _sum_of_nets(rows: DataFrame) -> DataFrame:
    return rows.groupBy("tick").agg(*[F.sum(f"net_{s}").alias(f"net_{s}") for s in metrics.STATES])


def read_gauges(spark: SparkSession, path: str, seconds: int = 5, max_queue: int = O.CrawlOptions.max_frontier_queue_size) -> DataFrame:
    """Gauges and pressure at the end of every tick that saw a change, from the generations so far."""
    return metrics.gauges_of(_sum_of_nets(_generations(spark, path, _NETS)[0]), seconds, max_queue)


def compact_gauges(spark: SparkSession, path: str) -> int:
    """Put the generations so far together: a row per tick."""
    return compact(spark, path, _NETS, lambda rows: _sum_of_nets(rows).withColumn("generation", F.lit(0)))


def stream_ticks(events: DataFrame, width: str = "5 seconds", delay: str = "1 minute") -> DataFrame:
    """Events per tick and kind of state change, by event time. Expects `ts`, `action`."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    state = metrics.state_after(F.col("action"))
    return timed.groupBy(F.window("ts", width)).agg(
        *[F.count_if(state == s).alias(f"to_{s}") for s in metrics.STATES],
    ).select(F.col("window.start").alias("tick_start"), *[f"to_{s}" for s in metrics.STATES])
