"""A growing set of URLs as a log in buckets by URL.

Every round appends what it adds, in files by a hash of the URL; a lookup joins to the log bucket by bucket, so
the log itself is never shuffled, however many rounds wrote to it. Now and then the rounds so far are put
together into one base. Rows carry their round, and a reader names the last finished one, so a round
that broke off is not seen, and when it is done again it writes its files anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.session import path_exists

MOST_BUCKETS = 4096
# Rounds between compactions.
COMPACT_EVERY = 32


class UrlLog:
    """A log at a path; its number of buckets is the same for all who use it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets

    @classmethod
    def at(cls, spark: SparkSession, path: str) -> UrlLog:
        """The log that was begun there, or one with as many buckets as the session has shuffle partitions."""
        begun = f"{path}-layout"
        if path_exists(spark, f"{begun}/_SUCCESS"):
            return cls(spark, path, spark.read.schema("buckets int").parquet(begun).first().buckets)
        return cls(spark, path, min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS))

    def _write(self, urls: DataFrame, folder: str) -> None:
        name = f"urls_{uuid.uuid4().hex}"
        urls.repartition(self.buckets, "url").write.mode("overwrite").option("path", f"{self.path}/{folder}") \
            .bucketBy(self.buckets, "url").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay

    def append(self, urls: DataFrame, round_no: int) -> None:
        """What a round adds; a round that is done again replaces what it wrote."""
        if not path_exists(self.spark, f"{self.path}-layout/_SUCCESS"):
            self.spark.range(0, 1, 1, 1).select(F.lit(self.buckets).alias("buckets")).write.mode("overwrite").parquet(f"{self.path}-layout")
        self._write(urls.select("url", F.lit(round_no).alias("round")), f"round-{round_no}")

    def read(self, last: int) -> DataFrame:
        """url of all rounds up to `last`, in buckets; a URL may have several rows."""
        name, place = f"urls_{uuid.uuid4().hex}", self.path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} (url STRING, round INT) USING parquet OPTIONS (recursiveFileLookup 'true') "
            f"CLUSTERED BY (url) INTO {self.buckets} BUCKETS LOCATION '{place}'")
        rows = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return rows.where(F.col("round") <= last).select("url")

    def _folders(self) -> list[tuple[str, int, object, object]]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/*-*")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = []
        for status in files.globStatus(place) or []:
            kind, number = status.getPath().getName().rsplit("-", 1)
            found.append((kind, int(number), status.getPath(), files))
        return found

    def compact(self, last: int) -> int:
        """Put all rounds up to `last`, a finished one, together; returns how many folders went. The base is written
        first, so if this breaks off, some URLs are there twice, which a set does not mind."""
        old = [f for f in self._folders() if f[1] < last or f[0] == "round" and f[1] == last]
        if len(old) < 2:
            return 0
        self._write(self.read(last).distinct().withColumn("round", F.lit(last)), f"base-{last}")
        for _, _, place, files in old:
            files.delete(place, True)
        return len(old)

    def compact_if_due(self, last: int, every: int = COMPACT_EVERY) -> int:
        rounds = sum(1 for kind, number, *_ in self._folders() if kind == "round" and number <= last)
        return self.compact(last) if rounds >= every else 0
