"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode.session import workdir

ORACLES: dict[str, str] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Rows of an Arrow batch. A batch is held several times, off the heap of the JVM and in the worker, and
# its rows are whole texts; the default of 10,000 of them is a GB where texts are long.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Texts of one call into vectorised code: about so many characters, however the batches came.
SLICE_CHARS = 2_000_000


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once below the shared folder and read back: lineage is cut, lost executors lose nothing."""
    path = workdir(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the tables of `stored` frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: str = "doc_id", folds: int = 5):
    """crc32 of the id written as text, modulo `folds`; null ids count as fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def in_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """df.mapInArrow for rows with texts. Lowers the session's rows per Arrow batch to `BATCH_ROWS`
    (a lower setting stays as it is), since the plan takes it from there when it runs."""
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH_SETTING, "10000")) not in range(1, BATCH_ROWS + 1):
        conf.set(_BATCH_SETTING, BATCH_ROWS)
    return df.mapInArrow(fn, schema)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Small batches of narrow rows put together to `rows` or a little more."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into row ranges whose texts have about `chars` bytes; one text is never cut."""
    for batch in batches:
        sizes = batch.column(column).fill_null("").cast(pa.large_binary())
        start, held = 0, 0
        for i, size in enumerate(pc.binary_length(sizes).to_pylist()):
            if held and held + size > chars:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have, the given one if it is free."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_fields(df: DataFrame, **kinds: str) -> T.StructType:
    """The schema of df and more columns behind it."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, T.DataType.fromDDL(k)) for n, k in kinds.items())])
