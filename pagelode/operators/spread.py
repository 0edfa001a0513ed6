"""Building blocks for order and for hot keys, without a task that holds a whole group.

Order is worked out in buckets of the order column, cut where the rows are: a bucket is one task's
share, and only one row per bucket takes part in the running sum over buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.session import through_table, workdir

BUCKET_ROWS = 1_000_000
HOT_ROWS = 2_000_000
# Rows of a key of up to a few hundred bytes and a few numbers that may be broadcast: some ten MB.
SMALL_ROWS = 100_000


def is_small(rows: DataFrame, bound: int = SMALL_ROWS) -> bool:
    """Whether a frame is within the bound. Counts at most one row beyond it."""
    return rows.limit(bound + 1).count() <= bound


def _session_parts(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dealt(rows: DataFrame, amount: int, share: int, *keys: str, always: bool = False) -> DataFrame:
    """Rows dealt out by their keys in as many parts as `amount` (rows or bytes) needs at `share` each, so that a
    task of the join or sum by these keys that follows does not grow with the table. Where the session has that many
    partitions, nothing is done, unless it is to be `always`: the exchange of what follows is fine."""
    parts = -(-amount // share)
    if parts > _session_parts(rows):
        return rows.repartition(parts, *keys)
    return rows.repartition(*keys) if always else rows


def ranged(rows: DataFrame, amount: int, share: int, *keys: str) -> DataFrame:
    """Rows in ranges of their keys, in as many as the session has partitions, or more if `amount` needs them."""
    parts = -(-amount // share)
    return rows.repartitionByRange(parts, *keys) if parts > _session_parts(rows) else rows.repartitionByRange(*keys)


def hot_pieces(counts: DataFrame, key: str, count: str, hot_rows: int) -> DataFrame:
    """Keys with more than `hot_rows` rows and the number of pieces to cut each into.

    At most the `SMALL_ROWS` hottest keys, whatever the number of rows, so the list may be
    broadcast. A key beyond them is joined uncut, like one below the bound.
    """
    hot = counts.where(F.col(count) > hot_rows).orderBy(F.col(count).desc(), key).limit(SMALL_ROWS)
    return hot.select(F.col(key), F.ceil(F.col(count) / hot_rows).cast("int").alias("_pieces"))


def lookup_join(rows: DataFrame, table: DataFrame, key: str, spread_by: Column | str,
                how: str = "left", hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Join rows to a table with one row per key, when a few keys may hold most of the rows.

    Hot keys are counted first (unless given, see `hot_pieces`); each is cut into pieces by a
    hash of `spread_by`, and its table row is repeated once per piece. Other keys are joined
    as they are. The rows are read twice, so what is costly to make should be stored before.
    """
    spread = F.col(spread_by) if isinstance(spread_by, str) else spread_by
    if hot is None:
        hot = hot_pieces(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), key, "_n", hot_rows)
    left = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_piece", F.when(F.col("_pieces").isNull(), 0)
        .otherwise(F.pmod(F.xxhash64(spread), F.col("_pieces"))).cast("int")).drop("_pieces")
    right = table.join(F.broadcast(hot), key, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))).drop("_pieces")
    return left.join(right, [key, "_piece"], how).drop("_piece")


def bucket_offsets(counts: DataFrame, bucket: str, values: dict[str, str], run_width: int = 10_000) -> DataFrame:
    """Sums over all earlier buckets, for a frame with one row per bucket. `values` maps each
    column to the name of its sum; other columns are kept.

    Two steps: inside runs of neighbouring buckets (`run_width` bucket numbers), then over the runs,
    so the one task at the end sees one row per run.
    """
    inside = W.partitionBy("_run").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    over_runs = W.orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    in_runs = counts.withColumn("_run", F.floor(F.col(bucket) / run_width))
    runs = in_runs.groupBy("_run").agg(*[F.sum(v).alias(f"_t{v}") for v in values]).select(
        "_run", *[F.coalesce(F.sum(f"_t{v}").over(over_runs), F.lit(0)).alias(f"_r{v}") for v in values])
    sums = [
        (F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"_r{v}")).cast("long").alias(out)
        for v, out in values.items()]
    return in_runs.join(runs, "_run").select(*counts.columns, *sums)


def order_buckets(rows: DataFrame, column: str, target: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """Adds `_bucket`, a number that rises with an integer column, and returns the width of the
    first cut (for `bucket_offsets`).

    Buckets are cut where the rows are: the whole span into even parts first, and then every part
    with more than `target` rows again, between its own smallest and largest value, until none
    is left but those of a single value. So an outlier or a sparse id costs one more cut, not a
    bucket with everything. A cut counts the rows of the parts it divided; nulls come first.
    """
    spark = rows.sparkSession
    span = rows.agg(F.min(column).alias("a"), F.max(column).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if span.a is None or span.n <= target:
        return rows.withColumn("_bucket", F.lit(0).cast("long")), 1
    value = F.coalesce(F.col(column).cast("long"), F.lit(span.a))
    parts = 2 * -(-span.n // target)
    width = -(-(span.b - span.a + 1) // parts)
    # Numbers start at 0 for the smallest value, so that runs of buckets are of equal length.
    place = value - F.lit(span.a)
    out = rows.withColumn("_bucket", (F.floor(place / width) * width).cast("long"))
    counted = out
    for _ in range(64):  # each cut at least halves a span of 64 bits
        sizes = counted.groupBy("_bucket").agg(
            F.min(place).alias("_low"), F.max(place).alias("_high"), F.count(F.lit(1)).alias("_n"))
        cut = F.ceil((F.col("_high") - F.col("_low") + 1) / (2 * F.ceil(F.col("_n") / target))).cast("long")
        large = through_table(
            sizes.where((F.col("_n") > target) & (F.col("_high") > F.col("_low"))).select("_bucket", "_low", cut.alias("_cut")),
            workdir(spark, "cuts"))
        if large.isEmpty():
            break
        # One row per oversized bucket: broadcast within the bound, which is checked.
        side = F.broadcast(large) if is_small(large) else large
        moved = F.col("_low") + F.floor((place - F.col("_low")) / F.col("_cut")) * F.col("_cut")
        joined = out.join(side, "_bucket", "left").withColumn(
            "_bucket", F.when(F.col("_low").isNull(), F.col("_bucket")).otherwise(moved).cast("long"))
        out = joined.select(*rows.columns, "_bucket")
        counted = joined.where(F.col("_low").isNotNull()).select(*rows.columns, "_bucket")
    return out, width


def cut_ties(bucketed: DataFrame, column: str, target: int = BUCKET_ROWS) -> DataFrame:
    """Adds `_sub` to bucketed rows: where a bucket of one value has more than `target` rows, a number that rises
    with a second order column (an integer), else 0. The order of (_bucket, _sub) is that of both columns."""
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target).select("_bucket")
    large = through_table(counts, workdir(bucketed.sparkSession, "ties"))
    if large.isEmpty():
        return bucketed.withColumn("_sub", F.lit(0).cast("long"))
    # One row per oversized bucket: broadcast within the bound, which is checked.
    side = F.broadcast(large) if is_small(large) else large
    tied = bucketed.join(side, "_bucket", "left_semi").withColumnRenamed("_bucket", "_first")
    cut, _ = order_buckets(tied, column, target)
    rest = bucketed.join(side, "_bucket", "left_anti").withColumn("_sub", F.lit(0).cast("long"))
    return rest.unionByName(cut.withColumnRenamed("_bucket", "_sub").withColumnRenamed("_first", "_bucket"))


def numbered(rows: DataFrame, order: list[str], out: str = "seq", target: int = BUCKET_ROWS) -> DataFrame:
    """Dense numbers from 1 in the order given. The first order column is an integer; a value
    of it holds a bounded number of rows (it is a row id, or a page id with its links).

    The rows are read more than once, so what is costly to make should be stored before.
    """
    bucketed, width = order_buckets(rows, order[0], target)
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = bucket_offsets(counts, "_bucket", {"_n": "_offset"}, 10_000 * width).drop("_n")
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(*order))
    return (
        bucketed.join(offsets, "_bucket")
        .withColumn(out, (F.col("_offset") + place).cast("long"))
        .drop("_bucket", "_offset")
    )


def kth_smallest(rows: DataFrame, column: str, k: int, target: int = BUCKET_ROWS) -> DataFrame:
    """One row, one column: the k-th smallest value of a unique integer column, null if there
    are fewer. Counts per bucket find the bucket, and only that bucket is sorted."""
    bucketed, width = order_buckets(rows.select(column), column, target)
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    chosen = (
        bucket_offsets(counts, "_bucket", {"_n": "_offset"}, 10_000 * width)
        .where((F.col("_offset") < k) & (F.col("_offset") + F.col("_n") >= k))
        .select("_bucket", "_offset")
    )
    inside = (
        bucketed.join(F.broadcast(chosen), "_bucket")  # one row at most
        .withColumn("_place", F.row_number().over(W.partitionBy("_bucket").orderBy(column)))
        .where(F.col("_offset") + F.col("_place") == k)
    )
    return inside.agg(F.max(column).alias(column))


def _time_cells(rows: DataFrame, order: list[str], target: int) -> DataFrame:
    """Rows with `_micros`, `_bucket` and `_sub`: cells of at most about `target` rows in the order of a timestamp
    and, where many rows have one time, of an integer."""
    timed = rows.withColumn("_micros", F.unix_micros(F.col(order[0]).cast("timestamp")))
    bucketed, _ = order_buckets(timed, "_micros", target)
    return cut_ties(bucketed, order[1], target) if len(order) > 1 else bucketed.withColumn("_sub", F.lit(0).cast("long"))


def previous_value(rows: DataFrame, key: str, order: list[str], value: str, out: str,
                   target: int = BUCKET_ROWS) -> DataFrame:
    """`value` of the row before, per key, in the order given; its first column is a timestamp, the second,
    if any, an integer.

    A hot key is spread over cells of time, and one instant over cells of the second column. Inside
    a cell the row before is a plain `lag`; the first row of a cell takes the last value of the nearest
    earlier cell of its key, found on one summary row per key and cell.
    """
    bucketed = _time_cells(rows, order, target)
    cells = bucketed.groupBy(key, "_bucket", "_sub").agg(
        F.max(F.struct(*[F.col(c) for c in order], F.col(value).alias("_v")))["_v"].alias("_last"))
    carried = cells.withColumn(
        "_carried", F.lag("_last").over(W.partitionBy(key).orderBy("_bucket", "_sub"))
    ).select(key, "_bucket", "_sub", "_carried")
    inside = W.partitionBy(key, "_bucket", "_sub").orderBy(*order)
    return (
        bucketed.withColumn("_lag", F.lag(value).over(inside))
        .withColumn("_first", F.row_number().over(inside) == 1)
        .join(carried, [key, "_bucket", "_sub"])
        .withColumn(out, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_lag")))
        .drop("_bucket", "_sub", "_lag", "_first", "_carried", "_micros")
    )


def spaced_starts(rows: DataFrame, key: str, order: list[str], micros: int, out: str, earliest: DataFrame | None = None,
                  target: int = BUCKET_ROWS) -> DataFrame:
    """The time in microseconds at which each row of a key can start, in the order given (a timestamp, then an
    integer): not before its own time, and `micros` behind the row before. `earliest` has, per key, a time
    (`_from`, microseconds) before which no row starts.

    With the i-th row's time t(i), start(i) is i * micros plus the largest t(j) - j * micros up to i. So a key may
    be cut into cells anywhere: a cell is summed up as its number of rows and its largest such value, and sums and
    largest values of the earlier cells carry over.
    """
    cells, step = _time_cells(rows, order, target), F.lit(micros).cast("long")
    inside = W.partitionBy(key, "_bucket", "_sub").orderBy(*order)
    placed = cells.withColumn("_i", F.row_number().over(inside) - 1).withColumn("_v", F.col("_micros") - F.col("_i") * step)
    earlier = W.partitionBy(key).orderBy("_bucket", "_sub").rowsBetween(W.unboundedPreceding, -1)
    sums = placed.groupBy(key, "_bucket", "_sub").agg(F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_most"))
    sums = sums.withColumn("_rows", F.coalesce(F.sum("_n").over(earlier), F.lit(0))) \
        .withColumn("_carry", F.max(F.col("_most") - F.col("_rows") * step).over(earlier))
    if earliest is not None:
        sums = sums.join(earliest, key, "left").withColumn("_carry", F.greatest("_carry", "_from")).drop("_from")
    so_far = F.max("_v").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow))
    start = (F.col("_rows") + F.col("_i")) * step + F.greatest(F.col("_so_far") - F.col("_rows") * step, F.col("_carry"))
    return (
        placed.withColumn("_so_far", so_far).join(sums.drop("_n", "_most"), [key, "_bucket", "_sub"])
        .withColumn(out, start.cast("long"))
        .drop("_bucket", "_sub", "_i", "_v", "_so_far", "_rows", "_carry", "_micros")
    )
