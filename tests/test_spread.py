import random

from pyspark.sql import functions as F

from pagelode.operators import spread


def test_numbered_is_dense_and_in_order(spark):
    rng = random.Random(3)
    pairs = [(page, pos) for page in rng.sample(range(10**6), 200) for pos in range(rng.randint(1, 4))]
    rows = spark.createDataFrame(pairs, "a long, b int").repartition(7)
    got = spread.numbered(rows, ["a", "b"], target=20).orderBy("seq").collect()
    assert [(r.a, r.b) for r in got] == sorted(pairs)
    assert [r.seq for r in got] == list(range(1, len(pairs) + 1))


def test_kth_smallest(spark):
    values = random.Random(4).sample(range(10**6), 300)
    rows = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    for k in (1, 2, 150, 300):
        assert spread.kth_smallest(rows, "v", k, target=20).first()[0] == sorted(values)[k - 1]
    assert spread.kth_smallest(rows, "v", 301, target=20).first()[0] is None


def test_lookup_join_cuts_hot_keys(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"))
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("unused", 3)], "key string, v int")
    want = {(r.id, r.v) for r in rows.join(table, "key", "left").collect()}
    joined = spread.lookup_join(rows, table, "key", "id", hot_rows=100)
    assert {(r.id, r.v) for r in joined.collect()} == want
    assert joined.count() == 1000
    assert spread.lookup_join(rows, table, "key", "id", "inner", hot_rows=100).count() == sum(v is not None for _, v in want)


def test_previous_value_crosses_buckets(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("aab"), rng.randint(0, 5000)) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, key string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = spread.previous_value(df, "key", ["ts", "event_id"], "s", "prev", target=30).collect()
    want = {}
    for key in "ab":
        last = None
        for i, _, s in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])):
            want[i] = last
            last = s
    assert {r.event_id: r.prev for r in got} == want


def test_bucket_offsets_over_runs(spark):
    counts = spark.range(25_000).select(F.col("id").alias("b"), (F.col("id") % 5).alias("n"))
    out = spread.bucket_offsets(counts, "b", {"n": "before"}).where("b in (0, 1, 9999, 10000, 24999)").orderBy("b").collect()
    assert [r.before for r in out] == [sum(i % 5 for i in range(b)) for b in (0, 1, 9999, 10000, 24999)]


def largest(rows, column, target):
    return spread.order_buckets(rows, column, target)[0].groupBy("_bucket").count().agg(F.max("count")).first()[0]


def test_an_outlier_does_not_fill_one_bucket(spark):
    rows = spark.range(50_000).select((F.col("id") + 1_700_000_000_000_000).alias("t")).union(spark.range(1).select(F.lit(0).cast("long")))
    assert largest(rows, "t", 1000) <= 1000


def test_sparse_ids_fill_buckets_evenly(spark):
    rows = spark.range(0, 40_000, 1, 7).select(F.monotonically_increasing_id().alias("t"))
    assert largest(rows, "t", 500) <= 500
    seq = spread.numbered(rows, ["t"], target=500)
    assert [r.seq for r in seq.orderBy("t").collect()] == list(range(1, 40_001))


def test_one_value_stays_one_bucket_and_nulls_come_first(spark):
    rows = spark.createDataFrame([(5,)] * 300 + [(i,) for i in range(100)] + [(None,)], "t long")
    bucketed, _ = spread.order_buckets(rows, "t", 50)
    sizes = {r._bucket: (r.low, r.high) for r in bucketed.groupBy("_bucket").agg(F.min("t").alias("low"), F.max("t").alias("high")).collect()}
    ordered = [sizes[b] for b in sorted(sizes)]
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))
    assert spread.numbered(rows, ["t"], target=50).count() == 401
    assert spread.numbered(rows.where("false"), ["t"]).count() == 0


def test_the_list_of_hot_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(spread, "SMALL_ROWS", 3)
    counts = spark.createDataFrame([(f"k{i}", 10 * i) for i in range(10)], "k string, n long")
    got = {r.k: r._pieces for r in spread.hot_pieces(counts, "k", "n", 20).collect()}
    assert got == {"k9": 5, "k8": 4, "k7": 4}


def test_one_instant_is_cut_by_the_second_column(spark):
    """A third of the rows at one instant: no cell of a key has more than the target, or little more."""
    rng = random.Random(6)
    rows = [(i, "ab"[i % 5 == 0], 777 if i % 3 == 0 else rng.randint(0, 2000)) for i in range(6000)]
    df = spark.createDataFrame(rows, "event_id long, key string, s long").withColumn("ts", F.timestamp_seconds("s"))
    cells = spread._time_cells(df, ["ts", "event_id"], 300).groupBy("_bucket", "_sub").count().collect()
    assert max(r["count"] for r in cells) <= 300 and sum(r["count"] for r in cells) == 6000
    got = {r.event_id: r.prev for r in spread.previous_value(df, "key", ["ts", "event_id"], "event_id", "prev", target=300).collect()}
    for key in "ab":
        own = [i for i, _, _ in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))]
        assert [got[i] for i in own] == [None, *own[:-1]]


def test_spaced_starts_equal_a_walk(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice("aaab"), 500 if i % 3 == 0 else rng.randint(0, 3000)) for i in range(900)]
    df = spark.createDataFrame(rows, "event_id long, key string, s long").withColumn("ts", F.timestamp_seconds("s"))
    known = spark.createDataFrame([("a", 700 * 10**6), ("c", 5)], "key string, _from long")
    for earliest, first in ((None, {}), (known, {"a": 700 * 10**6})):
        got = {r.event_id: r.start for r in spread.spaced_starts(df, "key", ["ts", "event_id"], 2 * 10**6, "start", earliest, target=40).collect()}
        for key in "ab":
            free = first.get(key, 0)
            for i, _, s in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])):
                start = max(s * 10**6, free)
                assert got[i] == start
                free = start + 2 * 10**6
