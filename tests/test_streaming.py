import glob
import random
import shutil

import pytest
from pyspark.sql import functions as F

from pagelode import schemas
from pagelode.operators import metrics
from pagelode.session import workdir
from pagelode.streaming import leases, streams

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ACTIONS = "event_id long, s long, action string, url string, worker_id string"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    yield
    spark.conf.set(PROVIDER, before)


def files(spark, rows, schema, parts, add=lambda df: df):
    """The rows as files in time order, one after the other."""
    path = workdir(spark, "stream-in")
    size = -(-len(rows) // parts)
    for i in range(parts):
        add(spark.createDataFrame(rows[i * size:(i + 1) * size], schema)).coalesce(1).write.mode("append").parquet(path)
    return path


def drain(spark, stream, out=None, label="out"):
    out = out or workdir(spark, label)
    streams.to_table(stream, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/table"), out


def test_discovered_once_over_files_and_restarts(spark):
    first = [(f"http://a.edu/{i % 5}#{i}",) for i in range(20)]
    path = files(spark, first, "url string", 4)
    read = lambda: streams.stream_discovered(streams.file_stream(spark, path, "*.parquet", "url string", 1))
    table, out = drain(spark, read())
    assert table.count() == 5
    spark.createDataFrame([("http://a.edu/4/",), ("http://a.edu/9",)], "url string").write.mode("append").parquet(path)
    table, _ = drain(spark, read(), out)
    assert sorted(r.url for r in table.collect()) == [f"http://a.edu/{i}" for i in (0, 1, 2, 3, 4, 9)]


def test_domain_counts_over_files(spark):
    rows = [(i, "ab"[i % 2]) for i in range(30)]
    path = files(spark, rows, "s long, domain string", 3, lambda df: df.withColumn("ts", F.timestamp_seconds("s")).drop("s"))
    stream = streams.file_stream(spark, path, "*.parquet", "domain string, ts timestamp", 1)
    out = workdir(spark, "counts")
    streams.keep_updates(streams.stream_domain_counts(stream), f"{out}/t", f"{out}/c").awaitTermination()
    got = streams.read_updates(spark, f"{out}/t", "domain", "domain string, n long, last_access timestamp")
    assert {(r.domain, r.n) for r in got.collect()} == {("a", 15), ("b", 15)}


def test_index_stream_last_write_wins(spark):
    rows = [(f"u{i % 4}", i) for i in range(12)] + [("", 99)]
    path = files(spark, rows, "url string, at long", 3)
    stream = streams.file_stream(spark, path, "*.parquet", "url string, at long", 1)
    out = workdir(spark, "index")
    for _ in range(2):  # the second run finds nothing new
        streams.stream_index_upsert(stream, out, f"{out}/checkpoint", ["at"]).awaitTermination()
    got = streams.read_index_stream(spark, out, "url string, at long", ["at"])
    assert sorted((r.url, r.at) for r in got.collect()) == [("u0", 8), ("u1", 9), ("u2", 10), ("u3", 11)]
    read = lambda: sorted((r.url, r.at) for r in streams.read_index_stream(spark, out, "url string, at long", ["at"]).collect())
    assert streams.read_index_quarantine(spark, out, "url string, at long").count() == 1
    assert streams.compact_index_stream(spark, out, "url string, at long", ["at"]) == 2
    spark.createDataFrame([("u0", 50)], "url string, at long").write.mode("append").parquet(path)
    streams.stream_index_upsert(stream, out, f"{out}/checkpoint", ["at"]).awaitTermination()
    assert read() == [("u0", 50), ("u1", 9), ("u2", 10), ("u3", 11)]
    # Compacted generations are not looked at again.
    spark.createDataFrame([("u9", 1, False)], "url string, at long, bad boolean").write.mode("overwrite").partitionBy("bad").parquet(f"{out}/docs/generation=0")
    assert read() == [("u0", 50), ("u1", 9), ("u2", 10), ("u3", 11)]
    assert streams.read_index_quarantine(spark, out, "url string, at long").count() == 1


@pytest.mark.parametrize("parts", [1, 3])
def test_a_table_is_a_file_or_a_folder(spark, parts):
    from __spark_entry__ import queries

    home = workdir(spark, "tables")
    rows = [(i, f"https://en.wikipedia.org/wiki/P{i}", f"<title>T{i}</title><a href='/wiki/Mountain_{'abcde'[i % 5] * 3}'>x</a>") for i in range(30)]
    made = spark.createDataFrame(rows, schemas.PAGES).repartition(parts)
    if parts > 1:
        made.write.parquet(f"{home}/pages.parquet")
    else:
        made.coalesce(1).write.parquet(f"{home}/written")
        [file] = glob.glob(f"{home}/written/*.parquet")
        shutil.copy(file, f"{home}/pages.parquet")
    stream = streams.file_stream(spark, home, "pages.parquet", schemas.PAGES, 1)
    table, _ = drain(spark, stream.select("page_id"))
    assert sorted(r.page_id for r in table.collect()) == list(range(30))
    assert queries()["stream_index_upsert"](spark, home).count() == 30
    got = queries()["stream_url_batches"](spark, home).collect()
    assert {(r.url, r.n) for r in got} == {(f"https://en.wikipedia.org/wiki/Mountain_{c * 3}", 6) for c in "abcde"}


def test_a_micro_batch_is_made_once(spark):
    rows = [(f"http://a.edu/{i % 30}", i) for i in range(90)]
    path = files(spark, rows, "url string, at long", 3)
    made = spark.sparkContext.accumulator(0)

    def parse(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch.assign(depth=1)

    stream = streams.file_stream(spark, path, "*.parquet", "url string, at long", 1).mapInPandas(parse, "url string, at long, depth int")
    out = workdir(spark, "once")
    streams.stream_index_upsert(stream, out, f"{out}/c1", ["at"]).awaitTermination()
    assert made.value == 90
    streams.stream_url_batches(stream, f"{out}/m", f"{out}/c2", F.lit("t"), ["at"], 25).awaitTermination()
    assert made.value == 180
    assert spark.read.text(f"{out}/m").count() == 6


def machine(rows, lease_ms):
    """State changes of each URL, events one by one; leases running at the end are left open."""
    out, state = [], {}
    for event_id, s, action, url, worker in sorted(rows, key=lambda r: (r[1], r[0])):
        at = s * 1000
        status, who, since = state.get(url, (None, None, None))
        if status == "inflight" and at >= since + lease_ms and action != "crash":
            out.append((url, since + lease_ms, "queued", who))
            status, who, since = state[url] = ("queued", None, None)
        if action == "enqueue" and status is None:
            state[url] = ("queued", None, None)
        elif action == "reserve" and status == "queued":
            state[url] = ("inflight", worker, at)
        elif action == "acknowledge" and status != "visited":
            state[url] = ("visited", worker, None)
        else:
            continue
        out.append((url, at, state[url][0], worker))
    end = max(r[1] for r in rows if r[2] != "crash") * 1000
    for url, (status, who, since) in state.items():
        if status == "inflight" and since + lease_ms <= end:
            out.append((url, since + lease_ms, "queued", who))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 4])
def test_leases_equal_one_by_one(spark, rocks, parts):
    rng = random.Random(17)
    times = sorted(rng.sample(range(1, 5000), 250))
    rows = [(i, t, rng.choice(["enqueue", "reserve", "reserve", "acknowledge", "crash"]), f"u{rng.randint(0, 40)}", f"w{rng.randint(0, 2)}")
            for i, t in enumerate(times)]
    path = files(spark, rows, ACTIONS, parts, lambda df: df.withColumn("ts", F.timestamp_seconds("s")).drop("s"))
    schema = "event_id long, action string, url string, worker_id string, ts timestamp"
    stream = streams.file_stream(spark, path, "*.parquet", schema, 1)
    table, _ = drain(spark, leases.stream_leases(stream, 300, "0 seconds"))
    assert sorted((r.url, r.at_ms, r.status, r.worker_id) for r in table.collect()) == machine(rows, 300_000)


def test_lost_worker_gives_its_url_back_once(spark, rocks):
    rows = [(0, 100, "enqueue", "u", "w1"), (1, 110, "reserve", "u", "w1"), (2, 900, "enqueue", "v", "w2")]
    path = files(spark, rows, ACTIONS, 3, lambda df: df.withColumn("ts", F.timestamp_seconds("s")).drop("s"))
    schema = "event_id long, action string, url string, worker_id string, ts timestamp"
    table, _ = drain(spark, leases.stream_leases(streams.file_stream(spark, path, "*.parquet", schema, 1), 300, "0 seconds"))
    assert [(r.at_ms, r.status) for r in table.where("url = 'u'").orderBy("at_ms").collect()] == [
        (100_000, "queued"), (110_000, "inflight"), (410_000, "queued")]


def test_gauges_and_ticks_by_hand(spark):
    rng = random.Random(19)
    rows = [(i, rng.randint(0, 400), rng.choice(["enqueue", "reserve", "acknowledge", "tick"]), f"u{rng.randint(0, 20)}", "w") for i in range(200)]
    df = spark.createDataFrame(rows, ACTIONS).withColumn("ts", F.timestamp_seconds("s"))
    state, sizes = {}, {}
    for _, s, action, url, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        if action != "tick":
            state[url] = metrics.STATE_AFTER[action]
            sizes[s // 5 * 5] = tuple(sum(v == k for v in state.values()) for k in metrics.STATES)
    ticks = metrics.monitor_ticks(df, 5, 10, target=3).select(F.unix_seconds("tick_start").alias("t"), "*").collect()
    assert {r.t: (r.queue_size, r.inflight_size, r.visited_count) for r in ticks} == sizes
    assert all(r.pressure == (r.queue_size > 8) for r in ticks)
    gauges = metrics.frontier_gauges(metrics.url_states(df)).first()
    assert (gauges.queue_size, gauges.inflight_size, gauges.visited_count) == sizes[max(sizes)]


def test_gauges_equal_the_batch_form(spark, rocks):
    """Over files, restarts and a compaction; ticks are divided among micro-batches."""
    rng = random.Random(11)
    rows = [(i, i // 3, rng.choice(["enqueue", "reserve", "acknowledge", "crash"]), f"u{rng.randint(0, 20)}", "w") for i in range(400)]
    add = lambda df: df.withColumn("ts", F.timestamp_seconds("s")).drop("s")
    schema = "event_id long, action string, url string, worker_id string, ts timestamp"
    out = workdir(spark, "gauges")

    def run(upto):
        path = files(spark, rows[:upto], ACTIONS, 4, add) if upto < len(rows) else paths[0]
        stream = streams.file_stream(spark, path, "*.parquet", schema, 1)
        streams.stream_gauges(stream, f"{out}/t", f"{out}/c", 10).awaitTermination()
        return path

    def same(upto):
        frame = add(spark.createDataFrame(rows[:upto], ACTIONS))
        wanted = metrics.monitor_ticks(frame, 10, 8).orderBy("tick_start").collect()
        assert streams.read_gauges(spark, f"{out}/t", 10, 8).orderBy("tick_start").collect() == wanted and wanted

    paths = [run(200)]
    same(200)
    assert streams.compact_gauges(spark, f"{out}/t") >= 0
    same(200)
    size = 50
    for i in range(4, 8):
        add(spark.createDataFrame(rows[i * size:(i + 1) * size], ACTIONS)).coalesce(1).write.mode("append").parquet(paths[0])
    run(400)
    same(400)
    streams.compact_gauges(spark, f"{out}/t")
    same(400)


def _lease_files(spark):
    rows = [(i, 1 + i // 3, ("enqueue", "reserve", "acknowledge")[i % 3], f"u{i // 3}", f"w{i // 3}") for i in range(30)]
    path = files(spark, rows, "event_id long, s long, action string, url string, worker_id string", 1,
                 lambda df: df.withColumn("ts", F.timestamp_seconds("s")).drop("s"))
    return streams.file_stream(spark, path, "*.parquet", "event_id long, action string, url string, worker_id string, ts timestamp")


def test_the_key_of_leases_is_a_column(spark, rocks):
    """As an expression of groupBy it could not be resolved."""
    table, _ = drain(spark, leases.stream_leases(_lease_files(spark), 60, buckets=2), label="leases")
    assert sorted((r.url, r.status) for r in table.collect()) == sorted(
        (f"u{i}", s) for i in range(10) for s in ("queued", "inflight", "visited"))


def test_an_event_without_a_time_does_not_stop_the_leases(spark, rocks):
    rows = [(0, 100, "enqueue", "u", "w"), (1, 110, "reserve", "u", "w"), (2, None, "acknowledge", "u", "w"), (3, 120, "enqueue", "v", "w"),
            (4, None, "reserve", "v", "w")]
    path = files(spark, rows, ACTIONS, 1, lambda df: df.withColumn("ts", F.timestamp_seconds("s")).drop("s"))
    stream = streams.file_stream(spark, path, "*.parquet", "event_id long, action string, url string, worker_id string, ts timestamp")
    table, _ = drain(spark, leases.stream_leases(stream, 300, buckets=1), label="leases")
    assert {(r.url, r.at_ms, r.status) for r in table.collect()} == {
        ("u", 100_000, "queued"), ("u", 110_000, "inflight"), ("u", None, "visited"), ("v", 120_000, "queued"), ("v", None, "inflight")}


def test_the_key_of_gauges_is_a_column(spark, rocks):
    out = workdir(spark, "gauges")
    streams.stream_gauges(_lease_files(spark), f"{out}/t", f"{out}/c", 5, buckets=2).awaitTermination()
    last = streams.read_gauges(spark, f"{out}/t", 5).orderBy(F.desc("tick_start")).first()
    assert [v for k, v in last.asDict().items() if "visited" in k] == [10]


def test_links_of_a_folder_of_pages_are_batched(spark):
    from __spark_entry__ import queries

    home = workdir(spark, "tables")
    rows = [(i, f"https://www.example.org/wiki/P{i}", f"<title>T{i}</title><a href='/wiki/Mountain_{'abcde'[i % 5] * 3}'>x</a>") for i in range(30)]
    spark.createDataFrame(rows, schemas.PAGES).repartition(3).write.parquet(f"{home}/pages.parquet")
    assert queries()["stream_index_upsert"](spark, home).count() == 30
    got = queries()["stream_url_batches"](spark, home).collect()
    assert {(r.url, r.n) for r in got} == {(f"https://www.example.org/wiki/Mountain_{c * 3}", 6) for c in "abcde"}
