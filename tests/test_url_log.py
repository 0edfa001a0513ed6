from pyspark.sql import functions as F

from pagelode.operators import frontier
from pagelode.session import workdir
from pagelode.sources.url_log import UrlLog


def urls(spark, numbers):
    return spark.createDataFrame([(f"https://a.edu/{i}",) for i in numbers], "url string")


def seen(log, last):
    return sorted(int(r.url.rsplit("/", 1)[1]) for r in log.read(last).distinct().collect())


def test_rounds_are_seen_once_they_are_finished(spark):
    log = UrlLog(spark, workdir(spark, "a log"), 4)
    log.append(urls(spark, range(10)), 0)
    log.append(urls(spark, range(10, 15)), 1)
    log.append(urls(spark, range(90, 99)), 2)  # breaks off
    assert seen(log, 1) == list(range(15)) and seen(log, 0) == list(range(10))
    log.append(urls(spark, range(15, 18)), 2)  # done again
    assert seen(log, 2) == list(range(18))


def test_compaction_keeps_the_set(spark):
    log = UrlLog(spark, workdir(spark, "log"), 4)
    for r in range(6):
        log.append(urls(spark, range(5 * r, 5 * r + 7)), r)
    assert log.compact_if_due(4, every=6) == 0
    assert log.compact_if_due(4, every=5) == 5
    assert seen(log, 4) == list(range(27)) and seen(log, 5) == list(range(32))
    log.append(urls(spark, [100]), 6)
    assert log.compact(6) == 3 and seen(log, 6) == [*range(32), 100]
    assert log.compact(6) == 0 and {t.name for t in spark.catalog.listTables() if t.name.startswith("urls_")} == set()


def test_the_log_is_not_shuffled(spark):
    log = UrlLog(spark, workdir(spark, "log"), 4)
    for r in range(3):
        log.append(urls(spark, range(20 * r, 20 * r + 20)), r)
    rows = urls(spark, range(50, 70)).hint("merge")
    joined = frontier.is_member(rows, log.read(2).distinct(), "known")
    assert sorted((int(r.url.rsplit("/", 1)[1]), r.known) for r in joined.collect()) == [(i, i < 60) for i in range(50, 70)]
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") <= 1
    assert log.read(2).where(F.col("url").isNull()).count() == 0


def test_a_log_keeps_its_number_of_buckets(spark):
    path = workdir(spark, "log")
    UrlLog(spark, path, 5).append(urls(spark, range(4)), 0)
    again = UrlLog.at(spark, path)
    assert again.buckets == 5 and seen(again, 0) == list(range(4))
    assert UrlLog.at(spark, workdir(spark, "log")).buckets == int(spark.conf.get("spark.sql.shuffle.partitions"))
