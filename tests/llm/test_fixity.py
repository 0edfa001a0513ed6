import hashlib

from pyspark.sql import functions as F

from pagelode.llm import fixity


def records(spark, rows):
    return spark.createDataFrame(rows, "file long, offset long, length long, digest string, text string")


def make(file, n, size=100):
    return [(file, i * size, size, hashlib.sha256(f"{file}-{i}".encode()).hexdigest(), "x") for i in range(n)]


def found(spark, a, b, **options):
    out = fixity.audit(records(spark, a), records(spark, b), **options)
    return sorted((r.file, r.offset, r.status) for r in out.collect())


def test_locates_each_kind_of_fault(spark):
    a = make(0, 500) + make(1, 300) + make(2, 10)
    b = [r for r in a if r[:2] not in ((0, 700), (1, 29_900))]
    b = [(*r[:3], "0" * 64, "") if r[:2] == (0, 40_000) else r for r in b]
    b = [(r[0], r[1], 99, r[3], "") if r[:2] == (0, 900) else r for r in b] + [(1, 29_901, 5, "f" * 64, "")]
    small = {"range_bytes": 1000, "fanout": 4, "levels": 2}
    assert found(spark, a, b, **small) == [
        (0, 700, "missing"), (0, 900, "changed"), (0, 40_000, "changed"), (1, 29_900, "missing"), (1, 29_901, "extra")]
    assert found(spark, a, a, **small) == []


def test_whole_files_and_empty_sides(spark):
    a = make(0, 3) + make(1, 2)
    assert found(spark, a, a[:3]) == [(1, 0, "missing"), (1, 100, "missing")]
    assert found(spark, [], a[:1]) == [(0, 0, "extra")]
    assert found(spark, a[:1], []) == [(0, 0, "missing")]
    assert found(spark, [], []) == []


def test_repeated_records_count(spark):
    a = make(0, 2) + make(0, 2)
    assert found(spark, a, a) == []
    assert found(spark, a, a[:3]) == [(0, 100, "missing")]


def test_a_tree_of_one_file(spark):
    a = make(0, 7)
    levels = fixity.tree(records(spark, a), range_bytes=200, fanout=2, levels=2)
    node = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lowest = [node("|".join(f"{o}:{n}:{d}" for _, o, n, d, _ in a[i:i + 2])) for i in (0, 2, 4, 6)]
    assert [r.digest for r in levels[0].orderBy("node").collect()] == lowest
    up = [node("|".join(f"{i + k}:{lowest[i + k]}" for k in (0, 1))) for i in (0, 2)]
    assert [r.digest for r in levels[1].orderBy("node").collect()] == up
    assert [r.digest for r in levels[-1].collect()] == [node(f"0:{up[0]}|1:{up[1]}")]


def test_hard_pages(spark):
    rows = [(1, "http://a/", "ab"), (1, "http://a/", "ab"), (2, None, None), (None, "u", "x" * 100_000), (4, "ü", "日本")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, offset int")
    laid = fixity.archive(pages)
    got = laid.orderBy("file", "offset").collect()
    assert len(got) == 5
    for file in (-1, 0):
        end = 0
        for r in (r for r in got if r.file == file):
            assert r.offset == end
            end += r.length
    raw = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: ü\r\nContent-Length: 6\r\n\r\n日本\r\n\r\n".encode()
    assert (len(raw), hashlib.sha256(raw).hexdigest()) in {(r.length, r.digest) for r in got}
    assert fixity.audit(laid, laid).count() == 0
    assert fixity.audit(laid, fixity.archive(fixity.damaged(pages), as_found=fixity.faulty)).count() == 0  # no page_id of these has a fault
    assert fixity.archive(pages.where("false"), as_found=fixity.faulty).count() == 0


def pages_of(spark, n=300):
    rows = [(i, f"http://a/{i}", f"page {i} " * (50 + i % 7)) for i in range(n)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def audited(spark, pages, other, **options):
    small = {"range_bytes": 4000, "fanout": 4, "levels": 2}
    laid = fixity.archive(pages, **options)
    at = {(r.file, r.offset): r.page_id for r in laid.collect()}
    out = fixity.audit(laid, fixity.archive(other, **options), **small).collect()
    return sorted((at.get((r.file, r.offset)), r.status) for r in out if r.status != "extra"), sum(r.status == "extra" for r in out)


def test_a_replica_of_its_own_rows_with_one_record_gone(spark):
    pages = pages_of(spark)
    assert audited(spark, pages, pages.where("page_id <> 40"), pages_per_file=100) == ([(40, "missing")], 0)
    assert audited(spark, pages, pages, pages_per_file=100) == ([], 0)


def test_a_replica_of_its_own_rows_with_many_faults(spark):
    pages = pages_of(spark)
    worse = pages.where("page_id not in (0, 57, 58, 299)").withColumn(
        "html", F.when(F.col("page_id").isin(5, 150, 298), F.concat("html", F.lit("!"))).otherwise(F.col("html")))
    worse = worse.unionByName(pages.where("page_id in (80, 210)"))
    faults, extra = audited(spark, pages, worse, pages_per_file=100)
    assert faults == [(0, "missing"), (5, "changed"), (57, "missing"), (58, "missing"), (150, "changed"), (298, "changed"), (299, "missing")]
    assert extra == 2


def test_large_files_are_cut(spark):
    rows = [(None, f"u{i}", "x") for i in range(500)] + [(7, "same", "copy")] * 400
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    laid = fixity.archive(pages, most_records=50)
    assert laid.count() == 900
    sizes = {r.file: r["count"] for r in laid.where("page_id is null").groupBy("file").count().collect()}
    assert len(sizes) >= 8 and max(sizes.values()) < 120
    same = sorted((r.offset, r.length) for r in laid.where("page_id = 7").collect())
    assert [o for o, _ in same] == [i * same[0][1] for i in range(400)]
    gone = spark.createDataFrame(rows[3:-2], "page_id long, url string, html string")
    out = fixity.audit(laid, fixity.archive(gone, most_records=50)).collect()
    assert sorted(r.status for r in out) == ["missing"] * 5
