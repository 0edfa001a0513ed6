"""Operator 8: Merkle fixity audit of WARC archives.

A record's leaf is the SHA-256 of its bytes with its offset and length. The lowest nodes hash the
leaves of one range of offsets in order, and each higher node the nodes of `FANOUT` neighbouring
ranges, up to one root per file. An audit compares the roots of two replicas and then, level by level,
only the children of nodes that differ, down to the ranges.

A replica is laid out from its own rows, so where it lost or gained bytes, all later records of the file
lie elsewhere and their ranges differ too. So the records of neighbouring differing ranges are realigned: the
k-th record with a digest in one replica is the k-th with it in the other, wherever it lies. What is left
over is a fault: `changed` if the other replica has a record at the same distance behind the last record that
both have, else `missing` or `extra`. Records that only lie elsewhere are none.

All of it is joins and groups of bounded size: a node has at most `FANOUT` children, the lowest one
the records of `RANGE_BYTES`, a file the distinct records of `PAGES_PER_FILE` pages; a file of more than
`MOST_RECORDS` is several, by a hash of the url. Payloads are hashed where they are read and never move.

Null columns: an empty url or payload; a record without a page_id lies in file -1 (or a file that goes on from it).
Payloads of any length are hashed whole. Repeated rows: each is a record with its own offset; equal records are
told apart by their order. Ties: records of one page lie in the order of their digests. Empty tables: no rows; a replica
without a file lacks all its records. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.llm.common import query, stored, table
from pagelode.operators.spread import hot_pieces

RANGE_BYTES = 65_536
FANOUT = 16
LEVELS = 4
PAGES_PER_FILE = 1000
MOST_RECORDS = 100_000
# Added to a file's number for each further file of the same pages.
NEXT_FILE = 1 << 40


def record_bytes(url: Column, payload: Column) -> Column:
    """A response record: header block, payload, two empty lines."""
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def archive(pages: DataFrame, pages_per_file: int = PAGES_PER_FILE, as_found=None, most_records: int = MOST_RECORDS) -> DataFrame:
    """page_id, file, offset, length and digest of each page's record, records laid end to end per file.

    `as_found(record, page_id)` gives the bytes that a replica holds in the record's place."""
    url, payload = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("url", "html"))
    record = record_bytes(url, payload)
    if as_found:
        record = as_found(record, F.col("page_id"))
    rows = stored(pages.select(
        F.col("page_id").cast("long"), F.coalesce(F.floor(F.col("page_id") / pages_per_file), F.lit(-1)).cast("long").alias("file"),
        F.xxhash64(url).alias("_url"), F.octet_length(record).cast("long").alias("length"), F.sha2(record.cast("binary"), 256).alias("digest")), "records")
    # Equal records need no order among them: they lie behind one another.
    distinct = rows.groupBy("file", "page_id", "_url", "digest", "length").agg(F.count(F.lit(1)).alias("_n"))
    large = hot_pieces(distinct.groupBy("file").agg(F.count(F.lit(1)).alias("_m")), "file", "_m", most_records)
    part = F.coalesce(F.pmod(F.col("_url"), F.col("_pieces")), F.lit(0))
    placed = distinct.join(F.broadcast(large), "file", "left").withColumn("file", F.col("file") + part * NEXT_FILE)
    before = W.partitionBy("file").orderBy("page_id", "digest", "length", "_url").rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.withColumn("_start", F.coalesce(F.sum(F.col("length") * F.col("_n")).over(before), F.lit(0)))
        .select("page_id", "file", "_start", "length", "digest", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_copy"))
        .select("page_id", "file", (F.col("_start") + F.col("_copy") * F.col("length")).alias("offset"), "length", "digest")
    )


def tree(records: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT, levels: int = LEVELS) -> list[DataFrame]:
    """Node tables from the lowest level to the roots: file, node (number of its range), digest."""
    leaf = F.concat_ws(":", "offset", "length", "digest")
    nodes = records.groupBy("file", F.floor(F.col("offset") / range_bytes).cast("long").alias("node")).agg(
        F.sha2(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("offset", "length", "digest", leaf.alias("leaf")))), lambda r: r["leaf"]), "|").cast("binary"), 256).alias("digest"))
    out = [stored(nodes, "fixity-0")]
    last = out[0].agg(F.max("node")).first()[0] or 0
    while len(out) <= levels or last >= fanout ** (len(out) - 1):
        child = F.struct("node", F.concat_ws(":", "node", "digest").alias("child"))
        up = out[-1].groupBy("file", F.floor(F.col("node") / fanout).cast("long").alias("up")).agg(
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda c: c["child"]), "|").cast("binary"), 256).alias("digest"))
        out.append(stored(up.withColumnRenamed("up", "node"), f"fixity-{len(out)}"))
    return out


def _differing(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys that one side lacks or whose digests differ."""
    left = a.select(*key, F.col("digest").alias("_a"))
    right = b.select(*key, F.col("digest").alias("_b"))
    return left.join(right, key, "full").where(~F.col("_a").eqNullSafe(F.col("_b")))


def audit(a: DataFrame, b: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Records in which replica b differs from a: file, offset (in a; of an extra record in b), status (changed,
    missing, extra), both digests and lengths (length 0: no record), and both roots of the file. Inputs have file,
    offset, length and digest."""
    columns = ["file", "offset", "length", "digest"]
    a, b = stored(a.select(*columns), "replica-a"), stored(b.select(*columns), "replica-b")
    trees = [tree(x, range_bytes, fanout, levels) for x in (a, b)]
    height = max(map(len, trees))
    trees = [tree(x, range_bytes, fanout, height - 1) if len(t) < height else t for x, t in zip((a, b), trees)]
    # A few rows per level, stored, so that no plan holds those of the levels above.
    found = stored(_differing(trees[0][-1], trees[1][-1], ["file", "node"]), "differing")
    roots = found.select("file", F.col("_a").alias("root_a"), F.col("_b").alias("root_b"))
    for level in range(height - 2, -1, -1):
        # Only children of nodes that differ are looked at.
        parents = found.select("file", F.col("node").alias("_parent"))
        sides = [
            t[level].withColumn("_parent", F.floor(F.col("node") / fanout).cast("long")).join(parents, ["file", "_parent"], "left_semi")
            for t in trees]
        found = stored(_differing(*sides, ["file", "node"]), "differing")
    # Neighbouring ranges that differ are one run, numbered by the place of its first range.
    runs = found.select("file", "node", (F.col("node") - F.row_number().over(W.partitionBy("file").orderBy("node"))).alias("run"))
    left, right = (stored(_aligned(x, runs, range_bytes), "aligned") for x in (a, b))
    key = ["file", "run", "digest", "length", "_k"]
    pairs = stored(left.select(*key, F.col("offset").alias("_in_a")).join(right.select(*key, F.col("offset").alias("_in_b")), key), "pairs")
    faults = [_unpaired(left, pairs, "_in_a", "_in_a", "a"), _unpaired(right, pairs, "_in_b", "_in_a", "b")]
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return (
        faults[0].join(faults[1], ["file", "run", "_anchor", "_distance", "_place"], "full").join(roots, "file")
        .select("file", F.coalesce("offset_a", "offset_b").alias("offset"), status.alias("status"),
                *[F.coalesce(c, F.lit(0)).alias(c) for c in ("length_a", "length_b")], "digest_a", "digest_b", "root_a", "root_b")
    )


def _aligned(records: DataFrame, runs: DataFrame, range_bytes: int) -> DataFrame:
    """The records of the differing ranges, each with its run and its place `_k` among equal ones there."""
    inside = records.withColumn("node", F.floor(F.col("offset") / range_bytes).cast("long")).join(runs, ["file", "node"]).drop("node")
    return inside.withColumn("_k", F.row_number().over(W.partitionBy("file", "run", "digest", "length").orderBy("offset")))


def _unpaired(records: DataFrame, pairs: DataFrame, own: str, anchor: str, side: str) -> DataFrame:
    """Records without a partner, with the last paired record before (by its offset in replica a), their distance from
    it, and their place among several at that distance."""
    paired = records.join(pairs.select("file", "run", F.col(own).alias("offset"), "digest", "length", "_k", F.col(anchor).alias("_anchor"), F.lit(True).alias("_paired")),
                          ["file", "run", "offset", "digest", "length", "_k"], "left")
    before = W.partitionBy("file", "run").orderBy("offset", "digest", "length", "_k").rowsBetween(W.unboundedPreceding, -1)
    last = {"_last": F.last("_anchor", True).over(before), "_at": F.last(F.when(F.col("_paired"), F.col("offset")), True).over(before)}
    alone = paired.withColumns(last).where(F.col("_paired").isNull())
    placed = alone.select(
        "file", "run", F.coalesce("_last", F.lit(-1)).alias("_anchor"), (F.col("offset") - F.coalesce("_at", F.lit(0))).alias("_distance"),
        "offset", "length", "digest")
    place = F.row_number().over(W.partitionBy("file", "run", "_anchor", "_distance").orderBy("digest", "length"))
    return placed.withColumn("_place", place).withColumnsRenamed({c: f"{c}_{side}" for c in ("offset", "length", "digest")})


def faulty(record: Column, page_id: Column) -> Column:
    """Changed bytes in some records, a lost last byte in others."""
    return (
        F.when(page_id % 97 == 3, F.translate(record, "e", "3"))
        .when(page_id % 101 == 5, F.substr(record, F.lit(1), F.length(record) - 1)).otherwise(record))


def damaged(pages: DataFrame) -> DataFrame:
    """The pages that a replica holds records of: some are lost, some are there twice."""
    kept = pages.where(~F.coalesce(F.col("page_id") % 103 == 7, F.lit(False)))
    return kept.unionByName(pages.where(F.col("page_id") % 107 == 9))


def _tree_sql(side: str) -> str:
    levels = [f"""
{side}_0 AS (
  SELECT file, "offset" // {RANGE_BYTES} AS node,
    sha256(string_agg("offset" || ':' || length || ':' || digest, '|' ORDER BY "offset", length, digest)) AS digest
  FROM {side} GROUP BY ALL)"""]
    levels += [f"""
{side}_{k} AS (
  SELECT file, node // {FANOUT} AS node, sha256(string_agg(node || ':' || digest, '|' ORDER BY node)) AS digest
  FROM (SELECT file, node, digest FROM {side}_{k - 1}) AS below GROUP BY file, below.node // {FANOUT})""" for k in range(1, LEVELS + 1)]
    return ",".join(levels)


SQL = f"""
WITH raw AS (
  SELECT page_id, page_id // {PAGES_PER_FILE} AS file, page_id AS mark,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html
    || chr(13) || chr(10) || chr(13) || chr(10) AS r
  FROM (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages)),
a AS (
  SELECT file, strlen(r) AS length, sha256(r) AS digest,
    coalesce(sum(strlen(r)) OVER (PARTITION BY file ORDER BY page_id, sha256(r) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM raw),
worse AS (
  SELECT page_id, file, mark,
    CASE WHEN mark % 97 = 3 THEN replace(r, 'e', '3') WHEN mark % 101 = 5 THEN left(r, length(r) - 1) ELSE r END AS r FROM raw),
held AS (SELECT * FROM worse WHERE mark % 103 <> 7 UNION ALL SELECT * FROM worse WHERE mark % 107 = 9),
b AS (
  SELECT file, strlen(r) AS length, sha256(r) AS digest,
    coalesce(sum(strlen(r)) OVER (PARTITION BY file ORDER BY page_id, sha256(r) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM held),
{_tree_sql("a")},
{_tree_sql("b")},
roots AS (
  SELECT file, x.digest AS root_a, y.digest AS root_b FROM a_{LEVELS} AS x FULL JOIN b_{LEVELS} AS y USING (file)
  WHERE x.digest IS DISTINCT FROM y.digest),
runs AS (
  SELECT file, node, node - row_number() OVER (PARTITION BY file ORDER BY node) AS run
  FROM a_0 AS x FULL JOIN b_0 AS y USING (file, node) WHERE x.digest IS DISTINCT FROM y.digest),
{",".join(f"""
in_{x} AS (
  SELECT r.file, run, "offset", length, digest, row_number() OVER (PARTITION BY r.file, run, digest, length ORDER BY "offset") AS k
  FROM {x} AS r JOIN runs ON runs.file = r.file AND runs.node = r."offset" // {RANGE_BYTES})""" for x in "ab")},
{",".join(f"""
alone_{x} AS (
  SELECT file, run, coalesce(paired_last, -1) AS anchor, "offset" - coalesce(own_last, 0) AS distance, "offset", length, digest,
    row_number() OVER (PARTITION BY file, run, coalesce(paired_last, -1), "offset" - coalesce(own_last, 0) ORDER BY digest, length) AS place
  FROM (
    SELECT m.file, m.run, m."offset", m.length, m.digest, o."offset" IS NOT NULL AS paired,
      last_value(CASE WHEN o."offset" IS NOT NULL THEN {first}."offset" END IGNORE NULLS) OVER before AS paired_last,
      last_value(CASE WHEN o."offset" IS NOT NULL THEN m."offset" END IGNORE NULLS) OVER before AS own_last
    FROM in_{x} AS m LEFT JOIN in_{y} AS o USING (file, run, digest, length, k)
    WINDOW before AS (PARTITION BY m.file, m.run ORDER BY m."offset", m.digest, m.length, m.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  WHERE NOT paired)""" for x, y, first in (("a", "b", "m"), ("b", "a", "o")))}
SELECT file, coalesce(x."offset", y."offset") AS "offset",
  CASE WHEN y.digest IS NULL THEN 'missing' WHEN x.digest IS NULL THEN 'extra' ELSE 'changed' END AS status,
  coalesce(x.length, 0) AS length_a, coalesce(y.length, 0) AS length_b, x.digest AS digest_a, y.digest AS digest_b, root_a, root_b
FROM alone_a AS x FULL JOIN alone_b AS y USING (file, run, anchor, distance, place) JOIN roots USING (file)
"""


@query("op8_merkle_fixity", SQL)
def op8(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return audit(archive(pages), archive(damaged(pages), as_found=faulty))
