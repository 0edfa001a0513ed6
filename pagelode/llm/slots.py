"""Operator 10: sharding by fixed virtual slots.

A record's slot never changes: a hash of its doc_id and text modulo thousands of slots. Bytes and rows are
aggregated per slot, and a versioned slot-to-shard map says where each slot lies. The first version
deals the slots out by number, before any sizes are known. Later versions are edits of the one before:
`rebalanced` moves slots off the fullest shards, and exchanges them where no move helps, `grown` moves slots from
the fullest shards into a new one and nowhere else. The map has a row per slot and version, so it is
small whatever the data, and the law that holds is `bytes`: shard sizes near equal. `shard` writes version
1, the rebalanced version 2, which places the records, and version 3 with one more shard.

Equal rows are interchangeable, so those that would make one slot heavy are spread: where the copies of one
row have more than a `1 / HEAVY` part of a mean slot's bytes or rows, each copy takes one of as many
slots as that makes parts, by its place in the stored records. There are at most 2 `HEAVY` such rows per slot, a proven bound.

The place of a record inside its shard (`slot` of the digest) is its place inside the virtual slot
plus the rows of the shard's earlier virtual slots, so no shard is ever sorted as a whole: the
window works on one virtual slot of thousands.

Null text: one byte, checksum of nothing. Null or repeated doc_ids: a hash of the text tells rows apart. Repeated
rows (ties of all that orders records): each has its own place, whichever of them it is. Texts of any length are one record,
measured where they are read; one text is in one shard, so a shard is no smaller than its largest. Empty table:
no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.llm.common import query, stored, table
from pagelode.session import workdir

SLOTS = 8192
SHARDS = 16
HEAVY = 4


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, `_key` (equal for equal rows) and `_row` of each row; texts are read, not kept."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return narrow.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.xxhash64(F.lit("id"), "doc_id", F.lit("text"), "text").alias("_key"), F.monotonically_increasing_id().alias("_row"))


def in_slots(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Adds virtual_slot to stored records."""
    total = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    parts = slots * HEAVY
    copies = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_bytes")).where("_n > 1")
    share = F.greatest(F.col("_n") * parts / max(total.rows, 1), F.col("_bytes") * parts / max(total.bytes or 0, 1))
    # A key here has over 1 / parts of all rows or bytes, so there are fewer than 2 * parts of them.
    heavy = copies.where(share > 1).select("_key", F.least("_n", F.ceil(share)).alias("_parts"))
    part = F.coalesce(F.pmod(F.xxhash64("_row"), F.col("_parts")), F.lit(0).cast("long"))
    slot = F.pmod(F.xxhash64("_key", part), F.lit(slots)).cast("int")
    return rows.join(F.broadcast(heavy), "_key", "left").withColumn("virtual_slot", slot).drop("_parts", "_key", "_row")


def slot_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


# Edits of the map work on one number pair per slot, on the driver: a fixed number of slots.

def numbered(slots: int, shards: int) -> list[int]:
    """First map: slots to shards by number, whatever they will hold."""
    return [slot % shards for slot in range(slots)]


def grown(shard_of: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """A map with one more shard, filled from the fullest ones; no other shard takes a slot."""
    out, new = list(shard_of), shards
    held, own = _held(out, sizes, shards)
    goal = sum(sizes.values()) // (shards + 1)
    taken = 0
    while taken < goal:
        fullest = max(range(shards), key=lambda s: held[s])
        room = min(goal - taken, max(held[fullest] - goal, 1))
        # The heaviest slot that fits, else the lightest, unless that overshoots by more than it helps.
        fits = [s for s in own[fullest] if 0 < sizes.get(s, 0) <= room]
        if not fits:
            break
        slot = max(fits, key=lambda s: (sizes.get(s, 0), -s))
        own[fullest].remove(slot)
        out[slot] = new
        held[fullest] -= sizes.get(slot, 0)
        taken += sizes.get(slot, 0)
    return out


def rebalanced(shard_of: list[int], sizes: dict[int, int], shards: int, tolerance: float = 0.0) -> list[int]:
    """Moves slots from the fullest to the emptiest shard, or exchanges two, as long as that brings them nearer
    to each other and they differ by more than the tolerance (a share of the mean)."""
    out = list(shard_of)
    held, own = _held(out, sizes, shards)
    mean = max(1, sum(sizes.values()) // shards)
    by_size = {s: sorted((sizes.get(slot, 0), slot) for slot in slots) for s, slots in own.items()}
    while True:
        full, empty = max(range(shards), key=lambda s: held[s]), min(range(shards), key=lambda s: held[s])
        gap = held[full] - held[empty]
        if gap <= tolerance * mean:
            return out
        # What leaves the fullest and what comes back for it, (0, -1) for nothing: nearest to half the gap.
        takes, gives = by_size.setdefault(empty, []), by_size[full]
        best = None
        for size, slot in gives:
            at = bisect_left(takes, (size - gap // 2, -1))
            for back in [(0, -1), *takes[max(at - 1, 0):at + 1]]:
                change = size - back[0]
                if 0 < change < gap and (best is None or abs(2 * change - gap) < best[0]):
                    best = abs(2 * change - gap), (size, slot), back
        if best is None:
            return out
        _, given, back = best
        for moved, source, target in ((given, full, empty), (back, empty, full)):
            if moved[1] >= 0:
                by_size[source].remove(moved)
                by_size[target].insert(bisect_left(by_size[target], moved), moved)
                out[moved[1]] = target
                held[source] -= moved[0]
                held[target] += moved[0]


def _held(shard_of: list[int], sizes: dict[int, int], shards: int) -> tuple[list[int], dict[int, list[int]]]:
    held, own = [0] * shards, defaultdict(list)
    for slot, shard in enumerate(shard_of):
        held[shard] += sizes.get(slot, 0)
        own[shard].append(slot)
    return held, own


class SlotMap:
    """A versioned map, one folder per version: virtual_slot, shard. Versions are never rewritten."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, version: int, shard_of: list[int]) -> DataFrame:
        listed = F.split(F.lit(",".join(map(str, shard_of))), ",").cast("array<int>")
        self.spark.range(1).select(F.posexplode(listed).alias("virtual_slot", "shard")).write.parquet(f"{self.path}/version={version}")
        return self.read(version)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema("virtual_slot int, shard int").parquet(f"{self.path}/version={version}")

    def shards(self, version: int) -> list[int]:
        """The map as a list by slot; its length is the fixed number of slots."""
        return [r.shard for r in self.read(version).orderBy("virtual_slot").toLocalIterator()]


def placed(rows: DataFrame, sizes: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds shard and the place in it to records. `sizes` and the map have a row per virtual slot."""
    before = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)
    starts = slot_map.join(sizes, "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(starts), "virtual_slot")  # a row per slot, their number is fixed
        .withColumn("slot", (F.col("_start") + F.col("_place") - 1).cast("long"))
        .drop("_start", "_place")
    )


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard and slot by version 2 of the map, and shard_if_grown by
    version 3; the versions are written below path."""
    spark = docs.sparkSession
    rows = stored(in_slots(stored(records(docs), "records"), slots), "slotted")
    sizes = stored(slot_sizes(rows), "slot-sizes")
    by_slot = {r.virtual_slot: r.bytes for r in sizes.toLocalIterator()}
    kept = SlotMap(spark, path or workdir(spark, "slot-map"))
    kept.write(1, numbered(slots, shards))
    balanced = kept.write(2, rebalanced(kept.shards(1), by_slot, shards))
    larger = kept.write(3, grown(kept.shards(2), by_slot, shards))
    after = larger.withColumnRenamed("shard", "shard_if_grown")
    return placed(rows, sizes, balanced).join(F.broadcast(after), "virtual_slot")  # a row per slot


@query("op10_virtual_slots")
def op10(spark, sf_dir):
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "shard_if_grown")
