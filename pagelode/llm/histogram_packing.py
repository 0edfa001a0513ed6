"""Operator 11: shortest-pack-first packing over the histogram of lengths.

A document is encoded once and cut into pieces of at most a sequence's tokens. What is planned is
not pieces but their length histogram, one number per length: as many sequences as the tokens need
are open from the start, lengths are taken longest first, and each goes to the pack that is shortest
so far. A pack's content is a pattern, and all packs of one pattern are one entry with a count; a
length moves a whole count from one pattern to the next, and only its last step divides an entry. So
there is at most a pattern more per length and cut, whatever the number of documents, and a
pattern has few distinct lengths: the plan is bounded by the capacity, and only it is broadcast.

A length that does not fit the shortest pack fits none. It is cut there, at a multiple of `GRAIN`
tokens, and its rest goes back to the histogram; so packs are left with less than `GRAIN` tokens
of room, and what then fits nowhere is packed the same way into further sequences. One sequence at the
end may be shorter.

Patterns are joined back to documents by rank. Pieces of a length are numbered without a task that
sees them all: by their place among the pieces of that length in their partition, and the counts of
the partitions before. A pattern's slot stands for a range of ranks. Checksums of cut pieces come from
checksums of `GRAIN` tokens each, so ids are neither stored nor encoded again.

Null text: an empty text, one end token. Texts of any length are encoded whole and give as many
pieces as they need. Null or repeated doc_ids and repeated rows: pieces are rows, not keys; each is
placed once. Equal lengths (ties) are placed in the order of their rank. Empty table: no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import binascii
import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.llm.common import in_arrow, query, slices, stored, table
from pagelode.llm.tokens import Encoder

CAPACITY = 2048
END_ID = 1
# Tokens between places where a piece may be cut.
GRAIN = 4

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "part int, place long, block_crcs binary")
PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_RANK_BITS = 40


def pieces(docs: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """A row per piece: its document's id and tokens, start, length, checksum, the partition it was made
    in (`part`), its place among that partition's pieces of its length, and a checksum per `grain` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder(), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.binary()]
        names = [c.split()[0] for c in PIECE.split(", ")]
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encoder.encode(text or ""), np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), capacity):
                    held = ids[start:start + capacity].tobytes()
                    length = len(held) // 4
                    crcs = [binascii.crc32(held[i:i + 4 * grain]) for i in range(0, len(held), 4 * grain)]
                    rows.append((doc_id, start, length, binascii.crc32(held), len(ids), part, int(seen[length]),
                                 np.array(crcs, "<u4").tobytes()))
                    seen[length] += 1
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return in_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PIECE)


@dataclass
class _Share:
    """Tokens [start, stop) of pieces of one length, of the ranks from `rank` on."""
    length: int
    start: int
    stop: int
    rank: int


class _Patterns:
    """Open packs by fill, and at a fill the count of each pattern: (share, copies) pairs in order."""

    def __init__(self, packs: int, capacity: int):
        self.capacity = capacity
        self.levels: dict[int, dict[tuple, int]] = {0: {(): packs}}
        self.fills = [0]

    def shortest(self) -> int:
        """The least fill of any pack; the capacity if all are full."""
        while self.fills and not self.levels.get(self.fills[0]):
            self.levels.pop(heapq.heappop(self.fills), None)
        return self.fills[0] if self.fills else self.capacity

    def take(self, fill: int, most: int) -> tuple[tuple, int]:
        """Up to `most` packs of one pattern at that fill."""
        level = self.levels[fill]
        pattern, count = next(iter(level.items()))
        taken = min(most, count)
        if taken == count:
            del level[pattern]
        else:
            level[pattern] = count - taken
        return pattern, taken

    def put(self, fill: int, pattern: tuple, share: int, size: int, packs: int) -> None:
        if pattern and pattern[-1][0] == share:
            pattern = (*pattern[:-1], (share, pattern[-1][1] + 1))
        else:
            pattern = (*pattern, (share, 1))
        level = self.levels.get(fill + size)
        if level is None:
            level = self.levels[fill + size] = {}
            if fill + size < self.capacity:
                heapq.heappush(self.fills, fill + size)
        level[pattern] = level.get(pattern, 0) + packs

    def counts(self) -> Iterator[tuple[tuple, int]]:
        for fill in sorted(self.levels, reverse=True):
            yield from ((p, n) for p, n in self.levels[fill].items() if p)


def pattern_counts(histogram: dict[int, int], capacity: int = CAPACITY, grain: int = GRAIN) -> tuple[list[_Share], list[tuple[tuple, int]]]:
    """Shares of lengths, and the patterns of shares with the number of packs that have each."""
    shares: list[_Share] = []
    counts: list[tuple[tuple, int]] = []
    # By tokens to place: (length, tokens placed before, first rank, pieces).
    todo: dict[int, list[tuple[int, int, int, int]]] = {n: [(n, 0, 0, m)] for n, m in histogram.items() if m}
    while todo:
        tokens = sum(rest * m for rest, items in todo.items() for *_, m in items)
        packs, left = _Patterns(-(-tokens // capacity), capacity), defaultdict(list)
        longest = [-rest for rest in todo]
        heapq.heapify(longest)
        while longest:
            rest = -heapq.heappop(longest)
            for length, start, rank, n in todo.pop(rest, []):
                whole = len(shares)
                shares.append(_Share(length, start, length, rank))
                cut = 0
                while n:
                    fill = packs.shortest()
                    room = capacity - fill
                    size = rest if rest <= room else room // grain * grain
                    if not size:
                        left[rest].append((length, start, rank, n))
                        break
                    pattern, m = packs.take(fill, n)
                    share = whole
                    if size < rest:
                        same = todo.get(rest - size)
                        if same is None:
                            same = todo[rest - size] = []
                            heapq.heappush(longest, size - rest)
                        if size == cut:  # one share and one rest for all that are cut here
                            share = len(shares) - 1
                            same[-1] = (*same[-1][:3], same[-1][3] + m)
                        else:
                            share, cut = len(shares), size
                            shares.append(_Share(length, start, start + size, rank))
                            same.append((length, start + size, rank, m))
                    packs.put(fill, pattern, share, size, m)
                    rank, n = rank + m, n - m
        counts += packs.counts()
        todo = dict(left)
    return shares, counts


SLOT = ("length", "start", "stop", "rank", "packs", "copies", "sequence", "offset")


def slots(histogram: dict[int, int], capacity: int = CAPACITY, grain: int = GRAIN) -> dict[str, np.ndarray]:
    """The plan by ranks, sorted by (length, start, rank): pieces of `length` with the ranks from `rank`
    on, `packs` times `copies` of them, have their tokens [start, stop) in the sequences from `sequence`
    on, `copies` in each from `offset` on."""
    shares, counts = pattern_counts(histogram, capacity, grain)
    used = [share.rank for share in shares]
    rows, sequence = [], 0
    for pattern, n in counts:
        offset = 0
        for i, copies in pattern:
            share = shares[i]
            rows.append((share.length, share.start, share.stop, used[i], n, copies, sequence, offset))
            used[i] += n * copies
            offset += copies * (share.stop - share.start)
        sequence += n
    rows.sort(key=lambda row: (row[0], row[1], row[3]))
    return dict(zip(SLOT, np.array(rows, np.int64).reshape(-1, len(SLOT)).T.copy()))


def _crc_of(crcs: np.ndarray, sizes: list[int]) -> int:
    """The checksum of blocks put together, from the checksum and bytes of each."""
    total = 0
    for crc, size in zip(crcs.tolist(), sizes):
        zeros = bytes(size)
        total = crc ^ binascii.crc32(zeros, total) ^ binascii.crc32(zeros)
    return total


def _placer(plan, capacity: int, grain: int):
    def keys(length: np.ndarray, start: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return ((length * (capacity + 1) + start) << _RANK_BITS) + rank

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = plan.value
        known = keys(slot["length"], slot["start"], slot["rank"])
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            rows, start = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            found = []
            while len(rows):
                at = np.searchsorted(known, keys(length[rows], start, rank[rows]), "right") - 1
                place, stop = rank[rows] - slot["rank"][at], slot["stop"][at]
                if (stop <= start).any() or (place >= slot["packs"][at] * slot["copies"][at]).any():
                    raise ValueError("a piece's rank is not in the plan")
                found.append((rows, start, stop, slot["sequence"][at] + place // slot["copies"][at],
                              slot["offset"][at] + place % slot["copies"][at] * (stop - start)))
                more = stop < length[rows]
                rows, start = rows[more], stop[more]
            if not found:
                continue
            rows, start, stop, sequence, offset = map(np.concatenate, zip(*found))
            crc = batch.column("ids_crc32").to_numpy()[rows].copy()
            for i in np.flatnonzero(stop - start < length[rows]).tolist():
                first, last = start[i] // grain, -(-stop[i] // grain)
                crcs = np.frombuffer(batch.column("block_crcs")[int(rows[i])].as_py(), "<u4")[first:last]
                crc[i] = _crc_of(crcs, [4 * int(min(grain, stop[i] - b * grain)) for b in range(first, last)])
            taken = batch.select(["doc_id", "doc_tokens"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [taken.column("doc_id"), pa.array(batch.column("start").to_numpy()[rows] + start), pa.array(stop - start),
                 pa.array(crc), taken.column("doc_tokens"), pa.array(sequence), pa.array(offset)],
                names=[c.split()[0] for c in PLACED.split(", ")])
    return run


def ranked(parts: DataFrame) -> DataFrame:
    """Adds `rank`, the number of a piece among all of its length, to stored pieces."""
    counts = parts.groupBy("length", "part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("_before"))
    return parts.join(offsets, ["length", "part"]).withColumn("rank", F.col("place") + F.col("_before")).drop("_before")


def shortest_pack_first(docs: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """Every document's pieces with sequence_id and offset: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id (from 0), offset. What goes to the driver is one row per length."""
    parts = stored(pieces(docs, capacity, grain), "lengths")
    histogram = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(slots(histogram, capacity, grain))
    rows = ranked(parts).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank", "block_crcs")
    return rows.mapInArrow(_placer(plan, capacity, grain), PLACED)


@query("op11_shortest_pack_first")
def op11(spark, sf_dir):
    return shortest_pack_first(table(spark, sf_dir, "documents"))
