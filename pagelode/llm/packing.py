"""Operator 4: best-fit packing with a swap-based local search.

`pieces` turns documents into rows of token pieces, `pack` places pieces into sequences of a
fixed number of tokens, `sequences` writes the ids of each sequence.

A piece that fills a sequence alone is placed at once. The rest is dealt at random into groups
of a few thousand pieces, one task each. A group starts from a best fit and then tries to empty
its sequences, least filled first: it moves a piece, exchanges one for one or two for one, with any
other sequence. A step is taken only if it raises the sum of squared fills, so the search ends, and
it ends when no two sequences have such a step or their number is at its lower bound. What a group
leaves underfull is dealt anew with the leftovers of other groups, as long as that removes a
sequence or until one group is left. Rows are a few numbers per piece; token ids never move.

Null text: an empty text, one end token. Texts of any length are encoded whole. Equal lengths (ties) are placed in the order of
their rows. Null or repeated doc_ids: pieces are rows, not keys; each
is placed once. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import binascii
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import in_arrow, query, slices, stored, table
from pagelode.llm.tokens import Encoder

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 8192

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]
PLACED = PIECE + ", sequence_id long, offset long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole if it fits, else full ones after a shorter first."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    starts = ([0] if head else []) + list(range(head, n, capacity))
    return [(s, min(head if head and s == 0 else capacity, n - s)) for s in starts]


def pieces(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, and the ids on request."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encoder.encode(text or ""), np.uint32(END_ID)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start:start + length]
                    row = (doc_id, k, start, length, binascii.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:6 if with_ids else 5]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return in_arrow(narrow, run, PIECE + (", ids array<int>" if with_ids else ""))


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the fullest bin that has room."""
    by_slack: list[list[int]] = [[] for _ in range(capacity + 1)]
    present = 0  # bit s is set if a bin has s tokens of room
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = present >> n
        if fits:
            slack = n + (fits & -fits).bit_length() - 1
            b = by_slack[slack].pop()
            if not by_slack[slack]:
                present &= ~(1 << slack)
            bins[b].append(i)
        else:
            slack, b = capacity, len(bins)
            bins.append([i])
        if slack > n:
            by_slack[slack - n].append(b)
            present |= 1 << (slack - n)
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: by the sum, and by pieces of which no two fit together."""
    return max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))


def _by_length(bin_: list[int], lengths: list[int]) -> dict[int, int]:
    return {lengths[i]: i for i in bin_}


def improving_step(donor: list[int], other: list[int], slack: int, lengths: list[int],
                   least: int = 0) -> tuple[list[int], list[int]] | None:
    """The pieces to give from donor to other and to take back that fill most of other's room
    (at most all of it, more than `least` tokens), or None. A step of more tokens than donor holds
    above other raises the sum of squared fills; so does any step if other is as full as donor."""
    give, take = _by_length(donor, lengths), _by_length(other, lengths)
    best, gain = None, least
    for x, i in give.items():  # move
        if gain < x <= slack:
            best, gain = ([i], []), x
    if gain == slack:
        return best
    for x, i in give.items():  # one for one
        for y, j in take.items():
            if gain < x - y <= slack:
                best, gain = ([i], [j]), x - y
    if gain == slack:
        return best
    for mine, theirs, back in ((donor, take, False), (other, give, True)):  # two for one, either way
        sizes = sorted((lengths[i], i) for i in mine)
        for y, j in theirs.items():
            low, high = 0, len(sizes) - 1
            while low < high:
                two = sizes[low][0] + sizes[high][0]
                got = y - two if back else two - y
                if gain < got <= slack:
                    pair = [sizes[low][1], sizes[high][1]]
                    best, gain = (([j], pair) if back else (pair, [j])), got
                # Walk towards the pair whose difference to y comes nearest to the room.
                if two < (y - slack if back else y + slack):
                    low += 1
                else:
                    high -= 1
    return best


class _Partners:
    """Finds the bins with which a donor has an improving step, all bins at once.

    A row per bin: how many of its piece lengths, and of the sums of two, are below each number."""

    def __init__(self, bins: list[list[int]], fill: np.ndarray, lengths: np.ndarray, capacity: int):
        self.bins, self.fill, self.lengths, self.capacity = bins, fill, lengths, capacity
        kind = np.int16 if capacity < 2**15 else np.int32
        self.ones, self.twos = (np.zeros((len(bins), capacity + 2), kind) for _ in range(2))
        self.stale = set(range(len(bins)))

    def refresh(self) -> None:
        for b in self.stale:
            sizes = self.lengths[self.bins[b]]
            sums = np.add.outer(sizes, sizes)[np.triu_indices(len(sizes), 1)]
            for rows, values in ((self.ones, sizes), (self.twos, sums)):
                row = np.zeros(self.capacity + 2, rows.dtype)
                row[values + 1] = 1
                np.cumsum(row, out=rows[b])
        self.stale.clear()

    def values(self, rows: np.ndarray, b: int) -> np.ndarray:
        return np.flatnonzero(np.diff(rows[b]))

    def of(self, donor: int) -> list[int]:
        """Fullest first."""
        self.refresh()
        room, least = self.capacity - self.fill, np.maximum(self.fill[donor] - self.fill, 0)
        others = np.flatnonzero((room > least) & (self.fill > 0))
        others = others[others != donor]
        room, least = room[others], least[others]
        found = self.ones[donor, room + 1] > self.ones[donor, least + 1]  # a move
        single, double = self.values(self.ones, donor), self.values(self.twos, donor)
        for rows, given in ((self.ones, single), (self.ones, double), (self.twos, single)):
            for x in given.tolist():  # x leaves, something from x - room to x - least - 1 comes back
                found |= rows[others, np.maximum(x - least, 0)] > rows[others, np.maximum(x - room, 0)]
        others = others[found]
        return others[np.argsort(-self.fill[others], kind="stable")].tolist()


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Empty underfull bins into others, least filled first, until no bin has an improving step."""
    sizes = lengths.tolist()
    fills = [sum(sizes[i] for i in b) for b in bins]
    full = [b for b, f in zip(bins, fills) if f == capacity]  # no step takes part of a full bin
    bins = [b for b, f in zip(bins, fills) if 0 < f < capacity]
    fill = np.array([f for f in fills if 0 < f < capacity], np.int64)
    spare = len(full) + len(bins) - lower_bound(lengths, capacity)
    if spare <= 0 or not bins:
        return full + bins
    partners = _Partners(bins, fill, lengths, capacity)
    improved = True
    while improved and spare > 0:
        improved = False
        for donor in np.argsort(fill, kind="stable").tolist():
            moved = spare > 0
            while moved and bins[donor] and fill[donor] < capacity:
                moved = False
                for b in partners.of(donor):
                    while bins[donor] and bins[b] and fill[b] < capacity:
                        least = max(int(fill[donor] - fill[b]), 0)
                        step = improving_step(bins[donor], bins[b], int(capacity - fill[b]), sizes, least)
                        if step is None:
                            break
                        given, taken = step
                        bins[donor] = [i for i in bins[donor] if i not in given] + taken
                        bins[b] = [i for i in bins[b] if i not in taken] + given
                        change = sum(sizes[i] for i in given) - sum(sizes[i] for i in taken)
                        fill[donor] -= change
                        fill[b] += change
                        partners.stale.update((donor, b))
                        moved = improved = True
                    if not bins[donor]:
                        spare -= 1
                        break
    return full + [b for b in bins if b]


def pack_group(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Sequence number inside the group, offset and fill for each row of a group."""
    lengths = group["length"].to_numpy(np.int64)
    bins = local_search(best_fit(lengths, capacity), lengths, capacity)
    at, offset, fill = (np.zeros(len(group), np.int64) for _ in range(3))
    for b, members in enumerate(bins):
        place = 0
        for i in members:
            at[i], offset[i] = b, place
            place += lengths[i]
        fill[members] = place
    return group.assign(bin=at, offset=offset, fill=fill)


def _packer(first: int, capacity: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = pack_group(group, capacity)
        # Sequence numbers: those of a round, of a group, then the place in the group.
        out["sequence_id"] = ((first + int(key[0])) << 20) + out["bin"]
        return out[[*COLUMNS, "sequence_id", "offset", "fill"]]
    return run


def pack(parts: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, full_enough: float = 0.98) -> DataFrame:
    """Place pieces: adds sequence_id and offset to the piece columns.

    Rounds go on as long as dealing the leftovers anew removes a sequence, or until one group has them
    all: a sequence filled to `full_enough` stays, the others' pieces are dealt anew. A round that
    removes none is dropped, and its pieces stay where the round before placed them.
    """
    parts = stored(parts, "pieces")
    ids = F.monotonically_increasing_id()
    done = [parts.where(F.col("length") >= capacity).withColumn("sequence_id", ids).withColumn("offset", F.lit(0).cast("long"))]
    rest = parts.where(F.col("length") < capacity)
    n, before, turn = rest.count(), None, 1
    first = 1 << 36  # the first group's number of a round, above the ids of `done`
    is_sequence = F.count_if(F.col("offset") == 0)
    while n:
        groups = -(-n // group_pieces)

        # Row numbers of a stored table: even groups whatever the keys are, the same in every attempt.
        dealt = rest.select(*COLUMNS).withColumn("group", F.pmod(F.xxhash64(ids, F.lit(turn)), F.lit(groups)))
        placed = stored(dealt.groupBy("group").applyInPandas(_packer(first, capacity), PLACED + ", fill long"), "packed")
        enough = F.col("fill") >= int(full_enough * capacity)
        left = placed.where(~enough)
        now, n_left, n_before = placed.agg(is_sequence, F.count_if(~enough), F.count_if(~enough & (F.col("offset") == 0))).first()
        if before is not None and now >= before:  # nothing is gained by dealing again
            done.append(rest.drop("fill"))
            break
        if groups == 1:
            done.append(placed.drop("fill"))
            break
        done.append(placed.where(enough).drop("fill"))
        rest, n, before, turn, first = left, n_left, n_before, turn + 1, first + groups
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def sequences(docs: DataFrame, placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The ids of each sequence: sequence_id, length, ids. A sequence is one row of bounded size."""
    keys = ["doc_id", "piece", "ids_crc32"]
    once = placed.dropDuplicates(["sequence_id", "offset"])
    parts = pieces(docs, capacity, with_ids=True).select(*keys, "ids").dropDuplicates(keys)
    return (
        once.join(parts, [once[k].eqNullSafe(parts[k]) for k in keys][0:3])
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
        .select("sequence_id", F.flatten(F.transform("_parts", lambda p: p["ids"])).alias("ids"))
        .withColumn("length", F.size("ids").cast("long"))
    )


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, capacity), capacity)


@query("op4_best_fit_packing")
def op4(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"))
