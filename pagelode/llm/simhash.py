"""Operator 6: near duplicates by SimHash fingerprints, found through anchor-point covering.

A fingerprint has 64 bits; two link at three or fewer differing bits. Of two such fingerprints one
half (32 bits) differs in at most one bit. So each half is covered by a code: the words of the
perfect Hamming code of 31 bits, with either value of the last bit, are anchors, and every half is
within one bit (the covering radius) of an anchor. A fingerprint is copied to all anchors within
covering radius plus threshold, 1 + 1 bits, of each of its halves: 17 at most, found by the
syndrome, no list of anchors is kept. Halves within one bit of each other thus meet at the anchor
nearest to either, and only fingerprints of one anchor are compared, on all 64 bits.

Copies are first reduced to distinct fingerprints. At an anchor the fingerprints are linked by a
search that compares each reached one with those not yet reached, and returns a spanning forest:
fewer links than members, and near linear work where a group is dense. Anchors with more than
`HOT_MEMBERS` fingerprints are divided further by equal bytes of the other half (of four bytes, one
is equal if at most three bits differ). Components of all links come from alternating star steps
on stored tables.

Null text: no words, fingerprint zero. Texts of any length are hashed whole. Null doc_id: has a fingerprint and takes part; the smallest
doc_id ignores nulls. Repeated rows: one fingerprint, same component. Empty table: no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import discard, gathered, in_arrow, query, stored, table, unused, with_fields
from pagelode.operators.spread import lookup_join

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
HALF_BITS = 32
CODE_BITS = 31
HOT_MEMBERS = 20_000
# Buckets up to this many fingerprints are compared by shifting whole batches against themselves.
SMALL_BUCKET = 8
HASHES_AT_ONCE = 65_536
ROWS_AT_ONCE = 100_000


def shingle_hashes(text: str | None, n: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each run of n words, repeats included; fewer words give one hash, none give none."""
    import xxhash

    # bytes.lower changes A-Z alone, bytes.split cuts at 0x20 and 0x09-0x0D alone.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < n:
        joined = iter([b" ".join(words)])
        count = 1
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(n))))
        count = len(words) - n + 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in joined), np.uint64, count)


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits, each set if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[start:start + HASHES_AT_ONCE].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """All columns of docs but text, and behind them `mark`, the text's fingerprint as a signed long."""
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(shingle_hashes(text.as_py(), n)) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(marks, pa.int64())], names=[*kept, "mark"])

    return in_arrow(docs, run, with_fields(docs.select(*kept), mark="long"))


def anchors_of(half: np.ndarray) -> np.ndarray:
    """Anchors within two bits of each 32-bit value: shape (n, 17), a repeated one where there are fewer."""
    half = half.astype(np.uint64)
    low = half & np.uint64((1 << CODE_BITS) - 1)
    top = half >> np.uint64(CODE_BITS)
    syndrome = np.zeros(len(half), np.uint64)
    for j in range(5):
        mask = sum(1 << (i - 1) for i in range(1, CODE_BITS + 1) if i >> j & 1)
        syndrome |= (np.bitwise_count(low & np.uint64(mask)).astype(np.uint64) & np.uint64(1)) << np.uint64(j)

    def flip(place: np.ndarray) -> np.ndarray:  # the bit at place 1..31; place 0 is no bit
        return np.where(place > 0, np.uint64(1) << (np.maximum(place, 1) - np.uint64(1)), np.uint64(0))

    nearest = low ^ flip(syndrome)
    # The code word itself with either last bit, then words two bits away: places a and b with a ^ b = syndrome.
    out = [nearest | top << np.uint64(CODE_BITS), nearest | (top ^ np.uint64(1)) << np.uint64(CODE_BITS)]
    places = np.arange(1, CODE_BITS + 1, dtype=np.uint64)
    other = places[None, :] ^ syndrome[:, None]
    # Each pair once (a below b); 15 of them where the syndrome is not zero, none where it is.
    good = (places[None, :] < other) & (syndrome[:, None] > 0)
    order = np.argsort(~good, axis=1, kind="stable")[:, :15]
    a = np.take_along_axis(np.broadcast_to(places, other.shape), order, axis=1)
    b = np.take_along_axis(other, order, axis=1)
    pairs = low[:, None] ^ flip(a) ^ flip(b) | (top << np.uint64(CODE_BITS))[:, None]
    pairs = np.where(np.take_along_axis(good, order, axis=1), pairs, out[0][:, None])
    return np.concatenate([np.stack(out, axis=1), pairs], axis=1)


def replicas(marks: DataFrame) -> DataFrame:
    """A row per distinct fingerprint and anchor: anchor (with the number of its half) and mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, ROWS_AT_ONCE // 32):
            mark = batch.column("mark").to_numpy()
            bits = mark.view(np.uint64)
            for part in (0, 1):
                half = bits >> np.uint64(HALF_BITS * part) & np.uint64((1 << HALF_BITS) - 1)
                words = anchors_of(half)
                first = np.concatenate([np.ones((len(words), 2), bool), words[:, 2:] != words[:, :1]], axis=1)
                yield pa.RecordBatch.from_arrays([
                    pa.array((words[first] | np.uint64(part << HALF_BITS)).astype(np.int64)),
                    pa.array(np.broadcast_to(mark[:, None], words.shape)[first])], names=["anchor", "mark"])

    return in_arrow(marks.select("mark"), run, "anchor long, mark long")


def differing(a: np.ndarray, b: np.ndarray | np.int64) -> np.ndarray:
    """Number of bits that differ. Unsigned, since numpy counts the bits of absolute values."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def spanning_links(marks: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Links that connect what is connected within max_bits: each reached fingerprint is compared
    with all that are not reached yet."""
    left, right = [], []
    rest = marks
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            near = differing(rest, one) <= max_bits
            if near.any():
                found = rest[near]
                left += [int(one)] * len(found)
                right += found.tolist()
                reached += list(found)
                rest = rest[~near]
    return left, right


def links_at_anchors(members: DataFrame, keys: list[str], max_bits: int) -> DataFrame:
    """Links (a, b) among the marks of each key; a partition holds its keys in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_mark = np.empty((0, len(keys)), np.int64), np.empty(0, np.int64)

        def linked(key: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(mark)])
            size = np.repeat(sizes, sizes)
            ordinal = np.repeat(np.arange(len(starts)), sizes)
            left, right = [], []
            for lag in range(1, min(SMALL_BUCKET, len(mark))):
                near = (ordinal[lag:] == ordinal[:-lag]) & (size[lag:] <= SMALL_BUCKET)
                near &= differing(mark[lag:], mark[:-lag]) <= max_bits
                left.append(mark[:-lag][near])
                right.append(mark[lag:][near])
            for start, n in zip(starts[sizes > SMALL_BUCKET], sizes[sizes > SMALL_BUCKET]):
                a, b = spanning_links(mark[start:start + n], max_bits)
                left.append(np.array(a, np.int64))
                right.append(np.array(b, np.int64))
            a = np.concatenate([*left, np.empty(0, np.int64)])
            b = np.concatenate([*right, np.empty(0, np.int64)])
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in gathered(batches, ROWS_AT_ONCE):
            if not batch.num_rows:
                continue
            held_key = np.concatenate([held_key, np.stack([batch.column(k).to_numpy() for k in keys], axis=1)])
            held_mark = np.concatenate([held_mark, batch.column("mark").to_numpy()])
            # The last key may go on in the next batch.
            ready = int(np.flatnonzero((held_key != held_key[-1]).any(axis=1)).max(initial=-1)) + 1
            if ready:
                yield linked(held_key[:ready], held_mark[:ready])
                held_key, held_mark = held_key[ready:], held_mark[ready:]
        if len(held_mark):
            yield linked(held_key, held_mark)

    return members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def fingerprint_links(marks: DataFrame, max_bits: int = MAX_BITS, hot_members: int = HOT_MEMBERS) -> DataFrame:
    """Links between distinct fingerprints whose components are those of all pairs within max_bits."""
    if max_bits > 3:
        raise ValueError("halves within one bit are only certain for up to three differing bits")
    members = stored(replicas(marks), "replicas")
    hot = stored(members.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_members), "hot")
    if hot.isEmpty():
        links = links_at_anchors(members, ["anchor"], max_bits)
    else:
        # The half that is not the anchor's, one row per byte of it.
        shift = F.when(F.shiftright("anchor", HALF_BITS) == 0, HALF_BITS).otherwise(0)
        byte = lambda k: F.expr(f"shiftrightunsigned(mark, _shift + {8 * k}) & 255L")
        divided = (
            members.join(hot.select("anchor"), "anchor", "left_semi").withColumn("_shift", shift)
            .select("anchor", "mark", F.explode(F.array(*[F.lit(256 * k) + byte(k) for k in range(4)])).alias("part")))
        links = links_at_anchors(members.join(hot.select("anchor"), "anchor", "left_anti"), ["anchor"], max_bits).unionByName(
            links_at_anchors(divided, ["anchor", "part"], max_bits))
    found = stored(links.distinct(), "near")
    discard(members, hot)
    return found


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node and the smallest node of its component, for all nodes of the links (a < b).

    Alternating stars: every node's larger neighbours, then its smaller ones, are tied to the
    smallest neighbour. Both keep components, and all links end at the smallest node after a
    number of rounds that grows with the logarithm of the size.
    """
    # Links point from the larger node to the smaller.
    edges = stored(links.select(F.col("b").alias("u"), F.col("a").alias("v")), "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select("v", "u")).toDF("n", "m")
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
        # Large star: each larger neighbour of n is tied to the least of n and its neighbours.
        large = both.where("m > n").join(least, "n").select(F.col("m").alias("u"), F.col("low").alias("v")).distinct()
        large = stored(large, "large-star")
        last = edges
        # Small star: the smaller neighbours of n and n itself are tied to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        edges = stored(
            large.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .union(low).distinct(), "small-star")
        discard(large, last)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def roots_of_marks(marks: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """mark, the root mark of its component, and the least doc_id that has it, a row per distinct mark."""
    distinct = stored(marks.groupBy("mark").agg(F.min("doc_id").alias("least_id")), "marks")
    roots = components(fingerprint_links(distinct, max_bits))
    return stored(
        distinct.join(roots, distinct["mark"] == roots["node"], "left")
        .select("mark", "least_id", F.coalesce("root", "mark").alias("root")), "roots")


def near_duplicates(docs: DataFrame, n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, a row per row of docs."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    marks = stored(fingerprints(narrow, n), "fingerprints")
    roots = roots_of_marks(marks, max_bits)
    ids = roots.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_mark = stored(lookup_join(roots.select("mark", "root"), ids, "root", "mark").select("mark", "component_id"), "classes")
    return lookup_join(marks, of_mark, "mark", "doc_id").select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per component of near duplicates, with all columns: that of the least doc_id (a row
    without one only where the component has no other), the least hash of the text among its rows."""
    key = F.xxhash64(F.col("text").cast("string"))
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), key.alias("key"))
    marks = stored(fingerprints(narrow, n), "fingerprints")
    rows = marks.groupBy("mark", "doc_id", "key").agg(F.count(F.lit(1)).alias("copies"))
    firsts = rows.groupBy("mark").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "copies")).alias("first"))
    kept = stored(
        firsts.join(roots_of_marks(marks, max_bits), "mark").groupBy("root").agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"), F.col("first.copies").alias("_copies")), "kept")

    def held(wanted: DataFrame) -> DataFrame:
        # Built as a hash table of the narrow side, so that texts are dealt out but not sorted.
        same = docs["doc_id"].cast("long").eqNullSafe(wanted["_id"]) & (F.xxhash64(docs["text"].cast("string")) == wanted["_key"])
        return docs.join(wanted.hint("shuffle_hash"), same, "left_semi")

    single = held(kept.where("_copies = 1"))
    repeated = kept.where("_copies > 1")
    if repeated.isEmpty():
        return single
    name = unused(docs, "_key")
    again = held(repeated).withColumn(name, key)
    return single.unionByName(again.dropDuplicates(["doc_id", name]).drop(name))


@query("op6_simhash")
def op6(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
