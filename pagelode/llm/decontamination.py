"""Operator 3: benchmark decontamination by size-partitioned MinHash containment search.

Short test items are searched inside long documents. An item leaks into a document if at least
`THRESHOLD` of its distinct five-word shingles occur in the document. Items are partitioned by
their number of shingles; in a partition the containment threshold becomes a number of shingles
that may be missing, and the MinHash sketch of an item is its that many plus one smallest shingle
hashes (bottom-k). A document that contains the item must contain one of them, so no leak is
lost, however long the document is: unlike a sketch of the document, which would hold ever fewer
of an item's shingles as the document grows, its whole shingle set is probed, one lookup per
shingle in the partitions' sketches. Candidates are verified on the shingles themselves.

Items, their sketches and shingles are tables. Tasks that read documents hold two bit filters, over the
hashes of sketches and of all items' shingles, of at most `MOST_BITS` bits for any number of items: they let
through the documents with a value of a sketch, and of those the shingles that an item may have. These few rows
meet sketches and shingles in joins, once per distinct text; a value that only looked right falls away there.
Words are runs of letters and digits, lower-cased. An item with fewer words than a shingle has one
shingle, all its words.

Null or empty item: no shingles, leaks nowhere. Null text: no words. Texts of any length are searched whole. Repeated rows of
documents or items: a row each. Containment of just the threshold (ties) is a leak. Empty tables: no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import discard, in_arrow, query, slices, stored, table
from pagelode.operators.spread import is_small

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# Bits of a filter: so many per value, within these powers of two. The larger one is 32 MB.
BITS_PER_VALUE = 128
LEAST_BITS, MOST_BITS = 20, 28
# A value sets a bit for each of these parts of its hash.
FILTER_SHIFTS = (0, 18, 36)
NOT_WORD = r"[^\p{L}\p{N}]+"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased runs of letters and digits of all texts, and where each text's words begin and end."""
    spaced = pc.replace_substring_regex(pc.fill_null(texts, ""), pattern=NOT_WORD, replacement=" ")
    lists = pc.split_pattern(pc.utf8_lower(spaced), pattern=" ")
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    word = pc.not_equal(flat, "")
    before = np.r_[0, np.cumsum(word.to_numpy(zero_copy_only=False))]
    return flat.filter(word), before[offsets - offsets[0]]


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash per word, worked out once per distinct word."""
    import xxhash

    coded = words.dictionary_encode()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in coded.dictionary.to_pylist()] or [0], np.uint64)
    return hashes[coded.indices.to_numpy()] if len(words) else np.empty(0, np.uint64)


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words, in order."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = (out ^ hashes[i:len(hashes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def shingles(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def may_miss(count: int, threshold: float) -> int:
    """Most shingles of `count` that a document may lack and still hold `threshold` of them."""
    need = next(k for k in range(int(threshold * count), count + 1) if k >= threshold * count - 1e-9)
    return count - max(need, 1)


def marks(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs of `size` words, told apart by the size, as signed numbers."""
    return (hashes ^ np.uint64(size * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)).view(np.int64)


ITEM = "item long, item_id long, size int, n_shingles long, shingles array<string>, marks array<long>, sketch array<long>"


def items_of(benchmark: DataFrame, n: int = SHINGLE_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """A row per item with a word: its number, id, words of a shingle, distinct shingles with their hashes, and
    its sketch, as many values as its size class needs: the largest size of a class may miss the most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            flat, bounds = words_of(batch.column("text"))
            rows = []
            for k, (number, item_id) in enumerate(zip(batch.column("item").to_pylist(), batch.column("item_id").to_pylist())):
                own = flat[bounds[k]:bounds[k + 1]].to_pylist()
                size = min(n, len(own))
                if not size:
                    continue
                listed = sorted(shingles(own, size))
                hashed = word_hashes(pa.array([w for s in listed for w in s], pa.string())).reshape(len(listed), size)
                mark = np.concatenate([rolling(row, size) for row in hashed])
                largest = 2 ** len(listed).bit_length() - 1
                sketch = np.sort(mark)[:may_miss(largest, threshold) + 1]
                rows.append((number, item_id, size, len(listed), [" ".join(s) for s in listed],
                             marks(mark, size).tolist(), marks(sketch, size).tolist()))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = list(zip(*rows)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in ITEM.split(", ")])

    numbered = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), F.col("text").cast("string"))
    return stored(in_arrow(numbered, run, ITEM), "items")


def bit_filter(values: DataFrame, column: str, most_bits: int = MOST_BITS) -> np.ndarray:
    """The bits of all values of a column, in words of 64. Its size is bounded; a fuller one lets more through."""
    n = values.count()
    bits = min(max((n * BITS_PER_VALUE).bit_length(), LEAST_BITS), most_bits)
    at = F.explode(F.array(*[F.shiftrightunsigned(column, k).bitwiseAND(F.lit((1 << bits) - 1)) for k in FILTER_SHIFTS]))
    words = values.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(max(1 << bits >> 6, 1), np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def in_filter(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    found, raw = np.ones(len(values), bool), values.view(np.uint64)
    for k in FILTER_SHIFTS:
        at = (raw >> np.uint64(k)) & np.uint64(len(bits) * 64 - 1)
        found &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


@dataclass
class Benchmark:
    """Stored items, and what tasks need to find documents that may hold one: the sizes of shingles (`n` at
    most), and the filters of sketches and shingles."""

    items: DataFrame
    sizes: list[int]
    sketches: np.ndarray
    shingles: np.ndarray


def benchmark_of(benchmark: DataFrame, n: int = SHINGLE_WORDS, threshold: float = THRESHOLD, most_bits: int = MOST_BITS) -> Benchmark:
    items = items_of(benchmark, n, threshold)
    sizes = sorted(r.size for r in items.select("size").distinct().collect())
    filters = [bit_filter(items.select(F.explode(c).alias("value")), "value", most_bits) for c in ("sketch", "marks")]
    return Benchmark(items, sizes, *filters)


HITS = "doc_id long, text_key binary, hits array<struct<size: int, mark: long, shingle: string>>"


def suspects(docs: DataFrame, known: Benchmark) -> DataFrame:
    """Documents that may hold a value of a sketch: doc_id, text_key (SHA-256 of the text), and the distinct
    shingles that an item may have."""
    shared = docs.sparkSession.sparkContext.broadcast((known.sketches, known.shingles))
    sizes = known.sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches, all_shingles = shared.value
        for batch in slices(batches):
            texts = batch.column("text")
            flat, bounds = words_of(texts)
            hashes = word_hashes(flat)
            rolled = {size: marks(rolling(hashes, size), size) for size in sizes}
            suspected: set[int] = set()
            for size, mark in rolled.items():
                at = np.flatnonzero(in_filter(mark, sketches))
                doc = np.searchsorted(bounds, at, "right") - 1
                suspected.update(doc[at + size <= bounds[doc + 1]].tolist())  # not across two documents
            rows = []
            ids = batch.column("doc_id")
            for d in sorted(suspected):
                first, last = int(bounds[d]), int(bounds[d + 1])
                found = {}
                for size, mark in rolled.items():
                    own = mark[first:max(last - size + 1, first)]
                    for p in np.flatnonzero(in_filter(own, all_shingles)).tolist():
                        found.setdefault((size, " ".join(flat[first + p:first + p + size].to_pylist())), int(own[p]))
                key = hashlib.sha256(texts[d].as_py().encode()).digest()
                rows.append((ids[d].as_py(), key, [{"size": size, "mark": m, "shingle": s} for (size, s), m in found.items()]))
            hit = pa.struct([("size", pa.int32()), ("mark", pa.int64()), ("shingle", pa.string())])
            columns = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.list_(hit)))], names=["doc_id", "text_key", "hits"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(in_arrow(narrow, run, HITS), "suspects")


def leaking_texts(hits: DataFrame, known: Benchmark, threshold: float = THRESHOLD) -> DataFrame:
    """text_key, item_id, n_shingles of the item, n_shared with the text; a row per distinct text and item."""
    once = hits.groupBy("text_key").agg(F.any_value("hits").alias("hits")).select("text_key", F.inline("hits"))
    held = stored(once, "shingles")  # read twice, a few rows per leak
    sketches = known.items.select("item", "size", F.explode("sketch").alias("mark")).distinct()
    candidates = held.join(sketches, ["size", "mark"]).select("text_key", "item").distinct()
    wanted = known.items.select("item", "item_id", "size", "n_shingles", F.explode("shingles").alias("shingle"))
    shared = candidates.join(wanted, "item").join(held.select("text_key", "size", "shingle"), ["text_key", "size", "shingle"])
    counts = shared.groupBy("text_key", "item", "item_id", "n_shingles").agg(F.count(F.lit(1)).alias("n_shared"))
    return counts.where(F.col("n_shared") >= threshold * F.col("n_shingles") - 1e-9).drop("item")


def leaks(docs: DataFrame, benchmark: DataFrame, n: int = SHINGLE_WORDS, threshold: float = THRESHOLD,
          most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, item_id, n_shingles of the item, n_shared with the document, containment."""
    known = benchmark_of(benchmark, n, threshold, most_bits)
    hits = suspects(docs, known)
    found = stored(leaking_texts(hits, known, threshold), "leaks")
    side = F.broadcast(found) if is_small(found) else found
    return hits.select("doc_id", "text_key").join(side, "text_key").select(
        "doc_id", "item_id", "n_shingles", "n_shared", F.round(F.col("n_shared") / F.col("n_shingles"), 6).alias("containment"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, n: int = SHINGLE_WORDS, threshold: float = THRESHOLD,
                  most_bits: int = MOST_BITS) -> DataFrame:
    """The documents into which no item leaks, all their columns kept."""
    known = benchmark_of(benchmark, n, threshold, most_bits)
    hits = suspects(docs, known)
    leaky = stored(leaking_texts(hits, known, threshold).select("text_key").distinct(), "leaky")
    discard(hits, known.items)
    side = F.broadcast(leaky) if is_small(leaky) else leaky
    return docs.join(side, F.unhex(F.sha2(F.col("text").cast("binary"), 256)) == side["text_key"], "left_anti")


_WORDS = "list_filter(string_split_regex(lower(regexp_replace(text, '[^\\p{L}\\p{N}]+', ' ', 'g')), ' +'), lambda x: x <> '')"
SQL = f"""
WITH items AS (
  SELECT item_id, row_number() OVER () AS r, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, r, w, least(5, len(w)) AS n FROM items WHERE len(w) > 0),
wanted AS (
  SELECT DISTINCT r, item_id, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM sized, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS t(i)),
counted AS (SELECT r, item_id, n, count(*) AS n_shingles FROM wanted GROUP BY ALL),
docs AS (SELECT doc_id, row_number() OVER () AS d, {_WORDS} AS w FROM documents),
held AS (
  SELECT DISTINCT d, doc_id, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM docs, (SELECT DISTINCT n FROM sized) AS sizes, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS t(i)
  WHERE len(w) >= n),
shared AS (
  SELECT d, doc_id, r, count(*) AS n_shared FROM held JOIN wanted USING (n, s) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_shared, round(n_shared / n_shingles, 6) AS containment
FROM shared JOIN counted USING (r) WHERE n_shared >= 0.8 * n_shingles
"""


@query("op3_decontamination", SQL)
def op3(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
