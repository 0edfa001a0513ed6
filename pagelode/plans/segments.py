"""A text index in segments, which takes changed documents without a rebuild.

A segment holds the documents of one batch: their rows, their postings, and what they add to the
vocabulary and to the field statistics. A batch that overwrites documents of earlier segments names them as
dead, and takes what they added off again, so sums over all segments are those of the live documents. What
a batch writes follows the batch. Small segments are merged as they gather: documents are numbered anew
in the order of their URLs, postings take the new numbers, dead ones fall away, and sums are added.

Postings are rows per term, field and block of documents (`BLOCK_BITS` bits of neighbouring numbers): the
hits as one array, each with its place in the block, and beside it the largest count and the shortest field, which bound
the score of any hit in the block. A search reads those first, and the hits of few blocks. Postings lie in folders by a hash of the term, at most
`MOST_BUCKETS` of them, sorted by term; documents in at most `SHARDS` folders.

Tables of a segment are written first; the list of live segments, one small table per version, last. A
failed batch leaves folders that no version names; `vacuum` deletes those, and what merges left behind.
One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.operators import packed, ranking, spread, vocabulary
from pagelode.session import shuffles_released, through_table, workdir

BLOCK_BITS = 12
SHARDS = 1024
LEAST_BUCKETS, MOST_BUCKETS = 16, 1024
BUCKET_BYTES = 32 * 2**20
# Text per slice of a bucket: one task sorts and writes its postings.
SLICE_BYTES = 16 * 2**20
# Buckets of a small segment are put together up to this much text per task.
LEAST_BYTES = 4 * 2**20
# So many segments of one size class are merged; a class is so many times larger than the one before.
FAN_IN, GROWTH = 4, 8
# Documents of a segment that are neighbours in it and in the one it is merged into make a run; up to so many runs go to every task.
MOST_RUNS = 2_000_000
# Dead documents are broadcast as lists of neighbours, 2 ** LIST_BITS numbers apart at most, up to so many times `spread.SMALL_ROWS`.
LIST_BITS, LISTED = 12, 10
# A segment with a larger share of dead documents is merged too.
MOST_DEAD = 0.3

DOCS = "doc long, url string, title string, content string, segment int, shard int"
POSTINGS = ("field string, term string, block long, n long, total_tf long, max_tf long, min_dl int, n_opens long, "
            "hits array<struct<place: int, tf: long, dl: int>>, segment int, bucket int")
VOCAB = "field string, term string, prefix string, df long, total_tf long, segment int"
PREFIXES = "prefix string, segment int"
STATS = "field string, n_docs long, n_tokens long, segment int"
DEAD = "in_segment int, doc long, segment int"
# Documents and postings are most of an index.
SMALL_FILES = {"compression": "zstd"}
SEGMENT = "number int, n_docs long, n_bytes long, n_dead long, buckets int, block_bits int"


@dataclass(frozen=True)
class Segment:
    number: int
    n_docs: int
    n_bytes: int
    n_dead: int  # documents of earlier segments that this one overwrites
    buckets: int
    block_bits: int


def shard_of(doc: Column) -> Column:
    """The folder of a document: numbers given out by one task share their upper bits."""
    return F.pmod(F.shiftright(doc, 33), F.lit(SHARDS)).cast("int")


@dataclass(frozen=True)
class SegmentIndex:
    """The live segments of one version."""

    spark: SparkSession
    path: str
    version: int
    segments: tuple[Segment, ...]

    def table(self, name: str, schema: str, only: Iterable[int] | None = None) -> DataFrame:
        """Rows of the live segments, or of some of them."""
        numbers = [s.number for s in self.segments] if only is None else list(only)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}")
        if not numbers:
            return self.spark.createDataFrame([], schema)
        return reader.parquet(*[f"{self.path}/{name}/segment={n}" for n in numbers])

    @property
    def dead(self) -> DataFrame:
        return self.table("dead", DEAD, [s.number for s in self.segments if s.n_dead])

    def without_dead(self, rows: DataFrame, n_rows: int = 0) -> DataFrame:
        """Rows (segment, doc, ...) whose document is live. Many are dealt by their number, if it is known."""
        if not any(s.n_dead for s in self.segments):
            return rows
        gone = self.dead.select(F.col("in_segment").alias("segment"), "doc")
        return spread.dealt(rows, n_rows, ranking.HIT_ROWS, "segment", "doc").join(gone, ["segment", "doc"], "left_anti")

    @property
    def docs(self) -> DataFrame:
        return self.table("docs", DOCS)

    def live_docs(self, only: Iterable[int] | None = None) -> DataFrame:
        """Live documents of all segments or of some of them. Few dead ones are broadcast, more of them as lists; where
        they are many, texts are dealt by their bytes."""
        chosen = [s for s in self.segments if only is None or s.number in only]
        docs, n_dead = self.table("docs", DOCS, [s.number for s in chosen]), sum(s.n_dead for s in self.segments)
        if not n_dead:
            return docs
        gone = self.dead.select(F.col("in_segment").alias("segment"), "doc")
        if n_dead <= spread.SMALL_ROWS:
            return docs.join(F.broadcast(gone), ["segment", "doc"], "left_anti")
        if n_dead <= LISTED * spread.SMALL_ROWS:
            return _marked(docs, gone).where(~F.col("_listed")).drop("_listed")
        dealt = spread.dealt(docs, sum(s.n_bytes for s in chosen), ranking.DOC_BYTES, "segment", "doc")
        return dealt.join(gone, ["segment", "doc"], "left_anti")

    @property
    def postings(self) -> DataFrame:
        return self.table("postings", POSTINGS)

    def hits(self, rows: DataFrame) -> DataFrame:
        """Rows of postings (segment, block, hits, ...) as one row per hit, (segment, ..., doc, tf, dl)."""
        bits = F.coalesce(*[F.when(F.col("segment") == s.number, F.lit(s.block_bits)) for s in self.segments], F.lit(0))
        found = rows.select("*", bits.alias("_bits"), F.inline("hits"))
        doc = F.call_function("shiftleft", F.col("block"), F.col("_bits")) + F.col("place")
        return found.select(*[c for c in rows.columns if c != "hits"], doc.alias("doc"), "tf", "dl")

    @property
    def vocab(self) -> DataFrame:
        """What each segment adds to document frequencies; a term may have a row per segment."""
        return self.table("vocab", VOCAB)

    @property
    def prefixes(self) -> DataFrame:
        return self.table("prefixes", PREFIXES).select("prefix").distinct()

    def vocabulary(self) -> DataFrame:
        """field, term, df and total_tf of the live documents."""
        return self.vocab.groupBy("field", "term").agg(
            F.sum("df").alias("df"), F.sum("total_tf").alias("total_tf")).where("df > 0")

    def field_stats(self) -> DataFrame:
        """Documents that have the field, its tokens and mean length: one row per field."""
        sums = self.table("stats", STATS).groupBy("field").agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs > 0")
        return sums.withColumn("avgdl", F.col("n_tokens") / F.col("n_docs"))


def _marked(docs: DataFrame, numbers: DataFrame) -> DataFrame:
    """Documents and whether `numbers` (segment, doc) has them, as `_listed`; texts stay where they are."""
    block = F.shiftright("doc", LIST_BITS).alias("_near")
    lists = numbers.groupBy("segment", block).agg(F.collect_set("doc").alias("_numbers"))  # 2 ** LIST_BITS numbers at most
    found = docs.select("*", block).join(F.broadcast(lists), ["segment", "_near"], "left")
    listed = F.coalesce(F.array_contains("_numbers", F.col("doc")), F.lit(False))
    return found.select(*docs.columns, listed.alias("_listed"))


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def create(spark: SparkSession, path: str) -> SegmentIndex:
    """An empty index."""
    return _commit(SegmentIndex(spark, path, -1, ()), ())


def open_index(spark: SparkSession, path: str) -> SegmentIndex:
    """The last version whose list was written in full."""
    files, place = _folder(spark, f"{path}/versions/*/_SUCCESS")
    found = [int(f.getPath().getParent().getName().split("=")[1]) for f in files.globStatus(place) or []]
    if not found:
        raise ValueError(f"no index at {path}")
    rows = spark.read.schema(SEGMENT).parquet(f"{path}/versions/v={max(found)}").orderBy("number").collect()
    return SegmentIndex(spark, path, max(found), tuple(Segment(**r.asDict()) for r in rows))


def _commit(index: SegmentIndex, segments: Iterable[Segment]) -> SegmentIndex:
    out = replace(index, version=index.version + 1, segments=tuple(segments))
    rows = [tuple(vars(s).values()) for s in out.segments]
    index.spark.createDataFrame(rows, SEGMENT).coalesce(1).write.mode("overwrite").parquet(f"{out.path}/versions/v={out.version}")
    return out


def _next_number(index: SegmentIndex) -> int:
    """Above every number that a folder has, so that a failed batch is never read as part of a later one."""
    files, place = _folder(index.spark, f"{index.path}/docs/segment=*")
    used = [int(f.getPath().getName().split("=")[1]) for f in files.globStatus(place) or []]
    return max([s.number for s in index.segments] + used, default=-1) + 1


def _write_docs(index: SegmentIndex, rows: DataFrame, number: int, extra: tuple[str, ...] = (),
                most_bytes: int | None = None) -> tuple[DataFrame, int, int]:
    """Documents in URL order with their numbers, `ranking.DOC_BYTES` of text per task at most; returns them, how many
    they are and their bytes. `most_bytes` bounds their text; it is summed up here unless it is known."""
    seen = Observation()
    size = F.coalesce(F.octet_length("title"), F.lit(0)) + F.coalesce(F.octet_length("content"), F.lit(0))
    path = f"{index.path}/docs/segment={number}"
    most_bytes = ranking.text_bytes(rows) if most_bytes is None else most_bytes
    spread.ranged(rows.select("url", "title", "content", *extra), most_bytes, ranking.DOC_BYTES, "url").sortWithinPartitions("url") \
        .observe(seen, F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("bytes")) \
        .withColumn("doc", F.monotonically_increasing_id()).withColumn("shard", shard_of(F.col("doc"))) \
        .write.mode("overwrite").options(**SMALL_FILES).partitionBy("shard").parquet(path)
    schema = "doc long, url string, title string, content string, shard int" + "".join(f", {c} long" for c in extra)
    return index.spark.read.schema(schema).parquet(path), seen.get["n"] or 0, seen.get["bytes"] or 0


def _layout(n_bytes: int) -> tuple[int, int]:
    """Buckets of terms, and slices of blocks that a bucket is written in."""
    buckets = min(max(LEAST_BUCKETS, -(-n_bytes // BUCKET_BYTES)), MOST_BUCKETS)
    return buckets, max(1, -(-n_bytes // (buckets * SLICE_BYTES)))


def _folded(batches: Iterator[pa.RecordBatch], block_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows in the order of term, field and doc as one row per block; a batch holds back its last block, which
    the next one may go on with."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch]).combine_chunks()
        block = rows.column("doc").to_numpy() >> block_bits
        new = np.append(True, block[1:] != block[:-1])
        for name in ("term", "field"):
            column = rows.column(name)
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, rows.num_rows - 1)).to_numpy()
        starts = np.flatnonzero(new)
        if len(starts) > 1:
            yield _blocks(rows.slice(0, starts[-1]), starts[:-1], block_bits)
        held = rows.slice(starts[-1]).to_batches()
    if held:
        yield _blocks(pa.Table.from_batches(held), np.zeros(1, dtype=int), block_bits)


def _blocks(rows: pa.Table, starts: np.ndarray, block_bits: int) -> pa.RecordBatch:
    """Blocks of postings; `starts` has the row that each begins with."""
    field, term, doc, tf, dl, opens = (rows.column(c).combine_chunks() for c in ("field", "term", "doc", "tf", "dl", "opens"))
    first, ends, counts = pa.array(starts), np.append(starts, rows.num_rows).astype(np.int32), tf.to_numpy()
    return pa.RecordBatch.from_pydict({
        "field": field.take(first), "term": term.take(first), "block": pa.array(doc.to_numpy()[starts] >> block_bits),
        "n": pa.array(np.diff(ends).astype(np.int64)), "total_tf": pa.array(np.add.reduceat(counts, starts)),
        "max_tf": pa.array(np.maximum.reduceat(counts, starts)), "min_dl": pa.array(np.minimum.reduceat(dl.to_numpy(), starts)),
        "n_opens": pa.array(np.add.reduceat(opens.cast("int64").to_numpy(), starts)),
        "hits": pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([doc, tf, dl], ["doc", "tf", "dl"]))})


def _placed(blocks: pa.RecordBatch, block_bits: int) -> pa.RecordBatch:
    """Blocks as they are stored: a hit has the place of its document in the block."""
    hits = blocks.column("hits")
    doc, tf, dl = hits.flatten().flatten()
    place = pa.array((doc.to_numpy() & (2**block_bits - 1)).astype(np.int32))
    stored = pa.ListArray.from_arrays(hits.offsets, pa.StructArray.from_arrays([place, tf, dl], ["place", "tf", "dl"]))
    return blocks.set_column(blocks.schema.get_field_index("hits"), "hits", stored)


def _slice_of(block: np.ndarray, slices: int) -> np.ndarray:
    """By a hash, since numbers given out by different tasks are far apart and end alike."""
    mixed = block.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(slices)).astype(np.int64)


def _write_postings(index: SegmentIndex, hits: DataFrame, number: int, n_bytes: int, block_bits: int,
                    moved: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """Rows (doc, field, dl, term, tf, opens) as blocks. One shuffle of packed rows, in which a bucket has several slices
    of its blocks, so that a frequent term is no single task. A task has one slice, whose text is bounded, or
    neighbouring buckets of a small segment; it sorts its rows once and folds them into blocks as they come. `moved`
    gives rows their numbers, where `hits` (with their segment) has those of older segments."""
    buckets, slices = _layout(n_bytes)
    path = f"{index.path}/postings/segment={number}"
    parts = min(buckets * slices, max(1, -(-n_bytes // LEAST_BYTES)))
    bucket = ranking.bucket_of(F.col("term"), buckets)

    def part_of(rows: pa.Table) -> np.ndarray:
        place = rows.column("bucket").to_numpy().astype(np.int64) * slices + _slice_of(rows.column("doc").to_numpy() >> block_bits, slices)
        return place * parts // (buckets * slices)

    hits.select(*(["segment"] if moved else []), "field", "term", "doc", "tf", "dl", "opens", bucket.alias("bucket")) \
        .mapInArrow(lambda batches: packed.packs(map(moved, batches) if moved else batches, part_of), packed.PACKS) \
        .repartitionById(parts, "part") \
        .mapInArrow(packed.unpacked, packed.POSTINGS) \
        .sortWithinPartitions("term", "field", "doc") \
        .mapInArrow(lambda batches: (_placed(b, block_bits) for b in _folded(batches, block_bits)), POSTINGS.removesuffix(", segment int, bucket int")) \
        .withColumn("bucket", bucket).sortWithinPartitions("bucket", "term", "field", "block") \
        .write.mode("overwrite").options(**SMALL_FILES).partitionBy("bucket").parquet(path)
    return index.spark.read.schema(POSTINGS.replace(", segment int", "")).parquet(path)


def _runs(numbered: DataFrame) -> pa.Table | None:
    """Documents (segment, _old, doc) as runs of `n` neighbours from `_old` on that are neighbours from `doc` on too; None if
    they are too many to go to every task."""
    by_task = W.partitionBy("segment", "_task").orderBy("_old")  # numbers given out by one task, whose text is bounded
    goes_on = (F.lag("_old").over(by_task) + 1 == F.col("_old")) & (F.lag("doc").over(by_task) + 1 == F.col("doc"))
    marked = numbered.withColumn("_task", F.shiftright("_old", packed.TASK_BITS)).withColumn("_new", F.when(goes_on, 0).otherwise(1))
    runs = marked.withColumn("_run", F.sum("_new").over(by_task)).groupBy("segment", "_task", "_run").agg(
        F.min("_old").alias("_old"), F.min("doc").alias("doc"), F.count(F.lit(1)).alias("n"))
    listed = runs.select("segment", "_old", "doc", "n").limit(MOST_RUNS + 1).toArrow()
    return listed if listed.num_rows <= MOST_RUNS else None


def _by_segment(runs: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First old number, first new number and length of the runs of each segment, in order."""
    segment, old, doc, n = (runs.column(c).to_numpy() for c in ("segment", "_old", "doc", "n"))
    order = np.lexsort((old, segment))
    return {int(s): tuple(x[order][segment[order] == s] for x in (old, doc, n)) for s in np.unique(segment)}


def _moved(rows: pa.RecordBatch, runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows (segment, doc, ...) with the new numbers of their documents, without those that have none."""
    segment, old = rows.column("segment").to_numpy(), rows.column("doc").to_numpy()
    doc = np.full(len(old), -1)
    for s in np.unique(segment):
        if int(s) in runs:
            first, new, n = runs[int(s)]
            mine = np.flatnonzero(segment == s)
            run = np.maximum(np.searchsorted(first, old[mine], "right") - 1, 0)
            place = old[mine] - first[run]
            doc[mine] = np.where((place >= 0) & (place < n[run]), new[run] + place, -1)
    at = rows.schema.get_field_index("doc")
    return rows.set_column(at, "doc", pa.array(doc)).filter(pa.array(doc >= 0))


def _write_sums(index: SegmentIndex, number: int, vocab: DataFrame, stats: DataFrame) -> None:
    """Vocabulary, prefixes and statistics, from rows that are added up."""
    where = f"{index.path}/{{}}/segment={number}"
    vocab.groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("total_tf").alias("total_tf")) \
        .where("df <> 0 or total_tf <> 0").withColumn("prefix", vocabulary.prefix_of(F.col("term"))) \
        .repartitionByRange("prefix", "term").sortWithinPartitions("prefix", "term", "field") \
        .write.mode("overwrite").option("parquet.block.size", 2**20).parquet(where.format("vocab"))
    index.spark.read.schema("prefix string").parquet(where.format("vocab")).distinct().sort("prefix") \
        .write.mode("overwrite").parquet(where.format("prefixes"))
    stats.groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")) \
        .coalesce(1).write.mode("overwrite").parquet(where.format("stats"))


def _append(index: SegmentIndex, rows: DataFrame, gone: DataFrame | None, block_bits: int) -> SegmentIndex:
    number, spark = _next_number(index), index.spark
    docs, n_docs, n_bytes = _write_docs(index, rows, number)
    posted = _write_postings(index, ranking.postings(docs, "doc", n_bytes=n_bytes), number, n_bytes, block_bits)
    vocab = posted.select("field", "term", F.col("n").alias("df"), "total_tf")
    stats = posted.select("field", F.col("n_opens").alias("n_docs"), F.col("total_tf").alias("n_tokens"))
    n_dead = 0
    if index.segments:
        urls = docs.select("url") if gone is None else docs.select("url").union(gone.select("url").distinct())
        found = index.live_docs().select("url", "segment", "shard", "doc").join(urls, "url").select("segment", "shard", "doc")
        dead = through_table(found, workdir(spark, "dead"))
        n_dead = dead.count()
        dead.select(F.col("segment").alias("in_segment"), "doc").write.mode("overwrite").parquet(f"{index.path}/dead/segment={number}")
    if n_dead:
        small, on = n_dead <= spread.SMALL_ROWS, ["segment", "shard", "doc"]
        if small:
            texts = index.docs.join(F.broadcast(dead), on)
        elif n_dead <= LISTED * spread.SMALL_ROWS:
            texts = _marked(index.docs, dead).where("_listed")
        else:
            texts = spread.dealt(index.docs, sum(s.n_bytes for s in index.segments), ranking.DOC_BYTES, *on).join(dead, on)
        old = texts.select(F.struct("segment", "doc").alias("_doc"), "title", "content")
        if not small:  # read twice below
            old = through_table(old, workdir(spark, "old"))
        # Read twice below, as rows of a few bytes.
        taken = through_table(ranking.postings(old, "_doc").groupBy("field", "term").agg(
            (-F.count(F.lit(1))).alias("df"), (-F.sum("tf")).alias("total_tf"), (-F.count_if("opens")).alias("n_docs")), workdir(spark, "taken"))
        vocab = vocab.unionByName(taken.select("field", "term", "df", "total_tf"))
        stats = stats.unionByName(taken.select("field", "n_docs", F.col("total_tf").alias("n_tokens")))
    _write_sums(index, number, vocab, stats)
    segment = Segment(number, n_docs, n_bytes, n_dead, _layout(n_bytes)[0], block_bits)
    return _commit(index, [*index.segments, segment])


def upsert(index: SegmentIndex, docs: DataFrame, block_bits: int = BLOCK_BITS) -> SegmentIndex:
    """Add `docs` (url, title, content; one row per URL, see `sources.index.upsert`) as a segment; they take
    the place of documents with the same URL."""
    with shuffles_released(index.spark):
        return _append(index, docs, None, block_bits)


def delete(index: SegmentIndex, urls: DataFrame) -> SegmentIndex:
    """Take the documents of these URLs out; URLs that no document has do nothing."""
    nothing = urls.where("false").select("url", F.lit("").alias("title"), F.lit("").alias("content"))
    with shuffles_released(index.spark):
        return _append(index, nothing, urls, BLOCK_BITS)


def merge(index: SegmentIndex, numbers: Iterable[int], block_bits: int = BLOCK_BITS) -> SegmentIndex:
    """Put segments together into one, without their dead documents."""
    chosen = sorted(set(numbers))
    inside = [s for s in index.segments if s.number in chosen]
    if not inside:
        return index
    with shuffles_released(index.spark):
        return _merge(index, chosen, inside, block_bits)


def _merge(index: SegmentIndex, chosen: list[int], inside: list[Segment], block_bits: int) -> SegmentIndex:
    number = _next_number(index)
    most_bytes = sum(s.n_bytes for s in inside)
    old = index.live_docs(chosen).select("url", "title", "content", F.col("segment").cast("long").alias("old_segment"), F.col("doc").alias("old_doc"))
    docs, n_docs, n_bytes = _write_docs(index, old, number, ("old_segment", "old_doc"), most_bytes)
    numbered = docs.select(F.col("old_segment").cast("int").alias("segment"), F.col("old_doc").alias("_old"), "doc")
    # Statistics are added up below, so no posting opens a field here.
    hits = index.hits(index.table("postings", POSTINGS, chosen).select("segment", "block", "field", "term", "hits")).withColumn("opens", F.lit(False))
    runs = _runs(numbered)
    if runs is None:
        met = spread.dealt(hits.withColumnRenamed("doc", "_old"), most_bytes, ranking.PART_BYTES, "segment", "_old").join(numbered, ["segment", "_old"])
        _write_postings(index, met, number, n_bytes, block_bits)
    else:
        given = index.spark.sparkContext.broadcast(_by_segment(runs))
        _write_postings(index, hits, number, n_bytes, block_bits, lambda rows: _moved(rows, given.value))
        given.destroy()
    _write_sums(index, number, index.table("vocab", VOCAB, chosen).select("field", "term", "df", "total_tf"),
                index.table("stats", STATS, chosen).select("field", "n_docs", "n_tokens"))
    # Dead documents of other segments stay dead.
    dead = through_table(
        index.table("dead", DEAD, [s.number for s in inside if s.n_dead]).where(~F.col("in_segment").isin(chosen)).select("in_segment", "doc"),
        f"{index.path}/dead/segment={number}")
    segment = Segment(number, n_docs, n_bytes, dead.count(), _layout(n_bytes)[0], block_bits)
    return _commit(index, [s for s in index.segments if s.number not in chosen] + [segment])


def due(index: SegmentIndex) -> list[int]:
    """The segments to merge next: those of the smallest size class that has `FAN_IN` of them, or those with too
    many dead documents."""
    classes: dict[int, list[int]] = {}
    for s in index.segments:
        size, n = 0, max(s.n_docs, 1)
        while n >= GROWTH:
            size, n = size + 1, n // GROWTH
        classes.setdefault(size, []).append(s.number)
    for size in sorted(classes):
        if len(classes[size]) >= FAN_IN:
            return classes[size]
    if any(s.n_dead for s in index.segments):
        counts = {r.in_segment: r["n"] for r in index.dead.groupBy("in_segment").agg(F.count(F.lit(1)).alias("n")).collect()}
        return [s.number for s in index.segments if counts.get(s.number, 0) > MOST_DEAD * s.n_docs]
    return []


def maintain(index: SegmentIndex) -> SegmentIndex:
    """Merge until nothing is due: the number of segments stays within `FAN_IN` per size class."""
    while numbers := due(index):
        index = merge(index, numbers)
    return index


def vacuum(index: SegmentIndex) -> list[str]:
    """Delete the folders that this version, the last one, does not name; returns them."""
    kept, gone = {s.number for s in index.segments}, []
    for pattern, live in (("*/segment=*", kept), ("versions/v=*", {index.version})):
        files, place = _folder(index.spark, f"{index.path}/{pattern}")
        for found in files.globStatus(place) or []:
            if int(found.getPath().getName().split("=")[1]) not in live:
                files.delete(found.getPath(), True)
                gone.append(found.getPath().toString())
    return gone
