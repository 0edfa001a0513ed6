import zlib
from collections import Counter

from pagelode.llm import slots


def check(rows, docs, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    for shard in range(shards):
        places = sorted(r.slot for r in rows if r.shard == shard)
        assert places == list(range(len(places)))
    assert all(0 <= r.shard < shards for r in rows)


def test_documents(spark, sf_dir, documents):
    rows = slots.op10(spark, sf_dir).collect()
    check(rows, documents, 16)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    held = [sum(r.size for r in rows if r.shard == s) for s in range(16)]
    assert max(held) - min(held) <= max(r.size for r in rows)


def test_hard_texts(spark, hard_docs, no_docs):
    out = slots.shard(hard_docs, shards=3, slots=64)
    check(out.collect(), [(r.doc_id, r.text) for r in hard_docs.collect()], 3)
    assert slots.shard(no_docs).count() == 0


def test_repeated_rows_and_ids_are_spread(spark):
    """A third of the rows is one row, another third has one id: shards are near equal, slots small."""
    rows = [(5, "x" * 400)] * 3000 + [(6, f"text {i} " * 40) for i in range(3000)] + [(i, "y" * 300) for i in range(100, 3100)]
    rows += [(None, "n" * 200)] * 500 + [(None, None)] * 2000
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = slots.shard(frame.repartition(4), shards=4, slots=256).collect()
    check(out, rows, 4)
    held = [sum(r.size for r in out if r.shard == s) for s in range(4)]
    assert max(held) - min(held) <= 401
    by_slot = Counter(r.virtual_slot for r in out)
    assert max(by_slot.values()) <= 0.03 * len(rows)
    grown = [sum(r.size for r in out if r.shard_if_grown == s) for s in range(5)]
    assert all(r.shard_if_grown in (r.shard, 4) for r in out) and max(grown) - min(grown) < 0.05 * sum(grown)


def test_two_large_texts_of_one_id_lie_apart(spark):
    rows = [(1, "a" * 300_000), (1, "b" * 300_000)] + [(i, "c" * 1000) for i in range(2, 40)]
    out = slots.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=2, slots=512).collect()
    assert len({r.shard for r in out if r.doc_id == 1}) == 2


def test_the_query_edits_its_map(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = slots.shard(docs, path=str(tmp_path / "map")).collect()
    first, second, third = (slots.SlotMap(spark, str(tmp_path / "map")).shards(v) for v in (1, 2, 3))
    assert first == [s % 16 for s in range(slots.SLOTS)] and first != second
    assert all(r.shard == second[r.virtual_slot] and r.shard_if_grown == third[r.virtual_slot] for r in rows)
    assert all(b == c or c == 16 for b, c in zip(second, third))


def test_a_grown_map_only_fills_the_new_shard():
    sizes = {s: 50 + s * 37 % 91 for s in range(1000)}
    before = slots.rebalanced(slots.numbered(1000, 8), sizes, 8)
    after = slots.grown(before, sizes, 8)
    assert all(a == b or a == 8 for a, b in zip(after, before))
    held = [sum(sizes[s] for s in range(1000) if after[s] == k) for k in range(9)]
    assert max(held) - min(held) <= 2 * max(sizes.values())


def test_rebalancing_edits_few_slots():
    sizes = {s: 100 for s in range(800)}
    before = slots.numbered(800, 8)
    sizes |= {s: 150 for s in range(800) if before[s] == 0}
    after = slots.rebalanced(before, sizes, 8)
    held = [sum(sizes[s] for s in range(800) if after[s] == k) for k in range(8)]
    assert max(held) - min(held) <= 150
    assert 0 < sum(a != b for a, b in zip(before, after)) < 80


def test_versions_of_the_map_stay(spark, tmp_path):
    kept = slots.SlotMap(spark, str(tmp_path / "map"))
    kept.write(1, [0, 1, 0, 1])
    kept.write(2, [0, 1, 2, 1])
    assert kept.shards(1) == [0, 1, 0, 1] and kept.shards(2) == [0, 1, 2, 1]


def test_a_slot_depends_on_id_and_text(spark):
    frame = spark.createDataFrame([(5, "a"), (5, "b"), (None, "a"), (None, "b"), (6, "a")], "doc_id long, text string")
    one, other = (slots.in_slots(slots.records(f)).collect() for f in (frame.coalesce(1), frame.repartition(3)))
    found = {(r.doc_id, r.text_crc32): r.virtual_slot for r in one}
    assert len(set(found.values())) == 5 and found == {(r.doc_id, r.text_crc32): r.virtual_slot for r in other}
