import binascii
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from pagelode.llm import histogram_packing as packing
from pagelode.llm.tokens import vocabulary_path


def plain_ids(texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary_path("json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def check(rows, docs, capacity=2048):
    """Every id lies in one piece, checksums are right, sequences are gapless. Returns the fills."""
    wanted = Counter((doc_id, tuple(ids)) for (doc_id, _), ids in zip(docs, plain_ids([t for _, t in docs])))
    by_document, fills = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        fills[r.sequence_id].append((r.offset, r.length))
    for (doc_id, ids), n in wanted.items():
        spans = by_document[doc_id, len(ids)]
        same = sum(m for (d, other), m in wanted.items() if d == doc_id and len(other) == len(ids))
        assert sum(length for _, length, _ in spans) == len(ids) * same
        if same == n == 1:
            assert [s for s, _, _ in sorted(spans)] == [0, *np.cumsum([length for _, length, _ in sorted(spans)])[:-1]]
        if same == n:
            assert all(binascii.crc32(np.array(ids[s:s + k], "<u4").tobytes()) == crc for s, k, crc in spans)
    assert {k for k, v in by_document.items() if v} == {(d, len(ids)) for d, ids in wanted}
    for spans in fills.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    return [sum(length for _, length in spans) for spans in fills.values()]


def test_documents(spark, sf_dir, documents):
    fills = check(packing.op11(spark, sf_dir).collect(), documents)
    assert len(fills) <= -(-sum(fills) // 2048) + 1


def test_hard_texts(spark, hard_docs, no_docs):
    check(packing.shortest_pack_first(hard_docs).collect(), [(r.doc_id, r.text) for r in hard_docs.collect()])
    check(packing.shortest_pack_first(hard_docs, capacity=100, grain=4).collect(), [(r.doc_id, r.text) for r in hard_docs.collect()], 100)
    assert packing.shortest_pack_first(no_docs).count() == 0


def by_hand(histogram, capacity, grain):
    """The same rule, a piece and a pack at a time; returns the fills."""
    todo, fills = Counter(histogram), []
    while todo:
        packs, left = [0] * -(-sum(n * m for n, m in todo.items()) // capacity), Counter()
        while todo:
            rest = max(todo)
            todo[rest] -= 1
            todo = +todo
            at = packs.index(min(packs))
            size = rest if packs[at] + rest <= capacity else (capacity - packs[at]) // grain * grain
            if not size:
                left[rest] += 1
                continue
            packs[at] += size
            if size < rest:
                todo[rest - size] += 1
        fills += packs
        todo = left
    return sorted(fills)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12), st.sampled_from([1, 4, 8]))
def test_plan(histogram, grain):
    slot = packing.slots(histogram, 40, grain)
    fills, used = defaultdict(list), Counter()
    for length, start, stop, rank, packs, copies, sequence, offset in zip(*(slot[c].tolist() for c in packing.SLOT)):
        for i in range(packs * copies):
            used[length, rank + i] += stop - start
            fills[sequence + i // copies].append((offset + i % copies * (stop - start), stop - start))
    assert used == {(n, r): n for n, m in histogram.items() for r in range(m)}
    for spans in fills.values():
        assert [o for o, _ in sorted(spans)] == [0, *np.cumsum([n for _, n in sorted(spans)])[:-1].tolist()]
    assert sorted(sum(n for _, n in spans) for spans in fills.values()) == by_hand(histogram, 40, grain)


def test_lengths_that_do_not_fit_are_cut():
    """Documents of 1100 tokens alone: two to a sequence need cuts, and little room is left."""
    slot = packing.slots({1100: 10_000})
    n = int((slot["sequence"] + slot["packs"]).max())
    assert n <= 1.01 * 10_000 * 1100 / 2048


def test_the_plan_does_not_grow_with_documents():
    rng = np.random.default_rng(5)
    shape = np.bincount(np.clip(rng.lognormal(5.5, 1.1, 200_000).astype(int), 1, 2048))
    small = {n: int(m) for n, m in enumerate(shape) if m}
    slot = packing.slots({n: 1_000 * m for n, m in small.items()})
    assert len(slot["length"]) < 40_000
    tokens = 1_000 * sum(n * m for n, m in small.items())
    assert int((slot["sequence"] + slot["packs"]).max()) * 2048 < 1.005 * tokens


def test_ranks_are_dense(spark):
    docs = spark.createDataFrame([(i, "a b c " * (i % 7)) for i in range(300)], "doc_id long, text string").repartition(9)
    rows = packing.ranked(packing.stored(packing.pieces(docs), "pieces")).select("length", "rank").collect()
    by_length = defaultdict(list)
    for r in rows:
        by_length[r.length].append(r.rank)
    assert len(rows) == 300
    assert all(sorted(ranks) == list(range(len(ranks))) for ranks in by_length.values())


def test_every_rank_is_found_in_the_plan():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(5.0, 1.3, 40_000).astype(int), 1, 2048)
    histogram = {n: int(m) for n, m in enumerate(np.bincount(lengths)) if m}
    slot = packing.slots(histogram)
    length = np.repeat(list(histogram), list(histogram.values()))
    rank = np.concatenate([np.arange(m) for m in histogram.values()])

    class Plan:
        value = slot

    batch = pa.RecordBatch.from_pydict({
        "doc_id": rank, "start": rank * 0, "length": length, "ids_crc32": rank, "doc_tokens": length, "rank": rank,
        "block_crcs": [b"\0" * 2048] * len(rank)})
    out = next(packing._placer(Plan, 2048, packing.GRAIN)(iter([batch]))).to_pandas()
    assert out["length"].sum() == lengths.sum()
    ends = out.sort_values(["sequence_id", "offset"])
    ends["after"] = ends["offset"] + ends["length"]
    first = ends["sequence_id"].ne(ends["sequence_id"].shift())
    assert (ends["offset"] == ends["after"].shift().where(~first, 0)).all() and ends["after"].max() <= 2048
