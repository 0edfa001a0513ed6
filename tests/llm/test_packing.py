import binascii
import random

import numpy as np
from hypothesis import given, settings, strategies as st

from pagelode.llm import packing
from pagelode.llm.tokens import Encoder, vocabulary_path


def plain_ids(texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary_path("json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def check(rows, docs, capacity=2048):
    """Pieces rebuild every document, sequences are gapless and within capacity."""
    wanted = sorted(
        (-1 if i is None else i, k, start, n, binascii.crc32(np.array(ids[start:start + n], "<u4").tobytes()))
        for (i, _), ids in zip(docs, plain_ids([t for _, t in docs])) for k, (start, n) in enumerate(packing.cut(len(ids), capacity)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_documents(spark, sf_dir, documents):
    rows = packing.op4(spark, sf_dir).collect()
    used = check(rows, documents)
    assert used <= -(-sum(r.length for r in rows) // 2048) + 1


def test_hard_texts(spark, hard_docs, no_docs):
    rows = packing.best_fit_packing(hard_docs).collect()
    check(rows, [(r.doc_id, r.text) for r in hard_docs.collect()])
    assert packing.best_fit_packing(no_docs).count() == 0


def test_rounds_merge_leftovers(spark):
    lengths = [random.Random(7).randint(1, 99) for _ in range(900)]
    parts = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], packing.PIECE)
    rows = packing.pack(parts, capacity=100, group_pieces=60).collect()
    assert sorted(r.doc_id for r in rows) == list(range(900))
    fills = {}
    for r in rows:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
    whole = packing.local_search(packing.best_fit(np.array(lengths), 100), np.array(lengths), 100)
    assert max(fills.values()) <= 100 and len(fills) <= 1.03 * len(whole)


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e " * 900), (3, None)], "doc_id long, text string")
    placed = packing.best_fit_packing(docs, capacity=512)
    by_id = {r.sequence_id: r.ids for r in packing.sequences(docs, placed, 512).collect()}
    ids = dict(zip((1, 2, 3), plain_ids(["a b c", "d e " * 900, None])))
    for r in placed.collect():
        assert by_id[r.sequence_id][r.offset:r.offset + r.length] == ids[r.doc_id][r.start:r.start + r.length]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=60))
def test_local_search(lengths):
    sizes = np.array(lengths)
    start = packing.best_fit(sizes, 20)
    squares = sum(sum(lengths[i] for i in b) ** 2 for b in start)
    bins = packing.local_search([list(b) for b in start], sizes, 20)
    fills = [sum(lengths[i] for i in b) for b in bins]
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert max(fills) <= 20 and len(bins) <= len(start) and sum(f * f for f in fills) >= squares


def test_search_empties_a_bin_by_exchange():
    # Bins 6+3, 6+3, 2 of capacity 10: 2 leaves only if a 3 is exchanged for it.
    lengths = np.array([6, 3, 6, 3, 1, 1])
    bins = packing.local_search([[0, 1], [2, 3], [4, 5]], lengths, 10)
    assert len(bins) == 2
    # Two for one: 4 + 4 for a 7.
    assert packing.improving_step([0, 1], [2], 1, [4, 4, 7]) == ([0, 1], [2])


def test_fast_ids_are_the_ids():
    encoder = Encoder()
    texts = ["it's  we'll\n\n x\t y 12a", "naïve café — 日本", " \xa0\x85 ", "a" * 9000, "<|endoftext|>", "''s 's'd I'M"]
    assert [encoder.encode(t).tolist() + [0] for t in texts] == plain_ids(texts)


def test_search_goes_on_until_nothing_improves():
    # Best fit makes 990 sequences of these, none full; 1034+522+492 and 2*532+2*492 make 810 full ones.
    lengths = np.array(([1034] * 6 + [532] * 6 + [522] * 6 + [492] * 12) * 90)
    start = packing.best_fit(lengths, 2048)
    assert len(start) == 990
    bins = packing.local_search(start, lengths, 2048)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert max(lengths[b].sum() for b in bins) <= 2048 and len(bins) <= 812


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=40))
def test_no_improving_step_is_left(lengths):
    sizes = np.array(lengths)
    bins = packing.local_search(packing.best_fit(sizes, 20), sizes, 20)
    fill = [sum(lengths[i] for i in b) for b in bins]
    if len(bins) > packing.lower_bound(sizes, 20):
        for a, donor in enumerate(bins):
            for b, other in enumerate(bins):
                if a != b and fill[a] < 20 and fill[b] < 20:
                    assert packing.improving_step(donor, other, 20 - fill[b], lengths, max(fill[a] - fill[b], 0)) is None


def test_rounds_go_on_while_sequences_go(spark):
    """No sequence of 60s and 32s reaches 98 of 100, so every piece is left over in every round."""
    parts = spark.createDataFrame([(i, 0, 0, 60 if i % 2 else 32, 0) for i in range(480)], packing.PIECE).coalesce(1)
    one = packing.pack(parts, capacity=100, group_pieces=40, full_enough=0.0).select("sequence_id").distinct().count()
    rows = packing.pack(parts, capacity=100, group_pieces=40).collect()
    assert sorted(r.doc_id for r in rows) == list(range(480))
    assert len({(r.sequence_id, r.offset) for r in rows}) == 480
    assert len({r.sequence_id for r in rows}) < one


def test_added_tokens_have_their_ids():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary_path("json"))
    encoder = Encoder()
    assert encoder.encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    for text in ("<|endoftext|>", "x<|endoftext|><|endoftext|> é", "日本 <|endoftext|>\n\n y", "<|endoftext|" + "a" * 5000, "<|endoftext|>" + "a" * 5000):
        assert encoder.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
