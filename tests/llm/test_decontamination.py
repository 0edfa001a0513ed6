import random

import duckdb
import pytest

from pagelode.llm import decontamination as d


def brute(docs, items, n=5, threshold=0.8):
    def words(t):
        return "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()

    def cut(w, size):
        return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}

    out = []
    for item_id, item in items:
        w = words(item)
        size = min(n, len(w))
        if not size:
            continue
        wanted = cut(w, size)
        for doc_id, text in docs:
            shared = len(wanted & cut(words(text), size))
            if shared >= threshold * len(wanted):
                out.append((doc_id, item_id, len(wanted), shared))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in df.collect()), key=str)


def test_documents(spark, sf_dir, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = rows(d.op3(spark, sf_dir))
    assert got and got == brute(documents, items)


@pytest.mark.parametrize("bits", [d.MOST_BITS, 8])
def test_partial_short_and_hard_items(spark, hard_docs, no_docs, bits):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    item = [rng.choice(vocabulary) for _ in range(40)]
    texts = []
    for cut in range(0, 14):  # ever more of the item's words replaced, inside long texts
        own = item[:]
        own[:cut] = ["zz"] * cut
        texts.append(" ".join(rng.choice(vocabulary) for _ in range(3000)) + " " + " ".join(own).upper() + ". end")
    texts += [" ".join(item[:20]) + " gap " + " ".join(item[20:]), " ".join(item[20:]), "one two", "ONE, two!"]
    docs = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.unionByName(hard_docs.select("doc_id", "text"))
    items = [(1, " ".join(item)), (2, "one two"), (3, None), (4, "..."), (5, "same text here again"), (5, "same text here again"), (None, "one")]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(plain, items)
    assert rows(d.leaks(docs, benchmark, most_bits=bits)) == want
    left = d.without_leaks(docs, benchmark, most_bits=bits).collect()
    bad = {w[0] for w in want}
    assert sorted(str(r.doc_id) for r in left) == sorted(str(i) for i, t in plain if not brute([(i, t)], items))
    assert bad
    assert d.leaks(no_docs, benchmark).count() == 0
    assert d.leaks(docs, benchmark.where("false")).count() == 0
    assert d.without_leaks(docs, benchmark.where("false")).count() == docs.count()


def test_sketches_lose_no_item_at_the_threshold():
    for count in range(1, 200):
        miss = d.may_miss(count, 0.8)
        assert miss < count
        assert (count - miss) >= 0.8 * count - 1e-9 > count - miss - 1 - 1e-9


def test_copies_are_verified_once(spark):
    """A third of the rows is one leaking text; another third almost leaks."""
    words = [f"w{i}" for i in range(60)]
    item = " ".join(words[:40])
    rows = [(i, "intro " + item + " outro") for i in range(300)] + [(300 + i, " ".join(words[:20])) for i in range(300)] + [(600 + i, f"clean text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    benchmark = spark.createDataFrame([(9, item)], "item_id long, text string")
    known = d.benchmark_of(benchmark)
    hits = d.suspects(docs, known)
    assert 300 <= hits.count() <= 600 and d.leaking_texts(hits, known).count() == 1
    assert sorted(r.doc_id for r in d.leaks(docs, benchmark).collect()) == list(range(300))
    assert sorted(r.doc_id for r in d.without_leaks(docs, benchmark).collect()) == list(range(300, 900))


def test_filters_hold_all_values(spark):
    import numpy as np
    values = np.random.default_rng(3).integers(-2**63, 2**63, 3000)
    frame = spark.createDataFrame([(int(v),) for v in values], "value long")
    bits = d.bit_filter(frame, "value")
    assert len(bits) * 64 == 1 << d.LEAST_BITS and d.in_filter(values, bits).all()
    assert d.in_filter(np.random.default_rng(4).integers(-2**63, 2**63, 100_000), bits).mean() < 1e-4
    assert not d.in_filter(values, d.bit_filter(frame.where("false"), "value")).any()
