import random

import numpy as np
import pytest

from pagelode.llm import simhash


def brute_fingerprint(text):
    import xxhash
    words, word = [], ""
    for c in text or "":
        c = c.lower() if "A" <= c <= "Z" else c
        if c == " " or "\t" <= c <= "\r":
            words, word = words + [word] if word else words, ""
        else:
            word += c
    words += [word] if word else []
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(docs, max_bits=3):
    marks = [brute_fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((str(d), f"{m:016x}", least.get(find(i))) for i, ((d, _), m) in enumerate(zip(docs, marks)))


def as_rows(df):
    return sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in df.collect())


def test_documents(spark, sf_dir, documents):
    assert as_rows(simhash.op6(spark, sf_dir)) == brute_components(documents)


def test_hard_texts(spark, hard_docs, no_docs):
    assert as_rows(simhash.near_duplicates(hard_docs)) == brute_components([(r.doc_id, r.text) for r in hard_docs.collect()])
    assert simhash.near_duplicates(no_docs).count() == 0


def linked(pairs):
    """Partition of all nodes that pairs connect."""
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = {}
    for x in list(root):
        groups.setdefault(find(x), set()).add(x)
    return sorted(sorted(g) for g in groups.values())


@pytest.mark.parametrize("hot", [10**9, 20])
def test_links_join_what_is_near(spark, hot):
    rng = random.Random(3)
    marks = {rng.getrandbits(64) for _ in range(120)}
    for center in list(marks)[:6]:  # dense groups, chains and lone pairs
        marks |= {center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(40)}
    marks |= {m ^ 7 for m in list(marks)[:30]}
    listed = [m - (1 << 64) if m >> 63 else m for m in marks]
    frame = spark.createDataFrame([(m,) for m in listed], "mark long")
    got = [(r.a, r.b) for r in simhash.fingerprint_links(frame, hot_members=hot).collect()]
    near = [(a, b) for a in listed for b in listed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert all(a < b for a, b in got)
    assert set(got) <= set(near)
    assert linked(got) == linked(near)


def test_anchors_cover():
    rng = np.random.default_rng(1)
    half = rng.integers(0, 2**32, 500, dtype=np.uint64)
    anchors = simhash.anchors_of(half)
    assert (np.bitwise_count(anchors ^ half[:, None]) <= 2).all()
    # Some anchor lies within one bit, and any value within one bit has that anchor too.
    assert (np.bitwise_count(anchors ^ half[:, None]).min(axis=1) <= 1).all()
    for bit in range(32):
        other = simhash.anchors_of(half ^ np.uint64(1 << bit))
        assert all(set(a) & set(b) for a, b in zip(anchors.tolist(), other.tolist()))


def test_components_of_long_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5001)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {x: 0 for x in range(1, 301)} | {x: 1000 for x in range(1001, 1200)} | {5001: 5000}
    assert {k: v for k, v in got.items() if k != v} == want
