import zlib

import numpy as np
import pyarrow as pa
import pytest

from pagelode.llm import quality


def test_documents(spark, sf_dir, documents):
    rows = quality.op2(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in documents)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = quality.op2(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").collect()
    assert len(held) > 50
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95


def test_hard_texts(spark, hard_docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(12)] + [(5, 0, ""), (None, 1, ""), (6, None, ""), (99, 1, "")], "doc_id long, quality int, text string")
    out = quality.quality_scores(hard_docs, labels).collect()
    assert len(out) == hard_docs.count() and all(0 <= r.score <= 1 for r in out)
    empty = {round(r.score, 9) for r in out if r.doc_id in (0, 1, 2)}
    assert len(empty) == 1  # null, empty and blank texts are alike
    kept = quality.scored(hard_docs, quality.fit(hard_docs, labels), "found")
    assert kept.columns == [*hard_docs.columns, "found"]
    assert quality.quality_scores(no_docs, labels).count() == 0


@pytest.mark.parametrize("rows", [[], [(1, 1), (2, 1)]])
def test_without_two_classes_the_share_is_the_score(spark, hard_docs, rows):
    out = quality.quality_scores(hard_docs, spark.createDataFrame(rows, "doc_id long, quality int")).collect()
    learned = [y for i, y in rows if zlib.crc32(str(i).encode()) % 5]
    assert {round(r.score, 6) for r in out} == {round((sum(learned) + 1) / (len(learned) + 2), 6)}


def test_word_ids_by_hand():
    import xxhash
    texts = ["Some WORDS, some 12ab", None, "", "x_y"]
    hashes, words, bounds = quality.word_ids(pa.array(texts, pa.string()))
    want = ["some", quality.CAPITALS, "words", ",", "some", "12", "ab", "x", "_", "y"]
    assert hashes[words].tolist() == [xxhash.xxh64_intdigest(w) for w in want]
    assert bounds.tolist() == [0, 7, 7, 7, 10] and len(hashes) == 9


def test_index_vectors_are_sparse_and_fixed():
    hashes = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    places, signs = quality.index_vectors(hashes)
    assert (np.diff(places, axis=1) > 0).all() and set(np.unique(signs)) == {-1, 1}
    counts = np.bincount(places.ravel(), minlength=quality.DIMENSIONS)
    assert counts.min() > 200 and abs(signs.mean()) < 0.05
    assert (quality.index_vectors(hashes[7:8])[0] == places[7]).all()


@pytest.mark.parametrize("min_share", [0.0, 0.2])
def test_word_vectors_by_hand(spark, min_share):
    import xxhash
    texts = ["a b c a", "c c", None, "", "b d"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = quality.word_vectors(docs, min_share)
    name = lambda w: np.array([xxhash.xxh64_intdigest(w)], np.uint64)

    def own(w):
        out = np.zeros(quality.DIMENSIONS)
        places, signs = quality.index_vectors(name(w))
        out[places[0]] = signs[0]
        return out

    context, count = {}, {}
    for text in texts:
        words = (text or "").split()
        for i, w in enumerate(words):
            count[w] = count.get(w, 0) + 1
            context.setdefault(w, np.zeros(quality.DIMENSIONS))
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                if j != i:
                    context[w] += own(words[j])
    unit = lambda v: v / max(np.linalg.norm(v), 1e-9)
    learned = {w for w, n in count.items() if n >= min_share * sum(count.values())}
    assert len(got.hashes) == len(learned) == (4 if min_share == 0 else 3)
    for w, v in context.items():
        want = unit(unit(own(w)) + unit(v - v.mean())) * 1e-3 / (1e-3 + count[w] / sum(count.values())) if w in learned else unit(own(w))
        assert np.allclose(got.of(name(w))[0], want, atol=1e-6)


def test_pooling_a_long_text_in_pieces():
    known = quality.Words(np.empty(0, np.uint64), np.zeros((0, 8), np.float32))
    text = "red green blue " * 100_000
    out = quality.pooled(pa.array([text, "red green blue", "x"]), known)
    assert np.allclose(out[0, :16], out[1, :16], atol=1e-3) and np.abs(out[0, :8]).sum() > 0


def test_an_id_on_many_rows_is_bounded(spark, monkeypatch):
    rows = [(3, f"text number {i % 40}") for i in range(400)] + [(i, "other words") for i in range(100, 130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in (3, *range(100, 130))] * 2, "doc_id long, quality int")
    seen = []
    train = quality.train
    monkeypatch.setattr(quality, "train", lambda x, y: seen.append(len(x)) or train(x, y, steps=10))
    quality.fit(docs, labels)
    quality.fit(docs, labels, max_labelled=20)
    n_ids = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(100, 130))
    assert seen == [40 * (zlib.crc32(b"3") % 5 != 0) + n_ids, 20]


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 5))
    chance = 1 / (1 + np.exp(-4 * x[:, 0] * x[:, 1]))
    y = (rng.random(3000) < chance).astype(float)
    net = quality.train(x[:2000], y[:2000])
    p = net.probability(x[2000:])
    assert np.mean((p > 0.5) == (chance[2000:] > 0.5)) > 0.9
    assert abs(p.mean() - y[2000:].mean()) < 0.06 and np.mean(np.abs(p - chance[2000:])) < 0.15
