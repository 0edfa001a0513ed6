import itertools
import zlib

import numpy as np
import pyarrow as pa

from pagelode.llm import language
from tests.llm.conftest import HARD_TEXTS

TEXTS = {"aa": "kata mako tola pira. Sona lamo tika!", "bb": "zchrst vltk brzg hmst. Krsk ptrl?"}


def table(spark, n=60):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        lang = ("aa", "bb")[i % 2]
        words = TEXTS[lang].split()
        rows.append((i, " ".join(rng.choice(words, 20)), lang, lang, i))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _x int")


def test_documents(spark, sf_dir, documents):
    rows = language.op9(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in documents)
    texts = dict(documents)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = language.op9(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out").collect()
    assert len(held) > 200 and np.mean([r.lang_pred == r.lang for r in held]) >= 0.98


def test_hard_texts(spark, hard_docs, no_docs):
    docs = table(spark).select("doc_id", "text", "lang").unionByName(hard_docs.select("doc_id", "text", "lang"))
    out = language.languages(docs).collect()
    assert len(out) == docs.count()
    letters = {i: any(map(str.isalpha, t or "")) for i, t in enumerate(HARD_TEXTS)}
    blank = [r for r in out if r.lang_pred == "und"]
    assert sorted(r.doc_id for r in blank) == [i for i, some in letters.items() if not some] == [0, 1, 2, 13]
    assert {r.score for r in blank} == {0.0}
    kept = language.identified(hard_docs, language.fit(docs), ("found", "part"))
    assert kept.columns == [*hard_docs.columns, "found", "part"]
    assert language.languages(no_docs).count() == 0


def test_nothing_learned_is_unknown(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in language.languages(docs).collect()} == {("und", 0.0)}


def test_switches_inside_a_text(spark):
    model = language.fit(table(spark))
    mixed = TEXTS["aa"].replace(".", " ").replace("!", " ") * 3 + TEXTS["bb"]
    share = language.label_shares(pa.array([TEXTS["aa"], TEXTS["bb"], mixed]), model)
    assert model.labels == ["aa", "bb"]
    assert share[0, 0] > 0.9 and share[1, 1] > 0.9
    letters = [sum(c.isalpha() for c in t) for t in (TEXTS["aa"] * 3, TEXTS["bb"])]
    assert abs(share[2, 0] - letters[0] / sum(letters)) < 0.1
    # To stay in a language is likelier than to switch.
    assert model.then[0, 0] > model.then[0, 1] and model.then[1, 1] > model.then[1, 0]


def test_forward_backward_against_all_labelings():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 4, 2])
    starts = np.cumsum(lengths) - lengths
    scores, first, then = rng.normal(size=(10, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    label, pairs, total = language.forward_backward(scores, starts, lengths, first, then)
    want, want_pairs, want_total = np.zeros((10, 3)), np.zeros((3, 3)), 0.0
    for s, n in zip(starts, lengths):
        weights = {}
        for path in itertools.product(range(3), repeat=int(n)):
            weights[path] = np.exp(first[path[0]] + sum(scores[s + t, path[t]] for t in range(n)) + sum(then[path[t - 1], path[t]] for t in range(1, n)))
        z = sum(weights.values())
        want_total += np.log(z)
        for path, w in weights.items():
            for t in range(n):
                want[s + t, path[t]] += w / z
                if t:
                    want_pairs[path[t - 1], path[t]] += w / z
    assert np.allclose(label, want) and np.allclose(pairs, want_pairs) and np.isclose(total, want_total)


def test_chains():
    words, word, text, starts, lengths = language.chains_of(pa.array(["One two. Three 12 !", None, "...", "a b c d e"]), 2)
    assert [words[w] for w in word] == ["one", "two", "three", "a", "b", "c", "d", "e"]
    assert text.tolist() == [0, 0, 0, 3, 3, 3, 3, 3]
    assert list(zip(starts.tolist(), lengths.tolist())) == [(0, 2), (2, 1), (3, 2), (5, 2), (7, 1)]


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    alone = [sorted(language.feature_table([w])[0].tolist()) for w in (b"ab", b"abc")]
    both, owners = language.feature_table([b"ab", b"abc"])
    assert [sorted(both[owners == k].tolist()) for k in (0, 1)] == alone


def test_a_language_without_spaces_is_learned(spark):
    rng = np.random.default_rng(7)
    spaceless = ["".join(rng.choice(list("的一是不了人我在有他这中大来上国"), int(rng.integers(5, 90)))) for _ in range(60)]
    english = [" ".join(rng.choice("the of and to in is that for it was".split(), 20)) for _ in range(60)]
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(t, "zh") for t in spaceless] + [(t, "en") for t in english])]
    out = language.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(out) == 120 and all(r.lang_pred == rows[r.doc_id][2] for r in out)


def test_the_sample_is_bounded(spark, monkeypatch):
    """Repeated rows are learned from once, and of many labels the commonest."""
    learned = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 4 != 2)
    rows = [(i, f"{TEXTS['aa']} {i}", "aa") for i in range(40)] + [(learned, TEXTS["bb"], "bb")] * 60 + [(500 + i, "odd words", f"x{i}") for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = {}
    monkeypatch.setattr(language, "train", lambda chains, tags, labels: seen.update(chains=chains, labels=labels))
    monkeypatch.setattr(language, "MAX_LABELS", 5)
    language.fit(frame, docs_per_language=1000, sentences=3)
    assert len(seen["labels"]) == 5 and {"aa", "bb"} <= set(seen["labels"])
    by_hand = sum(c == ["zchrst", "vltk", "brzg", "hmst"] for c in seen["chains"])
    assert by_hand <= 2  # one row of the sample, or joined to another once


def test_long_words_are_cut():
    words, word, text, starts, lengths = language.chains_of(pa.array(["ab " + "x" * 50, "½Ⅷ 3"]))
    assert [words[w] for w in word] == ["ab", "x" * 24, "x" * 24, "xx"] and text.tolist() == [0] * 4
    assert lengths.tolist() == [4]
