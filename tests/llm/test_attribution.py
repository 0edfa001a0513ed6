import numpy as np

from pagelode.llm import attribution
from pagelode.llm.tokens import vocabulary_path

OFFSETS = [None]


def plain_offsets(text):
    """Spans of whole characters from the library's own offsets, spaces before a word included."""
    from tokenizers import Tokenizer
    from tokenizers.processors import ByteLevel
    if OFFSETS[0] is None:
        OFFSETS[0] = Tokenizer.from_file(vocabulary_path("json"))
        OFFSETS[0].post_processor = ByteLevel(trim_offsets=False)
    return OFFSETS[0].encode(text, add_special_tokens=False).offsets


def brute(text, sections):
    tokens, shares, crossing = ([0.0] * (len(sections) + 1) for _ in range(3))
    for first, after in plain_offsets(text):
        held = {}
        for c in range(first, after):
            k = next((k for k, (a, b) in enumerate(sections) if a <= c < b), len(sections))
            held[k] = held.get(k, 0) + 1
        most = max(held.values())
        tokens[min(k for k, n in held.items() if n == most)] += 1
        for k, n in held.items():
            shares[k] += n / (after - first)
            crossing[k] += len(held) > 1
    return tokens, shares, crossing


def lines(text):
    out, at = [], 0
    for line in text.split("\n")[:-1]:
        out.append((at, at + len(line) + 1))
        at += len(line) + 1
    return out + [(at, len(text))] if at < len(text) or not out else out


def check(rows, docs, sections_of=lines):
    by_key = {}
    for r in rows:
        by_key.setdefault(r.doc_id, []).append(r)
    assert set(by_key) == {d for d, _ in docs}
    for doc_id, text in docs:
        text = text or ""
        sections = sections_of(text)
        tokens, shares, crossing = brute(text, sections)
        got = sorted(by_key[doc_id], key=lambda r: r.section % 2**31)
        spans = [(r.start, r.end) for r in got if r.section >= 0]
        assert spans == sections
        assert [r.n_tokens for r in got] == tokens[:len(got)]
        assert np.allclose([r.token_share for r in got], shares[:len(got)])
        assert [r.n_crossing for r in got] == crossing[:len(got)]
        assert sum(r.n_tokens for r in got) == len(plain_offsets(text))


def test_documents(spark, sf_dir, documents):
    check(attribution.op7(spark, sf_dir).collect(), documents)


def test_hard_texts(spark, hard_docs, no_docs):
    single = [(i, r.text) for i, r in enumerate(hard_docs.collect())]
    check(attribution.token_counts(spark.createDataFrame(single, "doc_id long, text string")).collect(), single)
    assert attribution.token_counts(hard_docs).where("doc_id is null").count() == 1
    assert attribution.token_counts(no_docs).count() == 0


def test_sections_across_tokens_and_gaps(spark):
    text = "internationalization of documents 日本語🙂 and more"
    cuts = [(0, 5), (5, 9), (12, 23), (23, 35), (35, 37), (37, 37), (40, 46)]
    frame = spark.createDataFrame([(1, text, cuts), (2, text, []), (3, text, None), (4, None, cuts[:1])],
                                  f"doc_id long, text string, sections {attribution.SECTIONS}")
    rows = attribution.token_counts(frame, "sections").collect()
    check([r for r in rows if r.doc_id == 1], [(1, text)], lambda _: cuts)
    outside = [r for r in rows if r.doc_id in (2, 3)]
    assert [(r.section, r.n_tokens) for r in outside] == [(-1, len(plain_offsets(text)))] * 2
    assert [r.n_tokens for r in rows if r.doc_id == 4] == [0]


def test_fields(spark):
    rows = spark.createDataFrame([(1, "A title", "the body\n\nof it", None), (2, None, "", "x")], "doc_id long, title string, body string, note string")
    made = attribution.fields(rows, ["title", "body", "note"])
    for r in made.collect():
        kept = rows.where(rows.doc_id == r.doc_id).first()
        assert [r.text[s.start:s.end] for s in r.sections] == [kept.title or "", kept.body or "", kept.note or ""]
    counts = attribution.token_counts(made, "sections").groupBy("doc_id").agg({"n_tokens": "sum"}).collect()
    assert {d: n for d, n in counts} == {r.doc_id: len(plain_offsets(r.text)) for r in made.collect()}


def test_added_token_is_one_token_of_its_characters(spark):
    cuts = [(0, 2), (2, 15), (15, 17)]
    frame = spark.createDataFrame([(1, "é <|endoftext|> b", cuts)], f"doc_id long, text string, sections {attribution.SECTIONS}")
    rows = attribution.token_counts(frame, "sections").orderBy("section").collect()
    assert [(r.section, r.n_tokens, r.token_share, r.n_crossing) for r in rows] == [(0, 2, 2.0, 0), (1, 1, 1.0, 0), (2, 1, 1.0, 0)]
