import corpus_pipeline as pipeline
from pagelode.llm import language, quality
from test_decontamination import brute as brute_leaks
from test_packing import check as check_packing
from test_simhash import brute_components


def test_stages_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    step = lambda name, df: dict(pipeline.STAGES)[name](spark, df, sf_dir)
    kept = step("quality_classifier", docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in quality.quality_scores(docs, labels).where("predicted = 1").collect()}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == good and len(good) < docs.count()

    spoken = step("language_id", kept)
    want = {r.doc_id for r in language.languages(kept).collect() if r.lang_pred != "und" and r.score >= pipeline.MIN_LANGUAGE_SHARE}
    assert spoken.columns == columns and {r.doc_id for r in spoken.collect()} == want

    single = step("near_dedup", spoken)
    pairs = [(r.doc_id, r.text) for r in spoken.collect()]
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in brute_components(pairs)})

    clean = step("decontaminate", single)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    pairs = [(r.doc_id, r.text) for r in single.collect()]
    leaking = {d for d, *_ in brute_leaks(pairs, items)}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {d for d, _ in pairs} - leaking

    placed = step("pack", clean).collect()
    check_packing(placed, [(r.doc_id, r.text) for r in clean.collect()])
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, pipeline.run(spark, sf_dir).collect())) == sorted(map(key, placed))


def test_one_row_stays_of_hard_texts(spark, hard_docs, no_docs):
    """Repeated rows and ids, rows without an id: one row per component, all columns kept."""
    single = pipeline.near_dedup(spark, hard_docs, "").collect()
    marks = [m for _, m, _ in brute_components([(r.doc_id, r.text) for r in hard_docs.collect()])]
    assert len(single) >= 1 and set(single) <= set(hard_docs.collect())
    roots = {}
    for m in set(marks):
        near = [o for o in roots if (int(o, 16) ^ int(m, 16)).bit_count() <= 3]
        roots[m] = near[0] if near else m
    assert len(single) == len({m for m, r in roots.items() if m == r})
    assert pipeline.near_dedup(spark, no_docs, "").count() == 0


def test_stages_on_hard_texts(spark, sf_dir, hard_docs, no_docs):
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, hard_docs, sf_dir)
        assert out.columns == hard_docs.columns, name
        assert set(out.collect()) <= set(hard_docs.collect()), name
        assert stage(spark, no_docs, sf_dir).count() == 0, name
    check_packing(pipeline.pack(spark, hard_docs, sf_dir).collect(), [(r.doc_id, r.text) for r in hard_docs.collect()])
    assert pipeline.pack(spark, no_docs, sf_dir).count() == 0
