import os
import random
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagelode.operators import packed, ranking, spread, vocabulary
from pagelode.plans import index_build, search, segment_search, segments
from pagelode.registry import segment_queries
from pagelode.session import workdir
from test_search import changed, edit_distance, exchanges, limit

WORDS = [f"{a}{b}{c}" for a in ("graph", "node", "edge", "tree", "path", "cycle") for b in ("", "s", "al", "ing") for c in ("", "x", "um")]
SCHEMA = "url string, title string, content string"


def rows(seed, n, first=0, least=1):
    rng = random.Random(seed)
    pick = lambda k: " ".join(rng.choice(WORDS[:rng.randint(least, len(WORDS))]) for _ in range(k))
    hosts = ("https://en.wikipedia.org/wiki", "https://example.org")
    return {f"{hosts[i % 2]}/{i}": (pick(rng.randint(0, 4)), pick(rng.randint(0, 40))) for i in range(first, first + n)}


def frame(spark, docs):
    return spark.createDataFrame([(u, *d) for u, d in docs.items()], SCHEMA).repartition(3)


QUERIES = ["graph", "grahp theory", "edges nodeal", "treex", "cycleing path", "zzzz", "", "path cycleing", "edge edge", "paths"]


def results(spark, index, plan, **more):
    asked = spark.createDataFrame(list(enumerate(QUERIES)), "query_id long, q string")
    got = plan(index, asked, **more).select("query_id", "position", "url", "title", "preview", "score").collect()
    return sorted(tuple(r) for r in got)


@pytest.fixture(scope="module")
def changed_index(spark):
    """A base, a batch that overwrites and adds, one that overwrites again, and a deletion."""
    index = segments.create(spark, workdir(spark, "segments"))
    live = rows(1, 120)
    index = segments.upsert(index, frame(spark, live), block_bits=2)
    for seed, first, n in ((2, 100, 40), (3, 110, 15)):
        more = rows(seed, n, first)
        index = segments.upsert(index, frame(spark, more), block_bits=2)
        live |= more
    gone = [u for i, u in enumerate(sorted(live)) if i % 11 == 3]
    index = segments.delete(index, spark.createDataFrame([(u,) for u in [*gone, "https://nobody.org"]], "url string"))
    return index, {u: d for u, d in live.items() if u not in gone}


def fresh(spark, live):
    return index_build.build_index(frame(spark, live), workdir(spark, "fresh"), buckets=3)


def sums(frame_):
    return sorted(tuple(r) for r in frame_.collect())


def test_changes_equal_a_rebuild(spark, changed_index):
    index, live = changed_index
    whole = fresh(spark, live)
    assert sorted(tuple(r) for r in index.live_docs().select("url", "title", "content").collect()) == sorted((u, *d) for u, d in live.items())
    assert sums(index.vocabulary()) == sums(whole.vocab.select("field", "term", "df", "total_tf"))
    assert sums(index.field_stats()) == sums(whole.stats.select("field", "n_docs", "n_tokens", "avgdl"))
    wanted = results(spark, whole, search.search)
    assert wanted and results(spark, index, segment_search.search) == wanted
    assert results(spark, index, segment_search.search, seeds=1, direct=0) == wanted
    opened = segments.open_index(spark, index.path)
    assert opened.segments == index.segments and results(spark, opened, segment_search.search) == wanted


def test_merges_keep_the_results(spark, changed_index):
    index, live = changed_index
    wanted, vocab, stats = results(spark, index, segment_search.search), sums(index.vocabulary()), sums(index.field_stats())
    for numbers in ([1, 2], [s.number for s in index.segments]):
        merged = segments.merge(index, numbers, block_bits=3)
        assert len(merged.segments) == len(index.segments) - len(numbers) + 1
        assert results(spark, merged, segment_search.search, direct=0) == wanted
        assert sums(merged.vocabulary()) == vocab and sums(merged.field_stats()) == stats
    assert merged.segments[0].n_docs == len(live) and merged.segments[0].n_dead == 0
    assert segments.merge(index, [99]) == index


def test_a_batch_writes_what_it_holds(spark, changed_index):
    index, _ = changed_index
    before = index.docs.count()
    one = segments.upsert(index, spark.createDataFrame([("https://example.org/7", "new", "unheard graph")], SCHEMA))
    added = one.segments[-1]
    assert (added.n_docs, added.n_dead) == (1, 1)
    assert one.docs.count() == before + 1 and one.table("dead", segments.DEAD, [added.number]).count() == 1
    assert one.table("postings", segments.POSTINGS, [added.number]).count() == 3
    # The new terms, and those that the old text had.
    assert 3 <= one.table("vocab", segments.VOCAB, [added.number]).count() < 100
    again = segments.upsert(one, one.live_docs().where("url = 'https://example.org/7'").select("url", "title", "content"))
    assert sums(again.vocabulary()) == sums(one.vocabulary())


def test_segments_stay_few(spark, monkeypatch):
    monkeypatch.setattr(segments, "FAN_IN", 2)
    index = segments.create(spark, workdir(spark, "segments"))
    live = {}
    for i in range(4):
        more = rows(20 + i, 6, 4 * i)
        live |= more
        index = segments.maintain(segments.upsert(index, frame(spark, more).coalesce(1)))
        assert len(index.segments) <= 2
    assert results(spark, index, segment_search.search) == results(spark, fresh(spark, live), search.search)
    gone = segments.vacuum(index)
    assert gone and results(spark, segments.open_index(spark, index.path), segment_search.search) == results(spark, index, segment_search.search)
    assert segments.vacuum(index) == []


def test_an_unfinished_batch_is_not_seen(spark, changed_index):
    index = segments.open_index(spark, changed_index[0].path)
    wanted = results(spark, index, segment_search.search)
    number = segments._next_number(index)
    segments._write_docs(index, frame(spark, rows(50, 5)), number)
    opened = segments.open_index(spark, index.path)
    assert number not in [s.number for s in opened.segments] and results(spark, opened, segment_search.search) == wanted
    assert segments._next_number(opened) == number + 1


def test_empty_index_and_no_queries(spark):
    index = segments.create(spark, workdir(spark, "segments"))
    assert results(spark, index, segment_search.search) == []
    filled = segments.upsert(index, frame(spark, rows(1, 5)))
    none = spark.createDataFrame([], "query_id long, q string")
    assert segment_search.search(filled, none).count() == 0
    gone = segments.delete(filled, filled.docs.select("url"))
    assert results(spark, gone, segment_search.search) == [] and gone.vocabulary().count() == 0
    assert segments.merge(gone, [0, 1]).segments[0].n_docs == 0
    with pytest.raises(ValueError):
        segments.open_index(spark, workdir(spark, "nothing"))


def skewed(spark):
    """A word that is frequent in the titles of one block alone."""
    docs = {f"https://en.wikipedia.org/wiki/{i:05d}": ("graph graph" if i // 64 == 5 else "", f"graph {'filler ' * 30} w{i}") for i in range(1024)}
    return segments.upsert(segments.create(spark, workdir(spark, "segments")), frame(spark, docs).coalesce(1), block_bits=6), docs


def test_blocks_are_skipped(spark):
    index, docs = skewed(spark)
    asked = spark.createDataFrame([(1, "graph")], "query_id long, q string")
    options = segment_search.SearchOptions()
    _, terms = segment_search.distinct_queries(asked)
    held = segment_search.asked_terms(index, segment_search.held(terms, "terms"), options)
    stats = index.field_stats()
    bounds = segment_search.block_bounds(index, held, stats, options)
    needed = segment_search.needed_blocks(index, held, stats, options, seeds=1, direct=0)
    assert bounds.count() >= 16 and needed.count() < 6
    every = segment_search.scored_blocks(index, held, stats, options)
    some = segment_search.scored_blocks(index, held, stats, options, needed)
    top = lambda f: [tuple(r) for r in f.orderBy(F.desc("score"), "doc").limit(50).collect()]
    assert top(some) == top(every) and some.count() < every.count() / 2
    # A bound is never below a score in its block.
    block = every.withColumn("block", F.shiftright("doc", 6)).groupBy("block").agg(F.max("score").alias("most"))
    assert block.join(bounds, "block").where("most > best + 1e-6").count() == 0


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_no_hit_is_shuffled_by_its_document(spark, changed_index):
    index, _ = changed_index
    asked = spark.createDataFrame([(1, "graph edge")], "query_id long, q string")
    _, terms = segment_search.distinct_queries(asked)
    held = segment_search.asked_terms(index, segment_search.held(terms, "terms"), segment_search.SearchOptions())
    scores = segment_search.scored_blocks(index, held, index.field_stats(), segment_search.SearchOptions())
    physical = plan_of(scores).split("== Physical Plan ==")[1]
    exchanges = [line for line in physical.splitlines() if "Exchange hashpartitioning" in line and "query_id" in line]
    assert exchanges and all("doc#" not in line.split("hashpartitioning")[1] for line in exchanges)


def test_many_queries_are_not_broadcast(spark, changed_index, monkeypatch):
    """Few words but many queries: rows are counted, not words."""
    index, _ = changed_index
    monkeypatch.setattr(segment_search, "HELD_ROWS", 20)
    wanted = results(spark, index, segment_search.search)
    n = 3_000
    many = spark.range(n).select(F.col("id").alias("query_id"), F.element_at(F.array(*[F.lit(q) for q in QUERIES]), (F.col("id") % len(QUERIES) + 1).cast("int")).alias("q"))
    out = segment_search.search(index, many)
    # The one hint left is on the statistics, a row per field, which are aggregated before.
    assert plan_of(out).split("== Analyzed Logical Plan ==")[0].count("strategy=broadcast") <= 1
    assert sorted(tuple(r)[1:] for r in out.where("query_id < 10").collect()) == sorted(r[1:] for r in wanted)
    assert out.count() == n // len(QUERIES) * len(wanted)


@pytest.mark.parametrize("seed", [1, 2])
def test_automaton_equals_all_prefixes(seed):
    rng = random.Random(seed)
    words = sorted({changed(rng, changed(rng, "".join(rng.choices("abcü", k=rng.randint(1, 9))))) or "a" for _ in range(1500)})
    prefixes = sorted({w[:vocabulary.PREFIX] for w in words})
    for term in rng.sample(words, 60):
        most = limit(term)
        near = {w[:vocabulary.PREFIX] for w in words if edit_distance(term, w) <= most}
        found = vocabulary.reached(prefixes, term, most)
        assert near <= set(found) and found == sorted(found)
        if most == 0:
            assert set(found) <= {term[:vocabulary.PREFIX]}


def test_automaton_passes_over_what_is_out_of_reach(monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    prefixes = sorted(a + b + c + d for a in letters for b in letters[::2] for c in letters[::2] for d in letters[::3])
    steps = []
    step = vocabulary.Automaton.step
    monkeypatch.setattr(vocabulary.Automaton, "step", lambda self, *a: steps.append(1) or step(self, *a))
    found = vocabulary.reached(prefixes, "magenta", 2)
    assert len(steps) < 0.6 * len(prefixes) and 0 < len(found) < len(prefixes) / 10


def test_near_terms_read_a_part(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 9))) for _ in range(6_000)})
    vocab = spark.createDataFrame([(f, w, w[:vocabulary.PREFIX], df) for w in words for f, df in (("content", 3), ("title", 1), ("title", -1))],
                                  "field string, term string, prefix string, df long").cache()
    asked = [words[10], changed(rng, words[2000]) or "abc", words[4000] + "q", "a", "ab", "abcabcabc"]
    got = vocabulary.near_terms(sorted(set(asked)), vocab, vocab.select("prefix").distinct().repartition(3))
    wanted = {(t, w, edit_distance(t, w)) for t in asked for w in words if edit_distance(t, w) <= limit(t)}
    assert {(r.qterm, r.term, r.edits) for r in got.collect()} == wanted
    assert {(r.field, r.df) for r in got.collect()} == {("content", 3)}
    reach = vocabulary.reachable(vocab.select("prefix").distinct(), [words[4000]])
    part = vocab.join(reach, "prefix").count()
    assert 0 < part < vocab.count() / 20


def test_ranges_cover_the_prefixes():
    wanted = sorted({"abca", "abcb", "abcd", "b", "ba", "xyzä", "日本"})
    for most in (1, 2, 3, 10):
        spans = vocabulary.ranges(wanted, most)
        assert len(spans) <= most and all(any(a <= w <= b for a, b in spans) for w in wanted)
    assert vocabulary.ranges([], 3) == [] and ("xyzä", "xyzä") in vocabulary.ranges(wanted, 10)


def test_a_frequent_term_is_written_by_several_tasks(spark):
    """Also if every document's number was given out by another task."""
    index = segments.create(spark, workdir(spark, "segments"))
    hits = spark.range(64).select((F.col("id") * 2**33).alias("doc"), F.lit("content").alias("field"), F.lit(3).alias("dl"),
                                  F.lit("graph").alias("term"), F.lit(2).cast("long").alias("tf"), F.lit(True).alias("opens"))
    posted = segments._write_postings(index, hits, 0, 2**30, segments.BLOCK_BITS)
    assert posted.select(F.input_file_name()).distinct().count() == 2
    assert posted.agg(F.count("block"), F.sum("n"), F.sum("total_tf"), F.sum("n_opens")).first() == (64, 64, 128, 64)


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_blocks_go_on_from_batch_to_batch(size):
    rng = random.Random(size)
    keys = sorted({(rng.choice(["a", "b", "é"]), rng.choice(["content", "title"]), rng.randrange(40) + rng.choice([0, 2**33])) for _ in range(90)})
    rows = [{"field": f, "term": t, "doc": d, "tf": rng.randint(1, 9), "dl": rng.randint(1, 99), "opens": rng.random() < 0.3} for t, f, d in keys]
    schema = pa.schema([("field", "string"), ("term", "string"), ("doc", "int64"), ("tf", "int64"), ("dl", "int32"), ("opens", "bool")])
    batches = [pa.RecordBatch.from_pylist(rows[i:i + size], schema) for i in range(0, len(rows), size)]
    got = [r for b in segments._folded(iter([pa.RecordBatch.from_pylist([], schema), *batches]), 3) for r in b.to_pylist()]
    wanted = []
    for (term, field, block), group in groupby(rows, lambda r: (r["term"], r["field"], r["doc"] >> 3)):
        group = list(group)
        wanted.append({
            "field": field, "term": term, "block": block, "n": len(group), "total_tf": sum(r["tf"] for r in group), "max_tf": max(r["tf"] for r in group),
            "min_dl": min(r["dl"] for r in group), "n_opens": sum(r["opens"] for r in group), "hits": [{c: r[c] for c in ("doc", "tf", "dl")} for r in group]})
    assert got == wanted


def test_documents_of_a_segment_are_ordered_in_tasks_that_follow_the_text(spark, monkeypatch):
    monkeypatch.setattr(ranking, "DOC_BYTES", 400)
    index = segments.upsert(segments.create(spark, workdir(spark, "segments")), frame(spark, rows(7, 200)))
    parts = index.docs.select(F.shiftright("doc", 33).alias("part")).groupBy("part").count().collect()
    assert len(parts) > 16 and max(r["count"] for r in parts) < 60
    assert [r.url for r in index.docs.orderBy("doc").collect()] == sorted(rows(7, 200))


def test_many_dead_documents(spark, monkeypatch):
    """More than may be broadcast: texts are dealt by their bytes, and nothing changes."""
    live, more = rows(1, 120), rows(2, 60, 40)
    index = segments.upsert(segments.create(spark, workdir(spark, "segments")), frame(spark, live))
    monkeypatch.setattr(spread, "SMALL_ROWS", 5)
    monkeypatch.setattr(ranking, "DOC_BYTES", 300)
    monkeypatch.setattr(ranking, "PART_BYTES", 300)
    index = segments.delete(segments.upsert(index, frame(spark, more)), spark.createDataFrame([(u,) for u in sorted(more)[:9]], "url string"))
    live = {u: d for u, d in (live | more).items() if u not in sorted(more)[:9]}
    assert index.segments[1].n_dead == 60 and any(on == ["segment", "doc"] and n > 8 for on, n in exchanges(index.live_docs()))
    whole, merged = fresh(spark, live), segments.merge(index, [0, 1, 2])
    for found in (index, merged):
        assert sorted(tuple(r) for r in found.live_docs().select("url", "title", "content").collect()) == sorted((u, *d) for u, d in live.items())
        assert sums(found.vocabulary()) == sums(whole.vocab.select("field", "term", "df", "total_tf"))
        assert results(spark, found, segment_search.search) == results(spark, whole, search.search)


@pytest.mark.parametrize("listed", [True, False])
def test_tasks_that_score_blocks_follow_their_number(spark, changed_index, monkeypatch, listed):
    index, live = changed_index
    asked = spark.createDataFrame(list(enumerate(QUERIES)), "query_id long, q string")
    _, terms = segment_search.distinct_queries(asked)
    asked = segment_search.asked_terms(index, segment_search.held(terms, "terms"), segment_search.SearchOptions())
    blocks = segment_search.needed_blocks(index, asked, index.field_stats(), segment_search.SearchOptions(), direct=0)
    wanted = results(spark, index, segment_search.search)
    monkeypatch.setattr(ranking, "HIT_ROWS", 10)
    if not listed:
        blocks = segment_search.Held(blocks.rows, None, blocks.among)
        monkeypatch.setattr(segment_search, "HELD_ROWS", 20)
    scores = segment_search.scored_blocks(index, asked, index.field_stats(), segment_search.SearchOptions(), blocks)
    n = blocks.count() if listed else blocks.among
    assert (["query_id", "segment", "block"], -(-n * 4 // 10)) in exchanges(scores)
    assert results(spark, index, segment_search.search, direct=0) == wanted


def test_postings_meet_their_documents_in_tasks_that_follow_their_number(spark, changed_index, monkeypatch):
    index, _ = changed_index
    monkeypatch.setattr(ranking, "HIT_ROWS", 50)
    monkeypatch.setattr(segment_queries, "changed_index", lambda *a: index)
    found = segment_queries.segment_postings(spark, None)
    assert any(on == ["segment", "doc"] and n > 16 for on, n in exchanges(found))
    whole = fresh(spark, changed_index[1])
    wanted = whole.postings.join(whole.docs.select("doc", "url"), "doc").select("url", "field", "term", "tf", "dl")
    assert sums(found) == sums(wanted)


POSTED = pa.schema([("term", "string"), ("field", "string"), ("doc", "int64"), ("tf", "int64"), ("dl", "int32"), ("opens", "bool")])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_packs_give_their_postings_back(seed):
    rng = random.Random(seed)
    words = ["a", "é", "日本", "x" * 700] + [f"w{i}" for i in range(40)]
    keys = {(rng.choice(words), rng.choice(["content", "title"]), (rng.choice([0, 1, 3, 900]) << 33) + rng.randrange(2**33 if i % 9 == 0 else 50)) for i in range(900)}
    made = [{"term": t, "field": f, "doc": d, "tf": rng.choice([1, 2, 300, 2**40]), "dl": rng.randint(1, 2**31 - 1 if seed == 3 else 90), "opens": rng.random() < 0.1} for t, f, d in keys]
    made.append({"term": "w1", "field": "title", "doc": 2**62, "tf": 1, "dl": 1, "opens": True})
    part = np.array([len(r["term"]) % 3 for r in made])
    got = {p: packed.opened(x).to_pylist() for p, x in packed.pack(pa.Table.from_pylist(made, POSTED), part)}
    place = lambda r: (r["term"], r["field"], r["doc"])
    assert {p: sorted(rows, key=place) for p, rows in got.items()} == {p: sorted((r for r, q in zip(made, part) if q == p), key=place) for p in set(part.tolist())}
    assert list(packed.pack(pa.Table.from_pylist([], POSTED), np.zeros(0, int))) == []


def test_packs_go_on_from_batch_to_batch(monkeypatch):
    monkeypatch.setattr(packed, "PACKED_ROWS", 10)
    monkeypatch.setattr(packed, "OPENED_ROWS", 10)
    made = [{"term": f"w{i % 5}", "field": "title", "doc": i, "tf": 1, "dl": 2, "opens": False} for i in range(57)]
    batches = [pa.RecordBatch.from_pylist(made[i:i + 4], POSTED) for i in range(0, 57, 4)]
    sent = list(packed.packs(iter([pa.RecordBatch.from_pylist([], POSTED), *batches]), lambda rows: rows.column("doc").to_numpy() % 2))
    assert len(sent) == 5 and {p for b in sent for p in b.column("part").to_pylist()} == {0, 1}
    got = [r for b in packed.unpacked(iter(sent)) for r in b.to_pylist()]
    assert sorted(got, key=lambda r: r["doc"]) == made


def test_postings_are_shuffled_in_a_few_bytes_each():
    """A row per posting took some sixteen."""
    rng = np.random.default_rng(4)
    n = 60_000
    term = np.minimum(rng.zipf(1.2, n), 9_000)
    keys = np.unique(np.stack([term, rng.integers(0, 3, n) * 2**33 + rng.integers(0, 900, n)]), axis=1)
    term, doc = keys
    rows_ = pa.table({"term": [f"word{t}" for t in term], "field": ["content"] * len(doc), "doc": doc, "tf": np.ones(len(doc), np.int64),
                      "dl": (doc % 613).astype(np.int32), "opens": np.zeros(len(doc), bool)})
    assert sum(len(x) for _, x in packed.pack(rows_, term % 16)) < 7 * len(doc)


def spark_files(spark):
    home = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sorted(f for top in home.localDirsString() for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_"))


def test_shuffle_files_of_a_batch_do_not_stay(spark):
    """They stayed until the driver collected its garbage: the disk of all steps at once."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    had, before = spark.conf.get(setting), spark_files(spark)
    index = segments.upsert(segments.create(spark, workdir(spark, "segments")), frame(spark, rows(1, 60)))
    index = segments.upsert(index, frame(spark, rows(2, 30, 40)))
    index = segments.merge(segments.delete(index, index.docs.select("url").limit(5)), [0, 1, 2])
    assert set(spark_files(spark)) <= set(before)
    assert index.segments[0].n_docs == 65 and spark.conf.get(setting) == had


def test_a_merge_shuffles_no_hit_by_its_document(spark, changed_index, monkeypatch):
    """New numbers go to the tasks as runs of neighbours; where these are too many, hits meet them in a join."""
    index, live = changed_index
    runs, met = segments._runs, []
    monkeypatch.setattr(segments, "_runs", lambda numbered: met.append(runs(numbered)) or met[-1])
    monkeypatch.setattr(spread, "dealt", lambda *a, **k: pytest.fail("hits are dealt"))
    merged = segments.merge(index, [s.number for s in index.segments], block_bits=3)
    assert met[0].num_rows < len(live) == sum(met[0].column("n").to_pylist())
    monkeypatch.undo()
    monkeypatch.setattr(segments, "MOST_RUNS", 5)
    joined = segments.merge(index, [s.number for s in index.segments], block_bits=3)
    hits = [sums(m.hits(m.postings.select("segment", "block", "field", "term", "hits")).drop("segment")) for m in (merged, joined)]
    assert hits[0] == hits[1] and len({h[3] for h in hits[0]}) > 3


def test_runs_of_numbers():
    runs = segments._by_segment(pa.table({"segment": pa.array([4, 2, 4], pa.int32()), "_old": [2**33, 0, 5], "doc": [90, 7, 20], "n": [3, 1, 2]}))
    made = pa.RecordBatch.from_pydict({"segment": pa.array([4] * 8 + [2, 2, 3], pa.int32()), "doc": [4, 5, 6, 7, 2**33 - 1, 2**33, 2**33 + 2, 2**33 + 3, 0, 1, 0], "tf": list(range(11))})
    assert segments._moved(made, runs).to_pydict() == {"segment": [4, 4, 4, 4, 2], "doc": [20, 21, 90, 92, 7], "tf": [1, 2, 5, 6, 8]}


def test_texts_stay_where_dead_documents_fit_in_lists(spark, monkeypatch):
    live, more = rows(1, 120), rows(2, 40, 40)
    index = segments.upsert(segments.create(spark, workdir(spark, "segments")), frame(spark, live))
    monkeypatch.setattr(spread, "SMALL_ROWS", 5)
    monkeypatch.setattr(ranking, "DOC_BYTES", 300)
    index = segments.upsert(index, frame(spark, more))
    live |= more
    assert index.segments[1].n_dead == 40 and not any(on == ["segment", "doc"] for on, _ in exchanges(index.live_docs()))
    assert sorted(tuple(r) for r in index.live_docs().select("url", "title", "content").collect()) == sorted((u, *d) for u, d in live.items())
    assert sums(index.vocabulary()) == sums(fresh(spark, live).vocab.select("field", "term", "df", "total_tf"))
