import itertools
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from pagelode.functions import edits
from pagelode.operators import ranking
from pagelode.options import SearchOptions
from pagelode.plans import index_build, search
from pagelode.session import workdir


def edit_distance(a, b):
    """Insert, delete, replace or swap two neighbours, each one edit; no text edited twice."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        before, last = last, row
    return last[-1]


def limit(term):
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def changed(rng, word):
    chars = list(word)
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(chars))
        kind = rng.randrange(4)
        if kind == 0 and len(chars) > 1:
            del chars[at]
        elif kind == 1:
            chars.insert(at, rng.choice("abü"))
        elif kind == 2:
            chars[at] = rng.choice("abü")
        elif at + 1 < len(chars):
            chars[at], chars[at + 1] = chars[at + 1], chars[at]
    return "".join(chars)


def test_edit_distance():
    assert [edit_distance(a, b) for a, b in (("ab", "ba"), ("abcd", "acbd"), ("ca", "abc"), ("", "ab"), ("kitten", "sitting"))] == [1, 1, 3, 2, 3]


def test_edits_equal_the_plain_distance_up_to_two(spark):
    words = ["".join(t) for n in range(6) for t in itertools.product("abc", repeat=n)]
    rng = random.Random(2)
    pairs = [(a, b) for a in rng.sample(words, 120) for b in words]
    pairs += [(w, changed(rng, changed(rng, w))) for w in ("".join(rng.choices("abcdü", k=rng.randint(6, 14))) for _ in range(4000))]
    got = spark.createDataFrame(pairs, "a string, b string").withColumn("e", edits.edits(F.col("a"), F.col("b"))).collect()
    assert [(r.a, r.b, min(r.e, 3)) for r in got] == [(a, b, min(edit_distance(a, b), 3)) for a, b in pairs]


def test_fuzzy_terms_equal_all_pairs(spark):
    rng = random.Random(13)
    asked = ["".join(rng.choices("abü", k=n)) for n in (1, 2, 3, 4, 5, 5, 6, 6, 7, 9, 12, 23, 24, 25, 26, 30, 41)]
    words = sorted({changed(rng, rng.choice(asked)) for _ in range(3000)} | {"".join(rng.choices("abü", k=rng.randint(1, 8))) for _ in range(500)})
    vocab = spark.createDataFrame([("content", w, 1, 1) for w in words], "field string, term string, df long, total_tf long")
    terms = spark.createDataFrame([(t,) for t in sorted(set(asked))], "qterm string")
    want = {(t, w, edit_distance(t, w)) for t in asked for w in words if edit_distance(t, w) <= limit(t)}
    for small in (True, False):
        got = ranking.fuzzy_terms(terms, vocab, small).collect()
        assert {(r.qterm, r.term, r.edits) for r in got} == want
        assert len(got) == len(want)
    few = ranking.few_terms(terms, vocab.withColumn("size", F.length("term"))).collect()
    assert {(r.qterm, r.term, r.edits) for r in few} == want and len(few) == len(want)


def test_no_query_terms(spark):
    vocab = spark.createDataFrame([("content", "abc", 1, 1)], "field string, term string, df long, total_tf long")
    terms = ranking.query_terms(spark.createDataFrame([(1, "  ")], "query_id int, q string"))
    assert ranking.fuzzy_terms(terms.select("qterm"), vocab, True).count() == 0
    assert ranking.few_terms(terms.select("qterm"), vocab.withColumn("size", F.length("term"))).count() == 0


def test_at_most_fifty_expansions_nearest_first(spark):
    words = [("content", "abcdef", 0, 5)] + [("content", f"abcde{i:02d}", 2, i) for i in range(80)] + [("content", "abcde", 1, 500)]
    matches = spark.createDataFrame([(f, "abcdef", w, df, e) for f, w, e, df in words],
                                    "field string, qterm string, term string, df long, edits int")
    kept = ranking.expansions(matches).collect()
    assert len(kept) == 50
    assert {r.term for r in kept} == {"abcdef", "abcde"} | {f"abcde{i:02d}" for i in range(48)}
    assert {r.shared_df for r in kept} == {500}


DOCS = [
    ("https://en.wikipedia.org/wiki/A#1", "Graph theory", "graph graph vertex edge"),
    ("https://en.wikipedia.org/wiki/A#2", "Graph", "vertex"),
    ("https://example.org/B", "Graphs graph", "graph " * 30),
    ("https://mit.edu/C", "Cooking", "pasta grpah and water " + "x" * 300),
    ("https://en.wikipedia.org/wiki/D", "", "edge edge pasta"),
]


def tokens(text):
    return re.findall(r"[^\W_]+", text.lower())


def brute_force(query, options=SearchOptions()):
    scores = {}
    for at, boost in ((1, 2.0), (2, 1.0)):
        docs = {d[0]: tokens(d[at]) for d in DOCS}
        filled = [t for t in docs.values() if t]
        n, mean = len(filled), sum(map(len, filled)) / len(filled)
        df = Counter(w for t in docs.values() for w in set(t))
        for url, text in docs.items():
            total = 0.0
            for term in tokens(query):
                near = sorted((edit_distance(term, w), -(1 - edit_distance(term, w) / min(len(term), len(w))), w)
                              for w in df if edit_distance(term, w) <= limit(term))
                near = [(w, -neg) for _, neg, w in near if -neg > 0][:50]
                shared = max((df[w] for w, _ in near), default=0)
                for w, weight in near:
                    f = text.count(w)
                    if f:
                        idf = math.log(1 + (n - shared + 0.5) / (shared + 0.5))
                        total += 2.2 * weight * idf * f / (f + 1.2 * (0.25 + 0.75 * len(text) / mean))
            if total:
                scores[url] = max(scores.get(url, 0.0), boost * total)
    ranked = sorted(((-round(s, 6), u) for u, s in scores.items()))[:50]
    out, seen = [], set()
    for neg, url in ranked:
        bare = url.split("#")[0]
        if any(d in bare.lower() for d in options.trusted_domains) and bare not in seen:
            seen.add(bare)
            out.append((bare, -neg))
    return out[:10]


def test_search_equals_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "url string, title string, content string").repartition(3)
    path = workdir(spark, "index")
    index_build.build_index(docs, path, buckets=3)
    index = index_build.open_index(spark, path)
    asked = ["graph", "grapf theory", "pasta edge", "vertex vertex", "", " ", "no", "zzzzzz", "Graph!"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, q string")
    got = search.search(index, queries).orderBy("query_id", "position").collect()
    for i, q in enumerate(asked):
        assert [(r.url, r.score) for r in got if r.query_id == i] == brute_force(q), q
    assert {len(r.preview) for r in got if r.url.endswith("/C")} == {203}


def test_pool_is_cut_before_the_trust_filter(spark):
    rows = [(1, f"https://{'en.wikipedia.org' if i >= 55 else 'example.org'}/{i}", 1.0, i, i) for i in range(1, 61)]
    hits = spark.createDataFrame(rows, "query_id long, url string, score double, rank int, doc long")
    assert ranking.search_top(hits.where("rank <= 50")).count() == 0
    assert ranking.search_top(hits).count() == 6


def test_document_numbers_rise_with_the_url(spark):
    docs = spark.createDataFrame([(f"u{i}", "t", "c") for i in range(500)], "url string, title string, content string")
    index = index_build.build_index(docs.repartition(6), workdir(spark, "index"))
    got = [r.url for r in index.docs.orderBy("doc").collect()]
    assert got == sorted(f"u{i}" for i in range(500))
    assert index.stats.where("field = 'title'").first().n_docs == 500


def test_many_queries_over_few_words_are_not_broadcast(spark):
    """Rows of the query side are counted, not its distinct terms."""
    docs = spark.createDataFrame(DOCS, "url string, title string, content string")
    index = index_build.build_index(docs, workdir(spark, "index"), buckets=3)
    words = ["graph", "theory", "vertex", "edge", "cooking", "pasta", "water", "graphs", "grpah", "and"]
    one = F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("id") % 10 + 1).cast("int"))
    many = spark.range(100_000).select(F.col("id").alias("query_id"), one.alias("q"))
    asked, small = search.asked_terms(index, many)
    assert asked.count() > 100_000 and not small
    pool, few = search.search_pool(index, many)
    plan = search.with_docs(pool, index, ("url",), few)._jdf.queryExecution().analyzed().toString()
    assert not few and plan.count("strategy=broadcast") == 1  # the statistics, a row per field
    assert search.search_pool(index, many.limit(20))[1]


def test_long_terms_are_found(spark):
    long = "x" * 99 + "abc"
    vocab = spark.createDataFrame([("content", w, 1, min(len(w), ranking.LONGEST)) for w in (long, long + "d", long + "def", "x" * 98)],
                                  "field string, term string, df long, size int")
    for term, wanted in ((long, {long, long + "d"}), ("x" * 99, {"x" * 98}), (long + "de", {long, long + "d", long + "def"})):
        got = ranking.few_terms(spark.createDataFrame([(term,)], "qterm string"), vocab).collect()
        assert {r.term for r in got} == wanted


def test_tasks_that_count_tokens_follow_the_text(spark, monkeypatch):
    """Parts of a bounded size, whatever the session's number of partitions; repeated and null keys are put together."""
    monkeypatch.setattr(ranking, "PART_BYTES", 1000)
    rows = [(i % 90 if i % 90 else None, "a b a", f"w{i % 7} common {'x' * 50}") for i in range(180)]
    docs = spark.createDataFrame(rows, "url long, title string, content string")
    posted = ranking.postings(docs)
    assert ranking.text_bytes(docs) == sum(len(t) + len(c) for _, t, c in rows)
    assert posted.rdd.getNumPartitions() == -(-ranking.text_bytes(docs) // 1000) > 10
    assert ranking.postings(docs, n_bytes=2500).rdd.getNumPartitions() == 3
    got = {(r.url, r.field, r.term): (r.dl, r.tf, r.opens) for r in posted.collect()}
    assert len(got) == posted.count() and got[(None, "title", "a")] == (3, 4, True) and got[(None, "title", "b")] == (3, 2, False)
    assert ranking.postings(docs.limit(0)).count() == 0


def exchanges(df):
    """Keys and number of partitions of every shuffle by a hash."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"Exchange hashpartitioning\((.*), (\d+)\)", plan)
    return [(re.findall(r"(\w+)#", keys), int(n)) for keys, n in found]


def many_docs(spark, n=400):
    return spark.createDataFrame([(f"https://example.org/{i:04d}", f"graph w{i % 7}", f"graph edge w{i % 5} {'x' * (i % 9)}") for i in range(n)],
                                 "url string, title string, content string")


def test_tasks_where_hits_meet_follow_their_number(spark, monkeypatch):
    """Joins of hits to URLs have as many parts as there are hits for, whatever the session's number of partitions."""
    index = index_build.build_index(many_docs(spark), workdir(spark, "index"), buckets=3)
    queries = spark.createDataFrame([(1, "graph"), (2, "edge grahp"), (3, "zzzz")], "query_id long, q string")
    asked, small = search.asked_terms(index, queries)
    hits = search.term_hits(index, asked, small)
    n = search.hit_count(asked)
    assert n == hits.count() > 1000
    plain = search.with_docs(hits, index, ("url",), False, n)
    wanted = sorted(map(tuple, plain.select("query_id", "term", "url", "tf").collect()))
    monkeypatch.setattr(ranking, "HIT_ROWS", 50)
    joined = search.with_docs(hits, index, ("url",), False, n)
    assert (["shard", "doc"], -(-n // 50)) in exchanges(joined)
    assert sorted(map(tuple, joined.select("query_id", "term", "url", "tf").collect())) == wanted


def test_tasks_that_add_up_scores_follow_the_hits(spark, monkeypatch):
    index = index_build.build_index(many_docs(spark), workdir(spark, "index"), buckets=3)
    queries = spark.createDataFrame([(1, "graph"), (2, "edge grahp"), (3, "zzzz")], "query_id long, q string")
    wanted = sorted(map(tuple, search.search_pool(index, queries)[0].collect()))
    monkeypatch.setattr(ranking, "HIT_ROWS", 50)
    pool = search.search_pool(index, queries)[0]
    n = search.hit_count(search.asked_terms(index, queries)[0])
    assert (["query_id", "doc"], -(-n // 50)) in exchanges(pool)
    assert wanted and sorted(map(tuple, pool.collect())) == wanted


def test_tasks_that_order_documents_follow_the_text(spark, monkeypatch):
    docs = many_docs(spark)
    monkeypatch.setattr(ranking, "DOC_BYTES", 400)
    index = index_build.build_index(docs, workdir(spark, "index"), buckets=3)
    parts = index.docs.select(F.shiftright("doc", 33).alias("part")).groupBy("part").count().collect()
    assert len(parts) > 16 and max(r["count"] for r in parts) < 100
    assert [r.url for r in index.docs.orderBy("doc").collect()] == sorted(r.url for r in docs.collect())
