"""Operator 2: quality classifier on random-indexing word vectors.

Random indexing: every word has a fixed sparse vector of a few +1 and -1 (its index vector, from a 64-bit
hash of the word), and its word vector is the sum of the index vectors of the words around it, over the
whole corpus. Counts and sums are per word and over all documents; each task sums its part and Spark adds the
parts. Words with less than `MIN_SHARE` of all words keep their index vector, at every size of the corpus:
so at most `1 / MIN_SHARE` words have a learned one, a proven bound on what tasks hold. A document is
pooled from its words' vectors (mean, spread, length of the mean, repeated neighbours, number of words) and
scored by a two-layer network in numpy, whose logits are divided by a temperature fitted on rows that the
training left out.

Words are runs of letters, of digits, and of other characters, in lower case; a word in capitals is
preceded by a mark. Labels come from at most `MAX_LABELLED` labelled ids and as many rows (those with the
smallest hashes); word vectors are from all documents. Labels, lang, source and doc_id are no inputs.

Null or empty text: no words, pooled zeros, scored like any other. Texts of any length are pooled whole, in pieces of
`PIECE_WORDS` words. Null doc_id: scored, never learned from. Repeated rows: each is scored, and learned from once.
Several labels of a document: each counts. No labels, or one class: the smoothed share of label 1 for every
document. A score at the threshold (ties) is predicted 1. Empty table: no rows. Other columns are kept by `scored`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import discard, fold, gathered, in_arrow, query, slices, stored, table, with_fields

# Of all words of the corpus, a learned vector is for those with this share or more.
MIN_SHARE = 1e-5
DIMENSIONS = 64
NONZERO = 4
WINDOW = 2
HIDDEN = 32
MAX_LABELLED = 20_000
FOLDS = 5
THRESHOLD = 0.3
SEED = 11
# Inputs farther from the mean count as this many standard deviations.
FARTHEST = 6.0
# Words of a text whose vectors are looked up at once: some 10 MB.
PIECE_WORDS = 50_000
_PARTS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
CAPITALS = "\x01capitals"


def index_vectors(hashes: np.ndarray, dimensions: int = DIMENSIONS, nonzero: int = NONZERO) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero values of each word's index vector, from bits of its hash: one
    value in each of `nonzero` equal parts."""
    width = dimensions // nonzero
    bits = [hashes >> np.uint64(13 * k) for k in range(nonzero)]
    places = [(b & np.uint64(0xFFF)).astype(np.int64) % width + k * width for k, b in enumerate(bits)]
    signs = [1 - 2 * ((b >> np.uint64(12)) & np.uint64(1)).astype(np.int64) for b in bits]
    return np.stack(places, axis=1), np.stack(signs, axis=1)


def parts(token: str) -> list[str]:
    """Words of a run without white space."""
    if token.isalpha() and (len(token) == 1 or not token.isupper()):
        return [token.lower()]
    out = []
    for part in _PARTS.findall(token):
        if len(part) > 1 and part.isupper():
            out.append(CAPITALS)
        out.append(part.lower())
    return out


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of the texts, all words as places in them, and where each text's words
    begin and end."""
    import xxhash

    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    distinct: dict[str, int] = {}
    place = distinct.setdefault
    flat_list, sizes_list = [], []
    for token in coded.dictionary.to_pylist():
        if token.isalpha() and (len(token) == 1 or not token.isupper()):
            flat_list.append(place(token.lower(), len(distinct)))
            sizes_list.append(1)
        else:
            own = [place(p, len(distinct)) for p in parts(token)]
            flat_list += own
            sizes_list.append(len(own))
    hashes = np.array([xxhash.xxh64_intdigest(word) for word in distinct], np.uint64)
    flat, sizes = np.array(flat_list, np.int64), np.array(sizes_list, np.int64)
    starts = np.cumsum(sizes) - sizes
    token = coded.indices.to_numpy().astype(np.int64)
    # Each token as its run of words.
    n = sizes[token] if len(token) else np.empty(0, np.int64)
    ends = np.cumsum(n)
    words = flat[np.repeat(starts[token] if len(token) else n, n) + np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)]
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return hashes, words, np.r_[0, ends][offsets - offsets[0]]


def _add_context(words: np.ndarray, bounds: np.ndarray, own: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """Add to `out`, for each distinct word with a row there, the index vectors of its neighbours in the texts.
    `own` has the index vectors of the distinct words, `rows` their rows, -1 for none."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for first in range(0, len(words), PIECE_WORDS):
        last = min(first + PIECE_WORDS, len(words))
        low, high = max(first - WINDOW, 0), min(last + WINDOW, len(words))
        vectors, near = own[words[low:high]], np.zeros((high - low, own.shape[1]), np.int8)
        for d in range(1, WINDOW + 1):
            same = (text[low + d:high] == text[low:high - d]).astype(np.int8)[:, None]
            near[d:] += vectors[:-d] * same
            near[:-d] += vectors[d:] * same
        row = rows[words[first:last]]
        known = np.flatnonzero(row >= 0)
        known = known[np.argsort(row[known], kind="stable")]
        if len(known):
            starts = np.flatnonzero(np.r_[True, np.diff(row[known]) > 0])
            out[row[known[starts]]] += np.add.reduceat(near[known + first - low], starts, axis=0, dtype=np.int64)


@dataclass
class Words:
    """Words with a learned vector, by hash (sorted), and their vectors."""

    hashes: np.ndarray
    vectors: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The vectors of words; one that is not known has its index vector."""
        dimensions = self.vectors.shape[1]
        out = np.zeros((len(hashes), dimensions), np.float32)
        places, signs = index_vectors(hashes, dimensions)
        np.put_along_axis(out, places, (signs / np.sqrt(places.shape[1])).astype(np.float32), axis=1)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            out[known] = self.vectors[at[known]]
        return out


def word_counts(docs: DataFrame) -> DataFrame:
    """word (the hash as a long) and n, over all documents. Runs without white space are counted by Spark, and
    each distinct one is cut into its words once."""
    tokens = docs.select(F.explode(F.split(F.col("text").cast("string"), r"\s+")).alias("token"))
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in gathered(batches, 50_000):
            split = [parts(t) for t in batch.column("token").to_pylist()]
            words = [xxhash.xxh64_intdigest(w) for own in split for w in own]
            n = np.repeat(batch.column("n").to_numpy(), [len(own) for own in split])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(words, np.uint64).view(np.int64)), pa.array(n)], names=["word", "n"])

    return counted.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def word_vectors(docs: DataFrame, min_share: float = MIN_SHARE, dimensions: int = DIMENSIONS) -> Words:
    """Word vectors, each of length one (own index vector and context in equal parts) and weighted down if
    the word is frequent."""
    counts = stored(word_counts(docs), "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = counts.where(F.col("n") >= max(1, min_share * total)).toArrow()  # 1 / min_share rows at most
    discard(counts)
    hashes = common.column("word").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, n = hashes[order], common.column("n").to_numpy()[order]
    names = [f"d{k}" for k in range(dimensions)]
    shared = docs.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sums, used = np.zeros((len(known), dimensions), np.int64), np.zeros(len(known), bool)
        for batch in slices(batches):
            found, words, bounds = word_ids(batch.column("text"))
            if not len(known) or not len(found):
                continue
            own = np.zeros((len(found), dimensions), np.int8)
            places, signs = index_vectors(found, dimensions)
            np.put_along_axis(own, places, signs.astype(np.int8), axis=1)
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            at[known[at] != found] = -1
            _add_context(words, bounds, own, at, sums)
            used[at[at >= 0]] = True
        rows = np.flatnonzero(used)
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(sums[rows, k]) for k in range(dimensions))], names=["row", *names])

    schema = "row long, " + ", ".join(f"{c} long" for c in names)
    summed = in_arrow(docs.select(F.col("text").cast("string")), run, schema).groupBy("row").agg(*[F.sum(c).alias(c) for c in names])
    got = summed.toArrow()  # a row per learned word
    own, context = Words(hashes[:0], np.zeros((0, dimensions))).of(hashes).astype(np.float64), np.zeros((len(hashes), dimensions))
    at = got.column("row").to_numpy()
    context[at] = np.stack([got.column(c).to_numpy() for c in names], axis=1) if len(at) else 0
    context -= np.outer(context.sum(axis=1), np.full(dimensions, 1 / dimensions))
    vectors = _unit(own) + _unit(context)
    return Words(hashes, (_unit(vectors) * (1e-3 / (1e-3 + n / max(total, 1)))[:, None]).astype(np.float32))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def pooled_width(dimensions: int) -> int:
    return 2 * dimensions + 3


def pooled(texts: pa.Array, known: Words) -> np.ndarray:
    """Mean and spread of each text's word vectors, length of the mean, share of words that are one of the
    words just before again, and log of the number of words."""
    hashes, words, bounds = word_ids(texts)
    vectors = known.of(hashes)
    n = np.diff(bounds)
    out = np.zeros((len(n), pooled_width(vectors.shape[1])), np.float32)
    again = np.zeros(len(words), bool)
    text = np.repeat(np.arange(len(n)), n)
    for d in range(1, WINDOW + 1):
        again[d:] |= (words[d:] == words[:-d]) & (text[d:] == text[:-d])
    repeated = np.bincount(text[again], minlength=len(n))
    for i in np.flatnonzero(n).tolist():
        total, squares = np.zeros(vectors.shape[1]), np.zeros(vectors.shape[1])
        for start in range(bounds[i], bounds[i + 1], PIECE_WORDS):
            part = vectors[words[start:min(start + PIECE_WORDS, bounds[i + 1])]]
            total += part.sum(axis=0)
            squares += np.einsum("ij,ij->j", part, part)
        mean = total / n[i]
        spread = np.sqrt(np.maximum(squares / n[i] - mean * mean, 0))
        out[i] = np.concatenate([mean, spread, [np.sqrt(mean @ mean), repeated[i] / n[i], np.log1p(n[i])]])
    return out


@dataclass
class Network:
    """Standardised inputs, one hidden layer of tanh units, one logit divided by a temperature."""

    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self.standard(x) @ self.w1 + self.b1) @ self.w2 + self.b2

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.center) / self.scale, -FARTHEST, FARTHEST)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, steps: int = 6000, batch: int = 128, rate: float = 3e-3, decay: float = 1e-3) -> Network:
    """Adam on logistic loss over four fifths of the rows; the temperature is fitted on the rest."""
    x = x.astype(np.float64)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(x))
    kept, left = order[len(x) // 5:], order[:len(x) // 5]
    # Constant network: the smoothed share of label 1.
    share = (y.sum() + 1) / (len(y) + 2)
    net = Network(x.mean(axis=0) if len(x) else np.zeros(x.shape[1]), np.maximum(x.std(axis=0), 1e-4) if len(x) else np.ones(x.shape[1]),
                  rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
                  np.zeros(hidden), float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return net
    xs = net.standard(x)
    net.w2 = rng.normal(0, 1 / np.sqrt(hidden), hidden)
    weights = [net.w1, net.b1, net.w2, np.array([net.b2])]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, epochs = 0, max(1, steps * batch // max(len(kept), 1))
    for epoch in range(epochs):
        pace = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for rows in np.array_split(rng.permutation(kept), max(1, len(kept) // batch)):
            h = np.tanh(xs[rows] @ weights[0] + weights[1])
            error = (_sigmoid(h @ weights[2] + weights[3]) - y[rows]) / len(rows)
            inner = np.outer(error, weights[2]) * (1 - h * h)
            slopes = [xs[rows].T @ inner + decay * weights[0], inner.sum(axis=0), h.T @ error + decay * weights[2], np.array([error.sum()])]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = weights[0], weights[1], weights[2], float(weights[3][0])
    if len(left):
        z, target = net.logits(x[left]), y[left]
        net.temperature = min((float(t) for t in np.geomspace(0.25, 8, 61)), key=lambda t: _loss(z / t, target))
    return net


@dataclass
class Classifier:
    words: Words
    network: Network

    def scores(self, texts: pa.Array) -> np.ndarray:
        return self.network.probability(pooled(texts, self.words))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Classifier:
    """Learns from labels outside the held-out fold, on at most `max_labelled` ids and rows."""
    words = word_vectors(docs)
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold(folds=FOLDS) != 0)).distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_labelled))
    spark = docs.sparkSession
    # Plain arrays: a broadcast of a class of this package would need the package on the executors.
    shared = spark.sparkContext.broadcast((words.hashes, words.vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = pooled(batch.column("text"), Words(*shared.value))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "label", "mark")), flat], names=["doc_id", "label", "mark", "x"])

    # The labelled ids are bounded, and so is what is broadcast. An id may have any number of rows: equal
    # ones are put together by their tasks, and the rest is limited as well.
    mark = F.xxhash64("text").alias("mark")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(known), "doc_id")
    inputs = in_arrow(rows.select("doc_id", "label", mark, "text"), run, "doc_id long, label int, mark long, x array<float>")
    once = inputs.groupBy("doc_id", "label", "mark").agg(F.any_value("x").alias("x"))
    got = once.orderBy(F.xxhash64("doc_id", "mark"), "doc_id", "label").limit(max_labelled).toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("mark", "ascending")])
    width = pooled_width(words.vectors.shape[1])
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, width) if got.num_rows else np.zeros((0, width), np.float32)
    return Classifier(words, train(x, got.column("label").to_numpy().astype(np.float64)))


def scored(docs: DataFrame, model: Classifier, column: str = "_score") -> DataFrame:
    """All columns of docs and the score as a last one."""
    shared = docs.sparkSession.sparkContext.broadcast((model.words.hashes, model.words.vectors, *vars(model.network).values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, vectors, *parts = shared.value
        here = Classifier(Words(hashes, vectors), Network(*parts))
        for batch in slices(batches):
            score = pa.array(here.scores(batch.column("text")).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=[*batch.schema.names, column])

    return in_arrow(docs, run, with_fields(docs, **{column: "double"}))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = scored(narrow, fit(docs, labels))
    return out.select(
        "doc_id", (fold(folds=FOLDS) == 0).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


@query("op2_quality_classifier")
def op2(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
