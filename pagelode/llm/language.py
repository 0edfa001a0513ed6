"""Operator 9: language identification by a linear-chain conditional random field.

Every word of a text gets a label by forward-backward over its sentence. A word's score for a label
is the sum of the weights of its features: byte n-grams of one to four, those with the word's
boundary (its affixes), and the whole word (the lexicon); features are hashed into a table of fixed
size. Scores for one label after another are learned too, so a chain can switch languages inside a
sentence and is not torn by a single odd word. A document's language is the one with the largest
expected number of letters over all its words, and its score that share.

A sentence ends at a word with `.`, `!` or `?` behind it; a longer one goes on as a new chain after
`CHAIN_WORDS` words. A word of more than `LONG_WORD` characters, as in languages written without spaces, is
a row of words of `LONG_WORD` characters. Weights are learned from a bounded sample of sentences of whole documents: up
to about `DOCS_PER_LANGUAGE` documents per language, by a hash of the id, `SENTENCES_PER_DOC` sentences
each, by a hash as well, sentences of one word only where a document has too few others; and of the
`MAX_LABELS` commonest values of lang. Some sentences are joined across languages, so that switches are seen.
Only text and lang are used, lang never for a prediction.

Null text or no letter (category L, as number signs are none): `und`, score 0. Null lang: predicted, never learned from. Nothing to learn
from: `und` for all. Texts of any length are labelled whole. Null doc_id: a row like any other. Repeated
rows: each is predicted, and learned from once. Equal shares (ties): the first label in order. Empty table: no rows.
Other columns are kept by `identified`.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.llm.common import fold, in_arrow, query, slices, table, with_fields

FEATURES = 1 << 17
MAX_NGRAM = 4
CHAIN_WORDS = 64
LONG_WORD = 24
DOCS_PER_LANGUAGE = 1000
# Labels that are learned; training holds some 5 MB for each.
MAX_LABELS = 100
SENTENCES_PER_DOC = 6
FOLDS = 4
HELD_OUT = 2
SEED = 5
SLICE = 2_000_000
UNKNOWN = "und"
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def word_and_end(token: str) -> tuple[str, bool]:
    """The token's word in lower case (empty if it has no letter), and whether a sentence ends."""
    end = token[-1] in ".!?" or token[-2:-1] in (".", "!", "?")
    if token.isalpha():
        return token.lower(), False
    if not any(map(str.isalpha, token)):
        return "", end
    return _EDGES.sub("", token).lower(), end


def words_of(word: str) -> list[str]:
    """The word itself, or its pieces if it is long; none if it is empty."""
    if len(word) <= LONG_WORD:
        return [word] if word else []
    return [word[i:i + LONG_WORD] for i in range(0, len(word), LONG_WORD)]


def feature_table(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of each word: flat feature numbers, and the number of the word that has each."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    raw = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    features = [np.array([digest(w) % FEATURES for w in words], np.int64)]
    owners = [np.arange(len(words))]
    for n in range(1, MAX_NGRAM + 1):
        if len(raw) < n:
            break
        mark = np.full(len(raw) - n + 1, n, np.uint64)
        for k in range(n):
            mark = (mark ^ raw[k:len(raw) - n + 1 + k]) * np.uint64(0x100000001B3)
            mark ^= mark >> np.uint64(23)
        inside = word[:len(raw) - n + 1] == word[n - 1:]
        if n == 1:
            inside &= raw > 3  # a boundary alone says nothing
        features.append((mark[inside] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(47)).astype(np.int64))
        owners.append(word[:len(raw) - n + 1][inside])
    return np.concatenate(features), np.concatenate(owners)


def word_scores(features: np.ndarray, owners: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each word's features, times a fixed strength, per label."""
    count = np.maximum(np.bincount(owners, minlength=n), 1)
    return np.stack([np.bincount(owners, w[features], n) for w in weights], axis=1) * (STRENGTH / count)[:, None]


STRENGTH = 4.0


def forward_backward(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray, then: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Probabilities of each label for each word, expected label pairs, and the log of all chains' sums.

    Chains lie at starts in `scores`, one word after another. Longest chains come first, so that a step
    over one place of all chains works on the head of an array.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    top = scores.max(axis=1, keepdims=True) if len(scores) else scores
    likely = np.exp(scores - top)
    move = np.exp(then)
    forward, backward = np.empty_like(likely), np.ones_like(likely)
    size = np.ones(len(scores))
    longest = int(lengths[0]) if len(lengths) else 0
    active = [int(np.searchsorted(-lengths, -t, "left")) for t in range(longest + 1)]  # chains longer than t
    for t in range(longest):
        at = starts[:active[t]] + t
        now = likely[at] * (np.exp(first) if t == 0 else forward[at - 1] @ move)
        size[at] = now.sum(axis=1)
        forward[at] = now / size[at][:, None]
    for t in range(longest - 2, -1, -1):
        at = starts[:active[t + 1]] + t
        back = (backward[at + 1] * likely[at + 1]) @ move.T
        backward[at] = back / size[at + 1][:, None]
    label = forward * backward
    pairs = np.zeros_like(move)
    for t in range(1, longest):
        at = starts[:active[t]] + t
        pairs += forward[at - 1].T @ (likely[at] * backward[at] / size[at][:, None]) * move
    return label, pairs, float(np.log(size).sum() + top.sum())


@dataclass
class Field:
    """Labels, feature weights (label, feature), scores of a chain's first label and of label after label."""

    labels: list[str]
    weights: np.ndarray
    first: np.ndarray
    then: np.ndarray


def train(chains: list[list[str]], tags: list[list[int]], labels: list[str], rounds: int = 60, decay: float = 1e-5, rate: float = 0.15) -> Field:
    """Maximum likelihood by Adam on the whole sample."""
    n_labels = len(labels)
    vocabulary: dict[str, int] = {}
    words = np.array([vocabulary.setdefault(w, len(vocabulary)) for c in chains for w in c], np.int64)
    target = np.array([t for c in tags for t in c], np.int64)
    lengths = np.array([len(c) for c in chains], np.int64)
    starts = np.cumsum(lengths) - lengths
    features, owners = feature_table([w.encode() for w in vocabulary])
    count = np.maximum(np.bincount(owners, minlength=len(vocabulary)), 1)
    params = [np.zeros((n_labels, FEATURES)), np.zeros(n_labels), np.zeros((n_labels, n_labels))]
    seen_first = np.bincount(target[starts], minlength=n_labels)
    follows = np.ones(len(words), bool)
    follows[starts] = False
    here = np.flatnonzero(follows)
    seen_pairs = np.bincount(target[here - 1] * n_labels + target[here], minlength=n_labels ** 2).reshape(n_labels, n_labels)
    once = np.eye(n_labels)[target]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        scores = word_scores(features, owners, len(vocabulary), params[0])[words]
        label, pairs, _ = forward_backward(scores, starts, lengths, params[1], params[2])
        missing = once - label
        by_word = np.stack([np.bincount(words, m, len(vocabulary)) for m in missing.T]) * (STRENGTH / count)
        slopes = [np.stack([np.bincount(features, m[owners], FEATURES) for m in by_word]),
                  seen_first - label[starts].sum(axis=0), seen_pairs - pairs]
        for k, (p, g, m, s) in enumerate(zip(params, slopes, means, squares)):
            g = g / len(words) - decay * p
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return Field(labels, params[0].astype(np.float32), params[1], params[2])


def chains_of(texts: pa.Array, chain_words: int = CHAIN_WORDS) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of the texts, and for all words in order: which distinct word, which text, and the
    starts and lengths of chains."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    token = coded.indices.to_numpy().astype(np.int64)
    made = [word_and_end(t) if t else ("", False) for t in coded.dictionary.to_pylist()] or [("", False)]
    vocabulary: dict[str, int] = {}
    pieces = [[vocabulary.setdefault(w, len(vocabulary)) for w in words_of(word)] for word, _ in made]
    sizes = np.array([len(p) for p in pieces], np.int64)
    flat = np.array([w for p in pieces for w in p], np.int64)
    ends = np.array([e for _, e in made], bool)
    n = sizes[token]
    text = np.repeat(np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy())), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    word = flat[np.repeat((np.cumsum(sizes) - sizes)[token], n) + inside]
    end = ends[token]
    # A token without a letter is no word, but may end a sentence.
    sentence = np.repeat(np.cumsum(end) - end, n)
    if not len(word):
        return [], word, text, np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.r_[True, (sentence[1:] != sentence[:-1]) | (text[1:] != text[:-1])])
    lengths = np.diff(np.r_[starts, len(word)])
    pieces = -(-lengths // chain_words)
    piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(starts, pieces) + piece * chain_words
    lengths = np.minimum(np.repeat(lengths, pieces) - piece * chain_words, chain_words)
    return list(vocabulary), word, text, starts, lengths


def label_shares(texts: pa.Array, model: Field) -> np.ndarray:
    """Expected share of each label among the letters' bytes of each text; zeros without a letter."""
    words, word, text, starts, lengths = chains_of(texts)
    out = np.zeros((len(texts), len(model.labels)))
    if not len(word) or not model.labels:
        return out
    raw = [w.encode() for w in words]
    scores = word_scores(*feature_table(raw), len(raw), model.weights)[word]
    label, _, _ = forward_backward(scores, starts, lengths, model.first, model.then)
    weight = np.array([len(w) for w in raw], float)[word]
    for k in range(len(model.labels)):
        out[:, k] = np.bincount(text, label[:, k] * weight, len(texts))
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-300)


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, sentences: int = SENTENCES_PER_DOC) -> Field:
    """Learns from text and lang of documents outside the held-out fold."""
    known = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(folds=FOLDS) != HELD_OUT))
    # The commonest labels: a bounded number of rows.
    common = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LABELS)
    counts = {r.lang: r.n for r in common.collect()}
    if not counts:
        return Field([], np.zeros((0, FEATURES), np.float32), np.zeros(0), np.zeros((0, 0)))
    part = F.lit(0.0)
    for lang, n in counts.items():
        part = F.when(F.col("lang") == lang, min(1.0, docs_per_language / n)).otherwise(part)
    chosen = known.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) < part * 1_000_003)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, chars=SLICE):
            words, word, text, starts, lengths = chains_of(batch.column("text"), 32)
            ids, langs, out = batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), []
            bounds = np.searchsorted(text[starts], np.arange(batch.num_rows + 1)) if len(starts) else np.zeros(batch.num_rows + 1, int)
            for row, body in enumerate(batch.column("text").to_pylist()):
                # The same choice for the same text, wherever it lies; one-word chains last.
                order = bounds[row] + np.random.default_rng([SEED, zlib.crc32(body.encode())]).permutation(bounds[row + 1] - bounds[row])
                for c in order[np.argsort(lengths[order] == 1, kind="stable")][:sentences].tolist():
                    out.append((ids[row], langs[row], [words[w] for w in word[starts[c]:starts[c] + lengths[c]]]))
            columns = list(zip(*out)) or [[], [], []]
            kinds = [pa.int64(), pa.string(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "lang", "words"])

    found = in_arrow(chosen, run, "doc_id long, lang string, words array<string>").distinct()
    by_lot = W.partitionBy("lang").orderBy(F.xxhash64("doc_id", "words"), "doc_id", "words")
    # Bounded by labels, documents per language and sentences of at most 32 words.
    kept = found.withColumn("_place", F.row_number().over(by_lot)).where(F.col("_place") <= docs_per_language * sentences)
    got = kept.select("lang", "words").toArrow().to_pylist()
    labels = sorted(counts)
    rows = sorted(((labels.index(r["lang"]), r["words"]) for r in got), key=lambda r: (r[0], r[1]))
    rng = np.random.default_rng(SEED)
    chains = [words for _, words in rows]
    tags = [[label] * len(words) for label, words in rows]
    for a, b in rng.integers(0, max(len(rows), 1), (len(rows) // 3, 2)).tolist():  # switches
        i, j = (int(rng.integers(1, n)) if n > 1 else n * (not k) for k, n in enumerate((len(chains[a]), len(chains[b]))))
        chains.append(rows[a][1][:i] + rows[b][1][j:])
        tags.append([rows[a][0]] * i + [rows[b][0]] * (len(rows[b][1]) - j))
    return train(chains, tags, labels) if chains else Field(labels, np.zeros((len(labels), FEATURES), np.float32), np.zeros(len(labels)), np.zeros((len(labels),) * 2))


def identified(docs: DataFrame, model: Field, columns: tuple[str, str] = ("_lang", "_share")) -> DataFrame:
    """All columns of docs and two last ones: the language and its share of the letters."""
    # Plain arrays: a broadcast of a class of this package would need the package on the executors.
    shared = docs.sparkSession.sparkContext.broadcast((model.labels, model.weights, model.first, model.then))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Field(*shared.value)
        labels = np.array([*here.labels, UNKNOWN], object)
        for batch in slices(batches, chars=SLICE):
            share = label_shares(batch.column("text"), here)
            most = share.max(axis=1, initial=0.0)
            best = np.where(most > 0, share.argmax(axis=1) if share.shape[1] else 0, len(labels) - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels[best], pa.string()), pa.array(np.clip(most, 0, 1))],
                names=[*batch.schema.names, *columns])

    return in_arrow(docs, run, with_fields(docs, **dict(zip(columns, ("string", "double")))))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of docs."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return identified(narrow, fit(docs)).select(
        "doc_id", (fold(folds=FOLDS) == HELD_OUT).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_share").alias("score"))


@query("op9_language_crf")
def op9(spark, sf_dir):
    return languages(table(spark, sf_dir, "documents"))
