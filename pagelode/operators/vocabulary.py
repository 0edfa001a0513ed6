"""Vocabulary terms within a few edits of query terms, found by walking prefixes with an automaton.

The vocabulary is stored in the order of its terms, with the first `PREFIX` letters of each beside it.
Its distinct prefixes are a trie written as a sorted list. A Levenshtein automaton of a query term walks
that list: a prefix is kept if some text that begins with it is within the allowed edits, and where a letter
leaves no way on, all prefixes behind it are passed over at once. Only the parts of the vocabulary
whose prefixes are kept are read, as ranges that the scan can push down, and a term is compared only with the
query terms that reach its prefix.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions import edits

PREFIX = 4
# Ranges of prefixes that are written into a plan; nearer ones are put together beyond it.
RANGES = 200
# Prefixes that are brought to the driver, of a few letters each. Beyond it they stay a table.
LISTED = 50_000


def prefix_of(term: Column) -> Column:
    return F.substring(term, 1, PREFIX)


def allowed(term: str) -> int:
    """The same rule as `edits.allowed_edits`."""
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


class Automaton:
    """Texts within `most` edits of a term: insert, delete, replace, or swap of two neighbours.

    A state is the last two rows of distances between what was read and each beginning of the term, as
    far as they are within reach, and the last letter."""

    def __init__(self, term: str, most: int):
        self.term, self.most = term, most
        self.start = (None, [i if i <= most else most + 1 for i in range(len(term) + 1)], "")

    def step(self, state: tuple, letter: str) -> tuple | None:
        """The state behind a letter, None if no text goes on from there."""
        older, last, before = state
        worst = self.most + 1
        row = [min(last[0] + 1, worst)]
        for j, own in enumerate(self.term, 1):
            best = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (own != letter))
            if older is not None and j > 1 and own == before and self.term[j - 2] == letter:
                best = min(best, older[j - 2] + 1)
            row.append(min(best, worst))
        # A swap may still go on from a row that is out of reach: its first letter reads as a change.
        return (last, row, letter) if min(row) < worst else None


def reached(prefixes: list[str], term: str, most: int) -> list[str]:
    """Those of the sorted distinct prefixes that a text within reach of the term can begin with."""
    automaton = Automaton(term, most)
    states, read, out, at = [automaton.start], "", [], 0
    while at < len(prefixes):
        prefix = prefixes[at]
        shared = 0
        while shared < min(len(read), len(prefix)) and read[shared] == prefix[shared]:
            shared += 1
        del states[shared + 1:]
        for i in range(shared, len(prefix)):
            state = automaton.step(states[-1], prefix[i])
            if state is None:
                # Everything that begins so is out of reach: go on behind it.
                read, dead = prefix[:i], prefix[:i + 1]
                at = bisect_left(prefixes, True, at, key=lambda p: p[:len(dead)] > dead)
                break
            states.append(state)
        else:
            read = prefix
            # A prefix shorter than PREFIX is a whole term.
            if len(prefix) == PREFIX or states[-1][1][-1] <= most:
                out.append(prefix)
            at += 1
    return out


def reachable(prefixes: DataFrame, terms: list[str]) -> DataFrame:
    """`qterm, prefix` for a few query terms; `prefixes` has distinct values of `prefix`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            listed = sorted(batch["prefix"])
            found = [(t, p) for t in terms for p in reached(listed, t, allowed(t))]
            yield pd.DataFrame(found, columns=["qterm", "prefix"])

    return prefixes.select("prefix").mapInPandas(run, "qterm string, prefix string")


def ranges(wanted: list[str], most: int = RANGES) -> list[tuple[str, str]]:
    """At most `most` ranges of texts that cover the sorted distinct prefixes: neighbours whose letters
    are nearest are put together first."""
    if not wanted:
        return []

    def place(prefix: str) -> int:
        return sum(min(ord(c), 0xFFFF) << 16 * (PREFIX - 1 - i) for i, c in enumerate(prefix))

    gaps = sorted(range(1, len(wanted)), key=lambda i: place(wanted[i - 1]) - place(wanted[i]))[:most - 1]
    cuts = [0, *sorted(gaps), len(wanted)]
    return [(wanted[a], wanted[b - 1]) for a, b in zip(cuts, cuts[1:])]


def near_terms(terms: list[str], vocab: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Vocabulary terms within the allowed edits of a few distinct query terms: `field, qterm, term, df,
    edits`. `vocab` has prefix beside term; a term may have several rows, whose df adds up; terms whose
    df is not above 0 are left out."""
    spark = vocab.sparkSession
    pairs = reachable(prefixes, terms)
    listed = pairs.limit(LISTED + 1).toArrow()
    rows = vocab
    if listed.num_rows <= LISTED:
        spans = ranges(sorted(set(listed.column("prefix").to_pylist())))
        kept = F.lit(False)
        for low, high in spans:
            kept = kept | ((F.col("prefix") >= low) & (F.col("prefix") <= high))
        rows = vocab.where(kept)
        pairs = F.broadcast(spark.createDataFrame(listed, "qterm string, prefix string"))
    most = edits.allowed_edits(F.col("qterm"))
    met = rows.join(pairs, "prefix").where(F.levenshtein("term", "qterm", 4).between(0, 2 * most))
    return met.groupBy("field", "qterm", "term").agg(F.sum("df").alias("df")).where("df > 0") \
        .withColumn("edits", edits.edits(F.col("qterm"), F.col("term"))).where(F.col("edits") <= most)
