"""Operator 7: token counts by offset-mapped attribution.

A whole document is encoded once. Each token's character span comes from its bytes; the spans are
joined to the document's sections (intervals of characters) by one ordered lookup, and counts per
section add up to the document's tokens, unlike counts of sections encoded one by one.

Rule for a token that crosses a boundary: it counts for the section that holds most of its
characters, the earlier one on a tie (`n_tokens`). `token_share` divides it by characters instead. A
character made of several tokens counts as a character of each. Characters outside all sections
belong to section -1.

Sections are lines (a line keeps its line end), or a column `sections` of (start, end) arrays in
order and without overlaps, as `fields` makes them. Null or empty text: one section without tokens.
Null doc_id, repeated rows: rows like any other. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import in_arrow, query, slices, table
from pagelode.llm.tokens import Encoder

OUTPUT = "doc_id long, section int, start long, end long, n_tokens long, token_share double, n_crossing long"
SECTIONS = "array<struct<start: int, end: int>>"


def token_spans(text: str, ids: np.ndarray, id_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one after the last, of each token."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    ends = np.cumsum(id_bytes[ids])
    if len(raw) == len(text):
        return ends - id_bytes[ids], ends
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    return character[ends - id_bytes[ids]], character[ends - 1] + 1


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the \\n-ended lines; a text without any has one."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return np.array([0, *ends[:-1]]), np.array(ends)


def attributed(first: np.ndarray, after: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, token shares and crossing tokens of each section, and at the end those outside all."""
    n = len(starts)
    tokens, shares, crossing = np.zeros(n + 1, np.int64), np.zeros(n + 1), np.zeros(n + 1, np.int64)
    low = np.searchsorted(ends, first, "right")  # the first section that ends after the token's start
    inside = low < n
    inside[inside] = (starts[low[inside]] <= first[inside]) & (after[inside] <= ends[low[inside]])
    whole = np.bincount(low[inside], minlength=n + 1)
    tokens += whole
    shares += whole
    for f, a, s in zip(first[~inside].tolist(), after[~inside].tolist(), low[~inside].tolist()):
        parts = []
        while s < n and starts[s] < a:
            part = min(a, int(ends[s])) - max(f, int(starts[s]))
            if part > 0:
                parts.append((s, part))
            s += 1
        if (outside := a - f - sum(p for _, p in parts)) > 0:
            parts.append((n, outside))
        most = max(p for _, p in parts)
        tokens[next(s for s, p in parts if p == most)] += 1
        for s, p in parts:
            shares[s] += p / (a - f)
            crossing[s] += len(parts) > 1
    return tokens, shares, crossing


def token_counts(docs: DataFrame, sections: str | None = None) -> DataFrame:
    """A row per document and section, in the order of the text."""
    spans = [F.col(sections).cast(SECTIONS).alias("sections")] if sections else []
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in slices(batches):
            ids, kept = batch.column("doc_id").to_pylist(), [[] for _ in range(7)]
            given = batch.column("sections").to_pylist() if sections else None
            for row, text in enumerate(batch.column("text")):
                text = text.as_py() or ""
                if given is None:
                    starts, ends = line_spans(text)
                else:
                    pairs = [(p["start"], p["end"]) for p in given[row] or [] if p and p["start"] is not None and p["end"] is not None]
                    starts, ends = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
                spans_of = token_spans(text, encoder.encode(text), encoder.id_bytes) if text else (np.empty(0, np.int64),) * 2
                tokens, shares, crossing = attributed(*spans_of, starts, ends)
                n = len(starts)
                order = np.arange(n + 1 if given is not None and (tokens[n] or shares[n] > 0) else n)
                for column, values in zip(kept, (
                        [ids[row]] * len(order), np.where(order < n, order, -1), np.append(starts, 0)[order], np.append(ends, len(text))[order],
                        tokens[order], shares[order], crossing[order])):
                    column.extend(values)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            names = [c.split()[0] for c in OUTPUT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(kept, kinds)], names=names)

    return in_arrow(narrow, run, OUTPUT)


def fields(rows: DataFrame, columns: list[str], between: str = "\n") -> DataFrame:
    """doc_id, a text of the columns one after another (null: empty), and the span of each as `sections`."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    spans, at = [], F.lit(0)
    for value in values:
        spans.append(F.struct(at.cast("int").alias("start"), (at + F.length(value)).cast("int").alias("end")))
        at = at + F.length(value) + len(between)
    return rows.select("doc_id", F.concat_ws(between, *values).alias("text"), F.array(*spans).alias("sections"))


@query("op7_token_attribution")
def op7(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))
