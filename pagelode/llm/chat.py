"""Operator 1: chat formatting by prefix-target expansion.

Every assistant turn is an example of its own: all turns before it are context and only its reply
is trainable. The examples of a conversation are prefixes of one formatted text, so that text is
stored once, a block per turn, and an example is its number, where its text ends, and the span
of its reply: the output is linear in the input, also for a conversation that holds a third of
all rows. `materialised` writes examples out in full where a reader wants them so.

Template: `<s>` and `</s>` around a turn; system texts between `<<SYS>>` and `<</SYS>>`, user
texts between `[INST]` and `[/INST]`, assistant texts bare, other roles as `[ROLE]role[/ROLE]` before
the text. Where a text has one of these strings, the backslashes right before it are doubled and one
more is put in; backslashes at the end of a text are doubled. So a marker counts as one if an even
number of backslashes precedes it, and reading back gives the texts that went in.

A conversation of more than `HOT_TURNS` rows is cut into pieces by turn, so that no task sorts it as a whole;
rows with one and the same turn stay together. A hash over all its turns is one stream: the task that
makes it holds a turn at a time.

Turns are ordered by turn, then role and text (ties, repeated rows), nulls first. Null text or role:
empty. Texts of any length are formatted whole; `materialised` puts the blocks of an example into one row, which
Spark bounds at 2 GB. Null conv_id: one conversation. Turns after the last reply are context of no example.
Empty table: no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.llm.common import in_arrow, query, table
from pagelode.operators.spread import SMALL_ROWS

MARKER = r"</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\]"
_RUN = re.compile(rf"(\\*)({MARKER})")
ASSISTANT = "assistant"
HOT_TURNS = 2_000_000
WRAPPED = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), ASSISTANT: ("", "")}
_ROLE_OF = {opening: role for role, (opening, _) in WRAPPED.items() if opening}


def escaped(text: Column) -> Column:
    inside = F.regexp_replace(text, rf"(\\*)({MARKER})", r"$1$1\\$2")
    return F.regexp_replace(inside, r"(\\+)\z", "$1$1")


def unescaped(text: str) -> str:
    """What `escaped` was made from."""
    end = len(text) - len(text.rstrip("\\"))
    body = text[:len(text) - end] + "\\" * (end // 2)
    return _RUN.sub(lambda m: "\\" * (len(m[1]) // 2) + m[2], body)


def _pieces(rows: DataFrame, hot_turns: int) -> tuple[DataFrame, bool]:
    """Rows with `_piece`, which rises with the turn and is 0 throughout but in hot conversations, and
    whether there are any."""
    counts = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_turns)
    # The SMALL_ROWS longest ones at most, an array of a few numbers each.
    hot = counts.orderBy(F.desc("_n"), "conv_id").limit(SMALL_ROWS).collect()
    if not hot:
        return rows.withColumn("_piece", F.lit(0)), False
    cuts = max(r["_n"] for r in hot) // hot_turns + 1
    is_hot = F.coalesce(F.col("conv_id").isin([r.conv_id for r in hot if r.conv_id is not None]), F.lit(any(r.conv_id is None for r in hot)))
    bounds = rows.where(is_hot).groupBy(F.col("conv_id").alias("_hot")).agg(
        F.percentile_approx("turn", [i / (cuts + 1) for i in range(1, cuts + 1)]).alias("_bounds"))
    joined = rows.join(F.broadcast(bounds), F.col("conv_id").eqNullSafe(F.col("_hot")) & is_hot, "left")
    piece = F.when(F.col("_bounds").isNull() | F.col("turn").isNull(), 0).otherwise(F.size(F.filter("_bounds", lambda b: b < F.col("turn"))))
    return joined.withColumn("_piece", piece).drop("_hot", "_bounds"), True


def blocks(turns: DataFrame, hot_turns: int = HOT_TURNS) -> DataFrame:
    """A row per turn: conv_id, ordinal, role, block (its formatted text), start and end in the
    conversation's text, example (number of the first example that has it, from 0), and for assistant
    turns target_start and target_end of the trainable reply."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    body = escaped(F.coalesce(F.col("text").cast("string"), F.lit("")))
    opening = F.concat(F.lit("[ROLE]"), escaped(role), F.lit("[/ROLE]"))
    closing = F.lit("")
    for name, (before, after) in WRAPPED.items():
        opening = F.when(role == name, F.lit(before)).otherwise(opening)
        closing = F.when(role == name, F.lit(after)).otherwise(closing)
    narrow = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    cut, any_hot = _pieces(narrow, hot_turns)
    rows = cut.select(
        "conv_id", "turn", "_piece", role.alias("role"), F.col("text").cast("string"),
        F.concat(F.lit("<s>"), opening, body, closing, F.lit("</s>")).alias("block"),
        (F.length(opening) + 3).alias("_before"), F.length(body).alias("_chars"))
    keys = ["conv_id", "_piece"] if any_hot else ["conv_id"]
    order = W.partitionBy(*keys).orderBy("turn", "role", "text")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    is_target = F.col("role") == ASSISTANT
    placed = (
        rows.withColumn("ordinal", (F.row_number().over(order) - 1).cast("long"))
        .withColumn("end", F.sum(F.length("block").cast("long")).over(so_far))
        .withColumn("example", F.sum(is_target.cast("long")).over(so_far) - is_target.cast("long"))
    )
    if any_hot:  # what earlier pieces of a conversation hold: a row per piece
        held = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_turns"), F.sum(F.length("block").cast("long")).alias("_length"), F.sum(is_target.cast("long")).alias("_targets"))
        earlier = W.partitionBy("conv_id").orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
        sums = {"ordinal": "_turns", "end": "_length", "example": "_targets"}
        carried = held.select(F.col("conv_id").alias("_conv"), F.col("_piece").alias("_at"), *[
            F.sum(c).over(earlier).alias(f"_add_{name}") for name, c in sums.items()]).where("_at > 0")
        same = placed["conv_id"].eqNullSafe(carried["_conv"]) & (placed["_piece"] == carried["_at"])
        placed = placed.join(carried, same, "left").withColumns(
            {name: F.col(name) + F.coalesce(f"_add_{name}", F.lit(0)) for name in sums})
    target_start = F.col("start") + F.col("_before")
    out = placed.withColumn("start", F.col("end") - F.length("block")).select(
        "conv_id", "ordinal", "role", "block", "start", "end", "example",
        F.when(is_target, target_start).alias("target_start"),
        F.when(is_target, target_start + F.col("_chars")).alias("target_end"))
    # The window leaves whole conversations in order, unless it works on pieces of them.
    out.by_conversation = not any_hot
    return out


def with_examples(formatted: DataFrame) -> DataFrame:
    """Blocks with `target`, the example that a turn ends (none but for assistant turns): its number, and places
    in the conversation's text: all before context_end is context, loss is on [target_start, target_end) alone,
    and its text ends at text_end."""
    example = F.struct("example", F.col("start").alias("context_end"), "target_start", "target_end", F.col("end").alias("text_end"))
    out = formatted.withColumn("target", F.when(F.col("target_start").isNotNull(), example))
    out.by_conversation = getattr(formatted, "by_conversation", False)
    return out


def examples(formatted: DataFrame) -> DataFrame:
    """A row per assistant turn: conv_id, the fields of `target`, and block, what the example's text has from
    context_end on."""
    return with_examples(formatted).where(F.col("target").isNotNull()).select("conv_id", "target.*", "block")


def materialised(formatted: DataFrame, wanted: DataFrame) -> DataFrame:
    """Full texts of the examples in `wanted` (rows of `examples`): adds text. The work is the size
    of the texts asked for."""
    wanted = wanted.drop("block")
    parts = formatted.select("conv_id", "ordinal", "block", F.col("example").alias("_from"))
    same = wanted["conv_id"].eqNullSafe(parts["conv_id"]) & (parts["_from"] <= wanted["example"])
    kept = [wanted[c] for c in wanted.columns]
    # Turns between two replies count for the later one, so `_from` is at most the example's number.
    return (
        wanted.join(parts, same).select(*kept, "ordinal", "block")
        .groupBy(*wanted.columns).agg(F.array_sort(F.collect_list(F.struct("ordinal", "block"))).alias("_parts"))
        .select(*wanted.columns, F.array_join(F.transform("_parts", lambda p: p["block"]), "").alias("text"))
    )


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    turns: list[tuple[str, str]] = []
    role, text, at = ASSISTANT, None, 0
    for m in _RUN.finditer(formatted):
        if len(m[1]) % 2:
            continue  # escaped: text
        literal, marker, at = formatted[at:m.start(2)], m[2], m.end()
        if marker == "<s>":
            role, text = ASSISTANT, None
        elif marker in _ROLE_OF:
            role = _ROLE_OF[marker]
        elif marker == "[/ROLE]":
            role = unescaped(literal)
        elif marker == "</s>":
            turns.append((role, unescaped(literal) if text is None else text))
        elif marker != "[ROLE]":  # the end of a wrapped text
            text = unescaped(literal)
    return turns


class _Reading:
    """What is read back of one conversation so far: one turn and two running hashes are held."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.n_turns = self.chars = self.n_loss = self.n_examples = self.expanded = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, block: str, target: dict | None) -> None:
        self.chars += len(block)
        for role, text in read_back(block):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        if target is not None:  # an example ends here: the tokens of its reply are learned
            start = target["context_end"]
            reply = unescaped(block[target["target_start"] - start:target["target_end"] - start])
            self.loss.update(reply.encode())
            self.n_loss += len(reply)
            self.n_examples += 1
            self.expanded += target["text_end"]

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.n_loss, self.loss.hexdigest(), self.chars,
                self.n_examples, self.expanded)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, what reading back its text (turns) and its examples (loss) gives, as counts and hashes.

    Streams over the turns, however long a conversation is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading, out = None, []

        def made() -> pa.RecordBatch:
            kinds = {"long": pa.int64(), "string": pa.string()}
            fields = [f.split() for f in DIGEST.split(", ")]
            columns = list(zip(*out)) if out else [[] for _ in fields]
            return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])

        for batch in batches:
            for conv_id, block, target in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "target"))):
                if reading is None or reading.conv_id != conv_id:
                    if reading is not None:
                        out.append(reading.row())
                    reading = _Reading(conv_id)
                reading.add(block, target)
            yield made()
            out = []
        if reading is not None:
            out.append(reading.row())
            yield made()

    rows = with_examples(formatted)
    if not rows.by_conversation:
        rows = rows.select("conv_id", "ordinal", "block", "target").repartition("conv_id").sortWithinPartitions("conv_id", "ordinal")
    return in_arrow(rows.select("conv_id", "block", "target"), run, DIGEST)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "n_examples long, expanded_chars long")

# A conversation whose texts are made of another template's control strings.
MARKED = """
SELECT CAST(-7 AS BIGINT) AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
FROM VALUES (CAST(0 AS BIGINT), 'user'), (CAST(1 AS BIGINT), 'assistant') AS t(turn, role)
"""


@query("op1_chat_prefix_targets")
def op1(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(blocks(turns.unionByName(spark.sql(MARKED))))
