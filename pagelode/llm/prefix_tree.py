"""Operator 13: prefix trie of conversations, measured by the Euler-tour technique.

`rebuilt` puts conversations together from a shared beginning and their own turns. `prefixes` names
every prefix of every conversation by a running sum of hashes of (depth, role, text), in four lanes of 32 bits;
equal names are one node of the trie (128 bits: no two different prefixes are expected to share a name).
A conversation may hold any share of the rows: its sums run in blocks of depths, and blocks are put together
from one row each.

`euler_tour` has two arcs per node, entering and leaving it. Nodes are numbered in the order of
(depth, parent, name), so siblings have neighbouring numbers, and an arc knows the arcs before and
behind it without a sort of siblings. `list_ranks` ranks that list: in every round the arcs whose random
mark is above both neighbours' leave the list at once, and their neighbours are joined up, a third of
it, until one task's share is left; then they come back in the reverse order, each behind the arc that was before it. Sums over a
subtree are differences of prefix sums between a node's arcs, in blocks of positions.

Turns are ordered by turn, nulls first; ties by the first characters of role and text (`TIE_CHARS`), then by
a digest of both, so that order never ships whole texts. Null role or text: empty. Texts are digested
whole, and only digests and lengths travel. Repeated rows are turns of their own. Rows without a conv_id
belong to no conversation and are left out. Negative conv_ids: the remainder has the sign of the
conv_id. Empty table: no rows, not even a root. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.llm.common import discard, query, stored, table
from pagelode.operators.spread import HOT_ROWS, bucket_offsets, hot_pieces, lookup_join

# Conversations c to c + FAMILY - 1, c a multiple of it, may share their first LONGEST_START turns.
FAMILY = 100
LONGEST_START = 5
TIE_CHARS = 100
# Rows of one task where a window needs them in order.
BLOCK = 20_000
# Arcs that one task ranks by walking.
WALKED = 50_000
# conv_ids of one text that is hashed at once.
CHUNK_IDS = 1000
_LANE = 0xFFFFFFFF
LANES = ("_a", "_b", "_c", "_d")


def in_order(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Stored rows with `place`, dense from 0 in the order of the keys, by a distributed sort."""
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stored(placed.withColumn("_part", F.spark_partition_id()).withColumn("_inside", inside), label)
    # One row per partition of the sort.
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    out = placed.join(offsets, "_part").withColumn("place", F.col("_before") + F.col("_inside"))
    return out.select(*rows.columns, "place")


def turn_digests(turns: DataFrame) -> DataFrame:
    """Turns of all conversations in order: conv_id, place, digest of role and text, chars of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.substring(role, 1, TIE_CHARS).alias("_role"), F.substring(text, 1, TIE_CHARS).alias("_text"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
        # Equal rows need no task in common.
        F.xxhash64(F.monotonically_increasing_id()).alias("_salt"))
    ordered = in_order(rows, ["conv_id", "turn", "_role", "_text", "digest", "_salt"], "turns")
    return ordered.select("conv_id", "place", "digest", "chars")


def rebuilt(turns: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) put together anew: the first h turns of conversation c - c % FAMILY, then
    the own turns after the first h, h being crc32 of c as text modulo LONGEST_START + 1.

    Conversations: conv_id, total (turns). Turns: conv_id, depth (from 1), total, digest, chars.
    """
    ordered = turn_digests(turns)
    heads = stored(ordered.groupBy("conv_id").agg(F.min("place").alias("_start"), F.count(F.lit(1)).alias("_n")), "heads")
    first = (
        heads.where(F.col("conv_id") % FAMILY == 0)
        .select(F.explode(F.sequence(F.col("_start"), F.col("_start") + F.least("_n", F.lit(LONGEST_START)) - 1)).alias("place"))
        .join(ordered, "place")
        .groupBy(F.col("conv_id").alias("_family"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("_first"))  # LONGEST_START at most
    )
    own_from = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LONGEST_START + 1)
    shared = F.least("_h", F.coalesce(F.size("_first"), F.lit(0))).cast("long")
    conversations = stored(
        heads.withColumn("_h", own_from).withColumn("_family", F.col("conv_id") - F.col("conv_id") % FAMILY)
        .join(first, "_family", "left")
        .withColumn("_shared", F.when(F.col("_first").isNull(), 0).otherwise(shared).cast("long"))
        .withColumn("total", F.col("_shared") + F.greatest(F.col("_n") - F.col("_h"), F.lit(0)))
        .select("conv_id", "_start", "_n", "_h", "_shared", "total", F.expr("slice(_first, 1, cast(_shared as int))").alias("_first")),
        "conversations")
    hot = hot_pieces(heads, "conv_id", "_n", hot_rows)
    own = (
        lookup_join(ordered, conversations.select("conv_id", "_start", "_h", "_shared", "total"), "conv_id", "place", "inner", hot=hot)
        .withColumn("_ordinal", F.col("place") - F.col("_start"))
        .where(F.col("_ordinal") >= F.col("_h"))
        .select("conv_id", (F.col("_shared") + F.col("_ordinal") - F.col("_h") + 1).alias("depth"), "total", "digest", "chars")
    )
    begun = conversations.select("conv_id", "total", F.posexplode("_first").alias("_at", "_turn")).select(
        "conv_id", (F.col("_at") + 1).cast("long").alias("depth"), "total", "_turn.digest", "_turn.chars")
    return conversations.select("conv_id", "total"), stored(own.unionByName(begun), "rebuilt")


def _name(high: Column, low: Column) -> Column:
    return F.shiftleft(high.bitwiseAND(F.lit(_LANE)), 32).bitwiseOR(low.bitwiseAND(F.lit(_LANE)))


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Turns (conv_id, depth from 1 without gaps, total, digest, chars) with the names of the prefix that
    ends there, k1 and k2, and of the one before, p1 and p2."""
    one, two = F.xxhash64("digest", "depth", F.lit(1)), F.xxhash64(F.lit(2), "depth", "digest")
    lanes = [one.bitwiseAND(F.lit(_LANE)), F.shiftrightunsigned(one, 32), two.bitwiseAND(F.lit(_LANE)), F.shiftrightunsigned(two, 32)]
    rows = turns.select(
        "*", *[lane.alias(c) for c, lane in zip(LANES, lanes)], F.floor((F.col("depth") - 1) / block).cast("long").alias("_block"))
    # Only conversations of more than one block carry sums from one to the next.
    blocks = rows.where(F.col("total") > block).groupBy("conv_id", "_block").agg(*[F.sum(c).alias(c) for c in LANES])
    earlier = W.partitionBy("conv_id").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select("conv_id", "_block", *[F.sum(c).over(earlier).alias(f"_before{c}") for c in LANES]).where("_block > 0")
    inside = W.partitionBy("conv_id", "_block").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = rows.withColumns({f"_sum{c}": F.sum(c).over(inside) for c in LANES}).join(carried, ["conv_id", "_block"], "left")
    here = [F.col(f"_sum{c}") + F.coalesce(F.col(f"_before{c}"), F.lit(0)) for c in LANES]
    up = [s - F.col(c) for s, c in zip(here, LANES)]
    return summed.select(
        "conv_id", "depth", "total", "chars", _name(*here[:2]).alias("k1"), _name(*here[2:]).alias("k2"),
        _name(*up[:2]).alias("p1"), _name(*up[2:]).alias("p2"))


def tree(conversations: DataFrame, named: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Nodes of the trie, numbered by `id` from the root, 0, on: depth, k1, k2, conv_id (smallest member),
    n_convs, chars, n_children, first and last (children), parent, parent_conv_id, parent_first, parent_last."""
    zero = F.lit(0).cast("long")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), "conv_id", "n_convs", zero.alias("chars"))
    below = named.groupBy("depth", "k1", "k2", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"))
    nodes = in_order(root.unionByName(below), ["depth", "p1", "p2", "k1", "k2"], "nodes").withColumnRenamed("place", "id")
    children = nodes.where("depth > 0").groupBy(F.struct(F.col("depth") - 1, "p1", "p2").alias("_node")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("id").alias("first"), F.max("id").alias("last"))
    own = stored(
        nodes.withColumn("_node", F.struct("depth", "k1", "k2")).join(children, "_node", "left")
        .withColumn("_parent", F.struct(F.col("depth") - 1, "p1", "p2")).drop("p1", "p2")
        .withColumn("n_children", F.coalesce("n_children", zero)), "own")
    parents = own.where("n_children > 0").select(
        F.col("_node").alias("_parent"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
        F.col("first").alias("parent_first"), F.col("last").alias("parent_last"))
    hot = hot_pieces(own.select(F.col("_node").alias("_parent"), "n_children"), "_parent", "n_children", hot_rows)
    joined = lookup_join(own, parents, "_parent", "id", "left", hot=hot)
    return stored(joined.drop("_node", "_parent"), "tree")


def euler_tour(nodes: DataFrame) -> DataFrame:
    """The tour as a list: arc (2 id to enter a node, 2 id + 1 to leave it), before, after; -1 for none."""
    enter, leave, none = F.col("id") * 2, F.col("id") * 2 + 1, F.lit(-1).cast("long")
    is_root, has_children = F.col("depth") == 0, F.col("n_children") > 0
    entering = F.struct(
        enter.alias("arc"),
        F.when(is_root, none).when(F.col("id") == F.col("parent_first"), F.col("parent") * 2).otherwise(enter - 1).alias("before"),
        F.when(has_children, F.col("first") * 2).otherwise(leave).alias("after"))
    leaving = F.struct(
        leave.alias("arc"),
        F.when(has_children, F.col("last") * 2 + 1).otherwise(enter).alias("before"),
        F.when(is_root, none).when(F.col("id") == F.col("parent_last"), F.col("parent") * 2 + 1).otherwise(leave + 1).alias("after"))
    return nodes.select(F.explode(F.array(entering, leaving)).alias("_arc")).select("_arc.*")


def _walk(arcs: pd.DataFrame) -> pd.DataFrame:
    """Ranks of a short list by following it."""
    arcs = arcs.sort_values("arc")
    names, steps = arcs["arc"].to_numpy(), arcs["step"].to_numpy()
    following = np.searchsorted(names, arcs["after"].to_numpy())
    ranks, rank = np.zeros(len(names), np.int64), 0
    at = int(np.flatnonzero(arcs["before"].to_numpy() < 0)[0])
    for _ in range(len(names)):
        rank += int(steps[at])
        ranks[at] = rank
        at = int(following[at])
    return pd.DataFrame({"arc": names, "rank": ranks})


def list_ranks(links: DataFrame, walked: int = WALKED) -> DataFrame:
    """The number of arcs before each, for one list of rows (arc, before, after): arc, rank.

    A round writes what is left of the list, about two thirds, in one shuffle; so all rounds together
    cost some three times the list, and then as much to bring the arcs back."""
    head = F.col("before") < 0
    rounds = [stored(links.withColumn("step", F.when(head, 0).otherwise(1).cast("long")), "list")]
    leaving: list[Column] = []
    none = F.lit(None).cast("long")
    while rounds[-1].count() > walked:
        left, turn = rounds[-1], F.lit(len(rounds))
        mark = F.xxhash64("arc", turn)
        # The ends of the list stay.
        leaves = ~head & (F.col("after") >= 0) & (mark > F.xxhash64("before", turn)) & (mark > F.xxhash64("after", turn))
        gone = left.where(leaves)
        rows = left.where(~leaves).select("arc", "before", "after", "step", none.alias("_before"), none.alias("_after"), none.alias("_step"))
        rows = rows.unionAll(gone.select("after", none, none, none, "before", none, "step")).unionAll(
            gone.select("before", none, none, none, none, "after", none))
        merged = rows.groupBy("arc").agg(*[F.max(c).alias(c) for c in rows.columns[1:]])
        rounds.append(stored(merged.select(
            "arc", F.coalesce("_before", "before").alias("before"), F.coalesce("_after", "after").alias("after"),
            (F.col("step") + F.coalesce("_step", F.lit(0))).alias("step")), "list"))
        leaving.append(leaves)
    ranks = stored(rounds[-1].groupBy(F.lit(0).alias("_all")).applyInPandas(_walk, "arc long, rank long"), "ranks")
    for left, leaves in zip(reversed(rounds[:-1]), reversed(leaving)):
        gone = left.where(leaves).select(F.col("arc").alias("_arc"), F.col("before").alias("arc"), "step")
        back = gone.join(ranks, "arc").select(F.col("_arc").alias("arc"), (F.col("rank") + F.col("step")).alias("rank"))
        known, ranks = ranks, stored(ranks.unionByName(back), "ranks")
        discard(known)
    discard(*rounds)
    return ranks


def subtree_sums(nodes: DataFrame, ranks: DataFrame, values: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """Per node id, the sum of each value (a column of nodes) over its subtree, from prefix sums at its arcs."""
    weights = nodes.select((F.col("id") * 2).alias("arc"), *[v.cast("long").alias(f"_v{c}") for c, v in values.items()])
    placed = ranks.join(weights, "arc", "left").select(
        "arc", "rank", F.floor(F.col("rank") / block).cast("long").alias("_bucket"),
        *[F.coalesce(f"_v{c}", F.lit(0)).alias(f"_v{c}") for c in values])
    counts = placed.groupBy("_bucket").agg(*[F.sum(f"_v{c}").alias(f"_v{c}") for c in values])
    offsets = bucket_offsets(counts, "_bucket", {f"_v{c}": f"_o{c}" for c in values}).drop(*[f"_v{c}" for c in values])
    so_far = W.partitionBy("_bucket").orderBy("rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    is_enter = F.col("arc") % 2 == 0
    here = {c: F.sum(f"_v{c}").over(so_far) + F.col(f"_o{c}") for c in values}
    # What is entered counts from its own arc on, so its value is taken off the sum there.
    signed = {c: F.when(is_enter, F.col(f"_v{c}") - F.col(f"_s{c}")).otherwise(F.col(f"_s{c}")) for c in values}
    return (
        placed.join(offsets, "_bucket").withColumns({f"_s{c}": s for c, s in here.items()})
        .groupBy(F.floor(F.col("arc") / 2).cast("long").alias("id"))
        .agg(*[F.sum(s).alias(c) for c, s in signed.items()])
    )


ENDS = "depth long, k1 long, k2 long"


def _streamed(fields: list[str], kinds: list[pa.DataType], step):
    """A mapInArrow function over sorted rows; `step(rows)` is a generator of output tuples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=fields)

        for row in step(rows):
            out.append(row)
            if len(out) >= CHUNK_IDS:
                yield made()
                out = []
        if out:
            yield made()
    return run


def _chunks(rows: Iterator[tuple]) -> Iterator[tuple]:
    node, ids = None, []
    for *key, conv_id in rows:
        if ids and (key != node or len(ids) >= CHUNK_IDS):
            yield *node, ids[0], ",".join(map(str, ids))
            ids = []
        node = key
        ids.append(conv_id)
    if ids:
        yield *node, ids[0], ",".join(map(str, ids))


def _hashes(rows: Iterator[tuple]) -> Iterator[tuple]:
    node, running = None, None
    for *key, _, ids in rows:
        if key == node:
            running.update(b",")
        else:
            if node is not None:
                yield *node, running.hexdigest()
            node, running = key, hashlib.sha256()
        running.update(ids.encode())
    if node is not None:
        yield *node, running.hexdigest()


def end_digests(ends: DataFrame) -> DataFrame:
    """Rows (depth, k1, k2, conv_id) to one per node with ends_sha256, of its conv_ids in order.

    A digest is one hash over all ids; they are sorted and written out in chunks of `CHUNK_IDS` by all
    tasks, and the task that hashes a node streams over its chunks and holds a batch of them."""
    key = ["depth", "k1", "k2"]
    kinds = [pa.int64()] * 4 + [pa.string()]
    in_turn = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    chunks = in_turn.mapInArrow(_streamed([*key, "_first", "_ids"], kinds, _chunks), ENDS + ", _first long, _ids string")
    by_node = chunks.repartition(*key).sortWithinPartitions(*key, "_first")
    return by_node.mapInArrow(_streamed([*key, "ends_sha256"], [*kinds[:3], kinds[4]], _hashes), ENDS + ", ends_sha256 string")


def prefix_tree(turns: DataFrame, walked: int = WALKED, block: int = BLOCK, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    conversations, said = rebuilt(turns, hot_rows)
    named = stored(prefixes(said, block), "prefixes")
    nodes = tree(conversations, named, hot_rows)
    sums = subtree_sums(
        nodes, list_ranks(euler_tour(nodes), walked),
        {"n_leaves": F.col("n_children") == 0, "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")}, block)
    zero = F.lit(0).cast("long")
    ends = named.where("depth = total").select("depth", "k1", "k2", "conv_id").unionByName(
        conversations.where("total = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(sums, "id").join(end_digests(ends), ["depth", "k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


# CRC-32 of the digits of a number, bit by bit; 4294967295 and 3988292384 are fixed values of CRC-32.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({s}) + 1),
    lambda i: list_transform(range(0, 8), lambda b: CASE WHEN b = 0 THEN ord(substr({s}, i, 1))::BIGINT ELSE 0::BIGINT END)))),
    lambda c, v: xor(xor(c, v) // 2, 3988292384::BIGINT * (xor(c, v) % 2))))"""

SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS ordinal
  FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT conv_id, n, conv_id - conv_id % {FAMILY} AS family, {_CRC32.format(s='digits')} % {LONGEST_START + 1} AS h
  FROM (SELECT conv_id, CAST(conv_id AS VARCHAR) AS digits, count(*) AS n FROM turns GROUP BY 1, 2)),
rebuilt AS (
  SELECT c.conv_id, t.ordinal + 1 AS depth, t.role, t.text
  FROM heads c JOIN turns t ON t.conv_id = c.family AND t.ordinal < c.h
  UNION ALL
  SELECT c.conv_id, t.ordinal - c.h + least(c.h, coalesce(f.n, 0)) + 1, t.role, t.text
  FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND t.ordinal >= c.h LEFT JOIN heads f ON f.conv_id = c.family),
prefixes AS (
  SELECT conv_id, depth, length(text) AS chars,
    string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM heads),
named AS (
  SELECT conv_id, depth, chars, sha256(path) AS path, max(depth) OVER (PARTITION BY conv_id) AS total FROM prefixes),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM named GROUP BY 1, 2),
edges AS (
  SELECT n.depth, n.path, u.path AS up FROM nodes n JOIN named u ON u.conv_id = n.conv_id AND u.depth = n.depth - 1),
children AS (SELECT depth - 1 AS depth, up AS path, count(*) AS n_children FROM edges GROUP BY 1, 2),
sums AS (
  SELECT a.depth, a.path, count(*) FILTER (WHERE k.path IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM nodes n JOIN named a ON a.conv_id = n.conv_id AND a.depth <= n.depth
  LEFT JOIN children k ON k.depth = n.depth AND k.path = n.path GROUP BY 1, 2),
ends AS (
  SELECT depth, path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS digest
  FROM named WHERE depth = total GROUP BY 1, 2)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs,
  CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM nodes n
LEFT JOIN edges g ON g.depth = n.depth AND g.path = n.path
LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.path = g.up
LEFT JOIN children k ON k.depth = n.depth AND k.path = n.path
JOIN sums s ON s.depth = n.depth AND s.path = n.path
LEFT JOIN ends e ON e.depth = n.depth AND e.path = n.path
"""


@query("op13_prefix_tree", SQL)
def op13(spark, sf_dir):
    return prefix_tree(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
