import binascii
import hashlib
import random
from collections import defaultdict

from pagelode.llm import prefix_tree

SCHEMA = "conv_id long, turn long, role string, text string, id long, depth int, place string"


def brute(rows):
    """Nodes of the trie from Python dictionaries."""
    said = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            said[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(turns)] for c, turns in said.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in said:
        h = binascii.crc32(str(c).encode()) % 6
        family = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(said.get(family, [])[:h] + said[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    out = {}
    for path, cs in members.items():
        out[path] = [min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), 0, 0, 0,
                     hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()]
    for path in members:
        if path:
            out[path[:-1]][4] += 1
    for path, cs in members.items():
        for d in range(len(path) + 1):
            out[path[:d]][5] += out[path][4] == 0
            out[path[:d]][6] += (len(cs) - 1) * (len(path[-1][1]) if path else 0)
    return sorted(map(tuple, out.values()), key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(prefix_tree.op13(spark, sf_dir)) == brute(rows)


def hard_rows():
    rng = random.Random(5)
    rows = []
    for c in (0, 1, 2, 3, 50, 99, 100, 101, 205, 207, 299, -7, -100, 10**12):
        for turn in range(rng.randint(1, 9)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "日本 🙂", "x" * 50_000])))
    rows += [(0, None, "user", "first"), (0, None, "user", "first"), (3, 1, "user", "tie"), (3, 1, "assistant", "tie"), (3, 1, None, "b")]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (400, 0, None, None)]
    # One conversation with most of the rows, and copies of it.
    rows += [(c, t, "user", f"t{t % 3}") for c in (501, 502, 500) for t in range(120)]
    rows += [(600 + k, 0, "user", f"child {k}") for k in range(90)]
    return [(*r, 1, 2, "p") for r in rows]


def test_hard_turns(spark):
    rows = hard_rows()
    frame = spark.createDataFrame(rows, SCHEMA)
    wanted = brute(rows)
    assert got(prefix_tree.prefix_tree(frame)) == wanted
    # Many rounds of ranking, blocks of a few rows, and pieces of hot conversations and parents.
    assert got(prefix_tree.prefix_tree(frame, walked=100, block=7, hot_rows=20)) == wanted
    empty = prefix_tree.prefix_tree(frame.where("false"))
    assert empty.count() == 0 and empty.columns == prefix_tree.prefix_tree(frame).columns
    assert prefix_tree.prefix_tree(frame.where("conv_id is null")).count() == 0


def test_ranks_of_a_long_list(spark):
    order = list(range(3_000))
    random.Random(2).shuffle(order)
    links = [(a, order[i - 1] if i else -1, order[i + 1] if i + 1 < len(order) else -1) for i, a in enumerate(order)]
    ranks = prefix_tree.list_ranks(spark.createDataFrame(links, "arc long, before long, after long"), walked=200).collect()
    assert {r.arc: r["rank"] for r in ranks} == {a: i for i, a in enumerate(order)}


def test_long_end_lists_are_hashed_in_order(spark):
    ids = [*range(0, 5_000, 2), *range(1, 5_000, 2)]
    frame = spark.createDataFrame([(1, 5, 6, i) for i in ids] + [(1, 5, 7, 9), (0, 0, 0, -3)], "depth long, k1 long, k2 long, conv_id long")
    found = {r.k2: r.ends_sha256 for r in prefix_tree.end_digests(frame).collect()}
    assert found[6] == hashlib.sha256(",".join(map(str, range(5_000))).encode()).hexdigest()
    assert found[7] == hashlib.sha256(b"9").hexdigest() and found[0] == hashlib.sha256(b"-3").hexdigest()
