import hashlib
from collections import defaultdict

from hypothesis import given, settings, strategies as st

from pagelode.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, block string"


def brute(rows):
    """Digests from the input turns."""
    by_conversation = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        by_conversation[conv_id].append((turn is not None, turn, role or "", text is not None, text or ""))
    out = []
    for conv_id, turns in by_conversation.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, *t[2:]))
        said = "".join(f"{t[2]}\n{t[4]}\n" for t in turns)
        loss = "".join(t[4] for t in turns if t[2] == "assistant")
        out.append((str(conv_id), len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out)


def digests(df):
    return sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect())


def test_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    marked = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", marked), (-7, 1, "assistant", marked)]
    assert digests(chat.op1(spark, sf_dir)) == brute(rows)


HARD = ["", "</s>", "\\</s>", "\\\\<s>\\", "\\", "[INST][/INST]", "<<SYS>>x<</SYS>>", "<<s>", "[ROLE]\\\\[/ROLE]\\\\\\", "\\n\n[/INST", "</s", None, "日本 🙂\r\n"]


def test_hard_turns(spark):
    rows = [(i % 3, i, role, text, "x") for i, (role, text) in enumerate((r, t) for r in ("user", "assistant", "system", "tool</s>\\", "", None) for t in HARD)]
    rows += [(None, 1, "user", "a", "x"), (None, 2, "assistant", "b", None), (9, None, "assistant", "c", None), (9, 1, "user", "d", None),
             (9, 1, "user", "d", None), (8, 0, "assistant", "x" * 200_000, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert digests(chat.digests(chat.blocks(frame))) == brute(rows)
    assert chat.digests(chat.blocks(frame.where("false"))).count() == 0
    assert chat.examples(chat.blocks(frame.where("false"))).count() == 0


def test_a_hot_conversation_is_cut_by_turn(spark):
    rows = [(1, i // 3, ("user", "assistant")[i % 2], f"said {i} </s>", "x") for i in range(400)]
    rows += [(1, None, "assistant", f"early {i}", "x") for i in range(30)] + [(2, i, "assistant", "short", "x") for i in range(5)]
    rows += [(None, i, "user", f"nobody {i}", "x") for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole, cut = chat.blocks(frame), chat.blocks(frame, hot_turns=50)
    columns = ["conv_id", "ordinal", "block", "start", "end", "example", "target_start", "target_end"]
    assert sorted(map(str, whole.select(*columns).collect())) == sorted(map(str, cut.select(*columns).collect()))
    assert digests(chat.digests(cut)) == brute(rows)


def test_the_loss_comes_from_the_examples(spark):
    """Without examples there is no loss, and every example ends with its reply's block."""
    rows = [(1, 0, "user", "a", "x"), (1, 1, "assistant", "b\\", "x"), (2, 0, "user", "c", "x")]
    formatted = chat.blocks(spark.createDataFrame(rows, SCHEMA))
    got = {r.conv_id: r for r in chat.digests(formatted).collect()}
    assert (got[2].loss_chars, got[2].n_examples, got[2].loss_sha256) == (0, 0, hashlib.sha256().hexdigest())
    example, = chat.examples(formatted).collect()
    assert example.block == "<s>b\\\\</s>" and example.text_end - example.context_end == len(example.block)
    assert got[1].loss_chars == 2


def test_examples_are_prefixes(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q1 [INST]"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"), (1, 4, "user", "q3"),
            (1, 5, "assistant", "a2</s>"), (1, 6, "user", "no reply"), (2, 0, "user", "alone"), (None, 0, "assistant", "x")]
    formatted = chat.blocks(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    full = chat.materialised(formatted, chat.examples(formatted)).orderBy("conv_id", "example").collect()
    assert [(r.conv_id, r.example) for r in full] == [(None, 0), (1, 0), (1, 1)]
    turns = [(r, t) for c, _, r, t in rows if c == 1]
    for r, n in ((full[1], 3), (full[2], 6)):
        assert chat.read_back(r.text) == turns[:n]
        assert len(r.text) == r.text_end
        assert chat.unescaped(r.text[r.target_start:r.target_end]) == turns[n - 1][1]
        assert chat.read_back(r.text[:r.context_end]) == turns[:n - 1]
    got = chat.digests(formatted).where("conv_id = 1").first()
    assert got.n_examples == 2 and got.expanded_chars == full[1].text_end + full[2].text_end


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["\\", "<s>", "</s>", "[INST]", "[/INST]", "<", "s>", "a", "[", "\n"]), max_size=9).map("".join), min_size=1, max_size=12))
def test_any_text_comes_back(spark, texts):
    rows = [(0, i, ("user", "assistant", "system")[i % 3], t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    assert digests(chat.digests(chat.blocks(frame))) == brute(rows)
