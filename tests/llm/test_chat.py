import hashlib
import time

from webglean.llm import chat, queries

HARD = ["\\### Assistant: </turn> ok", "\\\\h<#:\\", "", "a\n### user: b</turn>\n", "🙂é\\l\\\\c", "\\", "#" * 3000]


def test_layouts_to_turns(spark):
    df = spark.createDataFrame(
        [
            (1, [("user", "hi"), None, (None, None)], None, None, None, None, "x", 7),
            (2, None, [("human", "q"), ("gpt", "a")], None, None, None, "x", 7),
            (3, None, None, "do", "this", "done", "x", 7),
            (4, None, None, "do", None, "done", "x", 7),
            (5, None, None, "do", None, None, "x", 7),
            (6, [], None, None, None, None, None, None),
            (7, None, None, None, None, None, None, None),
        ],
        "id int, messages array<struct<role: string, content: string>>,"
        "conversations array<struct<from: string, value: string>>,"
        "instruction string, input string, output string, layout string, turns int",
    )
    got = {r.id: (r.layout, r.turns and [tuple(t) for t in r.turns])
           for r in chat.canonical_turns(df).collect()}
    assert got[1] == ("messages", [("user", "hi"), ("", "")])
    assert got[2] == ("conversations", [("user", "q"), ("assistant", "a")])
    assert got[3] == ("instruction-input-output", [("user", "do\n\nthis"), ("assistant", "done")])
    assert got[4] == ("instruction-output", [("user", "do"), ("assistant", "done")])
    assert got[5] == (None, None) and got[7] == (None, None)
    assert got[6] == ("messages", [])
    assert chat.canonical_turns(df.limit(0)).count() == 0


def test_everything_comes_back(spark):
    turns = [(r, t) for t in HARD for r in ("assistant", "user", "odd: #<\\role")]
    rows = [(1, turns, "k"), (2, [], "k"), (3, None, "k"), (4, [("assistant", "x")], None)]
    df = spark.createDataFrame(rows, f"id int, turns {chat.TURNS}, formatted string")
    done = chat.format_turns(df).withColumn("loss", chat.loss_text())
    back = {r.id: r for r in chat.parse_turns(done, to="back").collect()}
    assert [tuple(t) for t in back[1].back] == turns
    assert back[1].loss == "".join(t for r, t in turns if r == "assistant")
    assert (back[2].formatted, back[2].back, back[2].loss) == ("", [], "")
    assert back[3].formatted is None and back[3].loss is None
    assert back[4].formatted == "### assistant: x</turn>\n"
    assert hashlib.sha256(back[1].loss.encode()).hexdigest()


def test_unknown_tables(spark):
    df = spark.createDataFrame([(1, "text")], "id int, messages string")
    assert chat.canonical_turns(df).first().turns is None
    nested = spark.createDataFrame([(1, [("a", "b", 3)])], "id int, turns array<struct<role: string, text: string, turn: int>>")
    assert chat.canonical_turns(nested).first().layout == "turns"


def test_spans_of_many_turns_are_read_in_one_pass(spark):
    # Spans of all lengths, also over the borders of pieces, and signs of one to four bytes.
    turns = [(("user", "assistant")[i % 2], "aé€🙂#"[i % 5] * (i % 97 if i % 500 else 5_000)) for i in range(10_000)]
    df = spark.createDataFrame([(1, turns, "mine")], f"id int, turns {chat.TURNS}, _written string")
    begun = time.time()
    row = chat.format_turns(df).withColumn("loss", chat.loss_text()).first()
    assert row.loss == "".join(t for r, t in turns if r == "assistant") and row["_written"] == "mine"
    assert time.time() - begun < 20


def test_records_of_the_query_have_many_layouts(spark):
    pair, led = ["user", "assistant"], ["system", "user", "assistant"]
    kinds = [pair, led, ["user"], ["user", "human", "gpt"], [None, "assistant"], led + ["user"], pair * 3]
    rows = [
        (i, t, role, None if (i + t) % 5 == 0 else f"{role} # {i} < {t}")
        for i in range(42) for t, role in enumerate(kinds[i % len(kinds)])
    ] + [(None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    done = chat.canonical_turns(queries.chat_records(df)).collect()
    assert {r.layout for r in done} == {
        "turns", "messages", "conversations", "prompt-completion", "system-prompt-completion",
        "instruction-output", "system-instruction-output",
    }
    got = {(r.conv_id, i, t.role, t.text) for r in done for i, t in enumerate(r.turns)}
    assert got == {(c, t, role or "", text or "") for c, t, role, text in rows}
