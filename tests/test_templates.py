import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import context
from millrace.operators.templates import (
    EMPTY_THOUGHT, PLAIN, REASONING, TOOLS_AFTER, TOOLS_BEFORE, render, render_nested, segments,
)

SCHEMA = (
    "conv_id int, turn bigint, role string, content string, reasoning_content string, "
    "functions array<string>, tool_calls array<struct<name:string,arguments:string>>"
)


def S(text, **more):
    return {"role": "system", "content": text, **more}


def U(text):
    return {"role": "user", "content": text}


def A(text, **more):
    return {"role": "assistant", "content": text, **more}


def T(text):
    return {"role": "tool", "content": text}


def block(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def table(spark, *conversations):
    rows = [
        (
            i, turn, m["role"], m["content"], m.get("reasoning_content"), m.get("functions"),
            m.get("tool_calls"),
        )
        for i, messages in enumerate(conversations)
        for turn, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def text(spark, style, messages, **options):
    return render(table(spark, messages), style, "conv_id", **options).first().text


def fold(turns):
    message = F.struct(
        "turn", "role", "content", "reasoning_content", "functions", "tool_calls"
    )
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(message)).alias("messages"))


DEFAULT = block("system", "You are a helpful assistant")
T2 = [S("S"), U("a"), A("b"), U("c")]
T3 = [U("q"), A("", tool_calls=[("f", '{"x": 1}')]), T("r1"), T("r2"), A("done")]
T3_MIDDLE = (
    block("assistant", '<tool_call>\n{"name": "f", "arguments": {"x": 1}}\n</tool_call>')
    + "<|im_start|>user\n<tool_response>\nr1\n</tool_response>"
    + "\n<tool_response>\nr2\n</tool_response><|im_end|>\n"
)
T4 = [U("q"), A("<think>\nR\n</think>\n\nA")]

GOLDEN = [
    (PLAIN, [U("hi"), A("yo")], DEFAULT + block("user", "hi") + block("assistant", "yo")),
    (REASONING, [U("hi"), A("yo")], block("user", "hi") + block("assistant", EMPTY_THOUGHT + "yo")),
    *[
        (style, T2, block("system", "S") + block("user", "a") + block("assistant", "b") + block("user", "c"))
        for style in (PLAIN, REASONING)
    ],
    (PLAIN, T3, DEFAULT + block("user", "q") + T3_MIDDLE + block("assistant", "done")),
    (REASONING, T3, block("user", "q") + T3_MIDDLE + block("assistant", EMPTY_THOUGHT + "done")),
    (PLAIN, T4, DEFAULT + block("user", "q") + block("assistant", T4[1]["content"])),
    (REASONING, T4, block("user", "q") + block("assistant", "<think>\nR\n</think>\n\nA")),
    (REASONING, [*T4, U("z")], block("user", "q") + block("assistant", "A") + block("user", "z")),
    (PLAIN, [U("a"), {"role": "observer", "content": "o"}], DEFAULT + block("user", "a")),
    (PLAIN, [U("a"), A("b"), S("late")],
     DEFAULT + block("user", "a") + block("assistant", "b") + block("system", "late")),
    # Content that is not text.
    (PLAIN, [U(None), A(None)], DEFAULT + block("user", "") + block("assistant", "")),
    # Given thoughts win over inline ones and are stripped of newlines.
    (REASONING, [U("q"), A("\n\nx</think>y", reasoning_content="\nG\n\n")],
     block("user", "q") + block("assistant", "<think>\nG\n</think>\n\nx</think>y")),
    (REASONING, [U("q"), A("<think>a<think>b</think>c</think>\n\nd")],
     block("user", "q") + block("assistant", "<think>\nb\n</think>\n\nd")),
    # A thought stays on an earlier answer after the last query, an empty one does not.
    (REASONING, [U("q"), A("<think>t</think>m"), A("n"), T("r")],
     block("user", "q") + block("assistant", "<think>\nt\n</think>\n\nm") + block("assistant", "n")
     + "<|im_start|>user\n<tool_response>\nr\n</tool_response><|im_end|>\n"),
    # A wrapped tool response is no query; without any query the last turn counts as one.
    (REASONING, [U("<tool_response>x</tool_response>"), A("n")],
     block("user", "<tool_response>x</tool_response>") + block("assistant", "n")),
    # An unknown role ends a run of tools.
    (PLAIN, [U("q"), T("1"), {"role": "x", "content": ""}, T("2")],
     DEFAULT + block("user", "q")
     + "".join(f"<|im_start|>user\n<tool_response>\n{i}\n</tool_response><|im_end|>\n" for i in (1, 2))),
    # Calls after text, and several of them, are separated by newlines.
    (PLAIN, [A("t", tool_calls=[("f", "{}"), ("g", "[1]")])],
     DEFAULT + block("assistant", 't\n<tool_call>\n{"name": "f", "arguments": {}}\n</tool_call>'
                     '\n<tool_call>\n{"name": "g", "arguments": [1]}\n</tool_call>')),
]


@pytest.mark.parametrize("case", range(len(GOLDEN)))
def test_golden(spark, case):
    style, messages, expected = GOLDEN[case]
    assert text(spark, style, messages) == expected
    # The per-turn form with block windows adds up to the same text.
    parts = segments(table(spark, messages), style, "conv_id").orderBy("turn").collect()
    assert "".join(p.segment for p in parts) == expected
    # So does the form for rows that hold whole conversations.
    nested = fold(table(spark, messages))
    assert render_nested(nested, style, "conv_id").first().text == expected


@pytest.mark.parametrize("style", [PLAIN, REASONING])
def test_tools_block(spark, style):
    tools = [json.dumps({"name": "f"}), json.dumps({"name": "g", "p": [1, 2]})]
    got = text(spark, style, [S("S", functions=tools), U("q")])
    listed = "".join("\n" + t for t in tools)
    assert got == block("system", "S\n\n" + TOOLS_BEFORE + listed + TOOLS_AFTER) + block("user", "q")
    # Signatures on another message, or an empty list, change nothing.
    assert text(spark, PLAIN, [U("q")]) == DEFAULT + block("user", "q")
    assert text(spark, style, [S("S", functions=[])]) == block("system", "S")


@pytest.mark.parametrize(
    ("thinking", "ending"), [(None, ""), (True, ""), (False, "<think>\n\n</think>\n\n")]
)
def test_generation_prompt(spark, thinking, ending):
    got = text(spark, REASONING, T2, generation_prompt=True, enable_thinking=thinking)
    assert got == text(spark, REASONING, T2) + "<|im_start|>assistant\n" + ending


def test_history_windows(spark):
    turns = table(spark, [U("u1"), A("a1"), U("u2"), A("a2"), U("u3")])

    def seen(n):
        rows = context.history(turns, n, "conv_id").orderBy("prompt_turn").collect()
        return [" ".join(m.content for m in r.messages) for r in rows]

    assert seen(2) == ["u1", "u1 a1 u2", "u2 a2 u3"]
    assert seen(0) == ["u1", "u2", "u3"]


def test_long_conversations_cross_blocks(spark):
    messages = [U(f"u{i}") if i % 2 == 0 else T(f"t{i}") for i in range(9001)]
    turns = table(spark, messages)
    rows = context.history(turns, 3, "conv_id").collect()
    for r in rows:
        want = [m["content"] for m in messages[max(r.prompt_turn - 3, 0) : r.prompt_turn + 1]]
        assert [m.content for m in r.messages] == want
    assert len(rows) == 4501


def test_prompts(spark):
    turns = table(spark, [S("S"), U("a"), A("b"), U("c")])
    rows = context.chat_prompts(turns, PLAIN, 2, "conv_id").orderBy("prompt_turn").collect()
    assert rows[0].text == block("system", "S") + block("user", "a") + "<|im_start|>assistant\n"
    assert rows[1].text == (
        DEFAULT + block("user", "a") + block("assistant", "b") + block("user", "c")
        + "<|im_start|>assistant\n"
    )


@pytest.mark.parametrize(
    ("prompts", "interactive", "kept"),
    [
        ("a b quit c", False, "a b"), ("exit a", False, ""), ("a b", False, "a b"),
        ("a  b", True, "a"), ("a  b", False, "a  b"), ("a quit. exit", False, "a quit."),
    ],
)
def test_until_stop(spark, prompts, interactive, kept):
    words = prompts.split(" ")
    df = spark.createDataFrame([(1, i, w) for i, w in enumerate(words)], "s int, i int, t string")
    rows = context.until_stop(df, "s", "i", "t", interactive).orderBy("i").collect()
    assert [r.t for r in rows] == (kept.split(" ") if kept else [])


def test_append_replies(spark):
    turns = table(spark, [U("a")], [U("b"), A("c")])
    replies = spark.createDataFrame([(0, "r0"), (1, "r1"), (9, "r9")], "conv_id int, content string")
    rows = sorted(map(tuple, context.append_replies(turns, replies, "conv_id").collect()))
    assert rows == [
        (0, 0, "user", "a"), (0, 1, "assistant", "r0"),
        (1, 0, "user", "b"), (1, 1, "assistant", "c"), (1, 2, "assistant", "r1"),
    ]
