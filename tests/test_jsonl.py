import json

import pytest

from millrace.functions.jsontext import spaced
from millrace.sources import jsonl, tokens
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def mixed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("lines") / "mixed.jsonl"
    path.write_text(
        '{"text":"a"}\n\n{"text":1}\n{"text":null}\n{"nope":1}\n{bad\n{"text":"z"}', "utf-8"
    )
    return jsonl.scan_lines(spark, str(path))


def test_status_of_each_line(mixed):
    rows = jsonl.checked(mixed, "text", "quarantine").orderBy("row_idx").collect()
    assert [r.status for r in rows] == [
        "ok", "blank", "ok", "ok", "missing_key", "bad_json", "ok",
    ]


def test_drop_and_coerce(mixed):
    rows = jsonl.read_pretrain(mixed, "drop").orderBy("row_idx").collect()
    assert [(r.row_idx, r.text) for r in rows] == [(0, "a"), (2, "1"), (3, "None"), (6, "z")]


def test_quarantine_keeps_rows_without_text(mixed):
    rows = jsonl.read_pretrain(mixed, "quarantine").orderBy("row_idx").collect()
    assert [r.text for r in rows] == ["a", None, "1", "None", None, None, "z"]
    with pytest.raises(ValueError):
        jsonl.read_pretrain(mixed, "ignore")


def test_failfast_only_on_access(mixed):
    assert mixed.count() == 7
    good = jsonl.read_pretrain(mixed.where("row_idx in (0, 2, 6)"))
    assert good.count() == 3 and {r.text for r in good.collect()} == {"a", "1", "z"}
    for position, reason in ((1, "blank"), (4, "missing_key"), (5, "bad_json")):
        with pytest.raises(Exception, match=f"{reason} at row {position}"):
            jsonl.read_pretrain(mixed.where(f"row_idx = {position}")).collect()


@pytest.mark.parametrize(
    ("line", "status"),
    [
        ('{"text": "a"} x', "bad_json"), ('{"text": 1}{"text": 2}', "bad_json"),
        ("{'text': 1}", "bad_json"), ("[1]", "bad_json"), ("7", "bad_json"),
        (" \t　", "blank"), ("\t{\"text\": 1}\r", "ok"), ("　{\"text\": \"}\"}", "ok"),
        ("[{\"text\": 1}]", "bad_json"), ("{}", "missing_key"), ("null", "bad_json"),
        ("{\"text\": null} ", "ok"), ("{\"text\": {\"a\": 1}} {\"b\": 2}", "bad_json"), ('  {"text": {"a": [1, 2]}} ', "ok"),
        ('{"text": "a",}', "bad_json"), ('{"text": "a", "text": "b"}', "ok"),
    ],
)
def test_status_edges(spark, line, status):
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(jsonl.line_status(F.col("value"), "text").alias("s")).first().s == status


@pytest.mark.parametrize(
    ("value", "text"),
    [
        (True, "True"), (False, "False"), ("true", "true"), ("false", "false"), (None, "None"),
        (12, "12"), (1.5, "1.5"), ("é\n\"", "é\n\""), ("", ""),
    ],
)
def test_text_of_scalars(spark, value, text):
    df = spark.createDataFrame([(json.dumps({"text": value}),)], "value string")
    assert df.select(jsonl.text_of(F.col("value")).alias("t")).first().t == text == str(value)


def test_text_of_a_line_with_white_space_around(spark):
    df = spark.createDataFrame([("\t　{\"text\": \" a \"}\r",)], "value string")
    assert df.select(jsonl.text_of(F.col("value")).alias("t")).first().t == " a "


def test_json_spacing_matches_dumps(spark):
    values = [
        {"a": 1, "b": [1, 2, {"c": "x,y:z"}], "d": 'q"u\\o,te'}, [], {}, {"e": ""}, "a,b", 5,
        {"long": ["w" * 5000, "v,:" * 5000] * 40},
    ]
    compact = [(i, json.dumps(v, separators=(",", ":"), ensure_ascii=False)) for i, v in enumerate(values)]
    df = spark.createDataFrame(compact, "i int, v string").select("i", spaced(F.col("v")).alias("v"))
    got = [r.v for r in df.orderBy("i").collect()]
    assert got == [json.dumps(v, ensure_ascii=False) for v in values]


def test_nested_messages(spark, tmp_path):
    tool = {"type": "function", "function": {"name": "f", "parameters": {"x": [1, 2]}}}
    conversation = [
        {"role": "system", "content": "S", "functions": [tool]},
        {"role": "user", "content": 5},
        {
            "role": "assistant", "content": "", "reasoning_content": "R",
            "tool_calls": [
                {"name": "f", "arguments": {"x": 1, "y": "a, b"}},
                {"function": {"name": "g", "arguments": '{"z":2}'}},
            ],
        },
    ]
    path = tmp_path / "c.jsonl"
    path.write_text(json.dumps({"conversations": conversation}, separators=(",", ":")) + "\n")
    rows = jsonl.read_conversations(jsonl.scan_lines(spark, str(path))).orderBy("turn").collect()
    assert [(r.row_idx, r.turn, r.role, r.content) for r in rows] == [
        (0, 0, "system", "S"), (0, 1, "user", None), (0, 2, "assistant", ""),
    ]
    assert rows[0].functions == [json.dumps(tool)]
    assert rows[1].tool_calls is None and rows[1].reasoning_content is None
    assert rows[2].reasoning_content == "R"
    # Object arguments get the usual spacing, string arguments stay as they are.
    assert [tuple(c) for c in rows[2].tool_calls] == [
        ("f", '{"x": 1, "y": "a, b"}'), ("g", '{"z":2}'),
    ]


def test_added_tokens(spark):
    entry = {"lstrip": False, "normalized": False, "rstrip": False, "single_word": False}
    added = {
        "0": {"content": "<|endoftext|>", "special": True, **entry},
        "7": {"content": "<think>", "special": False, **entry},
    }
    df = spark.createDataFrame([(json.dumps(added),)], "added string")
    rows = tokens.added_tokens(df, "added").orderBy("token_id").collect()
    assert [tuple(r) for r in rows] == [(0, "<|endoftext|>", True), (7, "<think>", False)]


def test_every_kind_of_bad_conversation_line_keeps_its_reason(spark):
    good = '{"conversations":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]}'
    values = [good, "", "{bad", '{"nope":1}', '{"conversations":"x"}', '{"conversations":[]}', good]
    lines = spark.createDataFrame(list(enumerate(values)), "row_idx bigint, value string")
    rows = jsonl.read_conversations(lines, "quarantine").orderBy("row_idx", "turn").collect()
    assert [(r.row_idx, r.status, r.turn, r.content) for r in rows] == [
        (0, "ok", 0, "a"), (0, "ok", 1, "b"), (1, "blank", None, None), (2, "bad_json", None, None),
        (3, "missing_key", None, None), (4, "bad_type", None, None), (5, "ok", None, None),
        (6, "ok", 0, "a"), (6, "ok", 1, "b"),
    ]
    assert jsonl.read_conversations(lines, "drop").count() == 4
    with pytest.raises(Exception, match="bad_type at row 4"):
        jsonl.read_nested(lines.where("row_idx IN (0, 4)")).collect()
