import json

from pyspark.sql import functions as F

from millrace.operators import transcripts
from millrace.sources.transcripts import parse_transcripts, serialize_transcripts

TABLE = "id bigint, username string, content string"
LOG = "username string, seq bigint, content string"


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_login_update_clear(spark):
    table = spark.createDataFrame([], TABLE)
    logins = spark.createDataFrame([("x", 1), ("x", 2), ("w", 0)], "username string, seq bigint")
    table = transcripts.ensure_users(table, logins)
    assert rows(table) == [(1, "w", ""), (2, "x", "")]
    again = transcripts.ensure_users(table, logins)
    assert rows(again) == rows(table)
    more = transcripts.ensure_users(table, spark.createDataFrame([("a", 9)], "username string, seq bigint"))
    assert rows(more) == [(1, "w", ""), (2, "x", ""), (3, "a", "")]

    updates = spark.createDataFrame([("x", 5, "late"), ("x", 4, "early"), ("y", 6, "lost")], LOG)
    updated = transcripts.apply_updates(table, updates)
    assert rows(updated) == [(1, "w", ""), (2, "x", "late")]
    assert {r.status for r in transcripts.update_reports(updates).collect()} == {"updated"}
    cleared = transcripts.clear_transcripts(updated, updates.where("username = 'x'"))
    assert rows(cleared) == [(1, "w", ""), (2, "x", "[]")]
    answers = transcripts.login_answers(updated, logins)
    assert rows(answers) == [("w", 0, ""), ("x", 1, "late"), ("x", 2, "late")]


def test_key_violations(spark):
    table = spark.createDataFrame([(1, "a", ""), (2, "a", ""), (3, None, ""), (4, "b", "")], TABLE)
    assert {(r.username, r.n_rows) for r in transcripts.key_violations(table).collect()} == {("a", 2), (None, 1)}


def test_stored_text_is_what_dumps_writes(spark):
    messages = [("user", 'é "q" \\ \n\t/ 你好 , : {}'), ("assistant", ""), ("system", "s")]
    turns = spark.createDataFrame(
        [("u", i, r, c) for i, (r, c) in enumerate(messages)],
        "username string, turn int, role string, content string",
    )
    stored = serialize_transcripts(turns)
    want = json.dumps([{"role": r, "content": c} for r, c in messages], ensure_ascii=False)
    assert stored.first().content == want
    shown = parse_transcripts(stored).orderBy("turn").collect()
    assert [(r.turn, r.sender, r.text) for r in shown] == [(0, "user", messages[0][1]), (1, "bot", "")]


def test_texts_without_messages(spark):
    texts = ["", "not json", '{"a":1}', '{"role":"user","content":"x"}', "[", "null", "[]", None, '"s"',
             '[{"role": "user", "content": "x"}] more', '[{"role": "user", "content": "x"}],[]',
             "[{'role': 'user', 'content': 'x'}]"]
    df = spark.createDataFrame([(f"u{i}", t) for i, t in enumerate(texts)], "username string, content string")
    assert parse_transcripts(df).count() == 0
    kept = df.limit(1).withColumn("content", F.lit('\n\t[{"role": "user", "content": "x", "more": 1}]'))
    assert parse_transcripts(kept).first().text == "x"
