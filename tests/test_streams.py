import random
import time

import pytest

from millrace.streaming import tokens as ts
from millrace.streaming import upkeep

TOKENS = "session_id bigint, seq int, token string, is_last boolean"


def test_hold_back_steps():
    held, steps = "", []
    for token in ("ab", "cde", "f"):
        shown, held = ts.emit(held, token)
        steps.append(shown)
    assert steps == ["", "ab", "c"] and held == "def"


def streamed(spark, tmp_path, batches, **options):
    """Feed the batches one after another and return the final texts."""
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for batch in batches:
        spark.createDataFrame(batch, TOKENS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(TOKENS).parquet(source)
        (
            ts.stream_text(stream, ttl_ms=None, **options)
            .writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", state).trigger(availableNow=True)
            .start().awaitTermination(60)
        )
    chunks = spark.read.schema(ts.OUTPUT).parquet(sink)
    return {r.session_id: r.text for r in ts.session_texts(chunks).collect()}


@pytest.mark.parametrize("cuts", [[], [3], [1, 2, 5]])
def test_any_cut_gives_the_batch_text(spark, tmp_path, cuts):
    rng = random.Random(8)
    rows = []
    for session in range(4):
        for seq in range(7):
            token = "<end>" if (session, seq) == (2, 4) else rng.choice(["a", "bcd", "", "efgh", "é"])
            rows.append((session, seq, token, seq == 6 and session != 3))
    options = {"end_token": "<end>", "max_tokens": 6}
    bounds = [0, *cuts, 7]
    batches = []
    for low, high in zip(bounds, bounds[1:]):
        batch = [r for r in rows if low <= r[1] < high]
        rng.shuffle(batch)
        batches.append(batch)
    got = streamed(spark, tmp_path, batches, **options)
    expected = {r.session_id: r.text for r in ts.batch_text(spark.createDataFrame(rows, TOKENS), **options).collect()}
    plain = {}
    for session in range(4):
        text, n = "", 0
        for _, _, token, last in sorted(r for r in rows if r[0] == session):
            if token == "<end>" or n == 6:
                break
            text, n = text + token, n + 1
        plain[session] = text
    assert got == plain == expected


def test_unfinished_session_keeps_its_tail(spark, tmp_path):
    got = streamed(spark, tmp_path, [[(1, 0, "abcdef", False)]])
    assert got == {1: "abc"}


def test_an_idle_session_shows_its_tail_and_stays_done(spark, tmp_path):
    """The timer shows what was held back; a late token does not open the session anew."""
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def feed(rows):
        spark.createDataFrame(rows, TOKENS).coalesce(1).write.mode("append").parquet(source)

    def text_of(session):
        chunks = spark.read.schema(ts.OUTPUT).parquet(sink)
        return {r.session_id: r.text for r in ts.session_texts(chunks).collect()}.get(session)

    def wait_for(session, text):
        for _ in range(120):
            if text_of(session) == text:
                return True
            time.sleep(0.5)
        return False

    feed([(1, 0, "abc", False), (1, 1, "def", False), (2, 0, "xy", True)])
    stream = spark.readStream.schema(TOKENS).parquet(source)
    query = (
        ts.stream_text(stream, ttl_ms=2_000, done_ms=3_600_000)
        .writeStream.format("parquet").option("path", sink).option("checkpointLocation", state)
        .trigger(processingTime="500 milliseconds").start()
    )
    try:
        assert wait_for(1, "abcdef")
        feed([(1, 2, "late", False), (2, 1, "late", False), (3, 0, "new one", False)])
        assert wait_for(3, "new one")
        assert text_of(1) == "abcdef" and text_of(2) == "xy"
    finally:
        query.stop()


EVENTS = "username string, seq bigint, kind string, content string"


def test_upkeep_resolves_any_batching(spark, tmp_path):
    rng = random.Random(9)
    rows = [
        (f"u{rng.randrange(6)}", seq, rng.choice(["login", "update", "update"]), f"c{seq}")
        for seq in range(60)
    ] + [("ghost", 99, "update", "lost")]
    table = {}
    for name, _, kind, content in sorted(rows, key=lambda r: r[1]):
        if kind == "login":
            table.setdefault(name, "")
        elif name in table:
            table[name] = content
    source, state, out = (str(tmp_path / n) for n in ("in", "state", "table"))
    rng.shuffle(rows)
    for i in range(3):
        spark.createDataFrame(rows[i::3], EVENTS).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    upkeep.upkeep(stream, out, state).awaitTermination(60)
    got = {r.username: r.content for r in upkeep.current(spark, out).collect()}
    assert got == table

    # Merged deltas say the same.
    deltas = spark.read.schema(upkeep.DELTA).parquet(out)
    again = upkeep.resolve(upkeep.merge(deltas).unionByName(deltas.select("username", "first_login", "last_update")))
    assert {r.username: r.content for r in again.collect()} == table

    # A replayed batch overwrites its own delta.
    upkeep._write_delta(out, spark.createDataFrame(rows[2::3], EVENTS), 2)
    files = list((tmp_path / "table").iterdir())
    assert len([f for f in files if f.name.startswith("batch_id")]) == 3
