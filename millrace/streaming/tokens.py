"""Assemble generated text from token streams, session by session."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.session import limit_groups_early

# Python workers get the processor itself, whether or not this package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: characters held back, since later tokens may still change them.
HOLD_BACK = 3
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "session_id bigint, seq bigint, chunk string"
_STATE = "held string, n_tokens int, done boolean, last_seq bigint, timer bigint"
_NEW = ("", 0, False, 0, 0)


def emit(held: str, token: str) -> tuple[str, str]:
    """(text that is safe to show, text still held back) after more tokens."""
    text = held + token
    cut = max(len(text) - HOLD_BACK, 0)
    return text[:cut], text[cut:]


class TextAssembler(StatefulProcessor):
    """Keeps at most the held-back characters, a token count and a done flag per session.

    Tokens of a micro-batch are taken in ``seq`` order and shown as one chunk; the source
    delivers later tokens in later batches, and its rate limit bounds what one session can
    bring at a time. A timer runs out ``ttl_ms`` after a session's last token: what is held back
    is shown then, and the session is done. A done session stays marked for ``done_ms``,
    so that a late token does not open it anew; after that its state is gone.
    """

    def __init__(
        self, end_token: str | None, max_tokens: int | None, ttl_ms: int | None, done_ms: int
    ) -> None:
        self._end_token = end_token
        self._max_tokens = max_tokens
        self._ttl_ms = ttl_ms
        self._done_ms = done_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("session", _STATE)

    def _timer(self, old: int, after: int, timerValues) -> int:
        """Move the session's timer to so long after now; 0 without timers."""
        if self._ttl_ms is None:
            return 0
        if old:
            self._handle.deleteTimer(old)
        new = timerValues.getCurrentProcessingTimeInMs() + after
        self._handle.registerTimer(new)
        return new

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, seen, done, _, timer = self._state.get() if self._state.exists() else _NEW
        if done:
            return
        batch = pd.concat(list(rows)).sort_values("seq")
        tokens = batch["token"].tolist()
        # One past the last token that still counts, if the session ends in this batch.
        ends = [i + 1 for i, last in enumerate(batch["is_last"]) if last][:1]
        if self._end_token in tokens:
            ends.append(tokens.index(self._end_token))
        if self._max_tokens is not None and seen + len(tokens) >= self._max_tokens:
            ends.append(self._max_tokens - seen)
        done = bool(ends)
        taken = tokens[: min(ends)] if done else tokens
        shown, held = emit(held, "".join(taken))
        if done:
            shown, held = shown + held, ""
        last_seq = int(batch["seq"].iloc[-1])
        timer = self._timer(timer, self._done_ms if done else self._ttl_ms, timerValues)
        self._state.update((held, seen + len(taken), done, last_seq, timer))
        if shown:
            yield pd.DataFrame({"session_id": [key[0]], "seq": [last_seq], "chunk": [shown]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self._state.exists():
            return
        held, seen, done, last_seq, _ = self._state.get()
        if done:
            self._state.clear()
            return
        self._state.update(("", seen, True, last_seq, self._timer(0, self._done_ms, timerValues)))
        if held:
            # Behind the last chunk; later tokens are dropped, so the place is free.
            yield pd.DataFrame({"session_id": [key[0]], "seq": [last_seq + 1], "chunk": [held]})

    def close(self) -> None:
        pass


def stream_text(
    tokens: DataFrame,
    end_token: str | None = None,
    max_tokens: int | None = None,
    ttl_ms: int | None = 3_600_000,
    done_ms: int = 86_400_000,
) -> DataFrame:
    """Streaming (session_id, seq, chunk): text as soon as it is safe to show.

    ``tokens`` streams (session_id, seq, token, is_last). A session ends at ``is_last``, at
    ``end_token``, after ``max_tokens`` or ``ttl_ms`` after its last token, when what was held back
    is shown; later tokens are dropped for ``done_ms``. A run over finished input (trigger
    ``availableNow``) passes ``ttl_ms=None``: timers keep a query waiting for its clock, so
    that such a run would never end; its done sessions stay marked.
    """
    tokens.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return tokens.groupBy("session_id").transformWithStateInPandas(
        statefulProcessor=TextAssembler(end_token, max_tokens, ttl_ms, done_ms),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )


def _ordered_text(value: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct("seq", value)))
    return F.array_join(F.transform(ordered, lambda s: s[value]), "")


def session_texts(chunks: DataFrame) -> DataFrame:
    """(session_id, text) from the chunks that were emitted."""
    return chunks.groupBy("session_id").agg(_ordered_text("chunk").alias("text"))


def batch_text(
    tokens: DataFrame, end_token: str | None = None, max_tokens: int | None = None
) -> DataFrame:
    """The same final texts from a finished token table."""
    at_end = F.col("is_last") if end_token is None else (
        F.col("is_last") | (F.col("token") == end_token)
    )
    # Tokens after the first end are dropped; the end token itself carries no text.
    ends = tokens.where(at_end).groupBy("session_id").agg(F.min("seq").alias("_end"))
    kept = tokens.join(ends, "session_id", "left").where(
        F.col("_end").isNull() | (F.col("seq") <= F.col("_end"))
    )
    if end_token is not None:
        kept = kept.where(F.col("token") != end_token)
    if max_tokens is not None:
        limit_groups_early(tokens.sparkSession, max_tokens)
        order = Window.partitionBy("session_id").orderBy("seq")
        kept = kept.withColumn("_nth", F.row_number().over(order)).where(
            F.col("_nth") <= max_tokens
        )
    return kept.groupBy("session_id").agg(_ordered_text("token").alias("text"))
