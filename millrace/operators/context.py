"""Conversation context: stop words, history windows, prompts, replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.templates import ChatStyle, render
from millrace.plans.blocks import with_blocks

# What ends a console session.
STOP_WORDS = ("quit", "exit")


def until_stop(
    prompts: DataFrame, key: str, position: str, text: str, interactive: bool = False
) -> DataFrame:
    """Prompts of each session before its first stop word.

    ``interactive`` sessions also end at an empty input. The first stop is one small row per
    session, found before the exchange.
    """
    words = [*STOP_WORDS, ""] if interactive else list(STOP_WORDS)
    stops = (
        prompts.where(F.col(text).isin(words))
        .groupBy(key)
        .agg(F.min(position).alias("_stop"))
    )
    kept = F.col("_stop").isNull() | (F.col(position) < F.col("_stop"))
    return prompts.join(stops, key, "left").where(kept).drop("_stop")


def history(turns: DataFrame, n: int, *keys: str) -> DataFrame:
    """(keys, prompt_turn, messages): for each user turn the ``n`` messages before it and itself."""
    rows = with_blocks(turns.select(*keys, "turn", "role", "content"), "turn", before=n)
    window = (
        Window.partitionBy(*keys, "_block").orderBy("turn").rowsBetween(-n, Window.currentRow)
    )
    seen = rows.withColumn(
        "messages", F.collect_list(F.struct("turn", "role", "content")).over(window)
    )
    return seen.where(F.col("_own") & (F.col("role") == "user")).select(
        *keys, F.col("turn").alias("prompt_turn"), "messages"
    )


def window_turns(windows: DataFrame, *keys: str) -> DataFrame:
    """History windows as short conversations of their own, counted from zero."""
    return windows.select(
        *keys, "prompt_turn", F.posexplode("messages").alias("_pos", "_m")
    ).select(
        *keys,
        "prompt_turn",
        F.col("_pos").cast("bigint").alias("turn"),
        F.col("_m.role").alias("role"),
        F.col("_m.content").alias("content"),
    )


def chat_prompts(
    turns: DataFrame,
    style: ChatStyle,
    n: int,
    *keys: str,
    enable_thinking: bool | None = None,
) -> DataFrame:
    """(keys, prompt_turn, text): the prompt that is sent for each user turn."""
    return render(
        window_turns(history(turns, n, *keys), *keys),
        style,
        *keys,
        "prompt_turn",
        generation_prompt=True,
        enable_thinking=enable_thinking,
    )


def raw_prompt(text: Column, start: str = "<|im_start|>assistant") -> Column:
    """A prompt for a model without chat training: no history, no template."""
    return F.concat(F.lit(start), text)


def append_replies(turns: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    """Add one assistant reply per conversation behind its last turn."""
    ends = turns.groupBy(key).agg((F.max("turn") + 1).alias("turn"))
    added = replies.join(ends, key).select(
        key, "turn", F.lit("assistant").alias("role"), "content"
    )
    return turns.select(key, "turn", "role", "content").unionByName(added)
