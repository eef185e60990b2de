"""Stored transcripts: a JSON array of messages in a text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsontext import message_list

_MESSAGES = "array<struct<role:string,content:string>>"


def messages_of(content: Column) -> Column:
    """The stored messages; empty, invalid or non-array text gives an empty array."""
    # In brackets of its own, text behind the array becomes an error or a second element.
    alone = F.json_array_length(F.concat(F.lit("["), content, F.lit("]"))) == 1
    is_array = F.coalesce(content.rlike(r"^\s*\[") & alone, F.lit(False))
    parsed = F.when(is_array, F.from_json(content, _MESSAGES, {"allowSingleQuotes": "false"}))
    return F.coalesce(parsed, F.array().cast(_MESSAGES))


def parse_transcripts(table: DataFrame) -> DataFrame:
    """Displayed lines: user and assistant messages, the assistant shown as ``bot``."""
    rows = table.select(
        "username", F.posexplode(messages_of(F.col("content"))).alias("turn", "m")
    ).where(F.col("m.role").isin("user", "assistant"))
    return rows.select(
        "username",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(F.col("m.role") == "assistant", "bot").otherwise(F.col("m.role")).alias("sender"),
        F.col("m.content").alias("text"),
    )


def serialize_transcripts(turns: DataFrame, key: str = "username") -> DataFrame:
    """Messages of each user as the text that is stored."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "content")))
    return turns.groupBy(key).agg(message_list(ordered).alias("content"))
