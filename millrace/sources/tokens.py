"""Added-token dictionaries: a JSON map of id to token properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ENTRY = (
    "struct<content:string,lstrip:boolean,normalized:boolean,rstrip:boolean,"
    "single_word:boolean,special:boolean>"
)


def added_tokens(maps: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per token of each JSON map: (token_id, content, special)."""
    return maps.select(
        *keep, F.explode(F.from_json(column, f"map<string,{_ENTRY}>")).alias("_id", "_entry")
    ).select(
        *keep,
        F.col("_id").cast("int").alias("token_id"),
        F.col("_entry.content").alias("content"),
        F.coalesce("_entry.special", F.lit(False)).alias("special"),
    )


def added_token_rules(maps: DataFrame, column: str) -> DataFrame:
    """``token_id, content, special, lstrip, rstrip, single_word`` of each JSON map's tokens.

    Rules that a token does not state are false.
    """
    rows = maps.select(F.explode(F.from_json(column, f"map<string,{_ENTRY}>")).alias("_id", "_entry"))
    rules = [
        F.coalesce(F.col(f"_entry.{name}"), F.lit(False)).alias(name)
        for name in ("special", "lstrip", "rstrip", "single_word")
    ]
    return rows.select(F.col("_id").cast("int").alias("token_id"), F.col("_entry.content").alias("content"), *rules)


def token_map(token_id: Column, content: Column, special: Column) -> Column:
    """Aggregate token rows into the JSON map that :func:`added_tokens` reads."""
    entry = F.struct(
        content.alias("content"),
        F.lit(False).alias("lstrip"),
        F.lit(False).alias("normalized"),
        F.lit(False).alias("rstrip"),
        F.lit(False).alias("single_word"),
        special.alias("special"),
    )
    return F.to_json(
        F.map_from_entries(F.collect_list(F.struct(token_id.cast("string"), entry)))
    )


def read_token_config(spark: SparkSession, path: str) -> DataFrame:
    """The added tokens of a tokenizer configuration file (one JSON object)."""
    whole = spark.read.text(path, wholetext=True)
    field = F.from_json("value", "struct<added_tokens_decoder:string>")["added_tokens_decoder"]
    return added_tokens(whole.select(field.alias("added")), "added")
