"""Transcript upkeep from a stream of login and update events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

DELTA = "username string, first_login bigint, last_update struct<seq:bigint,content:string>"


def compact(events: DataFrame) -> DataFrame:
    """One row per user: first login and last update; combined before the exchange.

    ``events`` has (username, seq, kind, content), ``kind`` being login or update.
    """
    is_login = F.col("kind") == "login"
    return events.groupBy("username").agg(
        F.min(F.when(is_login, F.col("seq"))).alias("first_login"),
        F.max(F.when(~is_login, F.struct("seq", "content"))).alias("last_update"),
    )


def _write_delta(path: str, batch: DataFrame, batch_id: int) -> None:
    # The same batch id overwrites the same folder, so a replayed batch changes nothing.
    compact(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def upkeep(events: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start the query that keeps ``path`` up to date; each batch adds one compact delta."""
    return (
        events.writeStream.foreachBatch(lambda batch, n: _write_delta(path, batch, n))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def merge(deltas: DataFrame) -> DataFrame:
    """One delta for many, in any order; written as a new table it shortens a long history."""
    return deltas.groupBy("username").agg(
        F.min("first_login").alias("first_login"), F.max("last_update").alias("last_update")
    )


def resolve(deltas: DataFrame) -> DataFrame:
    """(username, content, first_login) from deltas.

    A user exists from the first login on; an update before it found no row to change.
    """
    counts = F.col("last_update.seq") > F.col("first_login")
    return merge(deltas).where(F.col("first_login").isNotNull()).select(
        "username",
        F.when(counts, F.col("last_update.content")).otherwise("").alias("content"),
        "first_login",
    )


def current(spark: SparkSession, path: str) -> DataFrame:
    return resolve(spark.read.schema(DELTA).option("basePath", path).parquet(path))
