"""Versioned transcripts kept from a stream: a snapshot, the deltas behind it, a pointer.

``delta/batch_id=N`` holds what batch N says of each user, ``state/version=N`` all that was
known after it, ``pointer`` the newest of both. A reader opens one snapshot and fewer than
``merge_every`` deltas, however long the history; older folders may be deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from millrace.plans.positions import index_by_key
from millrace.session import written
from millrace.streaming.upkeep import compact

MERGE_EVERY = 16
STATE = (
    "id bigint, username string, first_batch bigint, first_login bigint, "
    "last_update struct<seq:bigint,content:string>"
)
POINTER = "snapshot bigint, last bigint"


@dataclass(frozen=True)
class Version:
    """The batch of the newest snapshot and the last batch; -1 for none."""

    snapshot: int
    last: int


def newest(spark: SparkSession, path: str) -> Version:
    """What the pointer names. Two slots take turns, so one is whole while one is written."""
    slots = spark.read.schema(POINTER).parquet(f"{path}/pointer")
    best = slots.agg(F.max(F.struct("last", "snapshot")).alias("v")).first().v
    return Version(best.snapshot, best.last)


def _point(spark: SparkSession, path: str, slot: str, version: Version, mode: str) -> None:
    row = spark.range(1).select(
        F.lit(version.snapshot).cast("bigint").alias("snapshot"),
        F.lit(version.last).cast("bigint").alias("last"),
    )
    row.coalesce(1).write.mode(mode).parquet(f"{path}/pointer/slot={slot}")


def _named(events: DataFrame) -> DataFrame:
    """Without updates of nobody; a login without a name fails."""
    wrong = F.raise_error(F.lit("a login without a username")).cast("string")
    kept = events.where(F.col("username").isNotNull() | (F.col("kind") == "login"))
    return kept.withColumn("username", F.coalesce("username", wrong))


def state(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """All that is known at ``version``, with ids for the users that had none.

    Ids go up by batch, time and name of the first login and never change: a user that a
    reader numbers behind the snapshot gets the same id when the deltas are merged.
    """
    later = range(version.snapshot + 1, version.last + 1)
    if version.snapshot >= 0:
        known = spark.read.schema(STATE).parquet(f"{path}/state/version={version.snapshot}")
    else:
        known = spark.createDataFrame([], STATE)
    if later:
        folders = [f"{path}/delta/batch_id={n}" for n in later]
        deltas = spark.read.schema(STATE).parquet(*folders)
        known = written(
            known.unionByName(deltas)
            .groupBy("username")
            .agg(
                F.max("id").alias("id"),
                F.min("first_batch").alias("first_batch"),
                F.min("first_login").alias("first_login"),
                F.max("last_update").alias("last_update"),
            )
        )
    is_new = F.col("id").isNull() & F.col("first_batch").isNotNull()
    top = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = index_by_key(
        known.where(is_new).drop("id"), "first_batch", "first_login", "username", name="_nth"
    )
    new = new.withColumn("id", F.col("_nth") + (top + 1)).drop("_nth")
    return known.where(~is_new).unionByName(new).select("id", *known.drop("id").columns)


def write_batch(path: str, batch: DataFrame, n: int, merge_every: int) -> None:
    """Delta, every ``merge_every`` batches a snapshot, then the pointer.

    A batch that the pointer names already is done; one that was cut short is written again.
    """
    spark = batch.sparkSession
    before = newest(spark, path)
    if before.last == n:
        return
    if before.last != n - 1:
        raise ValueError(f"batch {n} behind batch {before.last}: another checkpoint's table?")
    batch_of = F.when(F.col("first_login").isNotNull(), F.lit(n).cast("bigint"))
    delta = compact(_named(batch)).select(
        F.lit(None).cast("bigint").alias("id"), "username", batch_of.alias("first_batch"),
        "first_login", "last_update",
    )
    delta.write.mode("overwrite").parquet(f"{path}/delta/batch_id={n}")
    snapshot = before.snapshot
    if n - snapshot >= merge_every:
        merged = state(spark, path, Version(snapshot, n))
        merged.write.mode("overwrite").parquet(f"{path}/state/version={n}")
        snapshot = n
    _point(spark, path, str(n % 2), Version(snapshot, n), "overwrite")


def upkeep(
    events: DataFrame, path: str, checkpoint: str, merge_every: int = MERGE_EVERY, **trigger
) -> StreamingQuery:
    """Keep ``path`` up to date with (username, seq, kind, content); one checkpoint per table."""
    _point(events.sparkSession, path, "start", Version(-1, -1), "ignore")
    return (
        events.writeStream.foreachBatch(lambda batch, n: write_batch(path, batch, n, merge_every))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current(spark: SparkSession, path: str) -> DataFrame:
    """(id, username, content) of the users that have logged in.

    An update counts if it is later than the first login.
    """
    counts = F.col("last_update.seq") > F.col("first_login")
    content = F.when(counts, F.col("last_update.content")).otherwise("")
    rows = state(spark, path, newest(spark, path)).where(F.col("id").isNotNull())
    return rows.select("id", "username", content.alias("content"))
