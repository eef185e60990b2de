"""Batch manifests: which rank reads which rows, in which batch of which epoch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shard(order: DataFrame, n: int, world: int) -> DataFrame:
    """Deal positions ``0..n-1`` of each epoch out to ``world`` ranks in turn.

    Ranks get equally many rows; the missing ones wrap around to the first positions.
    """
    total = -(-n // world) * world
    wrapped = F.sequence(F.col("position"), F.lit(total - 1).cast("bigint"), F.lit(n).cast("bigint"))
    slot = order.select("epoch", "row_idx", F.explode(wrapped).alias("_slot"))
    return slot.select(
        "epoch",
        (F.col("_slot") % world).cast("int").alias("rank"),
        F.expr(f"_slot div {world}").alias("seq"),
        "row_idx",
    )


def assign_batches(sharded: DataFrame, size: int) -> DataFrame:
    """Consecutive groups of ``size``; the last one may be smaller."""
    return sharded.select(
        "epoch",
        "rank",
        F.expr(f"seq div {size}").alias("batch_id"),
        (F.col("seq") % size).cast("int").alias("pos_in_batch"),
        "row_idx",
    )


def skip_batches(manifest: DataFrame, count: int) -> DataFrame:
    """Resume: leave out the first ``count`` batches of every epoch and rank."""
    return manifest.where(F.col("batch_id") >= count)


def batch_sizes(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("epoch", "rank", "batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


def plan_lengths(manifest: DataFrame) -> DataFrame:
    """(epoch, rank, n_batches, total_steps): epochs x ranks rows.

    ``total_steps`` are those of one rank over all epochs.
    """
    first_rows = F.sum(F.when(F.col("pos_in_batch") == 0, 1).otherwise(0))
    per_epoch = manifest.groupBy("epoch", "rank").agg(first_rows.alias("n_batches"))
    return per_epoch.withColumn(
        "total_steps", F.sum("n_batches").over(Window.partitionBy("rank"))
    )


def update_groups(batches: DataFrame, lengths: DataFrame, accumulation: int) -> DataFrame:
    """(epoch, rank, batch_id, update_id, applied): batches that share an optimizer update.

    Steps count from one in each epoch and an update follows each step with
    (step + 1) divisible by ``accumulation``; what is left over joins the next epoch. The
    number of updates before a batch is arithmetic inside its epoch plus a sum over earlier
    epochs, so only the epochs x ranks table is ordered.
    """
    whole = 1 if accumulation == 1 else 0

    def updates_through(step: str):
        return F.expr(f"({step} + 1) div {accumulation}") - whole

    per_rank = Window.partitionBy("rank").orderBy("epoch")
    done = lengths.select(
        "epoch", "rank", updates_through("n_batches").alias("_updates")
    ).select(
        "epoch",
        "rank",
        F.coalesce(
            F.sum("_updates").over(per_rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_earlier"),
        F.sum("_updates").over(Window.partitionBy("rank")).alias("_total"),
    )
    # batch_id is the number of steps already made in the epoch.
    update = (F.col("_earlier") + updates_through("batch_id")).cast("bigint")
    return batches.join(F.broadcast(done), ["epoch", "rank"]).select(
        "epoch",
        "rank",
        "batch_id",
        update.alias("update_id"),
        (update < F.col("_total")).alias("applied"),
    )
