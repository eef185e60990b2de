"""The sample sink: training samples laid out in the order they are consumed."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_samples(samples: DataFrame, path: str, files: int | None = None) -> None:
    """Parquet in (epoch, rank, batch, position) order, whole batches readable in sequence."""
    order = ["epoch", "rank", "batch_id", "pos_in_batch"]
    spark = samples.sparkSession
    parts = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        samples.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .parquet(path)
    )
