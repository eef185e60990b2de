"""Row positions without a global window: local counters plus a small offset table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import written

# monotonically_increasing_id() keeps the row counter in its low 33 bits.
COUNTER_MASK = (1 << 33) - 1
# Split tables up to this many rows (about 100 MB) are broadcast, larger ones shuffled.
BROADCAST_SPLITS = 1_000_000
# Rows of a permutation's bucket, at most about.
_BUCKET_ROWS = 100_000


def _pin_splits(spark: SparkSession) -> None:
    """Keep split boundaries the same when executors come or go between two passes."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set(
            "spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism)
        )


def running_before(value: str, order: list[str], within: list[str]) -> Column:
    """Sum of ``value`` over the rows before the current one; for small tables only."""
    window = Window.partitionBy(*within).orderBy(*order)
    return F.coalesce(
        F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )


def index_files(
    scan: DataFrame, name: str = "row_idx", parts: DataFrame | None = None
) -> DataFrame:
    """Number the rows of a plain file scan from zero in (file path, line) order.

    ``parts`` (part, first_row, n_rows), one row per file, tells where each file begins if the
    scan holds only some of the files; one that has other rows by now fails.

    Pass one counts rows per file split and reads no column; pass two is the scan itself
    with a narrow join to the split table. Both see the same splits: the scan is one file
    listing and the split size is pinned. A mismatch fails instead of misnumbering.
    """
    spark = scan.sparkSession
    _pin_splits(spark)
    tagged = scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_seen"),
    )
    splits = written(
        tagged.groupBy("_file", "_start").agg(
            F.count(F.lit(1)).alias("_rows"), F.min("_seen").alias("_first")
        )
    )
    # One row per file: the listing the driver already holds.
    files = splits.groupBy("_file").agg(F.sum("_rows").alias("_in_file"))
    if parts is None:
        files = files.select("_file", running_before("_in_file", ["_file"], []).alias("_base"))
    else:
        known = parts.select(F.col("part").alias("_file"), "first_row", "n_rows")
        changed = F.concat(F.lit("file changed since it was indexed: "), F.col("_file"))
        base = F.when(F.col("_in_file") == F.col("n_rows"), F.col("first_row")).otherwise(
            F.raise_error(changed).cast("bigint")
        )
        files = files.join(known, "_file", "left").select("_file", base.alias("_base"))
    offsets = splits.withColumn(
        "_before", running_before("_rows", ["_start"], ["_file"])
    ).join(files, "_file")
    offsets = offsets.select(
        "_file", "_start", "_rows", "_first", (F.col("_base") + F.col("_before")).alias("_base")
    )
    if splits.count() <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    local = F.col("_seen") - F.col("_first")
    fits = local.between(F.lit(0), F.col("_rows") - 1)
    position = F.when(fits, F.col("_base") + local).otherwise(
        F.raise_error(F.lit("file splits changed between the two passes")).cast("bigint")
    )
    return tagged.join(offsets, ["_file", "_start"], "left").select(
        position.alias(name), *scan.columns
    )


def index_by_key(
    df: DataFrame, *keys: str, name: str = "row_idx", partitions: int | None = None
) -> DataFrame:
    """Number rows from zero in key order; together the keys must be unique.

    Range partitioning samples its bounds anew in every plan, so partition numbers and
    local counters are written out once and only then turned into positions. The offset
    table has one row per partition.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(COUNTER_MASK).alias("_local"),
        )
    )
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select("_part", running_before("_rows", ["_part"], []).alias("_base"))
    return ranged.join(F.broadcast(offsets), "_part").select(
        (F.col("_base") + F.col("_local")).alias(name), *df.columns
    )


def hash_order(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[part.cast("string") for part in parts]))


def permute(
    rows: DataFrame, n: int, seed: int, epochs: int, name: str = "position"
) -> DataFrame:
    """A fresh reproducible order of ``row_idx`` for each epoch.

    Rows are ordered by an MD5 of (seed, epoch, row). Its leading digits cut every epoch
    into evenly filled buckets, so no range sampling and no epoch-wide sort is needed; the
    offset table has epochs x 16^digits rows.
    """
    digits = 1
    while n > _BUCKET_ROWS * 16**digits:
        digits += 1
    keyed = (
        rows.select("row_idx", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
        .withColumn("_hash", hash_order(F.lit(seed), F.col("epoch"), F.col("row_idx")))
        .withColumn("_bucket", F.substring("_hash", 1, digits))
    )
    counts = keyed.groupBy("epoch", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select(
        "epoch", "_bucket", running_before("_rows", ["_bucket"], ["epoch"]).alias("_base")
    )
    inside = Window.partitionBy("epoch", "_bucket").orderBy("_hash", "row_idx")
    return (
        keyed.withColumn("_local", F.row_number().over(inside) - 1)
        .join(offsets, ["epoch", "_bucket"])
        .select("epoch", (F.col("_base") + F.col("_local")).alias(name), "row_idx")
    )
