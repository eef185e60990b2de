"""Ordering inside groups when one group may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import written


def _before(column: str, within: list[str], order: list[Column | str]) -> Column:
    """Sum of a column over the earlier rows of the window."""
    rows = Window.partitionBy(*within).orderBy(*order)
    return F.coalesce(F.sum(column).over(rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def rank_with_sums(
    df: DataFrame,
    keys: list[str],
    value: str,
    tie: str,
    sums: Mapping[str, str] | None = None,
    rank: str = "rank",
) -> DataFrame:
    """Rank rows of each group by ``value`` descending, nulls last, then ``tie`` ascending.

    ``sums`` maps a new column to the column whose sum over the better rows it gets.

    Groups of any size take the same way. Rows are range-partitioned by (keys, value, tie),
    so that a large group lies in many partitions, and written once, as range bounds are
    sampled anew in every plan. Ranks and sums inside a partition's share of a group are
    added to those of its earlier shares, of which there is one row each.
    """
    sums = dict(sums or {})
    order = [F.desc_nulls_last(value), F.asc(tie)]
    shared = written(
        df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    )
    place = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order))
    inside = shared.withColumns(
        {rank: place.cast("bigint")}
        | {new: _before(source, ["_part", *keys], order) for new, source in sums.items()}
    )
    shares = shared.groupBy("_part", *keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(f"_sum_{new}") for new, s in sums.items()]
    )
    earlier = shares.select(
        F.col("_part").alias("_own"),
        *[F.col(key).alias(f"_key_{k}") for k, key in enumerate(keys)],
        _before("_n", keys, ["_part"]).alias("_rank_before"),
        *[_before(f"_sum_{new}", keys, ["_part"]).alias(f"_before_{new}") for new in sums],
    )
    same = F.col("_part") == F.col("_own")
    for k, key in enumerate(keys):
        same &= F.col(key).eqNullSafe(F.col(f"_key_{k}"))
    return inside.join(earlier, same).select(
        *df.columns,
        (F.col(rank) + F.col("_rank_before")).alias(rank),
        *[(F.col(new) + F.col(f"_before_{new}")).alias(new) for new in sums],
    )
