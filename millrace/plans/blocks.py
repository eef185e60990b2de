"""Neighbour windows over long sequences, cut into blocks that overlap by a few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096


def with_blocks(
    df: DataFrame, position: str, before: int = 0, after: int = 0, size: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``_block`` and ``_own``, copying rows into every block that needs to see them.

    ``position`` is dense within a sequence. A window over (sequence, ``_block``) that looks
    ``before`` rows back and ``after`` rows ahead is then exact on the rows with ``_own``,
    and no task holds more than one block, however long a single sequence is.
    """
    at = F.col(position)
    first = F.floor((at - after) / size)
    last = F.floor((at + before) / size)
    home = F.floor(at / size)
    blocks = F.explode(F.sequence(F.greatest(first, F.lit(0)), last))
    return df.select("*", blocks.alias("_block")).withColumn("_own", F.col("_block") == home)
