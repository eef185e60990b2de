"""Slices and lookups over tables that carry a zero-based ``row_idx``."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def split_bounds(split: str, n: int) -> tuple[int, int]:
    """Resolve ``train[a:b]``, ``[p%]`` or ``[:p%]`` to a half-open range inside ``0..n``."""
    found = re.search(r"\[(.+)\]", split)
    if found is None:
        return 0, n
    body = found.group(1).strip()
    if body.endswith("%"):
        number = body[:-1].removeprefix(":")
        if ":" in number:
            raise ValueError(f"a percentage takes no start: {split!r}")
        percent = float(number)
        if not 0 <= percent <= 100:
            raise ValueError(f"percentage outside 0..100: {split!r}")
        return 0, int(n * percent / 100)
    if "%" in body:
        raise ValueError(f"misplaced percent sign: {split!r}")
    if ":" not in body:
        raise ValueError(f"a slice needs a colon: {split!r}")
    # Anything after a second colon (a step) has no effect.
    first, last = body.split(":")[:2]
    start, stop, _ = slice(
        int(first) if first else None, int(last) if last else None
    ).indices(n)
    return start, max(start, stop)


def take_split(indexed: DataFrame, split: str, n: int | None = None) -> DataFrame:
    total = indexed.count() if n is None else n
    start, stop = split_bounds(split, total)
    return indexed.where((F.col("row_idx") >= start) & (F.col("row_idx") < stop))


def take_head(df: DataFrame, n: int, *keys: str, name: str = "row_idx") -> DataFrame:
    """The first ``n`` rows in key order with their positions: a top-n, no sort of the table."""
    order = Window.orderBy(*keys)
    first = df.orderBy(*keys).limit(n)
    return first.withColumn(name, F.row_number().over(order).cast("bigint") - 1)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def checked_positions(wanted: DataFrame, n: int) -> DataFrame:
    """``wanted.row_idx``; a null position or one outside ``0..n - 1`` fails."""
    row = F.col("row_idx").cast("bigint")
    shown = F.coalesce(row.cast("string"), F.lit("null"))
    wrong = F.raise_error(F.concat(F.lit("row index out of range: "), shown))
    inside = row.between(0, n - 1)
    return wanted.select(F.when(inside, row).otherwise(wrong.cast("bigint")).alias("row_idx"))


def lookup(indexed: DataFrame, wanted: DataFrame, n: int | None = None) -> DataFrame:
    """Rows at the positions in ``wanted.row_idx``; a position outside the table fails."""
    total = indexed.count() if n is None else n
    return indexed.join(checked_positions(wanted, total), "row_idx")
