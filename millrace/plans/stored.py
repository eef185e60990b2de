"""Stored indexes: slices and lookups that read only the parts which hold their rows.

An index is a small table (part, first_row, n_rows), one row per part, written once. A part is
a file of lines, or a folder of a table written in key order. Sizes come from the index, so no
slice counts its table, and a part without wanted rows is never opened.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from millrace.plans.positions import (
    BROADCAST_SPLITS,
    COUNTER_MASK,
    index_files,
    running_before,
)
from millrace.plans.slicing import checked_positions, split_bounds
from millrace.session import scratch_folder, written

# Rows of one part of a stored table, about.
PART_ROWS = 100_000
# Up to this many parts a lookup names each; beyond, it reads the range from first to last.
NAMED_PARTS = 1_000


def _numbered(counts: DataFrame) -> DataFrame:
    """First rows of (part, n_rows): one row per part, ordered by part."""
    return counts.select("part", running_before("n_rows", ["part"], []).alias("first_row"), "n_rows")


def place(wanted: DataFrame, parts: DataFrame) -> DataFrame:
    """The part of every position in ``wanted.row_idx``, as (row_idx, part).

    A range join by bins as wide as the average part: an index of P parts has at most 3 P
    entries, however uneven the parts are.
    """
    n, many = parts.agg(F.sum("n_rows"), F.count(F.lit(1))).first()
    width = F.lit(max(1, (n or 0) // max(1, many)))

    def bin_of(row: Column) -> Column:
        return F.floor(row / width)

    last = F.col("first_row") + F.col("n_rows") - 1
    bins = parts.select(
        "part", "first_row", last.alias("_last"),
        F.explode(F.sequence(bin_of(F.col("first_row")), bin_of(last))).alias("_bin"),
    )
    met = wanted.select("row_idx", bin_of(F.col("row_idx")).alias("_bin")).join(bins, "_bin")
    return met.where(F.col("row_idx").between(F.col("first_row"), F.col("_last"))).select(
        "row_idx", "part"
    )


@dataclass(frozen=True)
class Stored:
    """Parts and their index; what a part is and how it is read is up to the kinds below."""

    parts: DataFrame

    def n_rows(self) -> int:
        return self.parts.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]

    def split(self, split: str) -> DataFrame:
        """The rows of ``train[a:b]``, ``[p%]`` or ``[:p%]`` with their positions."""
        return self.slice(*split_bounds(split, self.n_rows()))

    def slice(self, start: int, stop: int) -> DataFrame:
        """Rows at ``start`` up to, not including, ``stop``; positions without rows give none."""
        last = F.col("first_row") + F.col("n_rows")
        held = self.parts.where((F.col("first_row") < stop) & (last > start) & F.lit(start < stop))
        ends = held.agg(
            F.min(F.struct("part", "first_row")).alias("low"),
            F.max(F.struct("part", "first_row")).alias("high"),
        ).first()
        if ends.low is None:
            return self._read(F.lit(False))
        rows = self._read(F.col("part").between(ends.low.part, ends.high.part))
        if ends.low.part == ends.high.part:
            rows = self._inside(rows, ends.low, start, stop)
        return rows.where((F.col("row_idx") >= start) & (F.col("row_idx") < stop))

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """Rows at the positions in ``wanted.row_idx``, as often as they are wanted.

        A null position or one outside the table fails.
        """
        placed = written(place(checked_positions(wanted, self.n_rows()), self.parts))
        named = placed.select("part").distinct().limit(NAMED_PARTS + 1).collect()
        if len(named) <= NAMED_PARTS:
            chosen = F.col("part").isin([r.part for r in named]) if named else F.lit(False)
        else:
            chosen = F.col("part").between(*placed.agg(F.min("part"), F.max("part")).first())
        return self._read(chosen).join(placed.select("row_idx"), "row_idx")

    def _read(self, chosen: Column) -> DataFrame:
        """Rows with ``row_idx`` of the parts for which ``chosen``, a test of ``part``, holds."""
        raise NotImplementedError

    def _inside(self, rows: DataFrame, part: Row, start: int, stop: int) -> DataFrame:
        """``rows`` of one part, cut closer where its files allow it."""
        return rows


@dataclass(frozen=True)
class StoredLines(Stored):
    """The rows of a plain file scan in (file path, line) order; a part is a file.

    The scan's own listing is pruned by path, so other files are not opened. Lines inside the
    chosen files are counted again by split, and a file that has other lines than the index
    says fails.
    """

    scan: DataFrame

    def _read(self, chosen: Column) -> DataFrame:
        path = F.col("_metadata.file_path")
        # The test of ``part`` has to name the scan's own column for the listing to be pruned.
        tagged = self.scan.select("*", path.alias("part")).where(chosen).drop("part")
        return index_files(tagged, parts=self.parts)


@dataclass(frozen=True)
class StoredRows(Stored):
    """A table written in key order, a folder for each part; rows keep their place in it.

    Folders are pruned by name. In a slice of a single part the place is a filter on the
    files too, so that row groups without wanted rows are skipped.
    """

    table: DataFrame

    def _read(self, chosen: Column) -> DataFrame:
        offsets = self.parts.select("part", "first_row")
        if offsets.count() <= BROADCAST_SPLITS:
            offsets = F.broadcast(offsets)
        position = F.col("first_row") + F.col("place")
        met = self.table.where(chosen).join(offsets, "part")
        return met.select(position.alias("row_idx"), "row.*")

    def _inside(self, rows: DataFrame, part: Row, start: int, stop: int) -> DataFrame:
        place = F.col("place")
        near = (place >= start - part.first_row) & (place < stop - part.first_row)
        return self.table.where((F.col("part") == part.part) & near).select(
            (F.lit(part.first_row) + place).alias("row_idx"), "row.*"
        )


def store_lines(scan: DataFrame, path: str | None = None) -> StoredLines:
    """Index a plain file scan: one pass that reads no column.

    The index is written to ``path``, or to a scratch folder. A later session opens it with
    ``StoredLines(spark.read.parquet(path), scan)``. Files without rows have no part.
    """
    counts = scan.select(F.col("_metadata.file_path").alias("part")).groupBy("part")
    return StoredLines(_kept(counts.agg(F.count(F.lit(1)).alias("n_rows")), path), scan)


def store_rows(df: DataFrame, *keys: str, part_rows: int = PART_ROWS) -> StoredRows:
    """Write ``df`` in key order with an index; together the keys must be unique.

    The number of parts follows the number of rows. Columns may have any names but
    ``row_idx``; an empty table has no part.
    """
    if "row_idx" in df.columns:
        raise ValueError("row_idx is the name of the position")
    spark = df.sparkSession
    parts = max(1, -(-df.count() // part_rows))
    path = scratch_folder(spark)
    (
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select(
            F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(COUNTER_MASK).alias("place"),
        )
        .write.partitionBy("part")
        .parquet(path)
    )
    schema = StructType().add("row", df.schema).add("place", LongType()).add("part", IntegerType())
    table = spark.read.schema(schema).parquet(path)
    counts = table.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))
    return StoredRows(_kept(counts, None), table)


def _kept(counts: DataFrame, path: str | None) -> DataFrame:
    numbered = _numbered(counts)
    if path is None:
        return written(numbered)
    numbered.write.parquet(path)
    return numbered.sparkSession.read.schema(numbered.schema).parquet(path)
