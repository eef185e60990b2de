"""What the operators of this subpackage share: their registry and Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Rows that a Python task works on at a time; a very long text counts for itself.
SLICE_ROWS = 128


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def tokenizer_file(name: str) -> str:
    return public_tokenizers.path(name)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Short pieces of the batches, so that output never builds up in a task."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def id_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
