"""Registration and the tables that several queries share."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.pretokens import PRETOKEN
from millrace.operators.tokenizer import PLAIN_SPECIALS, VOCAB_SIZE, Tokenizer, build_vocab
from millrace.plans.positions import index_by_key
from millrace.session import load, scratch_folder, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(load(spark, folder, "documents", "doc_id", "text"))


def turns(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "conversations").withColumnRenamed("text", "content")


def indexed_documents(spark: SparkSession, folder: str) -> DataFrame:
    return index_by_key(load(spark, folder, "documents", "doc_id"), "doc_id")


@lru_cache(maxsize=16)
def _tokenizer(_application: str, spark: SparkSession, folder: str, name: str) -> Tokenizer:
    """Each vocabulary is counted and written once per application, like any other table."""
    return Tokenizer(build_vocab(spread(load(spark, folder, name, "text"))))


def document_tokenizer(spark: SparkSession, folder: str) -> Tokenizer:
    return _tokenizer(spark.sparkContext.applicationId, spark, folder, "documents")


def chat_tokenizer(spark: SparkSession, folder: str) -> Tokenizer:
    return _tokenizer(spark.sparkContext.applicationId, spark, folder, "conversations")


def lines_folder(rows: DataFrame, line: Column, key: str = "doc_id") -> str:
    """Write one JSON line per row, in key order over all files."""
    spark = rows.sparkSession
    path = scratch_folder(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.select(key, line.alias("value"))
        .repartitionByRange(parts, key)
        .sortWithinPartitions(key)
        .select("value")
        .write.text(path)
    )
    return path


def joined(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


# --- SQL pieces --------------------------------------------------------------------------

_RX = PRETOKEN.replace("\\t", "\t").replace("\\r", "\r").replace("\\n", "\n")


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


RX = _quote(_RX)
N_FIXED = len(PLAIN_SPECIALS) + 256
IN_SPECIALS = ", ".join(_quote(t) for t in PLAIN_SPECIALS)


def vocab_sql(table: str, column: str = "text") -> str:
    """CTEs up to ``vocab(token, token_id, special)``."""
    specials = " UNION ALL ".join(
        f"SELECT {_quote(t)} AS token, {i} AS token_id, true AS special"
        for i, t in enumerate(PLAIN_SPECIALS)
    )
    return f"""
counted AS (
  SELECT token, count(*) AS n
  FROM (SELECT unnest(regexp_extract_all({column}, {RX})) AS token FROM {table})
  WHERE token NOT IN ({IN_SPECIALS}) GROUP BY token),
words AS (
  SELECT token, n FROM counted ORDER BY n DESC, token LIMIT {VOCAB_SIZE - N_FIXED}),
vocab AS (
  {specials}
  UNION ALL SELECT '<0x' || upper(printf('%02x', b)) || '>', (b + {len(PLAIN_SPECIALS)})::INT, false
  FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT token, (row_number() OVER (ORDER BY n DESC, token) + {N_FIXED - 1})::INT, false
  FROM words)"""


def encode_sql(source: str, key: str, column: str = "text") -> str:
    """CTEs up to ``encoded(key, ids)`` from ``source`` and ``vocab``."""
    return f"""
cut AS (
  SELECT {key}, unnest(regexp_extract_all({column}, {RX})) AS token,
         generate_subscripts(regexp_extract_all({column}, {RX}), 1) AS nth
  FROM {source}),
named AS (
  SELECT token, token_id FROM vocab WHERE token_id < {len(PLAIN_SPECIALS)} OR token_id >= {N_FIXED}),
known AS (
  SELECT cut.{key}, cut.nth,
         CASE WHEN named.token_id IS NOT NULL THEN [named.token_id]
         ELSE list_transform(range(octet_length(encode(cut.token))), lambda i:
           (('0x' || substr(hex(encode(cut.token)), 2 * i + 1, 2))::INT + {len(PLAIN_SPECIALS)})::INT)
         END AS part
  FROM cut LEFT JOIN named ON cut.token = named.token),
encoded AS (
  SELECT s.{key}, coalesce(flatten(k.parts), []::INT[]) AS ids
  FROM {source} s LEFT JOIN (
    SELECT {key}, list(part ORDER BY nth) AS parts FROM known GROUP BY {key}) k
  ON s.{key} = k.{key})"""
