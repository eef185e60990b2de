"""Streaming queries, run to the end of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import RX, query
from millrace.functions.pretokens import pretokens
from millrace.operators.tokenizer import END
from millrace.session import load, scratch_folder
from millrace.streaming import tokens as token_stream
from millrace.streaming import upkeep, versions

MAX_TOKENS = 400


def _token_table(spark: SparkSession, folder: str, end_token: str | None) -> DataFrame:
    """Pre-tokens of each conversation, with an end token behind every answer if asked for.

    ``seq`` orders by turn, then by place in the turn.
    """
    pieces = pretokens(F.col("text"))
    if end_token is not None:
        ends = F.when(F.col("role") == "assistant", F.array(F.lit(end_token)))
        pieces = F.concat(pieces, F.coalesce(ends, F.array().cast("array<string>")))
    rows = load(spark, folder, "conversations").select(
        F.col("conv_id").alias("session_id"), "turn", F.posexplode(pieces).alias("_place", "token")
    )
    last = rows.groupBy("session_id").agg(F.max(F.struct("turn", "_place")).alias("_last"))
    is_last = F.struct("turn", "_place") == F.col("_last")
    return rows.join(last, "session_id").select(
        "session_id",
        # A turn takes 2^32 places, more than an array can have.
        (F.shiftleft(F.col("turn").cast("bigint"), 32) + F.col("_place")).alias("seq"),
        "token",
        is_last.alias("is_last"),
    )


def _through_stream(
    tokens: DataFrame, end_token: str | None = None, max_tokens: int | None = None
) -> DataFrame:
    spark = tokens.sparkSession
    source, sink, state = (scratch_folder(spark) for _ in range(3))
    tokens.write.parquet(source)
    stream = spark.readStream.schema(tokens.schema).parquet(source)
    (
        token_stream.stream_text(stream, end_token, max_tokens, ttl_ms=None)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return token_stream.session_texts(spark.read.schema(token_stream.OUTPUT).parquet(sink))


@query(
    "stream_holdback",
    """SELECT conv_id AS session_id, string_agg(text, '' ORDER BY turn) AS text
       FROM conversations GROUP BY conv_id""",
)
def stream_holdback(spark: SparkSession, folder: str) -> DataFrame:
    return _through_stream(_token_table(spark, folder, None))


#: Up to the end of the first answer, if the tokens last so long.
_STOPPED = f"""WITH ends AS (
    SELECT conv_id, min(turn) FILTER (role = 'assistant') AS answer FROM conversations GROUP BY conv_id)
  SELECT conv_id AS session_id, array_to_string(
    flatten(list(regexp_extract_all(text, {RX}) ORDER BY turn))[1:{MAX_TOKENS}], '') AS text
  FROM conversations JOIN ends USING (conv_id) WHERE answer IS NULL OR turn <= answer
  GROUP BY conv_id"""


@query("stream_stop", _STOPPED)
def stream_stop(spark: SparkSession, folder: str) -> DataFrame:
    return _through_stream(_token_table(spark, folder, END), END, MAX_TOKENS)


@query("batch_stop", _STOPPED)
def batch_stop(spark: SparkSession, folder: str) -> DataFrame:
    return token_stream.batch_text(_token_table(spark, folder, END), END, MAX_TOKENS)


_TOLD = """told AS (
         SELECT 'user_' || user_id AS username, event_id AS seq,
           CASE WHEN event_type IN ('signup', 'view', 'click') THEN 'login' ELSE 'update' END AS kind,
           CASE event_type WHEN 'error' THEN '[]' ELSE props END AS content
         FROM events),
       firsts AS (
         SELECT username, min(seq) AS first_login FROM told WHERE kind = 'login' GROUP BY username),
       lasts AS (
         SELECT told.username, arg_max(content, seq) AS content
         FROM told JOIN firsts ON told.username = firsts.username
         WHERE kind = 'update' AND seq > first_login GROUP BY told.username)"""


@query(
    "stream_transcripts",
    f"""WITH {_TOLD}
       SELECT firsts.username, coalesce(content, '') AS content
       FROM firsts LEFT JOIN lasts ON firsts.username = lasts.username""",
)
def stream_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    told = _told(spark, folder)
    source, table, state = (scratch_folder(spark) for _ in range(3))
    told.repartition(4, "username").write.parquet(source)
    stream = (
        spark.readStream.schema(told.schema).option("maxFilesPerTrigger", "2").parquet(source)
    )
    upkeep.upkeep(stream, table, state).awaitTermination()
    return upkeep.current(spark, table).select("username", "content")


def _told(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return load(spark, folder, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username"),
        F.col("event_id").alias("seq"),
        F.when(kind.isin("signup", "view", "click"), "login").otherwise("update").alias("kind"),
        F.when(kind == "error", "[]").otherwise(F.col("props")).alias("content"),
    )


@query(
    "stream_users",
    f"""WITH {_TOLD}
       SELECT row_number() OVER (ORDER BY first_login, firsts.username) AS id,
              firsts.username, coalesce(content, '') AS content
       FROM firsts LEFT JOIN lasts ON firsts.username = lasts.username""",
)
def stream_users(spark: SparkSession, folder: str) -> DataFrame:
    """All events in three micro-batches by time, merged after the second."""
    told = _told(spark, folder)
    source, table, state = (scratch_folder(spark) for _ in range(3))
    ends = [F.coalesce(end, F.lit(0)) for end in (F.min("seq"), F.max("seq"))]
    low, high = told.agg(*ends).first()
    third = F.least(F.floor((F.col("seq") - low) * 3 / (high - low + 1)), F.lit(2))
    for k in range(3):
        told.where(third == k).write.mode("append").parquet(source)
        stream = spark.readStream.schema(told.schema).parquet(source)
        versions.upkeep(stream, table, state, merge_every=2).awaitTermination()
    return versions.current(spark, table)
