"""The transcript table: stored text, logins, updates, keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import query, turns
from millrace.operators import transcripts
from millrace.session import load
from millrace.sources.transcripts import parse_transcripts, serialize_transcripts

_STORED = """
stored AS (
  SELECT conv_id + 1 AS id, 'user_' || conv_id AS username,
    '[' || string_agg('{"role": ' || to_json(role) || ', "content": ' || to_json(text) || '}',
      ', ' ORDER BY turn) || ']' AS content
  FROM conversations GROUP BY conv_id)"""
_LOGINS = "logins AS (SELECT 'user_' || user_id AS username, event_id AS seq FROM events)"


def _named_turns(spark: SparkSession, folder: str) -> DataFrame:
    return turns(spark, folder).withColumn("username", F.concat(F.lit("user_"), F.col("conv_id").cast("string")))


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation as the transcript of one user."""
    texts = serialize_transcripts(_named_turns(spark, folder))
    number = F.substring_index("username", "_", -1).cast("bigint")
    return texts.select((number + 1).alias("id"), "username", "content")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username"),
        F.col("event_id").alias("seq"),
        "event_type",
        "props",
    )


def logins(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select("username", "seq")


@query(
    "transcript_serialize",
    f"WITH {_STORED} SELECT username, content FROM stored",
)
def transcript_serialize(spark: SparkSession, folder: str) -> DataFrame:
    return serialize_transcripts(_named_turns(spark, folder))


@query(
    "transcript_parse",
    """SELECT 'user_' || conv_id AS username, turn,
              CASE role WHEN 'assistant' THEN 'bot' ELSE role END AS sender, text
       FROM conversations WHERE role IN ('user', 'assistant')""",
)
def transcript_parse(spark: SparkSession, folder: str) -> DataFrame:
    # Beside them stand texts that hold no message list and so give no rows.
    table = stored(spark, folder)
    broken = F.explode(F.array(F.lit("not json"), F.lit(""), F.lit('{"a":1}')))
    return parse_transcripts(table.unionByName(table.withColumn("content", broken)))


@query(
    "ensure_users",
    f"""WITH {_STORED}, {_LOGINS}, newcomers AS (
          SELECT username, min(seq) AS first FROM logins
          WHERE username NOT IN (SELECT username FROM stored) GROUP BY username)
        SELECT id, username, content FROM stored
        UNION ALL
        SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY first, username), username, ''
        FROM newcomers""",
)
def ensure_users(spark: SparkSession, folder: str) -> DataFrame:
    return transcripts.ensure_users(stored(spark, folder), logins(spark, folder))


@query(
    "login_answers",
    f"""WITH {_STORED}, {_LOGINS}
        SELECT logins.username, seq, coalesce(content, '') AS content
        FROM logins LEFT JOIN stored ON logins.username = stored.username""",
)
def login_answers(spark: SparkSession, folder: str) -> DataFrame:
    return transcripts.login_answers(stored(spark, folder), logins(spark, folder))


@query(
    "apply_updates",
    f"""WITH {_STORED}, updates AS (
          SELECT 'user_' || user_id AS username, arg_max(props, event_id) AS props
          FROM events WHERE event_type = 'purchase' GROUP BY user_id)
        SELECT id, stored.username, coalesce(props, content) AS content
        FROM stored LEFT JOIN updates ON stored.username = updates.username""",
)
def apply_updates(spark: SparkSession, folder: str) -> DataFrame:
    updates = _events(spark, folder).where(F.col("event_type") == "purchase")
    return transcripts.apply_updates(
        stored(spark, folder), updates.withColumnRenamed("props", "content")
    )


@query(
    "update_reports",
    """SELECT 'user_' || user_id AS username, event_id AS seq, 'updated' AS status
       FROM events WHERE event_type = 'purchase'""",
)
def update_reports(spark: SparkSession, folder: str) -> DataFrame:
    return transcripts.update_reports(
        _events(spark, folder).where(F.col("event_type") == "purchase")
    )


@query(
    "clear_transcript",
    f"""WITH {_STORED} SELECT id, username, CASE WHEN username IN (
          SELECT 'user_' || user_id FROM events WHERE event_type = 'error')
          THEN '[]' ELSE content END AS content FROM stored""",
)
def clear_transcript(spark: SparkSession, folder: str) -> DataFrame:
    cleared = _events(spark, folder).where(F.col("event_type") == "error")
    return transcripts.clear_transcripts(stored(spark, folder), cleared)


@query(
    "unique_key",
    """SELECT 'user_' || user_id AS username, count(*) AS n_rows FROM events
       GROUP BY user_id HAVING count(*) > 1""",
)
def unique_key(spark: SparkSession, folder: str) -> DataFrame:
    return transcripts.key_violations(logins(spark, folder))
