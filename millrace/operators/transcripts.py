"""Upkeep of the transcript table (id, username, content)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.positions import index_by_key


def ensure_users(table: DataFrame, logins: DataFrame) -> DataFrame:
    """The table with an empty row for each new login; new ids go up in order of first login.

    ``logins`` has (username, seq). Repeated logins shrink to one row before the exchange.
    A login without a name fails.
    """
    name = F.coalesce("username", F.raise_error(F.lit("a login without a username")).cast("string"))
    first = logins.withColumn("username", name).groupBy("username").agg(F.min("seq").alias("_first"))
    return table.unionByName(assign_ids(table, first.join(table, "username", "left_anti")))


def assign_ids(table: DataFrame, newcomers: DataFrame) -> DataFrame:
    """Rows for ``newcomers`` (username, _first) with ids above all existing ones."""
    top = table.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).scalar()
    numbered = index_by_key(newcomers, "_first", "username", name="_nth")
    return numbered.select(
        (top + F.col("_nth") + 1).alias("id"), "username", F.lit("").alias("content")
    )


def login_answers(table: DataFrame, logins: DataFrame) -> DataFrame:
    """(username, seq, content): what each login is answered with; new users get ''."""
    return logins.join(table.select("username", "content"), "username", "left").select(
        "username", "seq", F.coalesce("content", F.lit("")).alias("content")
    )


def apply_updates(table: DataFrame, updates: DataFrame) -> DataFrame:
    """Overwrite the content of existing users with their last update.

    ``updates`` has (username, seq, content); unknown users change nothing.
    """
    last = updates.groupBy("username").agg(
        F.max(F.struct("seq", "content"))["content"].alias("_new")
    )
    return table.join(last, "username", "left").select(
        "id", "username", F.coalesce("_new", "content").alias("content")
    )


def update_reports(updates: DataFrame) -> DataFrame:
    """Every update is reported as done, whether or not the user exists."""
    return updates.select("username", "seq", F.lit("updated").alias("status"))


def clear_transcripts(table: DataFrame, cleared: DataFrame) -> DataFrame:
    """Set the transcripts of ``cleared`` (username, seq) to an empty list; rows stay."""
    return apply_updates(
        table, cleared.select("username", "seq", F.lit("[]").alias("content"))
    )


def key_violations(table: DataFrame) -> DataFrame:
    """(username, n_rows): missing usernames and those that occur more than once."""
    counts = table.groupBy("username").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where((F.col("n_rows") > 1) | F.col("username").isNull())
