"""Benchmark decontamination as a prefix-filtered join of item windows with documents."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import query
from millrace.session import load, written

WINDOW = 13
SHINGLE = 3
#: Item shingles that are broadcast at a time; larger benchmarks take several passes.
BROADCAST_SHINGLES = 500_000
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The key of the one row that every document sends through the join for itself.
_SELF = -1


def words_of(text: Column) -> Column:
    """Runs of digits, letters and non-ASCII characters, with A-Z (and only it) in lower case."""
    text = F.coalesce(text, F.lit(""))
    plain = F.char_length(text) == F.octet_length(text)
    lower = F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(lower, _BREAKS), "")


def _key(words: str, place: Column, length: int) -> Column:
    """Hash of the shingle at ``place``; the words decide in the end, so it need not be unique."""
    return F.xxhash64(F.lit(length), *[F.get(words, place + i) for i in range(length)])


def _with_keys(rows: DataFrame, lengths: list[int], more: Column | None = None) -> DataFrame:
    """A row for each shingle of ``words``: its place ``p`` and key ``h``.

    With ``more``, a row of that key follows behind the last place.
    """
    placed = rows.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("n"))))
    keys = [
        F.when(F.col("p") + length <= F.col("n"), _key("words", F.col("p"), length))
        for length in lengths
    ]
    if more is not None:
        keys[0] = F.when(F.col("p") == F.col("n"), more).otherwise(keys[0])
    key = keys[0] if len(keys) == 1 else F.explode(F.array(*keys))
    return placed.withColumn("h", key).where(F.col("h").isNotNull())


def _prefixes(items: DataFrame, counts: DataFrame, window: int, shingle: int) -> DataFrame:
    """The rarest shingle of every window of an item, with the windows that share it.

    Shingles are ordered by how often the documents hold them. A window can only occur
    where its rarest shingle does, so that one token is its necessary prefix. A shingle
    is the rarest of adjacent windows, which become one row: windows ``lo`` to ``hi`` of
    length ``len``, the place ``off`` of the shingle, and the item's words from ``lo`` on.
    """
    length = F.least(F.col("n"), F.lit(window))
    own = F.least(F.col("n"), F.lit(shingle))
    placed = items.where("n > 0").select(
        "row", "item_id", "words", "n", length.alias("len"), own.alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("n") - own)).alias("off"),
    )
    keyed = placed.withColumn(
        "h",
        F.coalesce(
            *[F.when(F.col("own") == k, _key("words", F.col("off"), k)) for k in range(1, shingle + 1)]
        ),
    )
    rare = keyed.join(counts, "h", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    first = F.greatest(F.lit(0), F.col("off") + F.col("own") - F.col("len"))
    last = F.least(F.col("off"), F.col("n") - F.col("len"))
    windows = rare.withColumn("w", F.explode(F.sequence(first, last)))
    best = windows.groupBy("row", "w").agg(
        F.min(F.struct("times", "h", "off")).alias("best"),
        F.first("item_id").alias("item_id"),
        F.first("words").alias("words"),
        F.first("len").alias("len"),
    )
    # A shingle that no document holds takes its windows out.
    return (
        best.where("best.times > 0")
        .groupBy("row", F.col("best.off").alias("off"), F.col("best.h").alias("h"))
        .agg(
            F.min("w").alias("lo"),
            F.max("w").alias("hi"),
            F.first("item_id").alias("item_id"),
            F.first("words").alias("words"),
            F.first("len").alias("len"),
        )
        .select(
            "h", "off", "lo", "hi", "len", "item_id",
            F.slice("words", F.col("lo") + 1, F.col("hi") - F.col("lo") + F.col("len")).alias("part"),
        )
    )


def _occurrences(docs: DataFrame, lengths: list[int], prefixes: DataFrame) -> DataFrame:
    """A row per document for itself, and one per shingle at which windows do occur.

    All of it is one narrow pass: positions are exploded, looked up in the broadcast
    prefixes, and verified against the words that are still at hand.
    """
    own = prefixes.sparkSession.range(1).select(
        F.lit(_SELF).cast("bigint").alias("h"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in prefixes.dtypes[1:]],
    )
    found = _with_keys(docs, lengths, F.lit(_SELF).cast("bigint")).join(
        F.broadcast(prefixes.unionByName(own)), "h"
    )
    is_doc = F.col("p") == F.col("n")
    # Where window w of the item would start in the document; it must lie inside.
    shift = F.col("p") - F.col("off")
    lo = F.greatest(F.col("lo"), -shift)
    hi = F.least(F.col("hi"), F.col("n") - F.col("len") - shift)
    found = found.where((is_doc & F.col("off").isNull()) | (~is_doc & (lo <= hi)))
    # Only the words around a place leave the pass over its document.
    found = found.select(
        "doc", "hash", "item_id", "len", F.when(is_doc, F.col("n")).alias("n"),
        (shift + lo).alias("at"), (hi - lo).alias("more"),
        F.slice("part", lo - F.col("lo") + 1, hi - lo + F.col("len")).alias("part"),
        F.when(~is_doc, F.slice("words", shift + lo + 1, hi - lo + F.col("len"))).alias("near"),
    )
    alike = F.filter(
        F.sequence(F.lit(0), F.col("more")),
        lambda w: F.slice("near", w + 1, F.col("len")) == F.slice("part", w + 1, F.col("len")),
    )
    # All windows at once where the whole stretch is equal, as it mostly is.
    good = F.when(F.col("near") == F.col("part"), F.sequence(F.lit(0), F.col("more"))).otherwise(alike)
    starts = F.when(F.col("n").isNull(), F.transform(good, lambda w: w + F.col("at")))
    # A filter on the result would move into the join and end its generated code there.
    return found.select("doc", "hash", "n", "item_id", "len", starts.alias("starts"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    least_share: int = 20,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """How much of each document lies inside passages of the benchmark items.

    Returns a row per document row: ``key, text_hash, n_words, n_hit, n_items,
    items_sha256, contaminated``. A window is ``window`` consecutive item words, or a whole
    shorter item; a document word inside any occurrence of a window is hit; a document is
    contaminated if any word is hit and at least one in ``least_share`` is. Null texts have
    no words, items without words or without an id are no items, equal ids are one item.
    Rows of equal key and text are judged once and returned as often as they came; null
    keys are keys. Other columns are not read. Items are joined in blocks of at most
    ``BROADCAST_SHINGLES`` shingles, each broadcast to a pass over the documents; without
    items one pass remains.
    """
    placed = docs.select(
        F.col(key).alias("doc"), F.xxhash64(text).alias("hash"), words_of(F.col(text)).alias("words")
    ).select("*", F.size("words").alias("n"))
    known = written(
        items.where(F.col(item_key).isNotNull())
        .select(F.col(item_key).cast("string").alias("item_id"), words_of(F.col(item_text)).alias("words"))
        .select("item_id", "words", F.size("words").alias("n"), F.monotonically_increasing_id().alias("row"))
        .where("n > 0")
    )
    sizes = known.agg(F.sum("n").alias("n"), F.collect_set(F.least("n", F.lit(shingle))).alias("k"))
    total, lengths = sizes.first()
    lengths = sorted(lengths) or [shingle]
    blocks = max(1, -(-(total or 0) // BROADCAST_SHINGLES))
    rows = None
    for block in range(blocks):
        part = known.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block) if blocks > 1 else known
        wanted = _with_keys(part, lengths).select("h").distinct()
        counts = (
            _with_keys(placed.drop("doc", "hash"), lengths)
            .select("h")
            .join(F.broadcast(wanted), "h")
            .groupBy("h")
            .agg(F.count(F.lit(1)).alias("times"))
        )
        prefixes = written(_prefixes(part, counts, window, shingle))
        found = _occurrences(placed, lengths, prefixes)
        if block:
            found = found.where("n IS NULL")
        rows = found if rows is None else rows.unionByName(found)
    hit = F.when(F.size("starts") > 0, F.struct("item_id", "len", "starts"))
    judged = rows.groupBy("doc", "hash").agg(
        F.max("n").alias("n_words"), F.count("n").alias("copies"), F.collect_list(hit).alias("hits")
    )
    places = F.flatten(
        F.transform(
            "hits",
            lambda h: F.flatten(
                F.transform(h["starts"], lambda s: F.sequence(s, s + h["len"] - 1))
            ),
        )
    )
    ids = F.array_sort(F.array_distinct(F.col("hits.item_id")))
    return (
        judged.select(
            F.col("doc").alias(key),
            F.col("hash").alias("text_hash"),
            F.col("n_words").cast("bigint").alias("n_words"),
            F.size(F.array_distinct(places)).cast("bigint").alias("n_hit"),
            ids.alias("items"),
            F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_copy"),
        )
        .select(
            key, "text_hash", "n_words", "n_hit",
            F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (least_share * F.col("n_hit") >= F.col("n_words"))).alias(
                "contaminated"
            ),
        )
    )


_LETTERS = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
_SQL = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
item_place AS (
  SELECT item_id, words, least(len(words), {WINDOW}) AS len,
         unnest(range(0, greatest(len(words) - {WINDOW}, 0) + 1)) AS w
  FROM item WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, len, array_to_string(words[w + 1 : w + len], ' ') AS gram
  FROM item_place),
doc_place AS (
  SELECT doc_id, words, len, unnest(range(0, len(words) - len + 1)) AS p
  FROM doc, (SELECT DISTINCT len FROM windows)),
hits AS (
  SELECT doc_id, p, d.len, item_id
  FROM (SELECT doc_id, p, len, array_to_string(words[p + 1 : p + len], ' ') AS gram
        FROM doc_place WHERE p + len <= len(words)) d
  JOIN windows USING (gram) WHERE windows.len = d.len),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + len)) AS place FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


@query("op8_decontamination", _SQL)
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside 13-word windows of the benchmark's items."""
    docs = load(spark, folder, "documents", "doc_id", "text")
    items = load(spark, folder, "benchmark", "item_id", "text")
    return contamination(docs, items).drop("text_hash")
