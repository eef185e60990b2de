"""URL filters: captures against dated list entries that were active at fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.base import query
from millrace.session import load

#: Days of a bucket that validity intervals and captures meet in.
BUCKET_DAYS = 30
_BUCKET_SECONDS = BUCKET_DAYS * 86_400
_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^/?#\]]*\]|[^/?#:@]+)"


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and a closing dot; null if there is none.

    An IPv6 address keeps its brackets.
    """
    host = F.regexp_extract(F.lower(url), _HOST, 1)
    return F.nullif(F.rtrim(host, F.lit(".")), F.lit(""))


def path_of(url: Column) -> Column:
    """Path without query and fragment, and without slashes at its ends."""
    return F.trim(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("/"))


def validity(entries: DataFrame) -> DataFrame:
    """Intervals from dated entries: ``list_id, kind, pattern, action, valid_from, valid_to``.

    An entry is ``list_id, kind`` (``domain``, ``host`` or ``prefix``), ``pattern, action``
    (``block``, ``allow`` or ``remove``) and ``at``. It holds from its time up to the next
    entry of its list, kind and pattern; the last one has no end. Of entries at the same
    time a removal comes last, and ``allow`` after ``block``. Entries with a null stay out.
    """
    own = entries.select("list_id", "kind", "pattern", "action", "at").dropna().distinct()
    order = F.when(F.col("action") == "remove", 2).when(F.col("action") == "allow", 1).otherwise(0)
    dated = Window.partitionBy("list_id", "kind", "pattern").orderBy("at", order)
    return (
        own.withColumn("valid_to", F.lead("at").over(dated))
        .where("action <> 'remove' AND (valid_to IS NULL OR valid_to > at)")
        .withColumnRenamed("at", "valid_from")
    )


def _bucket(time: Column) -> Column:
    return F.floor(F.unix_timestamp(time) / _BUCKET_SECONDS)


def _keys(captures: DataFrame, domain_depth: int, prefix_depth: int) -> DataFrame:
    """A row for each domain, host and path prefix of a URL that a list could name.

    No entry is deeper than the two depths, so nothing deeper can match.
    """
    labels = F.split("_host", "[.]")
    segments = F.filter(F.split(F.col("_path"), "/"), lambda s: s != "")
    domains = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(domain_depth, 1)))),
        lambda k: F.struct(
            F.lit("domain").alias("kind"),
            F.array_join(F.slice(labels, F.size(labels) - k + 1, k), ".").alias("pattern"),
            k.alias("depth"),
        ),
    )
    host = F.array(
        F.struct(F.lit("host").alias("kind"), F.col("_host").alias("pattern"), F.size(labels).alias("depth"))
    )
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(segments), F.lit(prefix_depth))),
        lambda k: F.struct(
            F.lit("prefix").alias("kind"),
            F.concat_ws("/", F.col("_host"), F.slice(segments, 1, k)).alias("pattern"),
            k.alias("depth"),
        ),
    )
    named = captures.where(F.col("_host").isNotNull() & F.col("fetched").isNotNull())
    return named.select(
        "page_id", "url", "fetched", F.inline(F.concat(domains, host, F.filter(prefixes, lambda p: p["depth"] > 0)))
    )


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Judge every capture (``page_id, url, fetched``) by the entries active when it was fetched.

    Returns ``page_id, url, fetched, n_active, decision, list_id, kind, pattern``: the number
    of active entries that match, and the deciding one. A prefix decides before a host,
    a host before a domain, a longer pattern before a shorter one, ``allow`` before
    ``block``, and the smaller list id in the end. ``decision`` is ``drop`` if that entry
    blocks, else ``keep``; captures without a match, URL, host or time are kept. Equal rows
    are judged once and each comes back. Other columns are not read; an empty list keeps
    everything.

    The as-of join is an equi-join on pattern and time bucket with the bounds of the
    interval as its condition: intervals of a list and pattern do not overlap, so that at
    most one is met. Buckets spread the captures of a frequent host, and the skew join splits
    what is left.
    """
    every = captures.select("page_id", "url", "fetched")
    own = every.distinct().select(
        "*", host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path")
    )
    dots = F.length("pattern") - F.length(F.replace(F.col("pattern"), F.lit("."), F.lit("")))
    slashes = F.length("pattern") - F.length(F.replace(F.col("pattern"), F.lit("/"), F.lit("")))
    depths = entries.agg(
        F.max(F.when(F.col("kind") == "domain", dots + 1)), F.max(F.when(F.col("kind") == "prefix", slashes))
    ).first()
    span = own.agg(F.min("fetched"), F.max("fetched")).first()
    keys = _keys(own, depths[0] or 0, depths[1] or 0).withColumn("bucket", _bucket(F.col("fetched")))
    intervals = validity(entries)
    if span[0] is not None:
        low, high = F.lit(span[0]), F.lit(span[1])
        intervals = intervals.where(
            (F.col("valid_from") <= high) & (F.col("valid_to").isNull() | (F.col("valid_to") > low))
        ).withColumn(
            "bucket",
            F.explode(
                F.sequence(
                    _bucket(F.greatest("valid_from", low)),
                    _bucket(F.least(F.coalesce("valid_to", high), high)),
                )
            ),
        )
    else:
        intervals = intervals.withColumn("bucket", F.lit(0).cast("bigint"))
    met = keys.join(intervals, ["kind", "pattern", "bucket"]).where(
        (F.col("valid_from") <= F.col("fetched"))
        & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    )
    rank = F.when(F.col("kind") == "prefix", 0).when(F.col("kind") == "host", 1).otherwise(2)
    first = F.struct(
        rank.alias("rank"), (-F.col("depth")).alias("depth"), "action", "list_id", "kind", "pattern"
    )
    verdicts = met.groupBy(
        F.col("page_id").alias("_id"), F.col("url").alias("_url"), F.col("fetched").alias("_at")
    ).agg(F.count(F.lit(1)).alias("n_active"), F.min(first).alias("by"))
    same = (
        F.col("url").eqNullSafe(F.col("_url"))
        & (F.col("fetched") == F.col("_at"))
        & F.col("page_id").eqNullSafe(F.col("_id"))
    )
    return every.join(verdicts, same, "left").select(
        "page_id", "url", "fetched",
        F.coalesce("n_active", F.lit(0)).cast("bigint").alias("n_active"),
        F.when(F.col("by.action") == "block", "drop").otherwise("keep").alias("decision"),
        *[F.col(f"by.{c}").alias(c) for c in ("list_id", "kind", "pattern")],
    )


def _digits(text: Column, at: int, n: int = 4) -> Column:
    """``n`` hexadecimal digits of the MD5 of a text, as a number."""
    return F.conv(F.substring(F.md5(text), at, n), 16, 10).cast("bigint")


def _day(number: Column) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + number * 86_400)


def derived_captures(pages: DataFrame) -> DataFrame:
    """The pages with a fetch time, a day of 2024 by the MD5 of the page id."""
    day = F.pmod(_digits(F.col("page_id").cast("string"), 1), F.lit(366))
    return pages.select("page_id", "url", _day(day).alias("fetched"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """Dated entries on hosts, domains and first path segments of the pages themselves.

    The MD5 of a pattern says whether it is listed, when, and when it leaves the list; some
    come back later.
    """
    parts = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.where("host IS NOT NULL").distinct()
    first = F.split("path", "/").getItem(0)
    domain = F.regexp_extract("host", r"([^.]+[.][^.]+[.][^.]+)$", 1)
    named = [
        (parts.select(F.col("host").alias("pattern")), "host", 6),
        (parts.select(domain.alias("pattern")), "domain", 4),
        (parts.where(first != "").select(F.concat_ws("/", "host", first).alias("pattern")), "prefix", 3),
    ]
    listed = None
    for rows, kind, of_16 in named:
        rows = rows.where("pattern <> ''").distinct().withColumn("kind", F.lit(kind))
        rows = rows.where(_digits(F.concat_ws(":", "kind", "pattern"), 1, 1) < of_16)
        listed = rows if listed is None else listed.unionByName(rows)
    code = F.concat_ws(":", "kind", "pattern")
    start = F.pmod(_digits(code, 2), F.lit(300))
    action = F.when(_digits(code, 6, 1) < 4, "allow").otherwise("block")
    steps = F.array(
        F.struct(action.alias("action"), _day(start).alias("at")),
        F.when(
            _digits(code, 7, 1) < 10,
            F.struct(F.lit("remove").alias("action"), _day(start + 20 + _digits(code, 8, 1)).alias("at")),
        ),
        F.when(
            _digits(code, 9, 1) < 5,
            F.struct(F.lit("block").alias("action"), _day(start + 50).alias("at")),
        ),
    )
    name = F.concat(F.lit("list"), F.pmod(_digits(code, 10), F.lit(3)).cast("string"))
    return listed.select(
        name.alias("list_id"), "kind", "pattern", F.inline(F.filter(steps, lambda s: s.isNotNull()))
    )


def _sql_digits(text: str, at: int, n: int = 4) -> str:
    return f"('0x' || substr(md5({text}), {at}, {n}))::BIGINT"


def _sql_day(number: str) -> str:
    return f"(TIMESTAMP '2024-01-01' + to_days(({number})::INT))"


_CODE = "kind || ':' || pattern"
_START = f"({_sql_digits(_CODE, 2)} % 300)"
_SQL = f"""
WITH parts AS (
  SELECT DISTINCT page_id, url,
    nullif(rtrim(regexp_extract(lower(url), '{_HOST}', 1), '.'), '') AS host,
    trim(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') AS path,
    {_sql_day(_sql_digits("page_id::VARCHAR", 1) + " % 366")} AS fetched
  FROM pages),
named AS (
  SELECT DISTINCT host AS pattern, 'host' AS kind, 6 AS share FROM parts
  UNION SELECT regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1), 'domain', 4 FROM parts
  UNION SELECT host || '/' || split_part(path, '/', 1), 'prefix', 3 FROM parts WHERE split_part(path, '/', 1) <> ''),
listed AS (
  SELECT * FROM named WHERE pattern <> '' AND {_sql_digits(_CODE, 1, 1)} < share),
entries AS (
  SELECT kind, pattern, 'list' || ({_sql_digits(_CODE, 10)} % 3) AS list_id,
    CASE WHEN {_sql_digits(_CODE, 6, 1)} < 4 THEN 'allow' ELSE 'block' END AS action, {_sql_day(_START)} AS at
  FROM listed
  UNION ALL SELECT kind, pattern, 'list' || ({_sql_digits(_CODE, 10)} % 3), 'remove',
    {_sql_day(f"{_START} + 20 + {_sql_digits(_CODE, 8, 1)}")} FROM listed WHERE {_sql_digits(_CODE, 7, 1)} < 10
  UNION ALL SELECT kind, pattern, 'list' || ({_sql_digits(_CODE, 10)} % 3), 'block',
    {_sql_day(f"{_START} + 50")} FROM listed WHERE {_sql_digits(_CODE, 9, 1)} < 5),
keys AS (
  SELECT page_id, url, fetched, 'host' AS kind, host AS pattern, len(string_split(host, '.')) AS depth FROM parts
  UNION ALL SELECT page_id, url, fetched, 'domain',
    array_to_string(string_split(host, '.')[-k:], '.'), k
  FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS k FROM parts)
  UNION ALL SELECT page_id, url, fetched, 'prefix', host || '/' || array_to_string(segments[:k], '/'), k
  FROM (SELECT *, unnest(range(1, len(segments) + 1)) AS k FROM (
    SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments FROM parts))),
met AS (
  SELECT k.page_id, k.url, k.fetched, e.kind, e.pattern, e.list_id, e.action, k.depth
  FROM keys k ASOF JOIN (SELECT * FROM entries WHERE list_id = 'list0') e
    ON k.kind = e.kind AND k.pattern = e.pattern AND k.fetched >= e.at
  UNION ALL SELECT k.page_id, k.url, k.fetched, e.kind, e.pattern, e.list_id, e.action, k.depth
  FROM keys k ASOF JOIN (SELECT * FROM entries WHERE list_id = 'list1') e
    ON k.kind = e.kind AND k.pattern = e.pattern AND k.fetched >= e.at
  UNION ALL SELECT k.page_id, k.url, k.fetched, e.kind, e.pattern, e.list_id, e.action, k.depth
  FROM keys k ASOF JOIN (SELECT * FROM entries WHERE list_id = 'list2') e
    ON k.kind = e.kind AND k.pattern = e.pattern AND k.fetched >= e.at),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY page_id, url, fetched) AS n_active,
    row_number() OVER (PARTITION BY page_id, url, fetched ORDER BY
      CASE kind WHEN 'prefix' THEN 0 WHEN 'host' THEN 1 ELSE 2 END, depth DESC, action, list_id) AS place
  FROM met WHERE action <> 'remove')
SELECT p.page_id, p.url, coalesce(n_active, 0) AS n_active,
  CASE WHEN action = 'block' THEN 'drop' ELSE 'keep' END AS decision, list_id, kind, pattern
FROM pages p LEFT JOIN ranked r ON p.page_id = r.page_id AND p.url = r.url AND r.place = 1"""


@query("op1_url_filter", _SQL)
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page against lists derived from the pages' own hosts and paths."""
    pages = load(spark, folder, "pages", "page_id", "url")
    return filter_captures(derived_captures(pages), derived_entries(pages)).drop("fetched")
