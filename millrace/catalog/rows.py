"""Scans, positions, slices and batch manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import indexed_documents, lines_folder, query
from millrace.operators import manifest
from millrace.plans import slicing
from millrace.plans.positions import permute
from millrace.plans.stored import Stored, store_rows
from millrace.session import load
from millrace.sources import jsonl, tokens

SEED, EPOCHS, WORLD, BATCH, ACCUMULATION, SKIP = 42, 2, 4, 16, 8, 3

_ROWS = "rows AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents)"
_N = "(SELECT count(*) FROM documents)"


@query(
    "scan_jsonl",
    """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_idx, doc_id, md5(text) AS text_md5
       FROM documents""",
)
def scan_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents", "doc_id", "text")
    path = lines_folder(docs, F.to_json(F.struct("doc_id", "text")))
    row = F.from_json("value", "doc_id bigint, text string")
    return (
        jsonl.scan_lines(spark, path)
        .select("row_idx", row.alias("r"))
        .select("row_idx", "r.doc_id", F.md5("r.text").alias("text_md5"))
    )


@query("row_index", f"WITH {_ROWS} SELECT row_idx, doc_id FROM rows")
def row_index(spark: SparkSession, folder: str) -> DataFrame:
    return indexed_documents(spark, folder)


@query("row_count", "SELECT count(*) AS n_rows FROM documents")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return slicing.count_rows(load(spark, folder, "documents"))


@query(
    "row_lookup",
    f"WITH {_ROWS} SELECT r.row_idx, r.doc_id FROM rows r JOIN labels l ON r.row_idx = l.doc_id",
)
def row_lookup(spark: SparkSession, folder: str) -> DataFrame:
    wanted = load(spark, folder, "labels", "doc_id").withColumnRenamed("doc_id", "row_idx")
    return store_rows(load(spark, folder, "documents", "doc_id"), "doc_id").lookup(wanted)


# What is written behind the line of a row, so that every kind of line occurs.
def _other_line(good: Column) -> Column:
    kind = F.col("doc_id") % 10
    return (
        F.when(kind == 3, F.lit("  "))
        .when(kind == 4, F.to_json(F.struct(F.col("text").alias("body"))))
        .when(kind == 5, F.substring(good, F.lit(1), F.length(good) - 2))
        .when(kind == 6, F.to_json(F.struct(F.col("n_chars").alias("text"))))
        .when(kind == 7, F.lit('{"text": null}'))
        .when(kind == 8, F.to_json(F.struct((F.col("n_chars") > 1000).alias("text"))))
        .when(kind == 9, F.concat(good, F.lit(" "), good))
    )


def _mixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A good line for every document, and another kind of line behind seven of ten."""
    docs = load(spark, folder, "documents", "doc_id", "text", "n_chars")
    good = F.to_json(F.struct("text"))
    lines = docs.select("doc_id", F.posexplode(F.array(good, _other_line(good))))
    lines = lines.where(F.col("col").isNotNull())
    numbered = lines.select((2 * F.col("doc_id") + F.col("pos")).alias("at"), "col")
    return jsonl.scan_lines(spark, lines_folder(numbered, F.col("col"), "at"))


_MIXED = """lines AS (
  SELECT doc_id, 0 AS place, 0 AS kind, text, n_chars FROM documents
  UNION ALL SELECT doc_id, 1, doc_id % 10, text, n_chars FROM documents WHERE doc_id % 10 >= 3),
mixed AS (SELECT *, row_number() OVER (ORDER BY doc_id, place) - 1 AS row_idx FROM lines)"""


@query(
    "bad_rows",
    f"""WITH {_MIXED} SELECT row_idx,
              CASE kind WHEN 3 THEN 'blank' WHEN 4 THEN 'missing_key'
              WHEN 5 THEN 'bad_json' WHEN 9 THEN 'bad_json' ELSE 'ok' END AS status
       FROM mixed""",
)
def bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = jsonl.checked(_mixed_lines(spark, folder), "text", "quarantine")
    return rows.select("row_idx", "status")


@query(
    "text_coerce",
    f"""WITH {_MIXED} SELECT row_idx,
                CASE kind WHEN 6 THEN n_chars::VARCHAR WHEN 7 THEN 'None'
                WHEN 8 THEN CASE WHEN n_chars > 1000 THEN 'True' ELSE 'False' END
                ELSE text END AS text
         FROM mixed WHERE kind NOT IN (3, 4, 5, 9)""",
)
def text_coerce(spark: SparkSession, folder: str) -> DataFrame:
    return jsonl.read_pretrain(_mixed_lines(spark, folder), "drop").select("row_idx", "text")


@query(
    "read_conversations",
    """SELECT dense_rank() OVER (ORDER BY conv_id) - 1 AS row_idx, turn, role, text AS content
       FROM conversations""",
)
def read_conversations(spark: SparkSession, folder: str) -> DataFrame:
    table = load(spark, folder, "conversations").withColumnRenamed("text", "content")
    nested = jsonl.fold_turns(table, "conv_id")
    path = lines_folder(
        nested, F.to_json(F.struct(F.col("messages").alias("conversations"))), "conv_id"
    )
    rows = jsonl.read_conversations(jsonl.scan_lines(spark, path))
    return rows.select("row_idx", "turn", "role", "content")


@query(
    "special_tokens",
    """SELECT conv_id, turn::INT AS token_id, text AS content, role = 'system' AS special
       FROM conversations""",
)
def special_tokens(spark: SparkSession, folder: str) -> DataFrame:
    table = load(spark, folder, "conversations")
    maps = table.groupBy("conv_id").agg(
        tokens.token_map(F.col("turn"), F.col("text"), F.col("role") == "system").alias("added")
    )
    return tokens.added_tokens(maps, "added", "conv_id")


def _splits(stored: Stored, splits: list[str]) -> DataFrame:
    parts = [stored.split(s).withColumn("split", F.lit(s)) for s in splits]
    return reduce(DataFrame.unionByName, parts)


def _splits_sql(conditions: dict[str, str]) -> str:
    return f"WITH {_ROWS} " + " UNION ALL ".join(
        f"SELECT '{split}' AS split, row_idx, doc_id FROM rows WHERE {condition}"
        for split, condition in conditions.items()
    )


@query(
    "split_range",
    _splits_sql(
        {
            "train": "true",
            "train[100:500]": "row_idx BETWEEN 100 AND 499",
            "train[:300]": "row_idx < 300",
            "train[-50:]": f"row_idx >= {_N} - 50",
            "train[10:-10]": f"row_idx >= 10 AND row_idx < {_N} - 10",
            "train[0:40:2]": "row_idx < 40",
            "train[9:3]": "false",
        }
    ),
)
def split_range(spark: SparkSession, folder: str) -> DataFrame:
    return _splits(
        store_rows(load(spark, folder, "documents", "doc_id"), "doc_id"),
        ["train", "train[100:500]", "train[:300]", "train[-50:]", "train[10:-10]",
         "train[0:40:2]", "train[9:3]"],
    )


@query(
    "split_percent",
    _splits_sql(
        {
            "train[25%]": f"row_idx < floor({_N} * 25.0 / 100)",
            "train[:10%]": f"row_idx < floor({_N} * 10.0 / 100)",
            "train[:33.3%]": f"row_idx < floor({_N} * 33.3 / 100)",
        }
    ),
)
def split_percent(spark: SparkSession, folder: str) -> DataFrame:
    stored = store_rows(load(spark, folder, "documents", "doc_id"), "doc_id")
    return _splits(stored, ["train[25%]", "train[:10%]", "train[:33.3%]"])


def _document_lines(spark: SparkSession, folder: str) -> Stored:
    docs = load(spark, folder, "documents", "doc_id", "text")
    return jsonl.stored_lines(spark, lines_folder(docs, F.to_json(F.struct("doc_id", "text"))))


def _line() -> Column:
    return F.from_json("value", "doc_id bigint, text string")


_TEXTS = """rows AS (
  SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents)"""


@query(
    "line_slices",
    f"WITH {_TEXTS} "
    + " UNION ALL ".join(
        f"SELECT '{split}' AS split, row_idx, doc_id, md5(text) AS text_md5 FROM rows WHERE {test}"
        for split, test in {
            "train[:3]": "row_idx < 3",
            "train[100:700]": "row_idx BETWEEN 100 AND 699",
            "train[-40:]": f"row_idx >= {_N} - 40",
            "train[60%]": f"row_idx < floor({_N} * 60.0 / 100)",
        }.items()
    ),
)
def line_slices(spark: SparkSession, folder: str) -> DataFrame:
    wanted = ["train[:3]", "train[100:700]", "train[-40:]", "train[60%]"]
    rows = _splits(_document_lines(spark, folder), wanted).withColumn("r", _line())
    return rows.select("split", "row_idx", "r.doc_id", F.md5("r.text").alias("text_md5"))


@query(
    "line_lookup",
    f"""WITH {_TEXTS} SELECT r.row_idx, r.doc_id, md5(r.text) AS text_md5
        FROM rows r JOIN labels l ON r.row_idx = l.doc_id""",
)
def line_lookup(spark: SparkSession, folder: str) -> DataFrame:
    wanted = load(spark, folder, "labels", "doc_id").withColumnRenamed("doc_id", "row_idx")
    rows = _document_lines(spark, folder).lookup(wanted).withColumn("r", _line())
    return rows.select("row_idx", "r.doc_id", F.md5("r.text").alias("text_md5"))


@query("head_n", f"WITH {_ROWS} SELECT row_idx, doc_id FROM rows WHERE row_idx < 50")
def head_n(spark: SparkSession, folder: str) -> DataFrame:
    first = slicing.take_head(load(spark, folder, "documents", "doc_id"), 50, "doc_id")
    return first.select("row_idx", "doc_id")


# --- manifests ---------------------------------------------------------------------------

_ORDER = f"""{_ROWS},
shuffled AS (
  SELECT epoch, row_idx,
         row_number() OVER (PARTITION BY epoch ORDER BY
           md5('{SEED}:' || epoch || ':' || row_idx), row_idx) - 1 AS position
  FROM rows, (SELECT unnest(range({EPOCHS}))::INT AS epoch))"""
_TOTAL = f"(ceil({_N} / {WORLD}.0) * {WORLD})"
_SHARDS = f"""{_ORDER},
sharded AS (
  SELECT epoch, (slot % {WORLD})::INT AS rank, slot // {WORLD} AS seq, row_idx FROM (
    SELECT epoch, row_idx, position AS slot FROM shuffled
    UNION ALL
    SELECT epoch, row_idx, position + {_N} FROM shuffled WHERE position + {_N} < {_TOTAL}))"""
_BATCHES = f"""{_SHARDS},
manifest AS (
  SELECT epoch, rank, seq // {BATCH} AS batch_id, (seq % {BATCH})::INT AS pos_in_batch, row_idx
  FROM sharded)"""


def shuffled_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    n = load(spark, folder, "documents").count()
    rows = indexed_documents(spark, folder).select("row_idx")
    return permute(rows, n, SEED, EPOCHS), n


def document_manifest(spark: SparkSession, folder: str) -> DataFrame:
    order, n = shuffled_rows(spark, folder)
    return manifest.assign_batches(manifest.shard(order, n, WORLD), BATCH)


@query("epoch_shuffle", f"WITH {_ORDER} SELECT epoch, position, row_idx FROM shuffled")
def epoch_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return shuffled_rows(spark, folder)[0]


@query("rank_shard", f"WITH {_SHARDS} SELECT epoch, rank, seq, row_idx FROM sharded")
def rank_shard(spark: SparkSession, folder: str) -> DataFrame:
    order, n = shuffled_rows(spark, folder)
    return manifest.shard(order, n, WORLD)


@query(
    "assign_batches",
    f"WITH {_BATCHES} SELECT epoch, rank, batch_id, pos_in_batch, row_idx FROM manifest",
)
def assign_batches(spark: SparkSession, folder: str) -> DataFrame:
    return document_manifest(spark, folder)


@query(
    "skip_batches",
    f"""WITH {_BATCHES} SELECT epoch, rank, batch_id, count(*) AS n_rows FROM manifest
        WHERE batch_id >= {SKIP} GROUP BY ALL""",
)
def skip_batches(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.batch_sizes(manifest.skip_batches(document_manifest(spark, folder), SKIP))


_LENGTHS = f"""{_BATCHES},
lengths AS (
  SELECT epoch, rank, count(DISTINCT batch_id) AS n_batches FROM manifest GROUP BY epoch, rank)"""


@query(
    "plan_lengths",
    f"""WITH {_LENGTHS} SELECT epoch, rank, n_batches,
        (sum(n_batches) OVER (PARTITION BY rank))::BIGINT AS total_steps FROM lengths""",
)
def plan_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.plan_lengths(document_manifest(spark, folder))


@query(
    "update_groups",
    f"""WITH {_BATCHES},
batches AS (
  SELECT epoch, rank, batch_id,
         CASE WHEN (batch_id + 2) % {ACCUMULATION} = 0 THEN 1 ELSE 0 END AS updates
  FROM (SELECT DISTINCT epoch, rank, batch_id FROM manifest))
SELECT epoch, rank, batch_id,
       (coalesce(sum(updates) OVER (PARTITION BY rank ORDER BY epoch, batch_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS update_id,
       coalesce(sum(updates) OVER (PARTITION BY rank ORDER BY epoch, batch_id
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) > 0 AS applied
FROM batches""",
)
def update_groups(spark: SparkSession, folder: str) -> DataFrame:
    rows = document_manifest(spark, folder)
    return manifest.update_groups(
        manifest.batch_sizes(rows), manifest.plan_lengths(rows), ACCUMULATION
    )
