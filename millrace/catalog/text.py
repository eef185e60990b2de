"""Vocabulary, encoding, lengths, labels and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import (
    N_FIXED,
    PLAIN_SPECIALS,
    RX,
    chat_tokenizer,
    document_tokenizer,
    documents,
    encode_sql,
    indexed_documents,
    joined,
    lines_folder,
    query,
    turns,
    vocab_sql,
)
from millrace.catalog.rows import _BATCHES, document_manifest
from millrace.functions import labels
from millrace.functions.pretokens import WORDS, pretokens
from millrace.operators import samples
from millrace.operators.templates import ANSWER_START, PLAIN, TURN_END, render, render_nested
from millrace.operators.tokenizer import END, PAD, VOCAB_SIZE, AddedTokens, build_vocab, token_ids
from millrace.plans.slicing import take_split
from millrace.session import load, scratch_folder
from millrace.sources import jsonl
from millrace.sources import tokens as added_maps
from millrace.sources.samples import write_samples

LENGTH = samples.MAX_LENGTH
#: More ids than an array can hold.
NO_LIMIT = 2**31 - 1

_DOC_IDS = f"WITH {vocab_sql('documents')}, {encode_sql('documents', 'doc_id')}"
# Rendered with the plain template: a default system block, then one block per turn.
_CHAT_TEXT = """
rendered AS (
  SELECT conv_id,
    string_agg(
      CASE WHEN turn = 0 AND role <> 'system'
        THEN '<|im_start|>system' || chr(10) || 'You are a helpful assistant<|im_end|>' || chr(10)
        ELSE '' END
      || '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn
    ) AS text
  FROM conversations GROUP BY conv_id)"""
_CHAT_IDS = f"WITH {vocab_sql('conversations')}, {_CHAT_TEXT}, {encode_sql('rendered', 'conv_id')}"


def _fit_sql(key: str) -> str:
    return f"""
fitted AS (
  SELECT {key}, list_concat(ids[1:{LENGTH}],
    list_transform(range(greatest({LENGTH} - len(ids), 0)), lambda i: 0)) AS ids,
    least(len(ids), {LENGTH})::INT AS n_real
  FROM encoded)"""


@query("vocab_build", f"WITH {vocab_sql('documents')} SELECT token, token_id, special FROM vocab")
def vocab_build(spark: SparkSession, folder: str) -> DataFrame:
    return build_vocab(documents(spark, folder))


@query(
    "encode",
    f"""{_DOC_IDS} SELECT doc_id, len(ids)::INT AS n_ids, array_to_string(ids, ',') AS ids
        FROM encoded""",
)
def encode(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = document_tokenizer(spark, folder)
    ids = documents(spark, folder).select("doc_id", tokenizer.encode(F.col("text")).alias("i"))
    return ids.select("doc_id", F.size("i").alias("n_ids"), joined(F.col("i")).alias("ids"))


@query(
    "pad_truncate_pretrain",
    f"""{_DOC_IDS}, {_fit_sql('doc_id')}
        SELECT doc_id, array_to_string(ids, ',') AS ids, n_real FROM fitted""",
)
def pad_truncate_pretrain(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = document_tokenizer(spark, folder)
    rows = samples.pretrain_samples(documents(spark, folder), tokenizer, "doc_id", LENGTH)
    return rows.select("doc_id", joined(F.col("input_ids")).alias("ids"), "n_real")


def _chat_samples(spark: SparkSession, folder: str, markers_only: bool = False) -> DataFrame:
    tokenizer = chat_tokenizer(spark, folder)
    return samples.chat_samples(
        turns(spark, folder), tokenizer, PLAIN, "conv_id", length=LENGTH,
        markers_only=markers_only,
    )


@query(
    "pad_truncate_sft",
    f"""{_CHAT_IDS}, {_fit_sql('conv_id')}
        SELECT conv_id, array_to_string(ids, ',') AS ids, n_real FROM fitted""",
)
def pad_truncate_sft(spark: SparkSession, folder: str) -> DataFrame:
    rows = _chat_samples(spark, folder)
    return rows.select("conv_id", joined(F.col("input_ids")).alias("ids"), "n_real")


@query(
    "token_to_id",
    f"""WITH {vocab_sql('documents')},
        chat AS (SELECT token, count(*) AS n FROM (
          SELECT unnest(regexp_extract_all(text, {RX})) AS token
          FROM conversations) GROUP BY token)
        SELECT chat.token, n, token_id FROM chat LEFT JOIN vocab ON chat.token = vocab.token""",
)
def token_to_id(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = document_tokenizer(spark, folder)
    table = load(spark, folder, "conversations", "text")
    found = table.select(F.explode(pretokens(F.col("text"))).alias("token"))
    counts = found.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return token_ids(counts, tokenizer)


@query("decode", "SELECT doc_id, text FROM documents")
def decode(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = document_tokenizer(spark, folder)
    marked = F.concat(F.lit("<|im_start|>"), F.col("text"), F.lit(END + PAD))
    ids = documents(spark, folder).select("doc_id", tokenizer.encode(marked).alias("ids"))
    return ids.select("doc_id", tokenizer.decode(F.col("ids")).alias("text"))


@query(
    "stop_at_end",
    f"""{_CHAT_IDS}, cutting AS (
          SELECT conv_id, ids, coalesce(list_position(ids, 2), len(ids) + 1) - 1 AS kept FROM encoded)
        SELECT conv_id, array_to_string(ids[1:kept], ',') AS ids FROM cutting""",
)
def stop_at_end(spark: SparkSession, folder: str) -> DataFrame:
    """What comes before a conversation's first end token, of any length."""
    tokenizer = chat_tokenizer(spark, folder)
    text = render(turns(spark, folder), PLAIN, "conv_id")
    ids = text.select("conv_id", tokenizer.encode(F.col("text")).alias("ids"))
    end = tokenizer.ids_of(END)[0]
    return ids.select("conv_id", joined(labels.until_end(F.col("ids"), end, NO_LIMIT)).alias("ids"))


@query(
    "stop_at_end_answers",
    f"""WITH {vocab_sql('conversations')}, answers AS (
          SELECT {{'conv': conv_id, 'turn': turn}} AS answer,
            coalesce(text, '') || '<|im_end|>' || chr(10) AS text
          FROM conversations WHERE role = 'assistant'),
        {encode_sql('answers', 'answer')}, cutting AS (
          SELECT answer, ids, list_position(ids, 2) - 1 AS kept FROM encoded)
        SELECT answer.conv AS conv_id, answer.turn AS turn, kept::INT AS n_ids,
          array_to_string(ids[1:kept], ',') AS ids FROM cutting""",
)
def stop_at_end_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Each answer by itself as it would come from a model, whole, up to its end token."""
    tokenizer = chat_tokenizer(spark, folder)
    answers = turns(spark, folder).where("role = 'assistant'")
    text = F.concat(F.coalesce("content", F.lit("")), F.lit(TURN_END))
    ids = answers.select("conv_id", "turn", tokenizer.encode(text).alias("ids"))
    kept = labels.until_end(F.col("ids"), tokenizer.ids_of(END)[0], NO_LIMIT)
    return ids.select("conv_id", "turn", kept.alias("i")).select(
        "conv_id", "turn", F.size("i").alias("n_ids"), joined(F.col("i")).alias("ids")
    )


# --- labels ------------------------------------------------------------------------------


@query(
    "pretrain_labels",
    f"""{_DOC_IDS}, {_fit_sql('doc_id')} SELECT doc_id, array_to_string(
          list_transform(ids, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END), ',') AS labels
        FROM fitted""",
)
def pretrain_labels(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = document_tokenizer(spark, folder)
    rows = samples.pretrain_samples(documents(spark, folder), tokenizer, "doc_id", LENGTH)
    return rows.select("doc_id", joined(F.col("labels")).alias("labels"))


# Marker ids come from the same vocabulary: the start marker is `<|im_start|>`, `assistant`
# (a word or its bytes) and a newline; the end marker is `<|im_end|>` and a newline.
_MARK_IDS = f"""
one AS (SELECT 0 AS k),
word AS (
  SELECT coalesce(
    (SELECT [token_id] FROM vocab WHERE token = 'assistant' AND token_id >= {N_FIXED}),
    list_transform(range(9), lambda i: (('0x' || substr(hex(encode('assistant')), 2 * i + 1, 2))::INT
      + {len(PLAIN_SPECIALS)})::INT)) AS ids FROM one),
newline AS (
  SELECT coalesce((SELECT token_id FROM vocab WHERE token = chr(10) AND token_id >= {N_FIXED}),
    10 + {len(PLAIN_SPECIALS)}) AS id FROM one),
marks AS (
  SELECT list_concat(list_concat([1], word.ids), [newline.id]) AS opening, [2, newline.id] AS closing
  FROM word, newline),"""
_MARKS = f"""{_CHAT_IDS}, {_fit_sql('conv_id')},{_MARK_IDS}
found AS (
  SELECT conv_id, ids, n_real, len(opening) AS width,
    list_filter(range(1, {LENGTH} + 1), lambda i: ids[i:i + len(opening) - 1] = opening) AS starts,
    list_filter(range(1, {LENGTH} + 1), lambda i: ids[i:i + 1] = closing) AS ends
  FROM fitted, marks)"""
# Answers hold no markers here, so a position is labelled iff no end marker is complete
# between the last start marker and it.
_LABELS = f"""{_MARKS},
labelled AS (
  SELECT conv_id, ids, n_real, list_transform(range(1, {LENGTH} + 1), lambda j:
    CASE WHEN len(list_filter(starts, lambda s: s + width <= j
      AND len(list_filter(ends, lambda e: e >= s + width AND e + 2 <= j)) = 0)) > 0
    THEN ids[j] ELSE -100 END) AS labels
  FROM found)"""


_ALL_MARKS = f"""{_CHAT_IDS},{_MARK_IDS}
found AS (
  SELECT conv_id, len(ids)::INT AS n_ids,
    list_filter(range(1, len(ids) + 1), lambda i: ids[i:i + len(opening) - 1] = opening) AS starts,
    list_filter(range(1, len(ids) + 1), lambda i: ids[i:i + 1] = closing) AS ends
  FROM encoded, marks)"""


@query(
    "marker_match",
    f"""{_ALL_MARKS} SELECT conv_id, array_to_string(starts, ',') AS starts,
        array_to_string(ends, ',') AS ends FROM found""",
)
def marker_match(spark: SparkSession, folder: str) -> DataFrame:
    return marker_match_whole(spark, folder).drop("n_ids")


@query(
    "marker_match_whole",
    f"""{_ALL_MARKS} SELECT conv_id, n_ids, array_to_string(starts, ',') AS starts,
        array_to_string(ends, ',') AS ends FROM found""",
)
def marker_match_whole(spark: SparkSession, folder: str) -> DataFrame:
    """Markers in all ids of each conversation."""
    tokenizer = chat_tokenizer(spark, folder)
    text = render(turns(spark, folder), PLAIN, "conv_id")
    rows = text.select("conv_id", tokenizer.encode(F.col("text")).alias("ids"))
    ids = F.col("ids")
    return rows.select(
        "conv_id",
        F.size(ids).alias("n_ids"),
        joined(labels.match_positions(ids, tokenizer.ids_of(ANSWER_START))).alias("starts"),
        joined(labels.match_positions(ids, tokenizer.ids_of(TURN_END))).alias("ends"),
    )


@query(
    "sft_labels",
    f"{_LABELS} SELECT conv_id, array_to_string(labels, ',') AS labels FROM labelled",
)
def sft_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _chat_samples(spark, folder).select("conv_id", joined(F.col("labels")).alias("labels"))


@query(
    "format_labels",
    f"""{_MARKS} SELECT conv_id, array_to_string(list_transform(range(1, {LENGTH} + 1), lambda j:
          CASE WHEN len(list_filter(starts, lambda s: s <= j AND j < s + width)) > 0
            OR len(list_filter(starts, lambda s: len(list_filter(ends, lambda e:
                 e >= s + width AND e <= j AND j < e + 2
                 AND len(list_filter(ends, lambda f: f >= s + width AND f < e)) = 0)) > 0)) > 0
          THEN ids[j] ELSE -100 END), ',') AS labels FROM found""",
)
def format_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = _chat_samples(spark, folder, markers_only=True)
    return rows.select("conv_id", joined(F.col("labels")).alias("labels"))


@query(
    "next_token_pairs",
    f"""{_LABELS} SELECT conv_id, (j - 1)::INT AS pos, ids[j]::INT AS input_id,
        labels[j + 1]::INT AS target_id
        FROM labelled, (SELECT unnest(range(1, {LENGTH})) AS j)""",
)
def next_token_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return samples.next_token_pairs(_chat_samples(spark, folder), "conv_id")


@query(
    "supervised_counts",
    f"""{_LABELS}, counted_labels AS (
          SELECT conv_id, len(list_filter(labels[2:], lambda x: x <> -100)) AS k FROM labelled)
        SELECT conv_id, ({LENGTH} - 1)::BIGINT AS n_tokens, k::BIGINT AS n_supervised,
               round(k / ({LENGTH} - 1.0), 6)::DOUBLE AS share
        FROM counted_labels""",
)
def supervised_counts(spark: SparkSession, folder: str) -> DataFrame:
    stats = samples.supervision(_chat_samples(spark, folder), "conv_id")
    return stats.withColumn("share", F.round("share", 6))


@query(
    "chat_corpus",
    f"""{_LABELS} SELECT dense_rank() OVER (ORDER BY conv_id) - 1 AS row_idx, n_real,
          array_to_string(ids, ',') AS ids, array_to_string(labels, ',') AS labels
        FROM labelled""",
)
def chat_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """From JSON lines to labelled samples; after the line positions nothing is exchanged."""
    nested = jsonl.fold_turns(turns(spark, folder), "conv_id")
    line = F.to_json(F.struct(F.col("messages").alias("conversations")))
    lines = jsonl.scan_lines(spark, lines_folder(nested, line, "conv_id"))
    texts = render_nested(jsonl.read_nested(lines), PLAIN, "row_idx")
    rows = samples.label_chats(texts, chat_tokenizer(spark, folder), "row_idx", length=LENGTH)
    return rows.select(
        "row_idx", "n_real", joined(F.col("input_ids")).alias("ids"),
        joined(F.col("labels")).alias("labels"),
    )


@query(
    "text_corpus",
    f"""{_DOC_IDS}, {_fit_sql('doc_id')}, rows AS (
          SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents)
        SELECT row_idx, n_real, array_to_string(ids, ',') AS ids
        FROM fitted JOIN rows ON fitted.doc_id = rows.doc_id""",
)
def text_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """From JSON lines through a slice to padded samples."""
    docs = documents(spark, folder)
    lines = jsonl.scan_lines(spark, lines_folder(docs, F.to_json(F.struct("text"))))
    texts = jsonl.read_pretrain(take_split(lines, "train[:]"))
    tokenizer = document_tokenizer(spark, folder)
    rows = samples.pretrain_samples(texts, tokenizer, "row_idx", LENGTH)
    return rows.select("row_idx", "n_real", joined(F.col("input_ids")).alias("ids"))


@query(
    "sample_sink",
    f"""{_DOC_IDS}, {_fit_sql('doc_id')}, {_BATCHES}
        SELECT epoch, rank, batch_id, pos_in_batch, manifest.row_idx, n_real,
               array_to_string(ids, ',') AS ids
        FROM manifest JOIN rows ON manifest.row_idx = rows.row_idx
        JOIN fitted ON rows.doc_id = fitted.doc_id""",
)
def sample_sink(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = document_tokenizer(spark, folder)
    rows = samples.pretrain_samples(documents(spark, folder), tokenizer, "doc_id", LENGTH)
    indexed = indexed_documents(spark, folder)
    path = scratch_folder(spark)
    batches = document_manifest(spark, folder).join(indexed, "row_idx").join(rows, "doc_id")
    write_samples(batches, path)
    return spark.read.parquet(path).select(
        "epoch", "rank", "batch_id", "pos_in_batch", "row_idx", "n_real",
        joined(F.col("input_ids")).alias("ids"),
    )


# The words between added tokens, as a character class that both engines read alike.
_WORDS = "'" + WORDS.replace("\\t", "\t").replace("\\r", "\r").replace("\\n", "\n") + "'"


@query(
    "encode_added",
    f"""WITH roles AS (
      SELECT role, (row_number() OVER (ORDER BY role) - 1)::INT AS id
      FROM (SELECT DISTINCT role FROM conversations)),
    k AS (SELECT count(*)::INT AS n FROM roles),
    pieces AS (
      SELECT conv_id, turn, unnest(regexp_extract_all(text, {_WORDS})) AS token,
             generate_subscripts(regexp_extract_all(text, {_WORDS}), 1) AS nth FROM conversations),
    ranked AS (
      SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS place FROM pieces GROUP BY token),
    named AS (
      SELECT token, (k.n + 257 + place)::INT AS token_id FROM ranked, k WHERE place <= {VOCAB_SIZE} - 258 - k.n),
    known AS (
      SELECT conv_id, turn, nth, CASE WHEN token_id IS NOT NULL THEN [token_id]
        ELSE list_transform(range(octet_length(encode(p.token))), lambda i:
          ('0x' || substr(hex(encode(p.token)), 2 * i + 1, 2))::INT + k.n + 2) END AS part
      FROM pieces p CROSS JOIN k LEFT JOIN named ON p.token = named.token),
    joined AS (SELECT conv_id, turn, flatten(list(part ORDER BY nth)) AS ids FROM known GROUP BY conv_id, turn),
    whole AS (
      SELECT c.conv_id, c.turn, list_concat([r.id, k.n], coalesce(j.ids, []::INT[]), [k.n + 1]) AS ids
      FROM conversations c JOIN roles r USING (role) CROSS JOIN k
      LEFT JOIN joined j ON j.conv_id = c.conv_id AND j.turn = c.turn)
    SELECT conv_id, turn, array_to_string(ids, ',') AS ids, len(ids)::INT AS n_tokens, true AS same FROM whole""",
)
def encode_added(spark: SparkSession, folder: str) -> DataFrame:
    """Turns behind a marker of their role, inside thinking tags: every tag one id, both ways.

    The added tokens go through the JSON map that tokenizer configurations hold: a special one
    for each role of the table, then the two tags, which decoding keeps.
    """
    rows = turns(spark, folder)
    roles = F.array_sort(F.collect_set("role"))
    names = F.concat(
        F.transform(roles, lambda role: F.concat(F.lit("<|"), role, F.lit("|>"))),
        F.array(F.lit("<think>"), F.lit("</think>")),
    )
    table = rows.agg(names.alias("names")).select(F.posexplode("names").alias("id", "name"))
    of_role = F.col("name").startswith("<|")
    maps = table.agg(added_maps.token_map(F.col("id"), F.col("name"), of_role).alias("added"))
    tokenizer = AddedTokens.of(added_maps.added_token_rules(maps, "added")).tokenizer(rows, "content")
    text = F.concat(F.lit("<|"), "role", F.lit("|><think>"), "content", F.lit("</think>"))
    ids = rows.select("conv_id", "turn", text.alias("_text"), tokenizer.encode(text).alias("_ids"))
    back = tokenizer.decode(F.col("_ids"), skip_special=False)
    return ids.select(
        "conv_id", "turn", joined(F.col("_ids")).alias("ids"), F.size("_ids").alias("n_tokens"),
        (back == F.col("_text")).alias("same"),
    )
