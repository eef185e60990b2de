"""JSON-lines sources: one row per line, parsed only where a field is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.jsontext import spaced
from millrace.plans.positions import index_files
from millrace.plans.stored import StoredLines, store_lines

STATUSES = ("ok", "blank", "bad_json", "missing_key")
MODES = ("failfast", "quarantine", "drop")
_SPACE = r"[\s\x1c-\x1f]"
_STRICT = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt"}

MESSAGES = (
    "array<struct<role:string,content:variant,reasoning_content:variant,"
    "functions:array<string>,tool_calls:array<string>>>"
)
_CALL = "struct<name:string,arguments:string,function:string>"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every ``\\n``-ended line with its position; blank lines count, the last may be open."""
    return index_files(_lines(spark, path))


def stored_lines(
    spark: SparkSession, path: str | list[str], index: str | None = None
) -> StoredLines:
    """The same lines behind a stored index, for slices and lookups that open few files."""
    return store_lines(_lines(spark, path), index)


def stripped(line: Column) -> Column:
    """Without white space of any script at either end; most lines have none."""
    edges = F.concat(F.left(line, F.lit(1)), F.right(line, F.lit(1)))
    bare = F.regexp_replace(line, f"(?U)^{_SPACE}+|{_SPACE}+$", "")
    return F.when(edges.rlike(f"(?U){_SPACE}"), bare).otherwise(line)


def _fields(line: Column, key: str) -> Column:
    """The one parse that status and text share: the field's text, or the corrupt line."""
    return F.from_json(line, f"struct<`{key}`:string,_corrupt:string>", _STRICT)


def _status(line: Column, parsed: Column, key: str) -> Column:
    # The parser stops behind the object. If the first brace that closes is the last
    # character, nothing can follow it; else the brackets turn what follows into an error.
    alone = F.locate("}", line) == F.length(line)
    single = alone | (F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1)
    is_object = line.startswith("{") & parsed["_corrupt"].isNull()
    # A missing field and a null one look alike in the parsed row.
    present = parsed[key].isNotNull() | F.coalesce(
        F.array_contains(F.json_object_keys(line), key), F.lit(False)
    )
    return (
        F.when(line == "", "blank")
        .when(~F.coalesce(is_object & single, F.lit(False)), "bad_json")
        .when(~present, "missing_key")
        .otherwise("ok")
    )


def line_status(line: Column, key: str) -> Column:
    """Why reading ``key`` from this line would fail, or ``ok``."""
    return _status(stripped(line), _fields(stripped(line), key), key)


def _parsed(lines: DataFrame, key: str, mode: str) -> DataFrame:
    """Add ``_line``, ``_row`` and ``status``, each worked out once per line, and apply the
    error rule to ``_line``."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    rows = (
        lines.withColumn("_line", stripped(F.col("value")))
        .withColumn("_row", _fields(F.col("_line"), key))
        .withColumn("status", _status(F.col("_line"), F.col("_row"), key))
    )
    if mode == "drop":
        return rows.where(F.col("status") == "ok")
    if mode == "quarantine":
        return rows
    message = F.concat(F.col("status"), F.lit(" at row "), F.col("row_idx").cast("string"))
    good = F.when(F.col("status") == "ok", F.col("_line"))
    return rows.withColumn("_line", good.otherwise(F.raise_error(message).cast("string")))


def checked(lines: DataFrame, key: str, mode: str = "failfast") -> DataFrame:
    """Apply the error rule when rows are read, not when they are scanned.

    ``failfast`` raises on the first bad row that is reached, ``drop`` leaves bad rows out,
    ``quarantine`` keeps all rows with a ``status``.
    """
    rows = _parsed(lines, key, mode)
    kept = ["status"] if mode == "quarantine" else []
    return rows.select("row_idx", F.col("_line").alias("value"), *kept)


def _text(line: Column, row: Column, key: str) -> Column:
    raw = row[key]
    kind = F.schema_of_variant(F.variant_get(F.try_parse_json(line), f"$.{key}", "variant"))
    # Only these two words can be a boolean, so the second parse is rare.
    as_text = F.when(
        raw.isin("true", "false"), F.when(kind == "BOOLEAN", F.initcap(raw)).otherwise(raw)
    ).otherwise(raw)
    return F.coalesce(as_text, F.lit("None"))


def text_of(line: Column, key: str = "text") -> Column:
    """The field as text: numbers as written, null as ``None``, booleans capitalised.

    Arrays and objects keep their JSON text.
    """
    line = stripped(line)
    return _text(line, _fields(line, key), key)


def read_pretrain(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """(row_idx, text), with ``status`` if bad rows are kept."""
    rows = _parsed(lines, "text", mode)
    # Touching the line makes a bad one raise; rows that are kept as bad have no text.
    quarantine = mode == "quarantine"
    good = F.col("status") == "ok" if quarantine else F.col("_line").isNotNull()
    text = F.when(good, _text(F.col("_line"), F.col("_row"), "text"))
    kept = ["status"] if quarantine else []
    return rows.select("row_idx", text.alias("text"), *kept)


def _string_only(value: Column) -> Column:
    is_text = F.schema_of_variant(value) == "STRING"
    return F.when(is_text, F.try_variant_get(value, "$", "string"))


def _tool_call(raw: Column) -> Column:
    outer = F.from_json(raw, _CALL)
    body = F.coalesce(outer["function"], raw)
    call = F.from_json(body, _CALL)
    kind = F.schema_of_variant(F.variant_get(F.try_parse_json(body), "$.arguments", "variant"))
    arguments = F.when(kind == "STRING", call["arguments"]).otherwise(spaced(call["arguments"]))
    return F.struct(call["name"].alias("name"), arguments.alias("arguments"))


def _message(raw: Column) -> Column:
    return F.struct(
        raw["role"].alias("role"),
        _string_only(raw["content"]).alias("content"),
        _string_only(raw["reasoning_content"]).alias("reasoning_content"),
        F.transform(raw["functions"], spaced).alias("functions"),
        F.transform(raw["tool_calls"], _tool_call).alias("tool_calls"),
    )


def read_nested(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """(row_idx, messages): each conversation with its message array.

    Tool signatures and object arguments become JSON text in ``json.dumps`` spacing;
    content that is not a string becomes null. Conversations that are no list are bad rows
    of status ``bad_type``; ``quarantine`` adds ``status`` and keeps bad rows, without
    messages.
    """
    raw = F.from_json("value", f"struct<conversations:{MESSAGES}>")["conversations"]
    # Status first, on all rows: the type is only known from the second parse.
    rows = checked(lines, "conversations", "quarantine").withColumn("_raw", raw)
    wrong = (F.col("status") == "ok") & F.col("_raw").isNull()
    rows = rows.withColumn("status", F.when(wrong, "bad_type").otherwise(F.col("status")))
    good = F.when(F.col("status") == "ok", F.transform("_raw", _message))
    if mode == "quarantine":
        return rows.select("row_idx", "status", good.alias("messages"))
    if mode == "drop":
        return rows.where("status = 'ok'").select("row_idx", good.alias("messages"))
    if mode != "failfast":
        raise ValueError(f"unknown mode {mode!r}")
    message = F.concat(F.col("status"), F.lit(" at row "), F.col("row_idx").cast("string"))
    failing = F.when(F.col("status") == "ok", F.col("_raw")).otherwise(
        F.raise_error(message).cast(MESSAGES)
    )
    return rows.select("row_idx", F.transform(failing, _message).alias("messages"))


def read_conversations(lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """One row per message: (row_idx, turn, role, content, reasoning_content, functions,
    tool_calls), with ``turn`` the position in the list.

    ``quarantine`` adds ``status``; a row without messages then has one row with nulls.
    """
    nested = read_nested(lines, mode)
    kept = ["status"] if mode == "quarantine" else []
    each = F.posexplode_outer("messages") if kept else F.posexplode("messages")
    flat = nested.select("row_idx", *kept, each.alias("_at", "m"))
    return flat.select("row_idx", *kept, F.col("_at").cast("bigint").alias("turn"), "m.*")


def fold_turns(turns: DataFrame, key: str = "row_idx") -> DataFrame:
    """The inverse: messages of a conversation as one ordered array."""
    message = F.struct("turn", "role", "content")
    return turns.groupBy(key).agg(
        F.transform(
            F.array_sort(F.collect_list(message)),
            lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")),
        ).alias("messages")
    )
