"""Chat templates and conversation context.

The conversations table has plain turns only, so some queries first derive tool runs, tool
calls, signatures and thoughts from it, the same way in Spark and in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import query, turns
from millrace.operators import context, templates
from millrace.operators.templates import PLAIN, REASONING, Turn
from millrace.session import load

KEY = "conv_id"

# --- derived turns -----------------------------------------------------------------------


def varied_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Tool runs, a late system turn, an unknown role, empty answers, wrapped queries and
    inline thoughts, by position in the conversation."""
    turn, text = F.col("turn"), F.col("content")
    role = (
        F.when(turn.isin(2, 3), "tool")
        .when(turn == 5, "system")
        .when(turn == 6, "observer")
        .otherwise(F.col("role"))
    )
    content = (
        F.when((F.col("role") == "user") & (F.col("conv_id") % 4 == 1),
               F.concat(F.lit("<tool_response>"), text, F.lit("</tool_response>")))
        .when((F.col("role") == "assistant") & ((F.col("conv_id") + turn) % 3 == 1),
              F.concat(F.lit("<think>\n"), F.left(text, F.lit(24)), F.lit("\n</think>\n\n"), text))
        .when((F.col("role") == "assistant") & ((F.col("conv_id") + turn) % 5 == 2), F.lit(""))
        .otherwise(text)
    )
    return turns(spark, folder).select(KEY, "turn", role.alias("role"), content.alias("content"))


_VARIED = """
varied AS (
  SELECT conv_id, turn,
    CASE WHEN turn IN (2, 3) THEN 'tool' WHEN turn = 5 THEN 'system' WHEN turn = 6 THEN 'observer'
      ELSE role END AS role,
    CASE WHEN role = 'user' AND conv_id % 4 = 1 THEN '<tool_response>' || text || '</tool_response>'
      WHEN role = 'assistant' AND (conv_id + turn) % 3 = 1
        THEN '<think>' || chr(10) || left(text, 24) || chr(10) || '</think>' || chr(10) || chr(10) || text
      WHEN role = 'assistant' AND (conv_id + turn) % 5 = 2 THEN ''
      ELSE text END AS content
  FROM conversations)"""


def tool_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Signatures on leading system turns and tool calls on assistant turns."""
    name = F.concat(F.lit("find_"), F.col("conv_id").cast("string"))
    signature = F.concat(
        F.lit('{"type": "function", "function": {"name": "'), name, F.lit('"}}')
    )
    other = F.lit('{"type": "function", "function": {"name": "other"}}')
    base = varied_turns(spark, folder)

    def call(i):
        arguments = F.concat(F.lit('{"n": '), i.cast("string"), F.lit("}"))
        return F.struct(name.alias("name"), arguments.alias("arguments"))

    n_calls = (F.col("turn") % 3).cast("int")
    calls = F.when(n_calls > 0, F.transform(F.sequence(F.lit(1), n_calls), call))
    return base.withColumns(
        {
            "functions": F.when(F.col("turn") == 0, F.array(signature, other)),
            "tool_calls": F.when(F.col("role") == "assistant", calls),
        }
    )


# --- SQL of the templates ----------------------------------------------------------------

_NL = "chr(10)"


def _sql_block(role: str, body: str) -> str:
    return f"('<|im_start|>' || {role} || {_NL} || {body} || '<|im_end|>' || {_NL})"


def _sql_text(text: str) -> str:
    return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in text.split("\n"))


_TOOLS_BLOCK = _sql_block(
    "'system'",
    f"content || {_sql_text(chr(10) * 2 + templates.TOOLS_BEFORE)}"
    """ || chr(10) || '{"type": "function", "function": {"name": "find_' || conv_id || '"}}'"""
    """ || chr(10) || '{"type": "function", "function": {"name": "other"}}'"""
    f" || {_sql_text(templates.TOOLS_AFTER)}",
)
_CALLS = """array_to_string(list_transform(range(1, turn % 3 + 1), lambda i:
  CASE WHEN i > 1 OR answer <> '' THEN chr(10) ELSE '' END || '<tool_call>' || chr(10)
  || '{"name": "find_' || conv_id || '", "arguments": {"n": ' || i || '}}' || chr(10)
  || '</tool_call>'), '')"""
# Facts and neighbours of every turn, then answer and thought of the reasoning style.
_FACTS = f"""{_VARIED},
facts AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
    max(turn) OVER (PARTITION BY conv_id) AS last_turn,
    coalesce(max(CASE WHEN role = 'user' AND NOT (starts_with(content, '<tool_response>')
      AND ends_with(content, '</tool_response>')) THEN turn END) OVER (PARTITION BY conv_id),
      max(turn) OVER (PARTITION BY conv_id)) AS last_query
  FROM varied WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
split AS (
  SELECT *,
    CASE WHEN contains(content, '</think>')
      THEN ltrim(split_part(content, '</think>', -1), chr(10)) ELSE content END AS answer,
    CASE WHEN contains(content, '</think>') THEN ltrim(split_part(
      rtrim(split_part(content, '</think>', 1), chr(10)), '<think>', -1), chr(10))
      ELSE '' END AS thought
  FROM facts),
shown AS (
  SELECT *, CASE WHEN turn > last_query AND (turn = last_turn OR thought <> '')
      THEN '<think>' || chr(10) || trim(thought, chr(10)) || chr(10) || '</think>' || chr(10)
        || chr(10) || ltrim(answer, chr(10)) ELSE answer END AS reply
  FROM split)"""
_TOOL_SEGMENT = f"""CASE WHEN before IS DISTINCT FROM 'tool' THEN '<|im_start|>user' ELSE '' END
  || {_NL} || '<tool_response>' || {_NL} || content || {_NL} || '</tool_response>'
  || CASE WHEN after IS DISTINCT FROM 'tool' THEN '<|im_end|>' || {_NL} ELSE '' END"""
_PLAIN_BLOCK = _sql_block("'system'", "'You are a helpful assistant'")


def _sql_segment(style: str, body: str = "", calls: str = "''", tools: bool = False) -> str:
    answer = body or ("reply" if style == "reasoning" else "content")
    default = _PLAIN_BLOCK if style == "plain" else "''"
    system = _TOOLS_BLOCK if tools else _sql_block("'system'", "content")
    return f"""CASE WHEN turn > 0 THEN '' WHEN role = 'system' THEN {system} ELSE {default} END
  || CASE WHEN role = 'user' OR (role = 'system' AND turn > 0) THEN {_sql_block('role', 'content')}
     WHEN role = 'assistant' THEN {_sql_block("'assistant'", f"{answer} || {calls}")}
     WHEN role = 'tool' THEN {_TOOL_SEGMENT} ELSE '' END"""


def _sql_render(style: str, tools: bool = False, calls: str = "''", ending: str = "''") -> str:
    return f"""SELECT '{style}' AS style, conv_id,
      string_agg({_sql_segment(style, calls=calls, tools=tools)}, '' ORDER BY turn) || {ending} AS text
    FROM shown GROUP BY conv_id"""


def _both(make) -> DataFrame:
    plain = make(PLAIN).withColumn("style", F.lit("plain"))
    return plain.unionByName(make(REASONING).withColumn("style", F.lit("reasoning")))


# --- queries -----------------------------------------------------------------------------


@query(
    "tmpl_system",
    f"""WITH {_VARIED}
        SELECT 'plain' AS style, conv_id, CASE WHEN role = 'system'
          THEN {_sql_block("'system'", "content")} ELSE {_PLAIN_BLOCK} END AS text
        FROM varied WHERE turn = 0
        UNION ALL
        SELECT 'reasoning', conv_id, CASE WHEN role = 'system'
          THEN {_sql_block("'system'", "content")} ELSE '' END
        FROM varied WHERE turn = 0""",
)
def tmpl_system(spark: SparkSession, folder: str) -> DataFrame:
    rows = varied_turns(spark, folder).withColumn("functions", F.lit(None).cast("array<string>"))
    return _both(
        lambda style: rows.where("turn = 0").select(
            KEY, templates.system_text(Turn.flat(), style).alias("text")
        )
    )


@query(
    "tmpl_tools",
    f"""WITH {_VARIED} SELECT conv_id, {_TOOLS_BLOCK} AS text FROM varied
        WHERE turn = 0 AND role = 'system'""",
)
def tmpl_tools(spark: SparkSession, folder: str) -> DataFrame:
    rows = tool_turns(spark, folder).where((F.col("turn") == 0) & (F.col("role") == "system"))
    return rows.select(KEY, templates.tools_text(Turn.flat()).alias("text"))


@query(
    "tmpl_turn",
    f"""WITH {_VARIED} SELECT conv_id, turn, {_sql_block('role', 'content')} AS text FROM varied
        WHERE role = 'user' OR (role = 'system' AND turn > 0)""",
)
def tmpl_turn(spark: SparkSession, folder: str) -> DataFrame:
    rows = varied_turns(spark, folder).select(KEY, "turn", templates.turn_text(Turn.flat()).alias("text"))
    return rows.where(F.col("text").isNotNull())


@query(
    "tmpl_assistant",
    f"""WITH {_FACTS} SELECT conv_id, turn,
          {_sql_block("'assistant'", f"content || {_CALLS.replace('answer', 'content')}")} AS text
        FROM shown WHERE role = 'assistant'""",
)
def tmpl_assistant(spark: SparkSession, folder: str) -> DataFrame:
    rows = tool_turns(spark, folder).where(F.col("role") == "assistant")
    return rows.select(KEY, "turn", templates.assistant_text(Turn.flat(), PLAIN).alias("text"))


@query(
    "tmpl_tool_runs",
    f"""WITH {_FACTS} SELECT conv_id, turn, {_TOOL_SEGMENT} AS text FROM shown
        WHERE role = 'tool'""",
)
def tmpl_tool_runs(spark: SparkSession, folder: str) -> DataFrame:
    rows = templates.with_tool_runs(varied_turns(spark, folder), KEY)
    return rows.where(F.col("role") == "tool").select(
        KEY, "turn", templates.tool_text(Turn.flat()).alias("text")
    )


@query("last_query", f"WITH {_FACTS} SELECT DISTINCT conv_id, last_turn, last_query FROM facts")
def last_query(spark: SparkSession, folder: str) -> DataFrame:
    return templates.query_facts(varied_turns(spark, folder), KEY)


@query(
    "split_reasoning",
    f"WITH {_FACTS} SELECT conv_id, turn, answer, thought FROM split WHERE role = 'assistant'",
)
def split_reasoning(spark: SparkSession, folder: str) -> DataFrame:
    rows = varied_turns(spark, folder).where(F.col("role") == "assistant")
    rows = rows.withColumn("reasoning_content", F.lit(None).cast("string"))
    answer, thought = templates.split_reasoning(Turn.flat(), REASONING)
    return rows.select(KEY, "turn", answer.alias("answer"), thought.alias("thought"))


@query(
    "think_block",
    f"WITH {_FACTS} SELECT conv_id, turn, reply AS text FROM shown WHERE role = 'assistant'",
)
def think_block(spark: SparkSession, folder: str) -> DataFrame:
    rows = varied_turns(spark, folder)
    answers = rows.where(F.col("role") == "assistant").withColumn(
        "reasoning_content", F.lit(None).cast("string")
    )
    known = answers.join(templates.query_facts(rows, KEY), KEY)
    return known.select(KEY, "turn", templates.answer_body(Turn.flat(), REASONING).alias("text"))


@query(
    "generation_prompt",
    f"""WITH {_FACTS}
        {_sql_render('plain', ending=_sql_text(templates.answer_prompt()))} UNION ALL
        {_sql_render('reasoning', ending=_sql_text(templates.answer_prompt(False)))}""",
)
def generation_prompt(spark: SparkSession, folder: str) -> DataFrame:
    rows = varied_turns(spark, folder)
    return _both(
        lambda style: templates.render(
            rows, style, KEY, generation_prompt=True,
            enable_thinking=False if style.reasoning else None,
        )
    )


@query(
    "render_chat",
    f"""WITH {_FACTS}
        {_sql_render('plain', True, _CALLS.replace('answer', 'content'))} UNION ALL
        {_sql_render('reasoning', True, _CALLS)}""",
)
def render_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = tool_turns(spark, folder)
    return _both(lambda style: templates.render(rows, style, KEY))


@query(
    "render_nested",
    f"""WITH {_FACTS}
        {_sql_render('plain', True, _CALLS.replace('answer', 'content'))} UNION ALL
        {_sql_render('reasoning', True, _CALLS)}""",
)
def render_nested(spark: SparkSession, folder: str) -> DataFrame:
    message = F.struct(
        "turn", "role", "content", F.lit(None).cast("string").alias("reasoning_content"),
        "functions", "tool_calls",
    )
    rows = tool_turns(spark, folder).groupBy(KEY).agg(
        F.array_sort(F.collect_list(message)).alias("messages")
    )
    return _both(lambda style: templates.render_nested(rows, style, KEY))


@query(
    "turn_segments",
    f"""WITH {_FACTS}
        SELECT 'plain' AS style, conv_id, turn, {_sql_segment('plain')} AS segment FROM shown
        UNION ALL
        SELECT 'reasoning', conv_id, turn, {_sql_segment('reasoning')} FROM shown""",
)
def turn_segments(spark: SparkSession, folder: str) -> DataFrame:
    rows = varied_turns(spark, folder)
    return _both(lambda style: templates.segments(rows, style, KEY))


# --- context -----------------------------------------------------------------------------


@query(
    "until_stop",
    """WITH prompts AS (
         SELECT user_id, event_id,
                CASE event_type WHEN 'error' THEN 'exit' WHEN 'signup' THEN '' ELSE event_type END
                  AS prompt
         FROM events),
       stops AS (
         SELECT user_id, min(CASE WHEN prompt IN ('quit', 'exit') THEN event_id END) AS stop,
                min(CASE WHEN prompt IN ('quit', 'exit', '') THEN event_id END) AS any_stop
         FROM prompts GROUP BY user_id)
       SELECT false AS interactive, user_id, event_id, prompt FROM prompts JOIN stops USING (user_id)
       WHERE stop IS NULL OR event_id < stop
       UNION ALL
       SELECT true, user_id, event_id, prompt FROM prompts JOIN stops USING (user_id)
       WHERE any_stop IS NULL OR event_id < any_stop""",
)
def until_stop(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    prompts = load(spark, folder, "events").select(
        "user_id",
        "event_id",
        F.when(kind == "error", "exit").when(kind == "signup", "").otherwise(kind).alias("prompt"),
    )

    def kept(interactive: bool) -> DataFrame:
        rows = context.until_stop(prompts, "user_id", "event_id", "prompt", interactive)
        return rows.withColumn("interactive", F.lit(interactive))

    return kept(False).unionByName(kept(True))


def _history_sql(n: int) -> str:
    return f"""SELECT {n} AS n, conv_id, turn AS prompt_turn, seen FROM (
      SELECT conv_id, turn, role, string_agg(role || ': ' || text, chr(10)) OVER (
        PARTITION BY conv_id ORDER BY turn ROWS BETWEEN {n} PRECEDING AND CURRENT ROW) AS seen
      FROM conversations) WHERE role = 'user'"""


@query("history_window", f"{_history_sql(2)} UNION ALL {_history_sql(0)}")
def history_window(spark: SparkSession, folder: str) -> DataFrame:
    rows = turns(spark, folder)
    line = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))

    def windows(n: int) -> DataFrame:
        return context.history(rows, n, KEY).select(
            F.lit(n).alias("n"), KEY, "prompt_turn", F.array_join(line, "\n").alias("seen")
        )

    return windows(2).unionByName(windows(0))


@query(
    "prompt_build",
    f"""WITH placed AS (
          SELECT a.conv_id, a.turn AS prompt_turn, b.turn, b.role, b.text AS content,
                 b.turn = greatest(a.turn - 2, 0) AS leads
          FROM conversations a JOIN conversations b
            ON a.conv_id = b.conv_id AND b.turn BETWEEN a.turn - 2 AND a.turn
          WHERE a.role = 'user')
        SELECT 'sft' AS mode, conv_id, prompt_turn,
          string_agg(CASE WHEN leads AND role <> 'system' THEN {_PLAIN_BLOCK} ELSE '' END
            || {_sql_block('role', 'content')}, '' ORDER BY turn)
            || '<|im_start|>assistant' || chr(10) AS text
        FROM placed GROUP BY conv_id, prompt_turn
        UNION ALL
        SELECT 'pretrain', conv_id, turn, '<|im_start|>assistant' || text FROM conversations
        WHERE role = 'user'""",
)
def prompt_build(spark: SparkSession, folder: str) -> DataFrame:
    rows = turns(spark, folder)
    chat = context.chat_prompts(rows, PLAIN, 2, KEY).withColumn("mode", F.lit("sft"))
    raw = rows.where(F.col("role") == "user").select(
        KEY,
        F.col("turn").alias("prompt_turn"),
        context.raw_prompt(F.col("content")).alias("text"),
        F.lit("pretrain").alias("mode"),
    )
    return chat.unionByName(raw)


@query(
    "append_reply",
    """WITH ends AS (
         SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text
         FROM conversations GROUP BY conv_id)
       SELECT conv_id, turn, role, text AS content FROM conversations
       UNION ALL
       SELECT conv_id, turn + 1, 'assistant', 'Re: ' || text FROM ends WHERE role = 'user'""",
)
def append_reply(spark: SparkSession, folder: str) -> DataFrame:
    rows = turns(spark, folder)
    last = rows.groupBy(KEY).agg(F.max(F.struct("turn", "role", "content")).alias("m"))
    replies = last.where(F.col("m.role") == "user").select(
        KEY, F.concat(F.lit("Re: "), F.col("m.content")).alias("content")
    )
    return context.append_replies(rows, replies, KEY)
