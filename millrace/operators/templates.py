"""Chat templates: one text segment per turn, joined per conversation."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.blocks import with_blocks
from millrace.session import limit_groups_early

# The markers and texts of both templates.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>\n"
ANSWER_START = "<|im_start|>assistant\n"
DEFAULT_SYSTEM = "You are a helpful assistant"
EMPTY_THOUGHT = "<think>\n\n</think>\n\n"
TOOLS_BEFORE = (
    "# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_AFTER = (
    "\n</tools>\n\nFor each function call, return a json object with function name and arguments "
    "within <tool_call></tool_call> XML tags:\n<tool_call>\n"
    '{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call>'
)
RENDERED_ROLES = ("system", "user", "assistant", "tool")

_OPTIONAL = {
    "reasoning_content": "string",
    "functions": "array<string>",
    "tool_calls": "array<struct<name:string,arguments:string>>",
}


@dataclass(frozen=True)
class ChatStyle:
    """``default_system`` opens conversations without a system turn; ``reasoning`` keeps
    the thoughts of answers after the last query."""

    default_system: str | None
    reasoning: bool


PLAIN = ChatStyle(default_system=DEFAULT_SYSTEM, reasoning=False)
REASONING = ChatStyle(default_system=None, reasoning=True)


def _full(turns: DataFrame) -> DataFrame:
    missing = {
        name: F.lit(None).cast(kind)
        for name, kind in _OPTIONAL.items()
        if name not in turns.columns
    }
    return turns.withColumns(missing) if missing else turns


def _block(role: Column | str, body: Column) -> Column:
    name = F.lit(role) if isinstance(role, str) else role
    return F.concat(F.lit(TURN_START), name, F.lit("\n"), body, F.lit(TURN_END))


def _no_newlines_before(text: Column) -> Column:
    return F.ltrim(text, F.lit("\n"))


# --- per conversation -------------------------------------------------------------------


def is_query(role: Column, content: Column) -> Column:
    """A user turn that is not a wrapped tool response."""
    wrapped = content.startswith("<tool_response>") & content.endswith("</tool_response>")
    return (role == "user") & content.isNotNull() & ~wrapped


def query_facts(turns: DataFrame, *keys: str) -> DataFrame:
    """Last turn and last query of each conversation, combined before the exchange.

    Without any query the last turn takes its place.
    """
    query = is_query(F.col("role"), F.col("content"))
    return turns.groupBy(*keys).agg(
        F.max("turn").alias("last_turn"),
        F.coalesce(F.max(F.when(query, F.col("turn"))), F.max("turn")).alias("last_query"),
    )


def leading_turns(turns: DataFrame, count: int, *keys: str) -> DataFrame:
    """The first ``count`` + 1 turns that can render: enough for the first ``count`` tokens.

    Every rendered turn gives at least one token. The rank filter is applied on the map side
    too, so even a conversation that holds much of the table sends few rows.
    """
    limit_groups_early(turns.sparkSession, count + 1)
    order = Window.partitionBy(*keys).orderBy("turn")
    return (
        turns.where(F.col("role").isin(*RENDERED_ROLES) | (F.col("turn") == 0))
        .withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") <= count + 1)
        .drop("_nth")
    )


def with_tool_runs(turns: DataFrame, *keys: str, blocks: bool = True) -> DataFrame:
    """Mark where a run of neighbouring tool turns opens and closes.

    ``blocks`` cuts long conversations into overlapping blocks; leave it off for short or
    already limited ones to keep their partitioning by ``keys``.
    """
    source = with_blocks(turns, "turn", before=1, after=1) if blocks else turns
    cut = [*keys, "_block"] if blocks else list(keys)
    order = Window.partitionBy(*cut).orderBy("turn")

    def tool_at(neighbour, distance: int) -> Column:
        same_run = (neighbour("turn", 1).over(order) - F.col("turn")) == distance
        return F.coalesce(same_run & (neighbour("role", 1).over(order) == "tool"), F.lit(False))

    is_tool = F.col("role") == "tool"
    marked = source.withColumns(
        {"opens_run": is_tool & ~tool_at(F.lag, -1), "closes_run": is_tool & ~tool_at(F.lead, 1)}
    )
    return marked.where("_own").drop("_own", "_block") if blocks else marked


# --- per turn ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Turn:
    """The columns a turn is rendered from: those of a flat row, or an array element."""

    turn: Column
    role: Column
    content: Column
    reasoning_content: Column
    functions: Column
    tool_calls: Column
    opens_run: Column
    closes_run: Column
    last_turn: Column
    last_query: Column

    @classmethod
    def flat(cls) -> Turn:
        return cls(*[F.col(f.name) for f in fields(cls)])

    @classmethod
    def nested(cls, message: Column, i: Column, messages: Column, facts: Column) -> Turn:
        def is_tool(at: Column) -> Column:
            return F.coalesce(F.get(messages, at)["role"] == "tool", F.lit(False))

        return cls(
            i, message["role"], message["content"], message["reasoning_content"],
            message["functions"], message["tool_calls"],
            is_tool(i) & ~is_tool(i - 1), is_tool(i) & ~is_tool(i + 1),
            facts["last_turn"], facts["last_query"],
        )

    @property
    def text(self) -> Column:
        """Content that is not text counts as empty."""
        return F.coalesce(self.content, F.lit(""))


def tools_text(t: Turn) -> Column:
    """The system block that lists one signature per line."""
    listed = F.array_join(F.transform(t.functions, lambda f: F.concat(F.lit("\n"), f)), "")
    return _block(
        "system",
        F.concat(t.text, F.lit("\n\n" + TOOLS_BEFORE), listed, F.lit(TOOLS_AFTER)),
    )


def system_text(t: Turn, style: ChatStyle) -> Column:
    """What opens a conversation; null on later turns."""
    leads = t.role == "system"
    default = (
        F.lit("") if style.default_system is None else _block("system", F.lit(style.default_system))
    )
    opening = (
        F.when(leads & (F.size(t.functions) > 0), tools_text(t))
        .when(leads, _block("system", t.text))
        .otherwise(default)
    )
    return F.when(t.turn == 0, opening)


def split_reasoning(t: Turn, style: ChatStyle) -> tuple[Column, Column]:
    """(answer, thought) of an assistant turn; the plain style keeps the content whole."""
    if not style.reasoning:
        return t.text, F.lit("")
    given = t.reasoning_content
    closed = t.text.contains("</think>")
    after = _no_newlines_before(F.substring_index(t.text, "</think>", -1))
    answer = F.when(given.isNull() & closed, after).otherwise(t.text)
    before = F.rtrim(F.substring_index(t.text, "</think>", 1), F.lit("\n"))
    inline = _no_newlines_before(F.substring_index(before, "<think>", -1))
    return answer, F.coalesce(given, F.when(closed, inline), F.lit(""))


def answer_body(t: Turn, style: ChatStyle) -> Column:
    """Answer text with its think block, if the turn keeps one."""
    answer, thought = split_reasoning(t, style)
    if not style.reasoning:
        return answer
    shown = (t.turn > t.last_query) & ((t.turn == t.last_turn) | (thought != ""))
    block = F.concat(
        F.lit("<think>\n"), F.trim(thought, F.lit("\n")), F.lit("\n</think>\n\n"),
        _no_newlines_before(answer),
    )
    return F.when(shown, block).otherwise(answer)


def calls_text(t: Turn, style: ChatStyle) -> Column:
    answer, _ = split_reasoning(t, style)

    def one(call: Column, i: Column) -> Column:
        gap = F.when((i > 0) | (answer != ""), F.lit("\n")).otherwise(F.lit(""))
        return F.concat(
            gap, F.lit('<tool_call>\n{"name": "'), call["name"],
            F.lit('", "arguments": '), call["arguments"], F.lit("}\n</tool_call>"),
        )

    return F.coalesce(F.array_join(F.transform(t.tool_calls, one), ""), F.lit(""))


def assistant_text(t: Turn, style: ChatStyle) -> Column:
    return _block("assistant", F.concat(answer_body(t, style), calls_text(t, style)))


def tool_text(t: Turn) -> Column:
    """One tool response inside the user block that its run shares."""
    return F.concat(
        F.when(t.opens_run, F.lit(TURN_START + "user")).otherwise(F.lit("")),
        F.lit("\n<tool_response>\n"), t.text, F.lit("\n</tool_response>"),
        F.when(t.closes_run, F.lit(TURN_END)).otherwise(F.lit("")),
    )


def turn_text(t: Turn) -> Column:
    """A user turn, or a system turn that does not lead; null otherwise."""
    plain = (t.role == "user") | ((t.role == "system") & (t.turn > 0))
    return F.when(plain, _block(t.role, t.text))


def segment_text(t: Turn, style: ChatStyle) -> Column:
    """All that a turn adds to the text. Unknown roles add nothing."""
    body = F.coalesce(
        turn_text(t),
        F.when(t.role == "assistant", assistant_text(t, style)).when(
            t.role == "tool", tool_text(t)
        ),
        F.lit(""),
    )
    return F.concat(F.coalesce(system_text(t, style), F.lit("")), body)


# --- whole texts ------------------------------------------------------------------------


def segments(
    turns: DataFrame,
    style: ChatStyle,
    *keys: str,
    facts: DataFrame | None = None,
    blocks: bool = True,
) -> DataFrame:
    """(keys, turn, segment) for a flat table of turns."""
    rows = with_tool_runs(_full(turns), *keys, blocks=blocks)
    if style.reasoning:
        known = query_facts(turns, *keys) if facts is None else facts
        rows = rows.join(known, list(keys))
    return rows.select(*keys, "turn", segment_text(Turn.flat(), style).alias("segment"))


def answer_prompt(enable_thinking: bool | None = None) -> str:
    """What a prompt ends with; thinking switched off adds an empty think block."""
    return ANSWER_START + (EMPTY_THOUGHT if enable_thinking is False else "")


def render(
    turns: DataFrame,
    style: ChatStyle,
    *keys: str,
    generation_prompt: bool = False,
    enable_thinking: bool | None = None,
    tokens: int | None = None,
) -> DataFrame:
    """(keys, text): whole conversations of a flat table as template text.

    ``tokens`` says how many leading tokens the caller keeps, as training samples do. Turns
    that cannot reach them are then left out before the exchange.
    """
    facts = query_facts(turns, *keys) if style.reasoning else None
    rows = turns if tokens is None else leading_turns(turns, tokens, *keys)
    parts = segments(rows, style, *keys, facts=facts, blocks=False)
    ordered = F.array_sort(F.collect_list(F.struct("turn", "segment")))
    joined = F.array_join(F.transform(ordered, lambda s: s["segment"]), "")
    text = _ended(joined, generation_prompt, enable_thinking)
    return parts.groupBy(*keys).agg(text.alias("text"))


def _ended(text: Column, generation_prompt: bool, enable_thinking: bool | None) -> Column:
    return F.concat(text, F.lit(answer_prompt(enable_thinking))) if generation_prompt else text


def nested_facts(messages: Column) -> Column:
    """What :func:`query_facts` gives, from the message array of one conversation."""
    last = F.size(messages) - 1
    queries = F.transform(messages, lambda m, i: F.when(is_query(m["role"], m["content"]), i))
    return F.struct(
        last.alias("last_turn"), F.coalesce(F.array_max(queries), last).alias("last_query")
    )


def render_nested(
    conversations: DataFrame,
    style: ChatStyle,
    *keys: str,
    messages: str = "messages",
    generation_prompt: bool = False,
    enable_thinking: bool | None = None,
) -> DataFrame:
    """(keys, text) where a row already holds its conversation: no exchange at all."""
    array = F.col(messages)
    facts = nested_facts(array)
    parts = F.transform(array, lambda m, i: segment_text(Turn.nested(m, i, array, facts), style))
    text = _ended(F.array_join(parts, ""), generation_prompt, enable_thinking)
    return conversations.select(*keys, text.alias("text"))
