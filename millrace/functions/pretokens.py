"""Lossless cutting of text into pre-tokens, before the vocabulary is applied."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markers that stay whole, then words with one leading blank, each
# newline alone (so an answer's first newline never merges with the marker's), other blanks.
MARKERS = r"<[|][a-z_]+[|]>|</?(?:think|tool_call|tool_response)>"
PRETOKEN = MARKERS + r"| ?[^ \t\r\n<]+|\n|[ \t\r]+|<"
#: The same words where no marker is known.
WORDS = r" ?[^ \t\r\n]+|\n|[ \t\r]+"


def pretokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PRETOKEN), F.lit(0))
