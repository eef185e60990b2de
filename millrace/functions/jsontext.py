"""JSON text in the spacing that Python's ``json.dumps`` writes (``", "`` and ``": "``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# From the last match on, string literals and other characters up to the next separator.
_UP_TO_SEPARATOR = r'\G((?:"(?:[^"\\]++|\\.)*+"|[^",:]++)*+)([,:])'


def spaced(compact: Column) -> Column:
    """Add the blank after every separator outside string literals."""
    return F.regexp_replace(compact, _UP_TO_SEPARATOR, "$1$2 ")


def quoted(text: Column) -> Column:
    """One string as a JSON literal, non-ASCII characters kept."""
    wrapped = F.to_json(F.array(text))
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def message_list(messages: Column) -> Column:
    """An array of (role, content) structs as a JSON array of objects."""
    items = F.transform(
        messages,
        lambda m: F.concat(
            F.lit('{"role": '), quoted(m["role"]),
            F.lit(', "content": '), quoted(m["content"]),
            F.lit("}"),
        ),
    )
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
