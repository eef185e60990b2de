"""Label and length operations on token id arrays; all narrow, all built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORE = -100


def _ints(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(int(v)) for v in values])


def _positions(size: Column) -> Column:
    """``1..size``, empty for an empty array."""
    return F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(
        F.array().cast("array<int>")
    )


def fit_length(ids: Column, length: int, pad: int) -> Column:
    """Exactly ``length`` ids: the first ones, padded on the right."""
    kept = F.slice(ids, 1, length)
    missing = F.greatest(F.lit(length) - F.size(ids), F.lit(0))
    return F.concat(kept, F.array_repeat(F.lit(pad), missing))


def until_end(ids: Column, end: int, max_new: int) -> Column:
    """Ids before the first end id, at most ``max_new`` of them."""
    at = F.array_position(ids, end).cast("int")
    before = F.when(at > 0, at - 1).otherwise(F.size(ids))
    return F.slice(ids, F.lit(1), F.least(before, F.lit(max_new)))


def mask_value(ids: Column, hidden: int, ignore: int = IGNORE) -> Column:
    """Ids as labels, ``ignore`` wherever the id is ``hidden`` (padding)."""
    return F.transform(ids, lambda x: F.when(x == hidden, F.lit(ignore)).otherwise(x))


def match_positions(ids: Column, marker: Sequence[int]) -> Column:
    """One-based positions at which the marker starts."""
    wanted = _ints(marker)
    # The first id decides nearly always; the slice is compared only behind it.
    return F.filter(
        _positions(F.size(ids) - (len(marker) - 1)),
        lambda i: (F.get(ids, i - 1) == marker[0]) & (F.slice(ids, i, len(marker)) == wanted),
    )


def answer_spans(ids: Column, start: Sequence[int], end: Sequence[int]) -> Column:
    """Greedy spans ``(opened, begin, close, stop)``, one-based, ``stop`` exclusive.

    ``opened`` is where the start marker sits, ``begin`` the first id after it, ``close``
    the end marker or null. Start markers inside a span open nothing, and a span without an
    end marker runs to the end.
    """
    span = "struct<opened:int,begin:int,close:int,stop:int>"
    ends = match_positions(ids, end)
    past = F.size(ids) + 1

    def extend(state: Column, opened: Column) -> Column:
        begin = opened + len(start)
        close = F.array_min(F.filter(state["ends"], lambda e: e >= begin))
        stop = F.coalesce(close + len(end), past)
        added = F.struct(
            opened.alias("opened"), begin.alias("begin"), close.alias("close"), stop.alias("stop")
        ).cast(span)
        return F.when(
            opened >= state["free"],
            F.struct(
                F.concat(state["spans"], F.array(added)).alias("spans"),
                stop.alias("free"),
                state["ends"].alias("ends"),
            ),
        ).otherwise(state)

    initial = F.struct(
        F.array().cast(f"array<{span}>").alias("spans"),
        F.lit(1).alias("free"),
        ends.alias("ends"),
    )
    return F.aggregate(match_positions(ids, start), initial, extend, lambda s: s["spans"])


def answer_labels(
    ids: Column,
    start: Sequence[int],
    end: Sequence[int],
    length: int,
    ignore: int = IGNORE,
    markers_only: bool = False,
) -> Column:
    """Labels on the answers, from after the start marker through the end marker.

    With ``markers_only`` the two markers are labelled and the answers are not.
    """

    def labelled(spans: Column, i: Column) -> Column:
        if markers_only:
            return F.exists(
                spans,
                lambda s: ((i >= s["opened"]) & (i < s["begin"]))
                | ((i >= s["close"]) & (i < s["stop"])),
            )
        return F.exists(spans, lambda s: (i >= s["begin"]) & (i < s["stop"]))

    # A one-element array binds the spans, so that they are built once per row.
    return F.get(
        F.transform(
            F.array(answer_spans(ids, start, end)),
            lambda spans: F.transform(
                ids,
                lambda x, i: F.when(
                    (i < length) & F.coalesce(labelled(spans, i + 1), F.lit(False)), x
                ).otherwise(F.lit(ignore)),
            ),
        ),
        0,
    )


def next_pairs(ids: Column, labels: Column) -> Column:
    """(input at t, label at t + 1) structs; the last input and first label fall away."""
    kept = F.greatest(F.size(ids) - 1, F.lit(0))
    zipped = F.arrays_zip(
        F.slice(ids, F.lit(1), kept).alias("input"), F.slice(labels, F.lit(2), kept).alias("target")
    )
    return F.transform(
        zipped, lambda p: F.struct(p["input"].alias("input"), p["target"].alias("target"))
    )
