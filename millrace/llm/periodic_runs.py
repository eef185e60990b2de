"""Periodic runs of words in whole texts, by extensions on a harmonic grid of periods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import id_type, query
from millrace.llm.difference_cover import Extensions
from millrace.session import load

#: A run has so many words at least, and two periods.
LEAST = 12
#: Words that are sorted together, texts being kept whole, and places tried at a time.
TOGETHER = 1 << 16
TRIED = 1 << 20


def _grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) with the place a multiple of the period and another one behind it."""
    period = 1
    while 2 * period <= n:
        # As many periods as fit; one at least.
        counts = (n - 1) // np.arange(period, n // 2 + 1)
        few = max(1, int(np.searchsorted(np.cumsum(counts), TRIED, side="right")))
        counts = counts[:few]
        periods = np.repeat(np.arange(period, period + few), counts)
        nth = np.arange(len(periods)) - np.repeat(np.cumsum(counts) - counts, counts)
        yield nth * periods, periods
        period += few


def find_runs(texts: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """For each list of words its runs as rows of (start, length, period), in that order.

    A run is a longest stretch with a smallest period q, of ``least`` words and two periods at
    least. It holds a multiple of q among its first q words, and the word q behind that. So
    the places 0, q, 2q, .. of each period q are tried; how far a place and the next one
    agree forwards and backwards gives the stretch. It is taken from its first place only,
    and of the periods of a stretch the smallest.
    """
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    # Texts stand between symbols of their own: end 0, text 0, end 1, text 1, .. end.
    starts = np.cumsum(sizes + 1) - sizes
    total = int(sizes.sum()) + len(texts) + 1
    coded = pa.array([word for words in texts for word in words], pa.large_binary()).dictionary_encode()
    symbols = np.empty(total, dtype=np.int64)
    inner = np.ones(total, dtype=bool)
    ends = np.concatenate((starts - 1, [total - 1]))
    inner[ends] = False
    symbols[inner] = coded.indices.to_numpy()
    symbols[ends] = len(coded.dictionary) + np.arange(len(ends))
    # Only pairs whose words are the same can lie in a run.
    places, periods = [], []
    for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
        own = symbols[start : start + size]
        for place, period in _grid(size) if size >= least else ():
            same = np.flatnonzero(own[place] == own[place + period])
            places.append(place[same] + start)
            periods.append(period[same])
    if not places or not sum(map(len, places)):
        return [np.zeros((0, 3), dtype=np.int64) for _ in texts]
    owner = np.searchsorted(starts, np.arange(total), side="right")
    forward = Extensions(symbols, owner)
    backward = Extensions(symbols[::-1].copy(), np.searchsorted(starts - 1, np.arange(total), side="right")[::-1].copy())
    found = []
    for place, period in zip(places, periods, strict=True):
        for at in range(0, len(place), TRIED):
            found.append(_stretches(forward, backward, place[at : at + TRIED], period[at : at + TRIED], least, total))
    runs = np.concatenate(found)
    # By stretch, smallest period first: it is kept.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    keep = np.ones(len(runs), dtype=bool)
    keep[1:] = (runs[1:, 0] != runs[:-1, 0]) | (runs[1:, 1] != runs[:-1, 1])
    runs = runs[keep]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    bounds = np.searchsorted(runs[:, 0], ends)
    parts = [runs[a:b].copy() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for part, start in zip(parts, starts.tolist(), strict=True):
        part[:, 0] -= start
    return parts


def _stretches(forward, backward, place, period, least: int, total: int) -> np.ndarray:
    ahead = forward.of(place, place + period)
    # At most period - 1 words more to the left, or an earlier place has the run.
    long = ahead + 2 * period - 1 >= np.maximum(least, 2 * period)
    place, period, ahead = place[long], period[long], ahead[long]
    # The words before both places, in the reversed array.
    back = backward.of(total - place - period, total - place)
    length = period + ahead + back
    run = (back < period) & (length >= np.maximum(least, 2 * period))
    return np.stack((place - back, length, period), axis=1)[run]


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those in a run behind its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(edges[:-1]) > 0
    return [word for word, drop in zip(words, dropped.tolist(), strict=True) if not drop]


def periodic_runs(
    docs: DataFrame, least: int = LEAST, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_words, runs, collapsed`` of each row, over whole texts.

    Words stand between blanks and control breaks. ``runs`` are structs of start, length and
    period in words, by start, then period; ``collapsed`` is the text with single blanks and without
    the words that repeat an earlier period of a run. A null text has no words. Each row is
    worked on by itself: null, equal and repeated keys give a row each; other columns are
    not read. A pass without any exchange; short texts are sorted together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            first, held, size = 0, [], 0
            for k, value in enumerate(texts):
                held.append((value or "").encode().split())
                size += len(held[-1])
                if size >= TOGETHER or k + 1 == len(texts):
                    yield rows(batch.column(0).slice(first, len(held)), held)
                    first, held, size = k + 1, [], 0

    def rows(keys: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = find_runs(texts, least)
        flat = np.concatenate(found)
        offsets = np.concatenate(([0], np.cumsum([len(runs) for runs in found])))
        columns = [pa.array(flat[:, k]) for k in range(3)]
        runs = pa.StructArray.from_arrays(columns, ["start", "length", "period"])
        collapsed = [b" ".join(kept_words(*pair)) for pair in zip(texts, found, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                keys,
                pa.array([len(words) for words in texts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ],
            names=[key, "n_words", "runs", "collapsed"],
        )

    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    schema = f"`{key}` {id_type(docs, key)}, n_words bigint, runs {runs}, collapsed string"
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def with_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text`` with a tenth of the texts made periodic behind some word, by a hash of the key.

    With h the CRC-32 of the key as text and g = floor(h / 10), a text of n > 0 words with
    h % 10 = 0 has as word i from a = g % n on its word a + (i - a) % p, where p = 1 +
    floor((n - a) / (3 + g % 8)). Other texts stay as they are, as do those with a null key.
    """
    chosen = F.crc32(F.col(key).cast("string"))
    words = F.filter(F.split("_text", r"[\x20\x09-\x0D]+", -1), lambda word: word != "")
    some = docs.select(F.col(key), F.col(text).alias("_text"), chosen.alias("_h")).withColumn(
        "_words", F.when(F.col("_h") % 10 == 0, words)
    )
    some = some.withColumn("_n", F.size("_words")).withColumn("_g", F.floor(F.col("_h") / 10))
    some = some.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    some = some.withColumn("_p", F.expr("1 + floor((_n - _a) / (3 + _g % 8))"))
    again = F.expr(
        "array_join(transform(_words, (w, i) -> if(i < _a, w, _words[int(_a + (i - _a) % _p)])), ' ')"
    )
    made = F.when(F.col("_n") > 0, again).otherwise(F.col("_text"))
    return some.select(F.col(key), made.alias(text))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of all documents, a tenth of them made periodic, and digests of what is left."""
    docs = with_repeats(load(spark, folder, "documents", "doc_id", "text"))
    found = periodic_runs(docs)
    longest = F.expr(
        "reduce(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>),"
        " (best, x) -> if(best is null or x.length > best.length, x, best))"
    )
    lines = F.expr(
        "array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')), '')"
    )
    rows = found.select("doc_id", "runs", "collapsed", longest.alias("_top"), lines.alias("_lines"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("_top.start").alias("start"),
        F.col("_top.length").alias("length"),
        F.col("_top.period").alias("period"),
        F.expr("_top.length * 1000 div _top.period").alias("exponent_milli"),
        F.sha2("_lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
