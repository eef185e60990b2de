"""Language identification by words first, and by shorter and shorter n-grams for new words."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.base import id_type, query, slices
from millrace.session import load, written

#: The model is fitted on so many labelled texts, of so many bytes together, at most.
FIT_ROWS = 5_000
FIT_BYTES = 8 << 20
#: The longest n-grams that stand in for a new word; a mark stands at both of its ends.
LONGEST = 5
#: What is added to each count of a language.
SMOOTH = 0.5
#: Every so many-th hash of the key is held out.
FOLDS = 5
#: New words whose scores a task remembers.
REMEMBERED = 200_000
UNKNOWN = "und"

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_MARK = " "


def words(text: str | None) -> list[str]:
    """Runs of letters, with their combining marks, in lower case."""
    return _WORD.findall(text.lower()) if text else []


def grams(word: str, n: int) -> list[str]:
    marked = _MARK + word + _MARK
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Frequencies(NamedTuple):
    """Log frequencies by language, a row for each string."""

    rows: dict[str, int]
    logs: np.ndarray

    @classmethod
    def of(cls, langs: list[str], table: list[tuple[str, str, int]]) -> Frequencies:
        place = {lang: k for k, lang in enumerate(langs)}
        rows = {string: k for k, string in enumerate(sorted({string for _, string, _ in table}))}
        counts = np.full((len(rows), len(langs)), SMOOTH, dtype=np.float64)
        for lang, string, n in table:
            counts[rows[string], place[lang]] += n
        return cls(rows, np.log(counts / np.maximum(counts.sum(axis=0, keepdims=True), SMOOTH)))


class Model(NamedTuple):
    """Languages, the one with most words first, and frequencies: of words, n-grams by n down."""

    langs: list[str]
    words: Frequencies
    grams: list[tuple[int, Frequencies]]

    def of_new(self, word: str) -> np.ndarray:
        """Mean log frequencies of the word's n-grams for the longest n with a known one."""
        for n, known in self.grams:
            found = [known.rows[gram] for gram in grams(word, n) if gram in known.rows]
            if found:
                return known.logs[found].mean(axis=0)
        return np.zeros(len(self.langs))


def _sample(docs: DataFrame, rows: int, size: int) -> DataFrame:
    """``lang, text``: unlike texts, the smallest hashes of each language in turn.

    Equal texts of a language are one before they are ranked. The first of all languages
    come before the second ones, up to ``rows`` texts and ``size`` bytes; texts of more than a
    sixteenth of that come last.
    """
    named = docs.select("lang", "text", F.xxhash64("text").alias("hash"))
    sizes = named.groupBy("lang", "hash").agg(F.max(F.octet_length("text")).alias("size"))
    large = F.col("size") > size // 16
    of_lang = Window.partitionBy("lang").orderBy(large, "hash")
    nth = sizes.withColumn("nth", F.row_number().over(of_lang)).where(F.col("nth") <= rows)
    first = nth.orderBy(large, "nth", "hash", "lang").limit(rows)
    # At most ``rows`` rows of numbers.
    before = Window.orderBy(large, "nth", "hash", "lang").rowsBetween(Window.unboundedPreceding, 0)
    few = first.withColumn("until", F.sum("size").over(before)).where(F.col("until") <= size)
    few = written(few.select("lang", "hash"))
    return named.join(F.broadcast(few), ["lang", "hash"]).dropDuplicates(["lang", "hash"]).select("lang", "text")


def _counted(rows: DataFrame, make) -> DataFrame:
    """``lang, string, n``: how often ``make`` gives a string, from rows of lang, value and weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = defaultdict(Counter)
        for batch in batches:
            for lang, value, weight in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for string in make(value):
                    held[lang][string] += weight
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(counts), pa.string()),
                    pa.array(list(counts), pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["lang", "string", "n"],
            )

    found = rows.mapInArrow(run, "lang string, string string, n bigint")
    return found.groupBy("lang", "string").agg(F.sum("n").alias("n"))


def _held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == 0, F.lit(False))


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    rows: int = FIT_ROWS, size: int = FIT_BYTES,
) -> Model:
    """Frequencies of words and n-grams in labelled texts whose key is not held out.

    The sample has at most ``rows`` texts and ``size`` bytes, which bounds the model and what
    the driver sees; it takes languages in turn, so that a rare one has its share. A text
    counts once, however many copies it has. Rows with a null key, text or language teach
    nothing. No such rows give a model without languages.
    """
    taught = F.crc32(F.col(key).cast("string")) % FOLDS != 0
    labelled = docs.where(taught & F.col(text).isNotNull() & F.col(lang).isNotNull())
    labelled = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    texts = _sample(labelled, rows, size).select("lang", "text", F.lit(1).cast("bigint").alias("n"))
    counts = written(_counted(texts, words))
    parts = _counted(counts, lambda word: (g for n in range(1, LONGEST + 1) for g in grams(word, n)))

    def held(df: DataFrame) -> list[tuple[str, str, int]]:
        table = df.toArrow()
        return list(zip(*(table.column(c).to_pylist() for c in ("lang", "string", "n")), strict=True))

    known, pieces = held(counts), defaultdict(list)
    for row in held(parts):
        pieces[len(row[1])].append(row)
    totals = Counter()
    for name, _, n in known:
        totals[name] += n
    langs = sorted(totals, key=lambda name: (-totals[name], name))
    by_length = [(n, Frequencies.of(langs, pieces[n])) for n in range(LONGEST, 0, -1)]
    return Model(langs, Frequencies.of(langs, known), by_length)


class Scorer:
    """Scores texts in a task; remembers what new words give, up to a number of them."""

    def __init__(self, model: Model) -> None:
        self.model, self.new = model, {}

    def _of_new(self, word: str) -> np.ndarray:
        found = self.new.get(word)
        if found is None:
            if len(self.new) >= REMEMBERED:
                self.new.clear()
            found = self.new[word] = self.model.of_new(word)
        return found

    def __call__(self, text: str | None) -> tuple[str, float]:
        """The likeliest language of a text and its share of the likelihoods."""
        langs = self.model.langs
        found = words(text)
        if not found or not langs:
            return UNKNOWN, 0.0
        rows = list(map(self.model.words.rows.get, found))
        total = np.zeros(len(langs))
        known = [row for row in rows if row is not None]
        if known:
            total += self.model.words.logs[known].sum(axis=0)
        if len(known) < len(rows):
            for word, row in zip(found, rows, strict=True):
                if row is None:
                    total += self._of_new(word)
        best = int(np.argmax(total))
        return langs[best], float(1 / np.exp(total - total[best]).sum())


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, held_out, lang_pred, score`` of each row, from its whole text alone.

    A known word adds its log frequency in every language; a new one the mean log frequency
    of its n-grams, for the longest n of which the model knows one. ``score`` is the share of
    the likeliest language in the likelihoods of all, from 0 to 1. Ties go to the language
    with most learned words. A text that is null or has no letter is ``und`` with a score
    of 0, as is every text if no language was learned. ``held_out`` tells that the key was kept from
    learning; it is false for a null key. Repeated rows give a row each. Other columns are
    not read. A pass without any exchange.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part in slices(batches):
            found = [scorer(value) for value in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:2],
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=[key, "held_out", "lang_pred", "score"],
            )

    schema = f"`{key}` {id_type(docs, key)}, held_out boolean, lang_pred string, score double"
    return docs.select(F.col(key), _held_out(key).alias("held_out"), F.col(text)).mapInArrow(run, schema)


@query("op12_language")
def op12_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = load(spark, folder, "documents", "doc_id", "text", "lang")
    return identify(docs, train(docs))
