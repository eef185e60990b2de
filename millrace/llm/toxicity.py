"""Toxicity categories by classifier chains over hashed words."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import id_type, query
from millrace.llm.linear import Rows, fit, predict
from millrace.llm.shingles import chunks, word_hashes
from millrace.session import load, written

#: Labelled rows that a chain is fitted on: those with the smallest hashes of their id.
SAMPLE_ROWS = 20_000
#: Words are hashed to so many columns, of which each category keeps the most telling ones.
COLUMNS = 1 << 20
KEPT_COLUMNS = 512
#: The least chi square of a kept column; chance gives so much to one in ten thousand.
LEAST_SCORE = 15.0
FOLDS = 3
#: Languages with a category of their own, the most frequent among toxic rows; the others share one.
LANGUAGES = 8

# Letters, digits and all bytes of other characters make words.
_PARTS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class Chain(NamedTuple):
    """``columns`` ascending; a row of ``weights`` per category, over columns, earlier
    categories and a bias."""

    categories: list[str]
    columns: np.ndarray
    weights: list[np.ndarray]


def hashed_words(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct columns of the words of each text, A-Z as lower case."""
    parts = [(text or "").encode().lower() for text in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    places, hashes = word_hashes(data, _PARTS)
    columns = (hashes >> np.uint64(44)).astype(np.int64)
    ends = np.searchsorted(places, np.cumsum([len(part) + 1 for part in parts]))
    return [np.unique(part) for part in np.split(columns, ends[:-1])] if texts else []


def _telling(sample: DataFrame, categories: list[str]) -> np.ndarray:
    """The columns that differ most, by chi square, between rows in and out of a category.

    Counted by Spark over the sample; what comes back is bounded by ``KEPT_COLUMNS``.
    """
    flags = [F.sum(category).alias(category) for category in categories]
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *flags).first()
    counts = sample.select(F.explode("columns").alias("column"), *categories)
    counts = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n"), *flags).where("n > 2")
    found: set[int] = set()
    for category in categories:
        rows, positive = totals["n"], totals[category] or 0
        if not 0 < positive < rows:
            continue
        share = positive / rows
        expected = F.col("n") * share
        score = (F.col(category) - expected) ** 2 / (expected * (1 - share))
        scored = counts.select("column", score.alias("score")).where(F.col("score") >= LEAST_SCORE)
        best = scored.orderBy(F.desc("score"), "column")
        found.update(row["column"] for row in best.limit(KEPT_COLUMNS).collect())
    return np.array(sorted(found), dtype=np.int64)


def _reduced(columns: list[np.ndarray], kept: np.ndarray) -> Rows:
    rows = []
    for own in columns:
        place = np.searchsorted(kept, own)
        place[place == len(kept)] = 0
        rows.append(place[kept[place] == own] if len(kept) else place[:0])
    return Rows.of(rows)


def fit_chain(sample: DataFrame, categories: list[str], folds: int = FOLDS) -> Chain:
    """Fit one logistic model per category, in order, on ``id_hash, text_hash, columns`` and 0/1 flags.

    Each model also sees the probabilities of the categories before it. For its training
    these come out of fold: every row's from models that were fitted without its fold, so
    that later models meet errors like those at prediction. The sample must be bounded.
    """
    kept = _telling(sample, categories)
    names = F.lit(kept.tolist()) if len(kept) else F.array()
    chosen = F.array_intersect("columns", names.cast("array<bigint>"))
    rows = sample.select("id_hash", "text_hash", chosen.alias("columns"), *categories).orderBy("id_hash", "text_hash").collect()
    held = _reduced([np.array(row["columns"], dtype=np.int64) for row in rows], kept)
    fold = np.arange(len(rows)) % folds
    earlier, weights = np.zeros((len(rows), 0)), []
    for category in categories:
        target = np.array([row[category] for row in rows], dtype=np.float64)
        out = np.zeros(len(rows))
        for k in range(folds):
            inside = fold != k
            model = fit(held.pick(inside), earlier[inside], target[inside], len(kept))
            out[~inside] = predict(held.pick(~inside), earlier[~inside], model)
        weights.append(fit(held, earlier, target, len(kept)))
        earlier = np.column_stack((earlier, out))
    return Chain(categories, kept, weights)


def chain_probabilities(chain: Chain, texts: list[str | None]) -> np.ndarray:
    """A row per text with the probability of each category."""
    held = _reduced(hashed_words(texts), chain.columns)
    earlier = np.zeros((len(texts), 0))
    for weights in chain.weights:
        earlier = np.column_stack((earlier, predict(held, earlier, weights)))
    return earlier


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    flag: str = "toxic", rows: int = SAMPLE_ROWS,
) -> Chain:
    """A chain over "toxic in language x" for the languages met, then "toxic" at all.

    At most ``rows`` labelled ids, those with the smallest hashes, are broadcast to a scan
    of the documents, so labels need no exchange of texts. Of the documents that they meet,
    equal ones are one, and ``rows`` at most are used, by hashes of id and text. Labels with
    a null id or flag are left out; of unequal labels of an id the toxic one counts. Without labels, or
    with labels all alike, the chain gives the constant share of toxic rows (none: 0).
    """
    known = (
        labels.select(F.col(key).alias("_id"), F.col(flag).cast("int").alias("_flag"))
        .where("_id IS NOT NULL AND _flag IS NOT NULL")
        .groupBy("_id")
        .agg(F.max("_flag").alias("_flag"))
        .withColumn("id_hash", F.xxhash64("_id"))
    )
    few = known.orderBy("id_hash", "_id").limit(rows)
    met = docs.select(F.col(key).alias("_own"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    met = met.join(F.broadcast(few), F.col("_own") == F.col("_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(4).to_pylist()
            for start, end in chunks(texts):
                columns = pa.array(hashed_words(texts[start:end]), pa.list_(pa.int64()))
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], columns], names=["id_hash", "text_hash", "lang", "toxic", "columns"]
                )

    found = met.select("id_hash", F.xxhash64("_text").alias("text_hash"), "_lang", "_flag", "_text").mapInArrow(
        run, "id_hash bigint, text_hash bigint, lang string, toxic int, columns array<bigint>"
    )
    unlike = found.dropDuplicates(["id_hash", "text_hash"])
    mixed = F.xxhash64("id_hash", "text_hash")
    sample = written(unlike.orderBy(mixed, "id_hash", "text_hash").limit(rows))
    toxic = sample.where("toxic = 1 AND lang IS NOT NULL").groupBy("lang").count()
    ranked = toxic.orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    named = {f"toxic_{row['lang']}": row["lang"] for row in ranked}
    flags = {
        name: ((F.col("toxic") == 1) & F.col("lang").eqNullSafe(value)).cast("int")
        for name, value in named.items()
    }
    if toxic.count() > LANGUAGES:
        rest = (F.col("toxic") == 1) & ~F.coalesce(F.col("lang").isin(list(named.values())), F.lit(True))
        flags["toxic in others"] = rest.cast("int")
    return fit_chain(sample.withColumns(flags), [*flags, "toxic"])


def score(
    docs: DataFrame, chain: Chain, threshold: float = 0.5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``probabilities`` by category, ``p_toxic`` (of the last) and ``is_toxic``.

    One pass without an exchange; null and empty texts are judged by the bias alone, every
    row by itself. Columns of these names are replaced.
    """
    names = [c for c in docs.columns if c not in ("probabilities", "p_toxic", "is_toxic")]
    schema = ", ".join(f"`{c}` {id_type(docs, c)}" for c in names)
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for start, end in chunks(texts):
                found = chain_probabilities(chain, texts[start:end])
                maps = [list(zip(chain.categories, map(float, row), strict=True)) for row in found]
                last = found[:, -1]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(start, end - start).columns,
                        pa.array(maps, pa.map_(pa.string(), pa.float64())),
                        pa.array(last, pa.float64()),
                        pa.array(last >= threshold, pa.bool_()),
                    ],
                    names=[*names, "probabilities", "p_toxic", "is_toxic"],
                )

    return docs.select(*names).mapInArrow(
        run, f"{schema}, probabilities map<string,double>, p_toxic double, is_toxic boolean"
    )


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its toxicity, from a chain fitted on the labelled ones."""
    docs = load(spark, folder, "documents", "doc_id", "text", "lang")
    chain = train(docs, load(spark, folder, "labels", "doc_id", "toxic"))
    return score(docs, chain).select("doc_id", "p_toxic", "is_toxic", "probabilities")
