"""Document quality from weak labels: a label model by EM, then a hashed linear scorer."""

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

#: Documents, at most, that the scorer is fitted on.
SAMPLE_ROWS = 10_000
COLUMNS = 1 << 14

# Kinds of bytes: 0 blanks, then letters in lower and upper case, digits, other characters
# of ASCII by themselves. All other bytes are lower-case letters.
_KIND = np.full(256, ord("a"), dtype=np.uint8)
for _b in range(128):
    _c = chr(_b)
    _KIND[_b] = (
        32 if _b <= 32 else ord("a") if _c.islower() else ord("A") if _c.isupper()
        else ord("0") if _c.isdigit() else _b
    )
_SPACE = np.arange(256) <= 32
_LETTER = np.isin(np.arange(256), [ord("a"), ord("A")])
_MARK = ~_LETTER & ~_SPACE & (np.arange(256) != ord("0"))


class Traits(NamedTuple):
    """Measures of each text, and its hashed shape columns."""

    words: np.ndarray
    marks: np.ndarray
    capitals: np.ndarray
    lone_marks: np.ndarray
    marked: np.ndarray
    repeats: np.ndarray
    distinct: np.ndarray
    columns: list[np.ndarray]


def traits(texts: list[str | None]) -> Traits:
    """Measure whole texts on arrays of bytes.

    The shape of a word is its kinds of bytes with runs drawn together (``Ab!!`` is
    ``Aa!``); a column stands for a shape and the power of two of its share in the text.
    """
    parts = [(text or "").encode() for text in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
    kind = _KIND[data]
    ends = np.cumsum([len(part) + 1 for part in parts])
    starts = ends - [len(part) + 1 for part in parts]

    def total(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.astype(np.int64), starts)

    letters, capitals = total(_LETTER[kind]), total(kind == ord("A"))
    seen, marks = total(~_SPACE[kind]), total(_MARK[kind])
    places, hashes = word_hashes(data, _SPACE)
    first = np.searchsorted(places, starts)
    last = np.searchsorted(places, ends)
    n = last - first
    fresh = np.ones(len(kind), dtype=bool)
    fresh[1:] = kind[1:] != kind[:-1]
    drawn = np.flatnonzero(fresh)
    _, shapes = word_hashes(kind[drawn], _SPACE)
    shapes = (shapes >> np.uint64(50)).astype(np.int64)
    # A word's last byte tells of marks behind it, its first two whether it is one mark.
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[kind], [True])).view(np.int8)))
    from_, to = edges[::2], edges[1::2] - 1
    lone = _MARK[kind[from_]] & (from_ == to)
    plain = np.isin(data[to], np.frombuffer(b".,;:?!)\"'", dtype=np.uint8))
    pairs = np.zeros(len(to), dtype=bool)
    pairs[to > from_] = _MARK[kind[to[to > from_] - 1]]
    odd = _MARK[kind[to]] & ~lone & (~plain | pairs)
    out: list[list] = [[], [], [], [], []]
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        size = max(b - a, 1)
        own = hashes[a:b]
        out[0].append(lone[a:b].sum() / size)
        out[1].append(odd[a:b].sum() / size)
        out[2].append((own[1:] == own[:-1]).sum() / size)
        out[3].append(len(np.unique(own)) / size)
        found, times = np.unique(shapes[a:b], return_counts=True)
        level = np.minimum(np.log2(size / times), 7).astype(np.int64)
        # The last columns stand for how many words repeat, and how few are distinct.
        again = min(int(-np.log2(max(out[2][-1], 2**-7))), 7)
        few = min(int(2 * np.log2(max(out[3][-1] * np.sqrt(max(size, 36)), 1))), 15)
        extra = [COLUMNS - 1 - again, COLUMNS - 9 - few]
        hashed = (found * 8 + level) * 2654435761 % (COLUMNS - 32)
        out[4].append(np.unique(np.append(hashed, extra)))
    return Traits(
        n, marks / np.maximum(seen, 1), capitals / np.maximum(letters, 1),
        *(np.array(values) for values in out[:4]), out[4],
    )


#: Labellers: measure, from where on it speaks for poor quality, below which (None: never)
#: for good, and the fewest words for which it speaks at all. Some only know one flaw and
#: otherwise abstain, as texts may be poor in other ways.
LABELLERS = (
    ("marks", 0.12, None, 10),
    ("capitals", 0.40, None, 3),
    ("lone_marks", 0.15, None, 3),
    ("marked", 0.30, None, 3),
    ("flaws", 1.0, 0.5, 3),
    ("repeats", 0.20, None, 5),
    ("monotony", 1.0, 0.5, 5),
)
ABSTAIN, POOR, GOOD = 0, 1, 2
# What EM starts from, P(vote | poor) and P(vote | good), for labellers with one side or two.
_ONE_SIDE = np.array([[0.60, 0.38, 0.02], [0.98, 0.005, 0.015]])
_TWO_SIDES = np.array([[0.20, 0.60, 0.20], [0.10, 0.05, 0.85]])
_START = np.array([_ONE_SIDE if good is None else _TWO_SIDES for _, _, good, _ in LABELLERS])


def measures(found: Traits) -> dict[str, np.ndarray]:
    """What the labellers look at; ``monotony`` is one or more where words repeat too often.

    Long texts repeat their common words, so the share of distinct words that is too small
    falls with length.
    """
    few = 1.2 / np.sqrt(np.maximum(found.words, 36)) / np.maximum(found.distinct, 1e-9)
    return {
        "marks": found.marks,
        "capitals": found.capitals,
        "lone_marks": found.lone_marks,
        "marked": found.marked,
        "flaws": np.maximum((found.lone_marks + found.marked) / 0.4, found.repeats / 0.2),
        "repeats": found.repeats,
        "monotony": few,
    }


def votes(found: Traits) -> np.ndarray:
    """A row per text and a column per labeller: ``ABSTAIN``, ``POOR`` or ``GOOD``."""
    out = np.zeros((len(found.words), len(LABELLERS)), dtype=np.int64)
    known = measures(found)
    for k, (name, poor, good, least) in enumerate(LABELLERS):
        fine = known[name] < good if good is not None else np.zeros(len(out), dtype=bool)
        out[:, k] = np.where(known[name] >= poor, POOR, np.where(fine, GOOD, ABSTAIN))
        out[found.words < least, k] = ABSTAIN
    return out


class LabelModel(NamedTuple):
    """Share of good documents, and P(vote | quality) by labeller, quality (poor, good), vote."""

    good: float
    table: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(good) for rows of votes."""
        logs = np.log(np.array([1 - self.good, self.good]))[None, :].repeat(len(patterns), 0)
        for k in range(patterns.shape[1]):
            logs = logs + np.log(self.table[k][:, patterns[:, k]]).T
        odds = np.clip(logs[:, 0] - logs[:, 1], -40, 40)
        return 1 / (1 + np.exp(odds))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, steps: int = 100) -> LabelModel:
    """Expectation-maximisation over the patterns of votes and how often each occurs.

    It starts from labellers that are mostly right; a prior of a hundredth of all documents
    keeps them better than chance. No votes at all give the start.
    """
    m = patterns.shape[1]
    model = LabelModel(0.85, _START)
    if not len(patterns):
        return model
    prior = _START * counts.sum() / 100
    for _ in range(steps):
        good = model.posterior(patterns)
        weight = np.stack((counts * (1 - good), counts * good))
        table = np.empty_like(model.table)
        for k in range(m):
            for vote in range(3):
                table[k, :, vote] = weight[:, patterns[:, k] == vote].sum(axis=1) + prior[k, :, vote]
            table[k] /= table[k].sum(axis=1, keepdims=True)
        # A rare class of some percent at either end keeps the two apart.
        share = float(np.clip(weight[1].sum() / counts.sum(), 0.02, 0.98))
        done = abs(share - model.good) + np.abs(table - model.table).max() < 1e-6
        model = LabelModel(share, table)
        if done:
            break
    return model


class Scorer(NamedTuple):
    labels: LabelModel
    weights: np.ndarray


def _per_chunk(docs: DataFrame, work, schema: str, names: list[str]) -> DataFrame:
    """Rows of ``work(texts)`` next to the other columns; the text comes last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for start, end in chunks(texts):
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *work(texts[start:end])], names=names
                )

    return docs.mapInArrow(run, schema)


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS
) -> Scorer:
    """Estimate the labellers over all documents, then fit the scorer on their posteriors.

    EM needs only how often each pattern of votes occurs; their number is bounded, counted by
    Spark over every document. The scorer sees at most ``rows`` documents, those with the
    smallest hashes of id and text, with the posterior as a soft label. Equal rows are one
    of them, so it sees some wherever there are any.
    """
    m = len(LABELLERS)
    codes = 3 ** np.arange(m)

    def cast(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array(votes(traits(texts)) @ codes, pa.int64())]

    patterns = (
        _per_chunk(docs.select(text), cast, "pattern bigint", ["pattern"])
        .groupBy("pattern")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    found = np.array([row["pattern"] for row in patterns], dtype=np.int64)
    counts = np.array([row["n"] for row in patterns], dtype=np.float64)
    model = fit_label_model(found[:, None] // codes % 3, counts)
    named = docs.select(F.xxhash64(key, text).alias("hash"), F.col(text).alias("_text"))
    least = written(named.select("hash").distinct().orderBy("hash").limit(rows))
    few = named.join(F.broadcast(least), "hash").dropDuplicates(["hash"])

    def features(texts: list[str | None]) -> list[pa.Array]:
        own = traits(texts)
        return [
            pa.array(model.posterior(votes(own)), pa.float64()),
            pa.array(own.columns, pa.list_(pa.int64())),
        ]

    sample = _per_chunk(
        few.select("hash", "_text"), features, "hash bigint, good double, columns array<bigint>",
        ["hash", "good", "columns"],
    )
    held = sample.orderBy("hash", "good").collect()
    x = Rows.of([np.array(row["columns"], dtype=np.int64) for row in held])
    y = np.array([row["good"] for row in held], dtype=np.float64)
    return Scorer(model, fit(x, np.zeros((len(held), 0)), y, COLUMNS))


def score(
    docs: DataFrame, scorer: Scorer, threshold: float = 0.5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``quality``, the scorer's probability, ``label_quality``, the label
    model's, and ``is_good``.

    One pass without an exchange; null and empty texts, on which all labellers abstain, get
    the share of good documents. Columns of these names are replaced.
    """
    own = ["quality", "label_quality", "is_good"]
    names = [c for c in docs.columns if c not in own]
    kept = [c for c in names if c != text] + [text]
    schema = ", ".join(f"`{c}` {id_type(docs, c)}" for c in kept)

    def work(texts: list[str | None]) -> list[pa.Array]:
        found = traits(texts)
        labels = scorer.labels.posterior(votes(found))
        quality = predict(Rows.of(found.columns), np.zeros((len(texts), 0)), scorer.weights)
        quality = np.where(found.words > 0, quality, labels)
        return [
            pa.array(texts, pa.string()),
            pa.array(quality, pa.float64()),
            pa.array(labels, pa.float64()),
            pa.array(quality >= threshold, pa.bool_()),
        ]

    scored = _per_chunk(
        docs.select(*kept), work, f"{schema}, quality double, label_quality double, is_good boolean",
        [*kept, *own],
    )
    return scored.select(*names, *own)


@query("op6_quality")
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its quality under weak labels of the documents themselves."""
    docs = load(spark, folder, "documents", "doc_id", "text")
    return score(docs, train(docs)).select("doc_id", "quality", "label_quality", "is_good")
