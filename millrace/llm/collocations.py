"""Phrase collocations of each language by best-first growth of prefixes under score bounds."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.base import query, slices
from millrace.session import load, written

#: A phrase occurs so often at least; so many of a language are returned.
LEAST = 30
KEPT = 2000
#: Words, or prefixes, that are sent to the tasks at a time; more take more passes.
BATCH = 1_000_000
#: The first bound of a language is the score of this bigram; each round goes so much further.
FIRST = 3_000
FURTHER = 4
#: Words that a task gathers before it counts or writes them.
BLOCK = 1 << 18
#: Words or codes that a task combines, and rows that it hands over at a time.
ROOM = 1 << 20
ROWS = 1 << 15
#: More than any score, which is at most 1,000,000.
ABOVE = 1_000_001

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_BREAKS + b"\t", b"." * len(_BREAKS) + b" ")
_LOW = (1 << 32) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SIEVE = 22


def tokens(text: str | None) -> list[bytes]:
    """Words of a text in lower-case A-Z; ``b"."`` stands where a piece ends."""
    return (text or "").encode().lower().translate(_TABLE).replace(b".", b" . ").split()


def _combined(parts: list[pa.Table]) -> pa.Table:
    """Sums of ``f`` by word."""
    found = pa.concat_tables(parts).group_by("word").aggregate([("f", "sum")])
    return pa.table({"word": found.column("word"), "f": found.column("f_sum")})


def _word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, f`` over all texts.

    A task combines what it counts as far as its room goes, so the exchange comes before the
    aggregation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(list), 0
        sums, room = defaultdict(list), 0

        def count() -> None:
            nonlocal room
            for lang, found in held.items():
                counts = pa.array(found, pa.large_binary()).value_counts()
                word = counts.field("values")
                keep = pc.not_equal(word, b".")
                own = {"word": word.filter(keep), "f": counts.field("counts").filter(keep)}
                sums[lang].append(pa.table(own))
                room += len(sums[lang][-1])
            held.clear()

        def combine() -> None:
            nonlocal room
            for lang, parts in sums.items():
                sums[lang] = [_combined(parts)]
            room = sum(len(parts[0]) for parts in sums.values())

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, (found,) in sums.items():
                for part in slices(found.to_batches(), ROWS):
                    word = part.column(0).cast(pa.binary()).cast(pa.string())
                    name = pa.array([lang] * len(word), pa.string())
                    yield pa.RecordBatch.from_arrays([name, word, part.column(1)], names=["lang", "word", "f"])
            sums.clear()

        for part in slices(batches):
            for lang, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                found = tokens(text)
                held[lang].extend(found)
                size += len(found)
                if size >= BLOCK:
                    count()
                    size = 0
                    if room >= ROOM:
                        combine()
                        if 2 * room >= ROOM:
                            yield from rows()
                            room = 0
        count()
        combine()
        yield from rows()

    rows = docs.mapInArrow(run, "lang string, word string, f bigint").repartition("lang", "word")
    return rows.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _numbered(words: DataFrame) -> DataFrame:
    """``lang, word, f, id``: numbers from 1 on without gaps, by partition and place there."""
    placed = written(words.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition that wrote words.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    found = placed.withColumn("_part", part).join(bases, "_part")
    number = F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return written(found.select("lang", "word", "f", number.alias("id")))


def _blocks(docs: DataFrame, words: DataFrame, total: int, batch: int) -> DataFrame:
    """``codes``: the words of all pieces as numbers, 32 bits each; zeros part them.

    A zero stands for the end of a piece or text and for any word that is not in ``words``,
    as no phrase that is asked for goes across it. The dictionary is sent ``batch`` words
    at a time; all but the last pass carry the texts on.
    """
    if total >= 1 << 31:
        raise ValueError("more frequent words than 31 bits can number")
    passes = max(1, -(-total // batch))
    spark = docs.sparkSession
    rows = docs.withColumn("codes", F.lit(None).cast("binary"))
    for nth in range(passes):
        own = words.where(F.floor((F.col("id") - 1) / batch) == nth).select("lang", "word", "id")
        table = own.toArrow()
        known = {}
        for lang in table.column("lang").unique().to_pylist():
            part = table.filter(pc.equal(table.column("lang"), lang))
            known[lang] = (
                part.column("word").combine_chunks().cast(pa.large_binary()),
                part.column("id").to_numpy().astype("<i4"),
            )
        shared = spark.sparkContext.broadcast(known)
        last = nth == passes - 1
        run = _encoder(shared, last)
        if last:
            return written(rows.mapInArrow(run, "codes binary"))
        rows = written(rows.mapInArrow(run, "lang string, text string, codes binary"))
    raise AssertionError


def _encoder(shared, last: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        held, size = [], 0

        def encoded() -> list[np.ndarray]:
            """Numbers of the words of each held row, and a zero behind them."""
            out = [np.zeros(len(found) + 1, dtype="<i4") for _, found, _ in held]
            for codes, (_, _, before) in zip(out, held, strict=True):
                if before is not None:
                    codes[:] = np.frombuffer(before, dtype="<i4")
            for lang, (words, ids) in known.items():
                own = [k for k, (name, _, _) in enumerate(held) if name == lang]
                flat = [word for k in own for word in held[k][1]]
                place = pc.index_in(pa.array(flat, pa.large_binary()), value_set=words)
                place = place.fill_null(-1).to_numpy()
                at = 0
                for k in own:
                    part = place[at : at + len(held[k][1])]
                    at += len(part)
                    here = part >= 0
                    out[k][:-1][here] = ids[part[here]]
            return out

        def rows() -> pa.RecordBatch:
            codes = [row.tobytes() for row in encoded()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, _, _ in held], pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(codes, pa.binary()),
                ],
                names=["lang", "text", "codes"],
            )

        def block() -> pa.RecordBatch:
            codes = np.concatenate(encoded())
            keep = np.ones(len(codes), dtype=bool)
            keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
            return pa.RecordBatch.from_arrays([pa.array([codes[keep].tobytes()], pa.binary())], ["codes"])

        texts = []
        for part in slices(batches):
            for lang, text, before in zip(*(c.to_pylist() for c in part.columns), strict=True):
                held.append((lang, tokens(text), before))
                size += len(held[-1][1]) + 1
                if not last:
                    texts.append(text)
                if size >= BLOCK:
                    yield block() if last else rows()
                    held, size, texts = [], 0, []
        if held:
            yield block() if last else rows()

    return run


class Members:
    """A set of grams of two words (``hi``) or three (``hi``, ``lo``) to look up in bulk."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray | None) -> None:
        self.heads = np.unique(hi)
        self.codes = None
        if lo is not None:
            self.codes = np.unique(np.searchsorted(self.heads, hi) << 32 | lo)
        self.sieve = np.zeros(1 << _SIEVE, dtype=bool)
        self.sieve[self._cell(self.heads)] = True

    @staticmethod
    def _cell(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _ODD) >> np.uint64(64 - _SIEVE)

    def holds(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each place whether the gram that starts there is in the set."""
        found = np.zeros(len(at), dtype=bool)
        if not len(self.heads) or not len(at):
            return found
        head = codes[at] << 32 | codes[at + 1]
        rest = np.flatnonzero(self.sieve[self._cell(head)])
        place = np.searchsorted(self.heads, head[rest])
        place[place == len(self.heads)] = 0
        same = self.heads[place] == head[rest]
        rest, place = rest[same], place[same]
        if self.codes is not None and len(rest):
            code = place << 32 | codes[at[rest] + 2]
            there = np.searchsorted(self.codes, code)
            there[there == len(self.codes)] = 0
            rest = rest[self.codes[there] == code]
        found[rest] = True
        return found


def _grams(blocks: DataFrame, size: int, least: int, wanted=None) -> DataFrame:
    """``hi, lo, a``: grams of ``size`` words that occur ``least`` times; two words a column.

    ``wanted`` is a broadcast list of (offset, hi, lo): a gram counts if the shorter one at
    that offset in it is in any of these sets. ``lo`` is None in a set of two-word grams.
    """

    def counted(codes: np.ndarray, sets) -> Iterator[pa.RecordBatch]:
        n = len(codes) - size + 1
        if n < 1:
            return
        full = codes > 0
        whole = full[:n].copy()
        for k in range(1, size):
            whole &= full[k : n + k]
        at = np.flatnonzero(whole)
        if sets is not None:
            hit = np.zeros(len(at), dtype=bool)
            for offset, members in sets:
                hit |= members.holds(codes, at + offset)
            at = at[hit]
        hi = codes[at] << 32 | codes[at + 1]
        if size == 2:
            hi.sort()
            new = hi[1:] != hi[:-1]
        else:
            lo = codes[at + 2] if size == 3 else codes[at + 2] << 32 | codes[at + 3]
            order = np.lexsort((lo, hi))
            hi, lo = hi[order], lo[order]
            new = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        starts = np.flatnonzero(np.concatenate(([len(hi) > 0], new)))
        counts = np.diff(np.append(starts, len(hi)))
        hi = hi[starts]
        lo = np.zeros_like(hi) if size == 2 else lo[starts]
        columns = [pa.array(values) for values in (hi, lo, counts)]
        yield from slices([pa.RecordBatch.from_arrays(columns, names=["hi", "lo", "a"])], ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = None if wanted is None else [(at, Members(hi, lo)) for at, hi, lo in wanted.value]
        held, room = [], 0
        for part in slices(batches, 1):
            # A block ends with a zero: no gram goes across.
            held.append(np.frombuffer(part.column(0)[0].as_buffer(), dtype="<i4"))
            room += len(held[-1])
            if room >= ROOM:
                yield from counted(np.concatenate(held).astype(np.int64), sets)
                held, room = [], 0
        if held:
            yield from counted(np.concatenate(held).astype(np.int64), sets)

    rows = blocks.mapInArrow(run, "hi bigint, lo bigint, a bigint").repartition("hi", "lo")
    return rows.groupBy("hi", "lo").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def _grown(
    blocks: DataFrame, size: int, least: int, batch: int, wanted: list[tuple[int, int, DataFrame]]
) -> DataFrame:
    """Counts of grams that have, at an offset, a gram of some length from a set (``hi, lo``).

    ``wanted`` lists offset, length and set. At most some ``batch`` members of a set are
    sent at a time, chosen by hash, in as many passes over the blocks as that takes; a gram
    counted by several passes has the same count in each.
    """
    spark = blocks.sparkSession
    sets = [(at, length, written(grams.select("hi", "lo"))) for at, length, grams in wanted]
    # Half of the room is left for what a hash deals unevenly.
    passes = max(1, *(-(-2 * grams.count() // batch) for _, _, grams in sets))
    found = None
    for nth in range(passes):
        part = []
        for at, length, grams in sets:
            own = grams.where(F.pmod(F.xxhash64("hi", "lo"), F.lit(passes)) == nth).toArrow()
            hi, lo = (own.column(c).to_numpy() for c in ("hi", "lo"))
            part.append((at, hi, None if length == 2 else lo))
        counts = _grams(blocks, size, least, spark.sparkContext.broadcast(part))
        found = counts if found is None else found.unionByName(counts)
    if passes > 1:
        found = found.groupBy("hi", "lo").agg(F.max("a").alias("a"))
    return written(found)


def _share(part: str, whole: str) -> Column:
    """floor(2,000,000 * part / whole) in integers of up to 38 digits."""
    return F.expr(
        f"(cast(2000000 as decimal(7,0)) * cast({part} as decimal(20,0))) div cast({whole} as decimal(20,0))"
    )


def _low(column: Column) -> Column:
    return column.bitwiseAND(F.lit(_LOW))


def _pair(first: Column, second: Column) -> Column:
    return F.shiftleft(first, 32).bitwiseOR(second)


def _with(grams: DataFrame, counts: DataFrame, name: str, *key: tuple[str, Column], how="inner") -> DataFrame:
    """Add the count (``a``) of a shorter gram, found by its key columns, as ``name``."""
    renamed = counts.select(*[F.col(c).alias(f"_{c}") for c, _ in key], F.col("a").alias(name))
    same = None
    for c, value in key:
        one = value == F.col(f"_{c}")
        same = one if same is None else same & one
    return grams.join(renamed, same, how).drop(*[f"_{c}" for c, _ in key])


def _scored(grams: DataFrame, cuts: int) -> DataFrame:
    """Add ``score, l, r`` of the lowest cut from ``l1, r1 .. ``, the first one among equals."""
    tried = [
        F.struct(
            _share("a", f"(l{k} + r{k})").alias("score"), F.lit(k).alias("k"),
            F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
        )
        for k in range(1, cuts + 1)
    ]
    best = F.least(*tried) if cuts > 1 else tried[0]
    return grams.withColumn("_cut", best).select(
        "*", F.col("_cut.score").alias("score"), F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r")
    ).drop("_cut")


class _Growth:
    """The state of one search: blocks, word and gram counts, and what was expanded so far."""

    def __init__(self, blocks: DataFrame, words: DataFrame, least: int, batch: int) -> None:
        self.blocks, self.least, self.batch = blocks, least, batch
        self.words = words.select(F.col("id").alias("hi"), "lang", F.col("f").alias("a"))
        pairs = written(_grams(blocks, 2, least))
        first, second = F.shiftright("hi", 32), _low(F.col("hi"))
        langs = self.words.select(F.col("hi").alias("_id"), "lang", F.col("a").alias("l1"))
        pairs = pairs.join(langs, first == F.col("_id")).drop("_id")
        pairs = _scored(_with(pairs, self.words, "r1", ("hi", second)), 1)
        self.pairs = written(pairs.withColumn("bound", _share("a", "(l1 + a)")))
        self.triples = self.fours = None

    def expand(self, levels: DataFrame) -> DataFrame:
        """All phrases (``lang, hi, lo, size, a, l, r, score``) that survive with ``low`` or more.

        ``levels`` has the languages at work with ``low``, their new bound, and ``high``,
        down to which their prefixes are expanded already.
        """
        triples = self._triples(levels)
        fours = self._fours(triples, levels)
        wanted = [
            self._surviving(self.pairs, triples, 2, levels),
            self._surviving(triples, fours, 3, levels),
            fours.join(levels, "lang").where("score >= low").withColumn("size", F.lit(4)),
        ]
        columns = ("lang", "hi", "lo", "size", "a", "l", "r", "score")
        found = [df.select(*columns) for df in wanted]
        return written(found[0].unionByName(found[1]).unionByName(found[2]))

    def _triples(self, levels: DataFrame) -> DataFrame:
        own = self.pairs.join(levels, "lang")
        new = _grown(
            self.blocks, 3, self.least, self.batch,
            [
                (0, 2, own.where("bound >= low AND bound < high")),
                # What may drop a phrase grows to the left of it, too.
                (1, 2, own.where("score >= low AND score < high")),
            ],
        )
        self.triples = self._measured(self._joined(self.triples, new))
        return self.triples

    def _joined(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        if old is None:
            return new
        both = old.select("hi", "lo", "a").unionByName(new)
        return both.groupBy("hi", "lo").agg(F.max("a").alias("a"))

    def _measured(self, triples: DataFrame) -> DataFrame:
        hi, lo = F.col("hi"), F.col("lo")
        left = self.pairs.select(
            F.col("hi").alias("_hi"), "lang", F.col("a").alias("l2"), F.col("l1")
        )
        found = triples.join(left, hi == F.col("_hi")).drop("_hi")
        found = _with(found, self.pairs, "r1", ("hi", _pair(_low(hi), lo)))
        found = _with(found, self.words, "r2", ("hi", lo))
        bound = F.least(_share("a", "(l1 + a)"), _share("a", "(l2 + a)"))
        return written(_scored(found, 2).withColumn("bound", bound))

    def _fours(self, triples: DataFrame, levels: DataFrame) -> DataFrame:
        own = triples.join(levels, "lang")
        new = _grown(
            self.blocks, 4, self.least, self.batch,
            [
                (0, 3, own.where("bound >= low AND bound < high")),
                (1, 3, own.where("score >= low AND score < high")),
            ],
        )
        self.fours = written(self._joined(self.fours, new))
        hi, lo = F.col("hi"), F.col("lo")
        first, rest = F.shiftright("lo", 32), _pair(_low(hi), F.shiftright("lo", 32))
        names = self.words.select(F.col("hi").alias("_id"), "lang", F.col("a").alias("l1"))
        found = self.fours.join(names, F.shiftright("hi", 32) == F.col("_id")).drop("_id")
        found = _with(found, self.pairs, "l2", ("hi", hi))
        found = _with(found, self.pairs, "r2", ("hi", lo))
        found = _with(found, self.words, "r3", ("hi", _low(lo)))
        # Without a counted prefix of three the bound is below the level: no candidate here.
        found = _with(found, triples, "l3", ("hi", hi), ("lo", first), how="left")
        found = written(_with(found, triples, "r1", ("hi", rest), ("lo", _low(lo)), how="left"))
        # The part behind the first word may begin with a prefix that was not expanded.
        open_ = (
            found.where("r1 IS NULL AND l3 IS NOT NULL")
            .join(levels, "lang")
            .where((_share("a", "(l2 + r2)") >= F.col("low")) & (_share("a", "(l3 + r3)") >= F.col("low")))
            .select(rest.alias("hi"), _low(lo).alias("lo"))
            .distinct()
        )
        late = _grown(self.blocks, 3, self.least, self.batch, [(0, 3, open_)])
        found = _with(found, late, "_late", ("hi", rest), ("lo", _low(lo)), how="left")
        found = found.withColumn("r1", F.coalesce("r1", "_late")).drop("_late")
        # What has no r1 or l3 still is below every level; it only may drop shorter phrases.
        none = F.col("r1").isNull() | F.col("l3").isNull()
        found = _scored(found.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("r1", "l3")}), 3)
        return written(found.withColumn("score", F.when(none, F.lit(-1)).otherwise(F.col("score"))))

    def _surviving(self, grams: DataFrame, longer: DataFrame, size: int, levels: DataFrame) -> DataFrame:
        """Phrases of ``size`` with ``low`` or more that no phrase of one more word drops.

        If a still longer phrase drops one, so does the phrase of one more word inside it.
        """
        hi, lo = F.col("hi"), F.col("lo")
        if size == 2:
            head = (hi, F.lit(0).cast("bigint"))
            tail = (_pair(_low(hi), lo), F.lit(0).cast("bigint"))
        else:
            head = (hi, F.shiftright("lo", 32))
            tail = (_pair(_low(hi), F.shiftright("lo", 32)), _low(lo))
        around = [longer.select(h.alias("hi"), t.alias("lo"), F.col("a").alias("_longer")) for h, t in (head, tail)]
        most = around[0].unionByName(around[1]).groupBy("hi", "lo").agg(F.max("_longer").alias("_longer"))
        own = grams.join(levels, "lang").where("score >= low").join(most, ["hi", "lo"], "left")
        wide = "decimal(20,0)"
        stays = F.expr(f"100 * cast(_longer AS {wide}) < 80 * cast(a AS {wide})")
        return own.where(F.col("_longer").isNull() | stays).withColumn("size", F.lit(size))


def _phrases(found: DataFrame, words: DataFrame) -> DataFrame:
    """Add ``phrase``: the words of a gram with single blanks between them."""
    hi, lo = F.col("hi"), F.col("lo")
    ids = [
        F.shiftright("hi", 32),
        _low(hi),
        F.when(F.col("size") == 3, lo).when(F.col("size") == 4, F.shiftright("lo", 32)),
        F.when(F.col("size") == 4, _low(lo)),
    ]
    names = []
    for k, value in enumerate(ids):
        own = words.select(F.col("id").alias(f"_id{k}"), F.col("word").alias(f"_w{k}"))
        found = found.join(own, value == F.col(f"_id{k}"), "left")
        names.append(f"_w{k}")
    return found.withColumn("phrase", F.concat_ws(" ", *names))


def collocations(
    docs: DataFrame, kept: int = KEPT, least: int = LEAST, lang: str = "lang", text: str = "text",
    first: int = FIRST, batch: int = BATCH,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``kept`` phrases of each language.

    Phrases have two to four words inside a piece of a text, occur ``least`` times (``a``) and
    are scored by their lowest cut, floor(2,000,000 a / (l + r)). One of which at least 80 %
    lie in a longer phrase is dropped. Order: score, ``a``, then bytes of the phrase.

    Prefixes grow best first. An extension of a prefix x with count a has at most the score
    2,000,000 a / (f(y) + a) for x and every shorter prefix y of x, since its count is at
    most a and what follows y is no rarer than the phrase. Each round lowers the bound of a
    language and expands all prefixes that reach it and were not expanded before, as well as
    both sides of every phrase that reaches it, which settles whether it is dropped. A
    language is settled when ``kept`` phrases survive at its bound, as every other phrase,
    ties included, is below, or when no prefix is left. ``first`` is the rank of the bigram whose
    score is the first bound; it changes the work and not the result.

    Each null text is empty, a null language is ``und``; keys and other columns are not
    read, repeated rows count each. No frequent phrase gives no rows.
    """
    own = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    counts = written(_word_counts(own))
    sums = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = _numbered(counts.where(F.col("f") >= least))
    total = words.count()
    if not total:
        empty = "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"
        return docs.sparkSession.createDataFrame([], empty)
    growth = _Growth(_blocks(own, words, total, batch), words, least, batch)
    best = Window.partitionBy("lang").orderBy(F.desc("score"))
    high = growth.pairs.select("lang").distinct().withColumn("high", F.lit(ABOVE).cast("bigint"))
    high, reach, done = written(high), max(first, 1), []
    while not high.isEmpty():
        nth = growth.pairs.join(high, "lang").withColumn("_nth", F.row_number().over(best))
        low = nth.where(F.col("_nth") == reach).select("lang", F.col("score").alias("low"))
        reach *= FURTHER
        levels = written(high.join(low, "lang", "left").fillna(0, ["low"]))
        # Where many bigrams tie, the bound may not be lower yet.
        waiting, levels = levels.where("low = high").select("lang", "high"), levels.where("low < high")
        if levels.isEmpty():
            continue
        found = growth.expand(levels)
        alive = found.groupBy("lang").agg(F.count(F.lit(1)).alias("_alive"))
        levels = written(levels.join(alive, "lang", "left").fillna(0, ["_alive"]))
        settled = (F.col("low") == 0) | (F.col("_alive") >= kept)
        done.append(found.join(levels.where(settled).select("lang"), "lang", "left_semi"))
        high = written(levels.where(~settled).select("lang", F.col("low").alias("high")).unionByName(waiting))
    if not done:
        # No frequent bigram: nothing to return.
        done = [growth.expand(high.withColumn("low", F.lit(0)))]
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = found.withColumn("_tied", F.rank().over(order)).where(F.col("_tied") <= kept)
    exact = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    named = _phrases(near, words).withColumn("rank", F.row_number().over(exact).cast("bigint"))
    return (
        named.where(F.col("rank") <= kept)
        .join(sums, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws
  FROM (SELECT lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
sums AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(ws[i : i + size - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, size, unnest(generate_series(1, len(ws) - size + 1)) AS i
        FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(ws) >= size)
  GROUP BY ALL HAVING count(*) >= {LEAST}),
phrases AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM grams WHERE size > 1),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(ws[1 : k], ' ') AS p, array_to_string(ws[k + 1 :], ' ') AS q
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM phrases)),
scored AS (
  SELECT c.lang, c.phrase, c.k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
  FROM cuts c JOIN grams l ON l.lang = c.lang AND l.phrase = c.p
  JOIN grams r ON r.lang = c.lang AND r.phrase = c.q),
lowest AS (
  SELECT lang, phrase, arg_min({{'l': l, 'r': r, 's': score}}, {{'s': score, 'k': k}}) AS cut
  FROM scored GROUP BY lang, phrase),
parts AS (
  SELECT lang, array_to_string(ws[i : i + len - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, ws, a, size, len, unnest(generate_series(1, size - len + 1)) AS i
        FROM phrases, (SELECT unnest([2, 3]) AS len) WHERE len < size)
  GROUP BY ALL),
stay AS (
  SELECT p.lang, p.phrase, p.a FROM phrases p LEFT JOIN parts USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * p.a::HUGEINT),
ranked AS (
  SELECT lang, row_number() OVER (
    PARTITION BY lang ORDER BY cut.s DESC, a DESC, encode(phrase)) AS rank,
    phrase, a::BIGINT AS a, cut.l::BIGINT AS l, cut.r::BIGINT AS r, cut.s AS score
  FROM stay JOIN lowest USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sums USING (lang) WHERE rank <= {KEPT}
"""


@query("op13_collocations", _SQL)
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 phrases of every language over all documents."""
    return collocations(load(spark, folder, "documents", "lang", "text"))
