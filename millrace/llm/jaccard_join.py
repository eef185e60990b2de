"""Near-duplicate documents by an exact Jaccard join on PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.base import id_type, query, slices
from millrace.llm.components import components
from millrace.llm.partenum import PartEnum, similar
from millrace.llm.shingles import chunks, mixed, shingle_sets
from millrace.session import load, written

#: Signatures of a bucket; a task compares one bucket at a time.
BUCKET_SIGNATURES = 2_000_000
#: Signatures that a task gathers before it deals them out to buckets.
GATHERED = 1_000_000
#: Up to so many sets under one signature are compared with each other at once.
COLD = 16
#: A sketch counts the features of a set by this many leading bits.
RANGE_BITS = 6
#: Rows of texts that a task takes out of Arrow at a time.
ROWS = 1_024
#: Features of a block of open sets; a task compares two blocks.
BLOCK_FEATURES = 1 << 20

# An entry is a set in one of its bands: the set's number times ``STEPS`` and 0 for its own
# band, 1 for the next, 2 for its single features.
STEPS = 4
#: Sets are dealt with numbers less than this apart, so that an entry takes two bytes.
_NUMBERS = (1 << 16) // STEPS
_BAND = 0xD6E8FEB86659FD93
# A signature of an entry. Four bytes of it decide inside its bucket; a chance hit is only a
# candidate more.
_SIGN = np.dtype([("low", "<u4"), ("entry", "<u2")])
_KEYS = "n bigint, k1 bigint, k2 bigint, sketch binary, need_own int, need_next int"


def set_keys(features: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    size = mixed(np.array([len(features)], dtype=np.uint64), 7)
    sums = [size + mixed(features, seed).sum(dtype=np.uint64) for seed in (11, 12)]
    return tuple(np.concatenate(sums).view(np.int64).tolist())


def sketch(features: np.ndarray) -> bytes:
    """How many features lie in each of 64 ranges of the domain, up to 255."""
    held = np.bincount((features >> np.uint64(64 - RANGE_BITS)).astype(np.int64), minlength=1 << RANGE_BITS)
    return np.minimum(held, 255).astype(np.uint8).tobytes()


def with_set_keys(docs: DataFrame, key: str, text: str, scheme: PartEnum) -> DataFrame:
    """A row's id ``doc`` and text ``hash``, its set's size ``n``, hashes, sketch and ``need``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            texts = batch.column(2).to_pylist()
            for start, end in chunks(texts):
                sets = shingle_sets(texts[start:end])
                keys = [set_keys(s) for s in sets]
                needs = scheme.needs(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        batch.column(1).slice(start, end - start),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()),
                        pa.array([sketch(s) for s in sets], pa.binary()),
                        pa.array([need for need, _ in needs], pa.int32()),
                        pa.array([need for _, need in needs], pa.int32()),
                    ],
                    names=["doc", "hash", "n", "k1", "k2", "sketch", "need_own", "need_next"],
                )

    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("hash"), F.col(text))
    return rows.mapInArrow(run, f"doc {id_type(docs, key)}, hash bigint, {_KEYS}")


def _classes(rows: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row per distinct set with its number ``cid`` and one of its texts.

    Numbers follow one another inside a part of the written table. Repeated rows of a
    document are one before their texts are joined.
    """
    ids = F.struct(
        F.col("doc").isNull().alias("_last"), "doc", "hash", "sketch", "need_own", "need_next"
    )
    heads = rows.where("n > 0").groupBy("k1", "k2", "n").agg(F.min(ids).alias("first"))
    heads = heads.select("k1", "k2", "n", "first.*").drop("_last").withColumn("id_hash", F.xxhash64("doc"))
    texts = (
        docs.groupBy(F.xxhash64(text).alias("hash"), F.xxhash64(key).alias("id_hash"))
        .agg(F.first(text).alias("text"))
    )
    found = heads.join(texts, ["hash", "id_hash"]).drop("id_hash")
    return written(found.withColumn("cid", F.monotonically_increasing_id()), "zstd")


def _dealt(classes: DataFrame, scheme: PartEnum, buckets: int) -> DataFrame:
    """Signatures of all sets, packed by the bucket that they fall into.

    Each takes six bytes, however few of a set's signatures fall into one bucket: entries
    count from ``base``, the first one of a pack, and stand in ascending order.
    """

    def packed(base: int, entries: list, signs: list, counts: list) -> pa.RecordBatch:
        flat = np.concatenate(signs)
        owner = np.repeat(np.array(entries, dtype=np.uint16), counts)
        bucket = (flat >> np.uint64(40)) % np.uint64(buckets)
        bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        out = np.empty(len(flat), dtype=_SIGN)
        out["low"] = (flat & np.uint64(0xFFFFFFFF))[order]
        out["entry"] = owner[order]
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(out)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[cuts[:-1]].astype(np.int64)),
                pa.array(np.full(len(cuts) - 1, base * STEPS, dtype=np.int64)),
                pa.array([out[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ],
            names=["bucket", "base", "signs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, entries, signs, counts, total = 0, [], [], [], 0
        for batch in slices(batches, ROWS):
            numbers, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, end in chunks(texts):
                sets = shingle_sets(texts[start:end])
                for cid, signatures in zip(numbers[start:end], scheme.of_sets(sets), strict=True):
                    if entries and (total >= GATHERED or not 0 <= cid - base < _NUMBERS):
                        yield packed(base, entries, signs, counts)
                        entries, signs, counts, total = [], [], [], 0
                    if not entries:
                        base = cid
                    for step, (band, found, _) in enumerate(signatures):
                        # Equal signatures of unlike bands do not meet.
                        signs.append(found + np.uint64(band * _BAND & (2**64 - 1)))
                        entries.append((cid - base) * STEPS + step)
                        counts.append(len(found))
                        total += len(found)
        if entries:
            yield packed(base, entries, signs, counts)

    return classes.select("cid", "text").mapInArrow(run, "bucket bigint, base bigint, signs binary")


_MET = "a bigint, b bigint, shared int, star int, `group` bigint, size int"


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, and how often each of them occurs."""
    codes.sort()
    starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))[: len(codes)])
    return codes[starts], np.diff(np.append(starts, len(codes)))


def _meet(table: pa.Table) -> pa.Table:
    """What one bucket holds: pairs, and members of the groups that are too large for pairs.

    A pair of entries (``a < b``) comes with the number of signatures of small groups that it
    shares here. Of a large group come its members, with ``group`` and its ``size``, and a
    pair of its first member with each other one, counted in ``star``.
    """
    names, met, at = [], [], 0
    for base, packed in zip(table.column("base").to_pylist(), table.column("signs").to_pylist(), strict=True):
        own = np.frombuffer(packed, dtype=_SIGN)
        new = np.ones(len(own), dtype=bool)
        new[1:] = own["entry"][1:] != own["entry"][:-1]
        names.append(base + own["entry"][new].astype(np.int64))
        met.append(own["low"].astype(np.uint64) << np.uint64(32) | (np.cumsum(new) + (at - 1)).astype(np.uint64))
        at += len(names[-1])
    names = np.concatenate(names)
    # Sorted by signature, then by entry, which counts once.
    met = _counted(np.concatenate(met))[0]
    owner = (met & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    met >>= np.uint64(32)
    starts = np.concatenate(([0], np.flatnonzero(met[1:] != met[:-1]) + 1))
    sizes = np.diff(np.append(starts, len(met)))

    def codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.astype(np.uint64) << np.uint64(32) | b

    pairs = [np.zeros(0, np.uint64)]
    for size in range(2, COLD + 1):
        first = starts[sizes == size]
        for i in range(size if len(first) else 0):
            pairs += [codes(owner[first + i], owner[first + j]) for j in range(i + 1, size)]
    large = sizes > COLD
    member = np.repeat(large, sizes)
    size = np.repeat(sizes[large], sizes[large])
    lead = np.repeat(owner[starts[large]], sizes[large])
    group, owned = met[member].astype(np.int64), owner[member]
    stars, star = _counted(codes(lead, owned)[lead != owned])
    pairs, shared = _counted(np.concatenate(pairs))
    both = np.concatenate((pairs, stars))
    a, b = names[both >> np.uint64(32)], names[both & np.uint64(0xFFFFFFFF)]
    none, alone = np.zeros(len(size), np.int64), np.arange(len(both) + len(size)) < len(both)
    return pa.table(
        {
            "a": pa.array(np.concatenate((np.minimum(a, b), names[owned]))),
            "b": pa.array(np.concatenate((np.maximum(a, b), none))),
            "shared": pa.array(np.concatenate((shared, 0 * star, none)).astype(np.int32)),
            "star": pa.array(np.concatenate((0 * shared, star, none)).astype(np.int32)),
            "group": pa.array(np.concatenate((np.zeros(len(both), np.int64), group)), mask=alone),
            "size": pa.array(np.concatenate((np.zeros(len(both), np.int64), size)).astype(np.int32)),
        }
    )


def _needs(classes: DataFrame) -> DataFrame:
    """``key, need``: how many signatures a similar set surely shares with an entry."""
    entry = F.col("cid") * STEPS
    steps = [F.struct((entry + k).alias("key"), F.greatest(need, F.lit(1)).alias("need")) for k, need in enumerate(("need_own", "need_next"))]
    weak = F.struct((entry + 2).alias("key"), F.lit(1).alias("need"))
    every = F.when(F.least("need_own", "need_next") < 1, F.array(*steps, weak)).otherwise(F.array(*steps))
    return classes.select(F.inline(every))


def _candidates(met: DataFrame, needs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of sets with first members, pairs that share enough, and members that need more.

    The first kind only connects large groups early: a set gets one pair, with the set that
    comes first in most of its groups.

    Two similar sets share at least ``need`` signatures. Those in small groups are counted;
    in large groups they share no more than either has there. If all signatures are ordered
    by the size of their group, two sets with ``need`` in common still have one in common
    when each leaves out its last ``need - 1``. So a set leaves as many large groups, the
    largest first; most sets leave them all.
    """
    hot = met.where("`group` IS NOT NULL").select(F.col("a").alias("key"), "bucket", "group", "size")
    there = hot.groupBy("key").agg(F.count(F.lit(1)).alias("hot"))
    pairs = (
        met.where("`group` IS NULL")
        .groupBy("a", "b")
        .agg(F.sum("shared").alias("shared"), F.sum("star").alias("star"))
    )
    enough = _enough(pairs, needs.join(there, "key", "left").fillna(0, ["hot"]))
    enough = written(enough.select(F.expr(f"a div {STEPS}").alias("u"), F.expr(f"b div {STEPS}").alias("v"), "shared", "star"))
    most = Window.partitionBy("v").orderBy(F.desc("star"), "u")
    stars = enough.where("star > 0").withColumn("nth", F.row_number().over(most)).where("nth = 1")
    kept = enough.where("shared > 0").select("u", "v").distinct()
    last = Window.partitionBy("key").orderBy(F.desc("size"), "bucket", "group")
    heavy = hot.withColumn("place", F.row_number().over(last)).join(needs, "key").where("place >= need")
    return stars.select("u", "v"), kept, heavy.select(F.expr(f"key div {STEPS}").alias("cid"), "bucket", "group")


def _enough(pairs: DataFrame, needs: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        own = needs.select(F.col("key").alias(side), F.col("need").alias(f"need_{side}"), F.col("hot").alias(f"hot_{side}"))
        pairs = pairs.join(own, side)
    return pairs.where(F.col("shared") + F.least("hot_a", "hot_b") >= F.greatest("need_a", "need_b"))


def _near_enough(scheme: PartEnum):
    """Leave out pairs whose sketches alone show too many unlike features.

    Counts of a range that differ by d hold d unlike features at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
                for c in ("sketch_u", "sketch_v")
            ]
            unlike = np.abs(sides[0].astype(np.int16) - sides[1]).sum(axis=1, dtype=np.int64)
            both = batch.column("n_u").to_numpy() + batch.column("n_v").to_numpy()
            keep = (scheme.num + scheme.den) * unlike <= (scheme.den - scheme.num) * both
            yield batch.select(["u", "v", "label_u", "label_v"]).filter(pa.array(keep))

    return run


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, scheme: PartEnum) -> DataFrame:
    """Links ``u, v`` between labels that classes with similar sets have, from pairs of classes.

    Classes of the same ``label`` are connected already and are not compared. Only texts
    travel, one per pair; a hot side is split by the skew join.
    """
    sized = pairs
    for number in ("u", "v"):
        side = classes.select("cid", "n", "label", "sketch").toDF(number, *(f"{c}_{number}" for c in ("n", "label", "sketch")))
        sized = sized.join(side, number)
    sized = sized.where(
        (scheme.den * F.least("n_u", "n_v") >= scheme.num * F.greatest("n_u", "n_v"))
        & (F.col("label_u") != F.col("label_v"))
    ).select("u", "v", "label_u", "label_v", "n_u", "n_v", "sketch_u", "sketch_v")
    sized = sized.mapInArrow(_near_enough(scheme), "u bigint, v bigint, label_u bigint, label_v bigint")
    for number in ("u", "v"):
        sized = sized.join(texts.select(F.col("cid").alias(number), F.col("text").alias(f"text_{number}")), number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] | None = None
        for batch in slices(batches, ROWS):
            rows = batch.to_pylist()
            found = []
            for start, end in chunks([row["text_v"] for row in rows]):
                part = rows[start:end]
                sets = shingle_sets([row["text_v"] for row in part])
                for row, b in zip(part, sets, strict=True):
                    if last is None or last[0] != row["text_u"]:
                        last = row["text_u"], shingle_sets([row["text_u"]])[0]
                    if similar(last[1], b, scheme.num, scheme.den):
                        found.append(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[c] for row in found], pa.int64()) for c in ("label_u", "label_v")], names=["u", "v"]
            )

    return sized.select("label_u", "label_v", "text_u", "text_v").mapInArrow(run, "u bigint, v bigint")


def _labelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes with the ``label`` of their component, its least ``cid``.

    ``links`` lie between the labels so far.
    """
    merged = components(links).select(F.col("node").alias("label"), F.col("label").alias("least"))
    found = classes.join(merged, "label", "left").withColumn("label", F.coalesce("least", "label"))
    return written(found.select(*classes.columns))


def _feature_rows(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``cid, n, label, h``: the shingles of each of the given classes as an array."""
    held = nodes.join(texts.select("cid", "text"), "cid").select("cid", "n", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS):
            texts = batch.column(3).to_pylist()
            for start, end in chunks(texts):
                sets = [s.view(np.int64) for s in shingle_sets(texts[start:end])]
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(sets, pa.list_(pa.int64()))], names=["cid", "n", "label", "h"]
                )

    return held.mapInArrow(run, "cid bigint, n bigint, label bigint, h array<bigint>")


def _circles(sets: DataFrame, scheme: PartEnum) -> DataFrame:
    """``node, label``: open sets that could be connected by pairs, as components.

    A prefix filter on the shingles, over the open sets only: by rarity, the first shingles
    of a set and those of a similar one have one in common. Every set is tied to the least set
    under each such shingle; pairs are not formed. Shingles whose sets are all of one
    component tie nothing.
    """
    rows = sets.select("cid", "n", "label", F.explode("h").alias("h"))
    times = rows.groupBy("h").agg(F.count(F.lit(1)).alias("times"))
    by_rarity = Window.partitionBy("cid").orderBy("times", "h")
    ranked = rows.join(times, "h").withColumn("place", F.row_number().over(by_rarity))
    reach = F.col("n") - F.ceil(F.col("n") * scheme.num / scheme.den) + 1
    first = written(
        ranked.where((F.col("times") > 1) & (F.col("place") <= reach)).select("h", "cid", "label")
    )
    least = (
        first.groupBy("h")
        .agg(F.min("cid").alias("v"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo < hi")
    )
    return components(first.join(least, "h").select(F.col("cid").alias("u"), "v"))


def _linked(table: pa.Table, i: int, j: int, scheme: PartEnum) -> pa.Table:
    """Links of labels that are not connected yet, among the sets of one block or two.

    Sets of unlike blocks are compared if ``i`` and ``j`` differ. Every set that shares one of
    its rarest shingles here with a set of another component meets all sets at once,
    by counting through their postings.
    """
    block = table.column("block").to_numpy()
    label = table.column("label").to_numpy()
    arrays = table.column("h").combine_chunks()
    flat = arrays.flatten().to_numpy()
    sizes = np.diff(arrays.offsets.to_numpy())
    owner = np.repeat(np.arange(len(sizes)), sizes)
    code = np.unique(flat, return_inverse=True)[1]
    times = np.bincount(code)
    # Postings of shingles that several sets have; the others count for the union alone.
    order = np.argsort(code, kind="stable")
    posting, ends = owner[order], np.cumsum(times)
    root = np.unique(label, return_inverse=True)[1]
    found_u, found_v = [], []
    starts = np.cumsum(sizes) - sizes
    for x in range(len(sizes)):
        own = code[starts[x] : starts[x] + sizes[x]]
        reach = sizes[x] - -(-sizes[x] * scheme.num // scheme.den) + 1
        rare = own[np.lexsort((own, times[own]))][:reach]
        near = [posting[ends[c] - times[c] : ends[c]] for c in rare[times[rare] > 1].tolist()]
        if not near or not (root[np.concatenate(near)] != root[x]).any():
            continue
        shared = [posting[ends[c] - times[c] : ends[c]] for c in own[times[own] > 1].tolist()]
        both = np.bincount(np.concatenate(shared), minlength=len(sizes))
        link = (scheme.den * both >= scheme.num * (sizes[x] + sizes - both)) & (root != root[x])
        if i != j:
            link &= block != block[x]
        for y in np.flatnonzero(link).tolist():
            if root[y] != root[x]:
                found_u.append(label[x])
                found_v.append(label[y])
                root[root == root[y]] = root[x]
    return pa.table({"u": pa.array(found_u, pa.int64()), "v": pa.array(found_v, pa.int64())})


def _rest(nodes: DataFrame, texts: DataFrame, scheme: PartEnum) -> DataFrame:
    """Links ``u, v`` of labels that connect what large groups left open.

    Open sets fall into circles that no similar pair leaves. A large circle is cut into blocks
    of some ``BLOCK_FEATURES`` by hash, and every two blocks are compared in a task of
    their own; small circles share a task. A task returns fewer links than it has sets.
    """
    sets = written(_feature_rows(nodes, texts))
    circles = written(_circles(sets, scheme))
    sized = sets.select("cid", "n").join(circles, F.col("cid") == F.col("node")).drop("node")
    sums = written(sized.withColumnRenamed("label", "circle").groupBy("circle").agg(F.sum("n").alias("n")))
    blocks = F.ceil(F.col("n") / BLOCK_FEATURES)
    total = sums.where(blocks == 1).agg(F.sum("n")).first()[0] or 0
    shares = max(1, -(-total // BLOCK_FEATURES))
    placed = (
        sets.withColumnRenamed("n", "own")
        .join(circles.select(F.col("node").alias("cid"), F.col("label").alias("circle")), "cid")
        .join(sums.withColumn("blocks", blocks).drop("n"), "circle")
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    )
    lone = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("circle"), F.lit(shares)))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    dealt = placed.withColumn("other", other).select(
        F.when(F.col("blocks") > 1, F.col("circle")).alias("circle"),
        F.coalesce(lone, F.least("block", "other")).alias("i"),
        F.coalesce(lone, F.greatest("block", "other")).alias("j"),
        "block", "label", "h",
    )

    def work(key: tuple, table: pa.Table) -> pa.Table:
        return _linked(table, key[1].as_py(), key[2].as_py(), scheme)

    return dealt.groupBy("circle", "i", "j").applyInArrow(work, "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, num: int = 75, den: int = 100, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of ``num / den`` or more.

    Sets are the distinct five-word shingles of whole texts. Returns a row per document
    row: ``key, text_hash, n_shingles, component_id, component``; the id is the smallest ``key``
    of the documents that links reach. Documents without words link with nothing. Equal
    sets are one class, so copies are never paired. Null keys and repeated rows are
    documents like others; a null is the component's id only if it has no other. Keys that
    are null or repeat make ``component_id`` the same for several components; ``component``
    is a number of each one's own, null without words. Other columns are not read.

    Classes meet under PartEnum signatures, dealt into buckets of a fixed size. Sets under
    a signature of up to ``COLD`` sets are paired. Larger groups first only link a set with
    the first one of most of its groups; sets that could still have a partner there, being in none
    or another component, are compared in blocks. Whole sets decide every pair that is
    compared. The result is components only: pairs inside a component that is known already
    are not compared, so the links themselves, or a document's number of links, cannot be
    had from here.
    """
    scheme = PartEnum(num, den)
    rows = written(with_set_keys(docs, key, text, scheme))
    texts = _classes(rows, docs, key, text)
    classes = texts.drop("text")
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_SIGNATURES))

    def meet(table: pa.Table) -> pa.Table:
        found = _meet(table)
        return found.append_column("bucket", pa.array([table.column("bucket")[0].as_py()] * len(found), pa.int64()))

    met = written(
        _dealt(texts, scheme, buckets).groupBy("bucket").applyInArrow(meet, f"{_MET}, bucket bigint")
    )
    stars, kept, heavy = _candidates(met, _needs(classes))
    placed = classes.withColumn("label", F.col("cid"))
    for pairs in (stars, kept):
        placed = _labelled(placed, _verified(pairs, placed, texts, scheme))
    # Large groups whose members are not connected yet.
    heavy = heavy.join(placed.select("cid", "n", "label"), "cid")
    unlike = (
        heavy.groupBy("bucket", "group")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo < hi")
    )
    left = written(
        heavy.join(unlike, ["bucket", "group"], "left_semi")
        .select("cid", "n", "label")
        .distinct()
    )
    if not left.isEmpty():
        placed = _labelled(placed, _rest(left, texts, scheme))
    heads = placed.groupBy("label").agg(F.min("doc").alias("component_id"))
    of_class = placed.join(heads, "label").select("k1", "k2", "n", "component_id", "label")
    linked = rows.join(of_class, ["k1", "k2", "n"], "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc"))
    return linked.select(
        F.col("doc").alias(key), F.col("hash").alias("text_hash"), F.col("n").alias("n_shingles"),
        own.alias("component_id"), F.col("label").alias("component"),
    )


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents: five words, a similarity of 0.75 or more."""
    docs = load(spark, folder, "documents", "doc_id", "text")
    return near_duplicates(docs).drop("text_hash", "component")
