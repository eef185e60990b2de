"""Best-fit packing of token pieces by hierarchical residual packing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import id_type, query, slices, tokenizer_file
from millrace.llm.encoding import ID, id_bytes
from millrace.session import load, written

#: Items that one task packs at a time.
GROUP_ITEMS = 20_000
#: A bin whose free room is at most this share of its size is nearly full and leaves.
NEARLY_FULL = 1 / 128


def tokenize(
    docs: DataFrame, path: str, end_id: int, size: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of at most ``size`` ids: ``key, piece, start, length, ids, ids_crc32``.

    A document is its ids (a null text: none) and ``end_id``; only longer ones are cut.
    ``ids`` are little-endian unsigned 32-bit integers. No exchange; other columns are not
    read. Repeated rows and null keys give pieces of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_bytes(path, keeps_space=False)
        end = np.array([end_id], dtype=ID).tobytes()
        step = size * ID.itemsize
        for part in slices(batches):
            rows, pieces, starts, packed = [], [], [], []
            for row, text in enumerate(part.column(1).to_pylist()):
                ids = encode(text or "") + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // ID.itemsize)
                    packed.append(ids[at : at + step])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array([len(ids) // ID.itemsize for ids in packed], pa.int64()),
                    pa.array(packed, pa.binary()),
                    pa.array([zlib.crc32(ids) for ids in packed], pa.int64()),
                ],
                names=[key, "piece", "start", "length", "ids", "ids_crc32"],
            )

    schema = (
        f"`{key}` {id_type(docs, key)}, piece int, start bigint, length bigint, ids binary, "
        "ids_crc32 bigint"
    )
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item, and the fill of each bin; items come in the given order.

    Every item goes to the fullest bin that still has room for it. Bins wait in one list
    per free room; a bit mask finds the smallest free room that is large enough.
    """
    waiting: list[list[int]] = [[] for _ in range(size + 1)]
    fills: list[int] = []
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    mask = 0
    for k, length in enumerate(lengths.tolist()):
        fitting = mask >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            place = waiting[room].pop()
            if not waiting[room]:
                mask ^= 1 << room
        else:
            room, place = size, len(fills)
            fills.append(0)
        bins[k], offsets[k] = place, fills[place]
        fills[place] += length
        left = room - length
        if left:
            waiting[left].append(place)
            mask |= 1 << left
    return bins, offsets, fills


_BINS = "fill bigint, open boolean, members array<struct<item:bigint,at:bigint>>"


def _pack_round(items: DataFrame, size: int, groups: int) -> DataFrame:
    """Pack each of ``groups`` groups of items, themselves bins of earlier rounds, into bins."""
    spare = int(size * NEARLY_FULL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        fill = table.column("fill").to_numpy()
        members = table.column("members").combine_chunks()
        first = members.flatten().field("item").to_numpy()[members.offsets.to_numpy()[:-1]]
        order = np.lexsort((first, -fill))
        bins, offsets, fills = best_fit(fill[order], size)
        by_bin = np.argsort(bins, kind="stable")
        taken = members.take(pa.array(order[by_bin]))
        counts = np.diff(taken.offsets.to_numpy())
        inner = taken.flatten()
        at = inner.field("at").to_numpy() + np.repeat(offsets[by_bin], counts)
        per_bin = np.bincount(bins[by_bin], weights=counts, minlength=len(fills))
        ends = np.concatenate(([0], np.cumsum(per_bin.astype(np.int64)))).astype(np.int32)
        packed = pa.ListArray.from_arrays(
            pa.array(ends),
            pa.StructArray.from_arrays([inner.field("item"), pa.array(at)], ["item", "at"]),
        )
        fills = np.array(fills, dtype=np.int64)
        out = pa.RecordBatch.from_arrays(
            [pa.array(fills), pa.array(size - fills > spare), packed],
            names=["fill", "open", "members"],
        )
        yield from slices([out], 4096)

    dealt = items.select("fill", "members").repartition(groups, F.expr("members[0].item"))
    return dealt.mapInArrow(run, _BINS)


def pack(items: DataFrame, size: int, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Place items (``item`` unique, ``length`` from 1 to ``size``) into few bins of ``size``.

    Returns ``item, sequence_id, offset``; a sequence is named by its first item, and its
    items lie without gaps from offset 0. Items of full length are bins at once. The others
    are dealt over groups of ``group_items`` and packed there, longest first, each into the
    fullest bin with room. Nearly full bins leave; of the underfull ones, those that can
    still be joined are the items of the next round, in fewer groups, until one group held
    them all or none is left. A task never holds more than a group, however many rows share
    a length or key. No item is lost, no items give no rows.

    Two bins that a group leaves never fit into one, so at most one bin a group is half full
    or less, and every later join takes one of these. Each join needs at most one bin that is
    more than half full, and the emptiest serve as well as any others. So a round goes on
    with the bins of up to half a size and as many of the emptiest others. With groups of
    four items and more, each round has fewer items than the one before.
    """
    if group_items < 4:
        raise ValueError("group_items must be at least four")
    start = items.select(
        F.col("length").alias("fill"),
        (F.col("length") < size).alias("open"),
        F.array(F.struct(F.col("item").alias("item"), F.lit(0).cast("bigint").alias("at"))).alias(
            "members"
        ),
    )
    done, left = start.where(~F.col("open")), start.where("open")
    n = left.count()
    while n:
        groups = -(-n // group_items)
        bins = written(_pack_round(left, size, groups))
        if groups == 1:
            done = done.unionByName(bins)
            break
        small = F.col("open") & (2 * F.col("fill") <= size)
        n_small = bins.where(small).count()
        others = bins.where(F.col("open") & ~small).withColumn("_first", F.expr("members[0].item"))
        emptiest = others.orderBy("fill", "_first").limit(n_small).drop("_first")
        left = written(bins.where(small).unionByName(emptiest))
        going = left.select(F.expr("members[0].item").alias("_gone"))
        stay = bins.join(going, F.expr("members[0].item") == F.col("_gone"), "left_anti")
        done, n = done.unionByName(stay), left.count()
    return done.select(
        F.expr("members[0].item").alias("sequence_id"), F.inline("members")
    ).select("item", "sequence_id", F.col("at").alias("offset"))


def pack_documents(
    docs: DataFrame, path: str, size: int = 4096, end_id: int = 1, key: str = "doc_id"
) -> DataFrame:
    """Pieces of all documents with their places: ``key, piece, start, length, ids_crc32,
    sequence_id, offset``. The ids themselves are left out; see :func:`sequences`."""
    pieces = written(
        tokenize(docs, path, end_id, size, key)
        .drop("ids")
        .withColumn("item", F.monotonically_increasing_id())
    )
    return pieces.join(pack(pieces, size), "item").drop("item")


def sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """Whole sequences, ``sequence_id`` and ``ids``, from pieces that carry ``item`` and ``ids``.

    A sequence is one cell, at most as long as a bin.
    """
    part = F.struct("offset", "ids")
    whole = pieces.select("item", "ids").join(places, "item").groupBy("sequence_id")
    return whole.agg(F.sort_array(F.collect_list(part)).alias("_parts")).select(
        "sequence_id",
        F.expr("aggregate(_parts, X'', (whole, part) -> concat(whole, part.ids))").alias("ids"),
    )


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens of the word vocabulary."""
    docs = load(spark, folder, "documents", "doc_id", "text")
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json"))
