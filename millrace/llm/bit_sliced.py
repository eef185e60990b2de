"""Exact top-k inner products over a bit-sliced index of quantised vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.base import query
from millrace.session import load, written

#: Rows of an index block, and queries of a query block.
BLOCK_ROWS = 32_768
BLOCK_QUERIES = 256
_WORD = 64
#: Bytes and zero point of exact scores as binary that sorts like them: sums of up to 2**31
#: products of two 64-bit numbers fit.
_SORT_BYTES = 20
_SORT_ZERO = 1 << (8 * _SORT_BYTES - 1)


def quantised(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component; null where the vector takes no part.

    What 64 bits do not hold becomes the nearest number that they do.
    """
    good = vector.isNotNull() & F.forall(
        vector,
        lambda x: x.isNotNull()
        & ~F.isnan(x)
        & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.when(
        good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    )


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words, the first flag lowest."""
    pad = -flags.shape[-1] % _WORD
    padded = np.pad(flags, [(0, 0)] * (flags.ndim - 1) + [(0, pad)])
    return np.packbits(padded, axis=-1, bitorder="little").view("<u8").astype(np.uint64)


def slice_up(values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lowest value of each attribute, and the bit slices of what lies above it.

    ``values`` has a row per vector; slice b of an attribute is a bitmap over all rows.
    """
    low = values.min(axis=0)
    above = (values - low).astype(np.uint64)
    slices = []
    for column in above.T:
        bits = max(int(column.max()).bit_length(), 1)
        flags = column[None, :] >> np.arange(bits, dtype=np.uint64)[:, None] & np.uint64(1)
        slices.append(_bits(flags.astype(np.uint8)))
    return low, slices


def _signed_digits(value: int) -> Iterator[tuple[int, int]]:
    """(power, +1 or -1) of the form of ``value`` without adjacent non-zero digits."""
    power = 0
    while value:
        if value & 1:
            digit = 2 - (value & 3)
            yield power, digit
            value -= digit
        value >>= 1
        power += 1


def add_slices(weights: list[int], low: np.ndarray, slices: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Bit slices of the weighted sum of the attributes, and a constant to add to it.

    Slices of equal power are added three at a time into a sum slice of that power and a
    carry slice of the next, until one is left of each. A subtracted slice is added as its
    complement, which is the slice taken from one; the constant corrects that.
    """
    constant = sum(w * int(x) for w, x in zip(weights, low, strict=True))
    columns: dict[int, list[np.ndarray]] = {}
    for weight, own in zip(weights, slices, strict=True):
        for power, digit in _signed_digits(weight):
            stack = own if digit > 0 else ~own
            if digit < 0:
                constant -= ((1 << len(own)) - 1) << power
            for b in range(len(own)):
                columns.setdefault(power + b, []).append(stack[b : b + 1])
    result, power = [], 0
    words = slices[0].shape[1] if slices else 0
    while columns:
        here = columns.pop(power, [])
        group = np.concatenate(here) if here else np.zeros((1, words), np.uint64)
        carries = []
        while len(group) > 1:
            third = len(group) // 3
            if third == 0:
                a, b = group
                carries.append((a & b)[None])
                group = (a ^ b)[None]
                break
            a, b, c = group[:third], group[third : 2 * third], group[2 * third : 3 * third]
            odd = a ^ b
            carries.append(a & b | odd & c)
            group = np.concatenate((odd ^ c, group[3 * third :]))
        result.append(group[0])
        if carries:
            columns.setdefault(power + 1, []).extend(carries)
        power += 1
    return result, constant


def top_rows(slices: list[np.ndarray], among: np.ndarray, k: int) -> np.ndarray:
    """Places of the k rows of ``among`` with the largest sums; of equal ones the first.

    From the most significant slice down, rows are known to be in (``sure``) or still tied
    (``tied``). What is tied in the end has the boundary value; its first rows fill up.
    """
    sure, tied = np.zeros_like(among), among
    have = 0
    for bits in reversed(slices):
        upper = tied & bits
        n = have + int(np.bitwise_count(upper).sum())
        if n > k:
            tied = upper
        else:
            sure, tied, have = sure | upper, tied & ~bits, n
            if have == k:
                break
    return np.concatenate((_places(sure), _places(tied)[: k - have]))


def _places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.astype("<u8").view(np.uint8), bitorder="little"))


def _sums(slices: list[np.ndarray], rows: np.ndarray) -> list[int]:
    total = [0] * len(rows)
    for power, bits in enumerate(slices):
        on = bits[rows // _WORD] >> (rows % _WORD).astype(np.uint64) & np.uint64(1)
        total = [t + (int(bit) << power) for t, bit in zip(total, on.tolist(), strict=True)]
    return total


def search_block(
    ids: np.ndarray,
    low: np.ndarray,
    slices: list[np.ndarray],
    query_ids: np.ndarray,
    queries: np.ndarray,
    k: int,
) -> Iterator[tuple[int, np.ndarray, list[int]]]:
    """Position of each query, with the places and scores of its best k rows of one block.

    ``low`` and ``slices`` are the block's index. Its rows come in ascending order of id.
    Rows with the id of the query are its own.
    """
    everything = _bits(np.ones((1, len(ids)), dtype=np.uint8))[0]
    for position, (own, weights) in enumerate(zip(query_ids.tolist(), queries.tolist(), strict=True)):
        among = everything
        first, last = np.searchsorted(ids, own), np.searchsorted(ids, own, "right")
        if first < last:
            mask = np.ones((1, len(ids)), dtype=np.uint8)
            mask[0, first:last] = 0
            among = _bits(mask)[0]
        total, constant = add_slices(weights, low, slices)
        rows = top_rows(total, among, k)
        yield position, rows, [s + constant for s in _sums(total, rows)]


def _packed_blocks(df: DataFrame, rows: int, key: str) -> DataFrame:
    """Blocks of rows with vectors of one length: ``dims, block, ids, uids, cells``.

    Rows are dealt by a hash of their unique number, so blocks are of even size whatever
    ids repeat; a block holds about ``rows`` rows, each of bounded size.
    """
    sizes = df.groupBy(F.size("_q").alias("_dims")).agg(
        F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("_blocks")
    )
    place = F.pmod(F.xxhash64("_uid"), F.col("_blocks")).cast("int")
    dealt = df.withColumn("_dims", F.size("_q")).join(sizes, "_dims").withColumn("_block", place)
    cell = F.struct(F.col(key).alias("id"), F.col("_uid").alias("uid"), F.col("_q").alias("q"))
    return dealt.groupBy("_dims", "_block").agg(F.collect_list(cell).alias("_cells"))


_INDEX = (
    "_dims int, _block int, ids array<bigint>, uids array<bigint>, low array<bigint>, "
    "bits array<int>, slices array<binary>"
)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index of each block: its ids in order, lowest values, and slices as bytes.

    The slices of an attribute lie one after the other in one value; ``bits`` has their number.
    """
    for batch in batches:
        for place in range(batch.num_rows):
            ids, uids, values = _arrays(batch.column("_cells")[place].values)
            order = np.lexsort((uids, ids))
            low, slices = slice_up(values[order])
            one = {
                "_dims": batch.column("_dims")[place].as_py(),
                "_block": batch.column("_block")[place].as_py(),
                "ids": ids[order],
                "uids": uids[order],
                "low": low,
                "bits": np.array([len(stack) for stack in slices], dtype=np.int32),
                "slices": [stack.astype("<u8").tobytes() for stack in slices],
            }
            yield pa.RecordBatch.from_pylist([one], schema=_INDEX_ARROW)


_INDEX_ARROW = pa.schema(
    [
        ("_dims", pa.int32()),
        ("_block", pa.int32()),
        ("ids", pa.list_(pa.int64())),
        ("uids", pa.list_(pa.int64())),
        ("low", pa.list_(pa.int64())),
        ("bits", pa.list_(pa.int32())),
        ("slices", pa.list_(pa.binary())),
    ]
)


def build_index(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Bit slices of blocks of some ``block_rows`` rows (``_id, _uid, _q``), built once and stored."""
    blocks = _packed_blocks(rows, block_rows, "_id")
    return written(blocks.select("_dims", "_block", "_cells").mapInArrow(_build, _INDEX))


def _opened(batch: pa.RecordBatch, place: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    ids, uids, low, bits = (
        batch.column(name)[place].values.to_numpy() for name in ("ids", "uids", "low", "bits")
    )
    stacks = batch.column("slices")[place].values
    slices = [
        np.frombuffer(stack.as_buffer(), dtype="<u8").reshape(n, -1)
        for stack, n in zip(stacks, bits.tolist(), strict=True)
    ]
    return ids, uids, low, slices


_FOUND = "query_id bigint, query_uid bigint, vec_id bigint, uid bigint, score bigint, exact binary"
_LEAST, _MOST = -(2**63), 2**63 - 1


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k largest integer inner products of every query row with all rows but its own.

    ``queries`` is a condition on the rows of ``vectors``. Returns ``query_id, rank, vec_id,
    score``; ties go to the smaller id, and a query with fewer candidates returns them all.
    Vectors that are null or hold null or non-finite components, and rows without an id,
    take no part; vectors of different lengths are not compared. Rows with an equal id are
    one another's own; repeated rows stay candidates and queries each. Other columns are
    not read. Components of any finite size take part: sums are exact whatever their size and
    decide the ranks, and a score that 64 bits do not hold is shown as the nearest number that
    they do. Scaled components beyond 64 bits count as the nearest such number.

    The index holds the bit slices of blocks of some ``block_rows`` rows and is built once.
    Index blocks meet query blocks; each pair is one task's work and returns k rows a query,
    which are ranked in the end.
    """
    rows = vectors.select(
        F.col(key).cast("bigint").alias("_id"),
        quantised(F.col(vector), scale).alias("_q"),
        F.coalesce(queries, F.lit(False)).alias("_asks"),
    ).where(F.col("_id").isNotNull() & F.col("_q").isNotNull())
    rows = written(rows.withColumn("_uid", F.monotonically_increasing_id()))
    index = build_index(rows.drop("_asks"), block_rows)
    asked = _packed_blocks(rows.where("_asks").drop("_asks"), BLOCK_QUERIES, "_id").select(
        "_dims", F.col("_block").alias("_query_block"), F.col("_cells").alias("_queries")
    )
    pairs = asked.join(index.select("_dims", "_block"), "_dims")
    met = pairs.join(index, ["_dims", "_block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                own, uid, q = _arrays(batch.column("_queries")[place].values)
                ids, uids, low, slices = _opened(batch, place)
                out = [[], [], [], [], [], []]
                for n, found, scores in search_block(ids, low, slices, own, q, k):
                    m = len(found)
                    shown = [min(max(s, _LEAST), _MOST) for s in scores]
                    exact = [(s + _SORT_ZERO).to_bytes(_SORT_BYTES, "big") for s in scores]
                    for column, more in zip(
                        out,
                        ([own[n]] * m, [uid[n]] * m, ids[found], uids[found], shown, exact),
                        strict=True,
                    ):
                        column.extend(more)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in out[:5]]
                    + [pa.array(out[5], pa.binary())],
                    names=["query_id", "query_uid", "vec_id", "uid", "score", "exact"],
                )

    found = met.select("_queries", "ids", "uids", "low", "bits", "slices").mapInArrow(run, _FOUND)
    best = Window.partitionBy("query_uid").orderBy(F.desc("exact"), "vec_id", "uid")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _arrays(cells: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, uids = cells.field("id").to_numpy(), cells.field("uid").to_numpy()
    q = cells.field("q")
    return ids, uids, q.flatten().to_numpy().reshape(len(ids), -1)


#: Scores of whole vectors in SQL, for comparison.
_SQL = """
WITH quantised AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM quantised a JOIN quantised b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
         vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query("op3_top_k_search", _SQL)
def op3_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five best rows for each row whose id is divisible by 50, over all rows."""
    vectors = load(spark, folder, "embeddings", "vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5)
