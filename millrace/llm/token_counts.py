"""Token counts by heap-and-linked-list byte-pair merging, without any ids."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.base import id_type, query, slices, tokenizer_file
from millrace.llm.encoding import _PLAIN, Remembered, Units, lettered, load_tokenizer
from millrace.session import load

Ranks = dict[tuple[str, str], int]


def merged_length(symbols: list[str], ranks: Ranks) -> int:
    """Symbols that are left when the lowest-ranked adjacent pair is merged again and again.

    Adjacent symbols are a doubly linked list; a heap holds the rank and place of each pair
    that may merge, the leftmost first among equal ranks. Entries whose symbols have changed
    meanwhile are skipped. n symbols take O(n log n) steps.
    """
    n = len(symbols)
    if n < 2:
        return n
    after = [*range(1, n), -1]
    before = [-1, *range(n - 1)]
    now: list[str | None] = list(symbols)
    heap = []
    for place in range(n - 1):
        rank = ranks.get((symbols[place], symbols[place + 1]))
        if rank is not None:
            heap.append((rank, place))
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, left = heapq.heappop(heap)
        right = after[left]
        if now[left] is None or right < 0 or ranks.get((now[left], now[right])) != rank:
            continue
        merges += 1
        now[left] += now[right]
        now[right] = None
        after[left] = after[right]
        if after[left] >= 0:
            before[after[left]] = left
            rank = ranks.get((now[left], now[after[left]]))
            if rank is not None:
                heapq.heappush(heap, (rank, left))
        if before[left] >= 0:
            rank = ranks.get((now[before[left]], now[left]))
            if rank is not None:
                heapq.heappush(heap, (rank, before[left]))
    return n - merges


def token_counter(path: str) -> Callable[[str], int]:
    """Counts the tokens of a text as a byte-level tokenizer file gives them.

    Special strings in a text are one token each, as the library has it by default. Other
    text is cut into pre-tokens, whose counts a worker remembers.
    """
    tokenizer = load_tokenizer(path)
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    if parts["normalizer"] is not None or parts["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError("token_counter needs a byte-level tokenizer without a normalizer")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in parts["added_tokens"]):
        raise ValueError("token_counter takes added tokens only where they stand as written")
    pairs = (m.split(" ") if isinstance(m, str) else m for m in parts["model"]["merges"])
    ranks = {(left, right): rank for rank, (left, right) in enumerate(pairs)}
    special = [re.escape(t["content"]) for t in parts["added_tokens"]]
    cut = re.compile(f"({'|'.join(sorted(special, key=len, reverse=True))})") if special else None
    pretokens = tokenizer.pre_tokenizer.pre_tokenize_str
    known = Remembered(lambda letters: merged_length(list(letters), ranks))

    def count(unit: str) -> int:
        plain = _PLAIN.fullmatch(unit)
        if plain is not None:
            word = known[lettered(plain[1] + plain[2])]
            return word + (known[lettered(plain[3])] if plain[3] else 0)
        pieces = cut.split(unit) if cut else [unit]
        # Every second piece is a special string.
        return len(pieces) // 2 + sum(
            known[letters] for piece in pieces[::2] if piece for letters, _ in pretokens(piece)
        )

    units = Units(count, [t["content"] for t in parts["added_tokens"]])
    return lambda text: sum(units(text))


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of each row, whole texts counted.

    A null text counts as empty. Each row is counted by itself: repeated rows, null keys and
    equal keys give a row each; other columns are not read. A pass without any exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(path)
        for part in slices(batches):
            texts = [value or "" for value in part.column(1).to_pylist()]
            counts = [counter(value) for value in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(value.encode()) for value in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=[key, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"`{key}` {id_type(docs, key)}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under the byte-level vocabulary; over 512 is over the limit."""
    docs = load(spark, folder, "documents", "doc_id", "text")
    return count_tokens(docs, tokenizer_file("byte_bpe_50k.json"))
