"""Token counts, packing and token files against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing, simple8b, token_counts, token_files
from millrace.llm.base import tokenizer_file
from millrace.llm.encoding import id_bytes, load_tokenizer
from millrace.llm.ranked_bytes import ranked_id_bytes
from millrace.session import scratch_folder
from tests.llm.helpers import AWKWARD, SCHEMA, clashing, prose

BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
TEXTS = [
    "", " ", "\n", "a  b", " a", "a ", "\n\na\t b\n", "a　b", "it's 'tis don't can't!", "Ab!! x|y, ÉÀ ÿ İ ß Œ",
    "日本語 🙂🙂", "\x00\x01\x1c\x1d", "\x85a \x85", "aaaa" * 3000, "<|endoftext|>", "a <|endoftext|> b<|endoftext|>",
    "<|startoftext|>x", "é É", prose(3, 500),
]


@pytest.mark.parametrize(("path", "keeps"), [(BYTES, True), (WORDS, False)])
def test_ids_are_those_of_the_library(path, keeps):
    library, own = load_tokenizer(path), id_bytes(path, keeps)
    for text in TEXTS:
        ids = np.frombuffer(own(text), dtype="<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:40]


def test_counts_are_those_of_the_library():
    library, count = load_tokenizer(BYTES), token_counts.token_counter(BYTES)
    for text in TEXTS:
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), text[:40]


@pytest.mark.parametrize("space", ["\n", "\n\n", "\n\n\n\n", "\xa0\xa0", "  ", "\n ", " \n\n", "\t\t"])
def test_white_space_before_a_special_string_is_one_unit(space):
    library, own, count = load_tokenizer(BYTES), id_bytes(BYTES, True), token_counts.token_counter(BYTES)
    end = "<|endoftext|>"
    for text in (f"a{space}{end}b", f"{space}{end}", f"{end}{space}{end}{space}b", f"a b{end}{space}"):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own(text), dtype="<u4").tolist() == ids, text
        assert count(text) == len(ids), text


def test_merging_takes_the_lowest_rank_then_the_leftmost():
    ranks = {("a", "a"): 0, ("aa", "a"): 1, ("b", "c"): 2}
    assert token_counts.merged_length(list("aaabc"), ranks) == 2
    assert token_counts.merged_length([], ranks) == 0
    assert token_counts.merged_length(list("aaaa"), {("a", "a"): 0}) == 2


def test_count_tokens_keeps_every_row(spark):
    df = clashing(spark.createDataFrame(AWKWARD, SCHEMA))
    rows = token_counts.count_tokens(df, BYTES, limit=3).collect()
    library = load_tokenizer(BYTES)
    expected = []
    for key, text in AWKWARD:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((key, len((text or "").encode()), n, n > 3))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    assert token_counts.count_tokens(df.limit(0), BYTES).count() == 0


@pytest.mark.parametrize(
    "values",
    [
        [], [0] * 5000, [1] * 1025, [2**60 - 1, 2**60 - 2, 5, 2**64 - 1, 0], list(range(70_000)),
        [0, 2**40] * 700, [int(x) for x in np.random.default_rng(0).integers(0, 50_257, 30_000)],
    ],
)
def test_simple8b_round_trip(values):
    own = np.array(values, dtype=np.uint64)
    words, first, escapes = simple8b.encode(own)
    assert (simple8b.decode(words, first, escapes, len(own)) == own).all()
    if len(own) > 2 * simple8b.BLOCK and not len(escapes):
        # A block alone.
        part = simple8b.decode(words[first[1] : first[2]], np.array([0]), escapes, simple8b.BLOCK)
        assert (part == own[simple8b.BLOCK : 2 * simple8b.BLOCK]).all()


def test_zeros_and_small_values_share_words():
    assert len(simple8b.encode(np.zeros(1024, np.uint64))[0]) == 5
    assert len(simple8b.encode(np.ones(600, np.uint64))[0]) == 10


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    monkeypatch.setattr(token_files, "FILE_SEGMENTS", 2)
    rows = AWKWARD + [(k, prose(k, k % 40)) for k in range(10, 200)]
    df = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    folder = scratch_folder(spark)
    token_files.write_tokens(df, folder, BYTES, 2)
    found = token_files.with_starts(token_files.read_tokens(spark, folder)).orderBy("start").collect()
    library, expected = load_tokenizer(BYTES), defaultdict(list)
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected[key].append(np.array(ids, dtype="<u4").tobytes())
    at = 0
    for row in found:
        assert row.start == at
        expected[row.doc_id].remove(bytes(row.ids))
        at += row.n_tokens
    assert not any(expected.values())
    keys = [row.doc_id for row in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))


def test_no_documents_no_tokens(spark):
    folder = scratch_folder(spark)
    token_files.write_tokens(spark.createDataFrame([], SCHEMA), folder, BYTES, 2)
    assert token_files.read_tokens(spark, folder).count() == 0


def test_best_fit_fills_the_fullest_bin():
    bins, offsets, fills = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert fills == [10, 10]
    assert (bins.tolist(), offsets.tolist()) == ([0, 1, 0, 1, 1], [0, 0, 6, 5, 8])


@pytest.mark.parametrize("group_items", [20_000, 25])
def test_packing(spark, group_items):
    lengths = [(k, 1 + k * k % 97) for k in range(500)] + [(1000 + k, 100) for k in range(3)]
    items = spark.createDataFrame(lengths, "item bigint, length bigint")
    placed = packing.pack(items, 100, group_items).collect()
    assert sorted(row.item for row in placed) == sorted(k for k, _ in lengths)
    length, bins = dict(lengths), defaultdict(list)
    for row in placed:
        bins[row.sequence_id].append((row.offset, length[row.item]))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 100
    least = sum(length.values()) / 100
    assert len(bins) <= (1.05 if group_items > 100 else 1.12) * least + 1


def test_items_over_half_stay_alone_and_no_items_give_none(spark):
    items = spark.createDataFrame([(k, 60) for k in range(200)], "item bigint, length bigint")
    assert packing.pack(items, 100, 20).select("sequence_id").distinct().count() == 200
    assert packing.pack(items.limit(0), 100).count() == 0


@pytest.mark.parametrize(("lengths", "group_items"), [((30,), 4), ((70, 8), 10), ((51, 52, 3), 25), ((60, 41, 17), 12)])
def test_no_two_underfull_sequences_fit_together(spark, lengths, group_items):
    rows = [(i, lengths[i * i % 7 % len(lengths)]) for i in range(300)]
    items = spark.createDataFrame(rows, "item bigint, length bigint")
    placed = packing.pack(items, 100, group_items).collect()
    assert sorted(r.item for r in placed) == list(range(300))
    fills = Counter()
    for r in placed:
        fills[r.sequence_id] += rows[r.item][1]
    open_ = sorted(f for f in fills.values() if 100 - f > int(100 * packing.NEARLY_FULL))
    assert max(fills.values()) <= 100
    assert len(open_) < 2 or open_[0] + open_[1] > 100


def test_packed_documents_and_sequences(spark):
    df = clashing(spark.createDataFrame(AWKWARD, SCHEMA))
    rows = packing.pack_documents(df, WORDS, size=256).collect()
    library, expected = load_tokenizer(WORDS), []
    for key, text in AWKWARD:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[at : at + 256], dtype="<u4").tobytes()
            expected.append((key, piece, at, len(part) // 4, zlib.crc32(part)))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert packing.pack_documents(df.limit(0), WORDS).count() == 0
    items = [(1, 0, "ab"), (2, 0, "c"), (3, 1, "d")]
    pieces = spark.createDataFrame([(k, t.encode()) for k, _, t in items], "item bigint, ids binary")
    places = spark.createDataFrame([(1, 1, 0), (2, 1, 2), (3, 3, 0)], "item bigint, sequence_id bigint, offset bigint")
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(pieces, places).collect()}
    assert whole == {1: b"abc", 3: b"d"}


def test_ranks_give_the_ids_of_the_library():
    path = tokenizer_file("byte_bpe_50k.json")
    library, ranked = Tokenizer.from_file(path), ranked_id_bytes(path)
    rng = random.Random(5)
    plain = [chr(c) for c in [*range(9, 14), *range(32, 127), *range(0xA0, 0x250)]] + [" "] * 60
    plain += ["\n"] * 10 + list("eationst") * 12 + ["'s", "'ll", "<|endoftext|>"]
    for k in range(4000):
        letters = plain if k % 5 else [*plain, "日", "🙂", "\x85", "\x1c", "\u3000", "e\u0301"]
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ranked(text), dtype="<u4").tolist() == expected, repr(text)
