import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.catalog import text as text_queries
from millrace.functions import labels
from millrace.operators import samples
from millrace.operators.templates import ANSWER_START, PLAIN, TURN_END
from millrace.operators.tokenizer import (
    KEPT_TOKENS,
    PLAIN_SPECIALS,
    AddedTokens,
    Tokenizer,
    build_vocab,
    token_ids,
)


@pytest.fixture(scope="module")
def tokenizer(spark):
    text = "the cat sat on the mat\nthe dog <think>x</think> é 你好 assistant\n assistant" * 3
    vocab = build_vocab(
        spark.createDataFrame([(text,)], "text string"), size=300, kept=KEPT_TOKENS
    )
    return Tokenizer(vocab)


def arrays(spark, rows):
    return spark.createDataFrame([(i, list(r)) for i, r in enumerate(rows)], "i int, ids array<int>")


def run(spark, rows, expression):
    df = arrays(spark, rows).select("i", expression(F.col("ids")).alias("out")).orderBy("i")
    return [r.out for r in df.collect()]


def test_vocabulary_layout(tokenizer):
    rows = tokenizer.vocab.orderBy("token_id").collect()
    assert [r.token_id for r in rows] == list(range(len(rows)))
    assert [r.token for r in rows[:9]] == [*PLAIN_SPECIALS, *KEPT_TOKENS]
    assert [r.special for r in rows[:9]] == [True] * 3 + [False] * 6
    assert rows[9].token == "<0x00>" and rows[264].token == "<0xFF>"
    assert len(rows) <= 300


@settings(
    max_examples=25, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(st.lists(st.text(st.characters(exclude_categories=("Cs",)), max_size=40), min_size=1, max_size=30))
def test_decode_undoes_encode(spark, tokenizer, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    out = df.select("i", "t", tokenizer.decode(tokenizer.encode(F.col("t"))).alias("d"))
    assert all(r.t == r.d for r in out.collect())


def test_specials_inside_text_are_single_ids(spark, tokenizer):
    text = "a<|im_end|><|endoftext|><think>b<|nope|>"
    ids = tokenizer.ids_of(text)
    assert ids.count(2) == 1 and ids.count(0) == 1 and ids.count(3) == 1
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    dropped, kept = df.select(
        tokenizer.decode(F.col("ids")), tokenizer.decode(F.col("ids"), skip_special=False)
    ).first()
    assert dropped == "a<think>b<|nope|>" and kept == text


def test_bad_bytes_are_replaced(spark, tokenizer):
    base = tokenizer.byte_base
    df = spark.createDataFrame([([base + 0x41, base + 0xFF, base + 0x42],)], "ids array<int>")
    assert df.select(tokenizer.decode(F.col("ids"))).first()[0] == "A�B"


def test_limit_equals_cut(spark, tokenizer):
    text = "the zebra sat on 你好 <|im_end|>\n" * 20
    whole = tokenizer.ids_of(text)
    df = spark.createDataFrame([(text,)], "t string")
    for limit in (1, 7, 50, 10_000):
        got = df.select(tokenizer.encode(F.col("t"), limit)).first()[0]
        assert got == whole[:limit]


def test_marker_survives_answer_starting_with_newline(tokenizer):
    start = tokenizer.ids_of(ANSWER_START)
    assert tokenizer.ids_of(ANSWER_START + "\nyes")[: len(start)] == start
    assert tokenizer.ids_of(TURN_END)[0] == 2


def test_token_ids(spark, tokenizer):
    df = spark.createDataFrame([("<|im_end|>",), ("absent",)], "token string")
    assert {r.token: r.token_id for r in token_ids(df, tokenizer).collect()} == {
        "<|im_end|>": 2, "absent": None,
    }


def test_lengths_and_stops(spark):
    rows = [[], [1, 2, 3], [1, 2, 3, 4, 5, 6]]
    assert run(spark, rows, lambda x: labels.fit_length(x, 5, 0)) == [
        [0] * 5, [1, 2, 3, 0, 0], [1, 2, 3, 4, 5],
    ]
    rows = [[3, 4, 9, 5], [3, 4, 5, 6, 7], [9], []]
    assert run(spark, rows, lambda x: labels.until_end(x, 9, 4)) == [[3, 4], [3, 4, 5, 6], [], []]


def test_pretrain_masks_pad_anywhere(spark):
    out = run(spark, [[3, 0, 4]], lambda x: labels.mask_value(labels.fit_length(x, 5, 0), 0))
    assert out == [[3, -100, 4, -100, -100]]


CASES = [
    ([9, 1, 7, 5, 6, 2, 5, 1, 8, 1, 7, 3], [0, 0, 0, 5, 6, 2, 5, 0, 0, 0, 0, 3]),
    ([1, 7, 1, 7, 2, 5], [0, 0, 1, 7, 2, 5]),
    ([1, 7, 2, 5], [0, 0, 2, 5]),
    ([1, 7, 3, 2], [0, 0, 3, 2]),
    ([1, 7, 3, 0, 0], [0, 0, 3, None, None]),
    ([4, 1, 7], [0, 0, 0]),
    ([4, 2, 5], [0, 0, 0]),
    ([], []),
]


def test_answer_labels(spark):
    got = run(spark, [c[0] for c in CASES], lambda x: labels.answer_labels(x, [1, 7], [2, 5], 99))
    for (ids, marks), out in zip(CASES, got):
        assert out == [i if m != 0 else -100 for i, m in zip(ids, marks)], ids


def spans_by_scan(ids, start, end):
    """Independent reading of the rule: walk from marker to marker."""
    spans, at = [], 0
    while at <= len(ids) - len(start):
        if ids[at : at + len(start)] != start:
            at += 1
            continue
        begin = at + len(start)
        close = next(
            (e for e in range(begin, len(ids) - len(end) + 1) if ids[e : e + len(end)] == end), None
        )
        stop = len(ids) if close is None else close + len(end)
        spans.append((at, begin, close, stop))
        at = stop
    return spans


@pytest.mark.parametrize(("start", "end"), [([1, 7], [2, 5]), ([1], [2]), ([1, 1], [1, 2]), ([1, 2, 3], [3])])
def test_labels_on_random_arrays(spark, start, end):
    rng = random.Random(11)
    rows = [[rng.choice([1, 2, 3, 5, 7]) for _ in range(rng.randrange(24))] for _ in range(700)]
    answers = run(spark, rows, lambda x: labels.answer_labels(x, start, end, 20))
    markers = run(spark, rows, lambda x: labels.answer_labels(x, start, end, 20, markers_only=True))
    for ids, answer, marker in zip(rows, answers, markers):
        on_answer, on_marker = set(), set()
        for opened, begin, close, stop in spans_by_scan(ids, start, end):
            on_answer |= set(range(begin, stop))
            on_marker |= set(range(opened, begin))
            on_marker |= set() if close is None else set(range(close, stop))
        assert answer == [v if i in on_answer and i < 20 else -100 for i, v in enumerate(ids)]
        assert marker == [v if i in on_marker and i < 20 else -100 for i, v in enumerate(ids)]


def test_next_pairs_and_counts(spark):
    df = spark.createDataFrame(
        [(1, [10, 11, 12], [-100, 11, 12]), (2, [5], [5]), (3, [], [])],
        "k int, input_ids array<int>, labels array<int>",
    )
    pairs = sorted(tuple(r) for r in samples.next_token_pairs(df, "k").collect())
    assert pairs == [(1, 0, 10, 11), (1, 1, 11, 12)]
    stats = {r.k: (r.n_tokens, r.n_supervised, r.share) for r in samples.supervision(df, "k").collect()}
    assert stats == {1: (2, 2, 1.0), 2: (0, 0, None), 3: (0, 0, None)}


def test_limited_rendering_gives_the_same_samples(spark, tokenizer):
    """Leaving late turns out early must not change what is kept."""
    rng = random.Random(2)
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 60)):
            role = rng.choice(["user", "assistant", "tool", "observer", "system"])
            rows.append((conv, turn, role, rng.choice(["", "the cat", "\nyes\n"])))
    turns = spark.createDataFrame(rows, "conv_id int, turn bigint, role string, content string")
    from millrace.operators.templates import REASONING, render

    for style in (PLAIN, REASONING):
        whole = render(turns, style, "conv_id").select(
            "conv_id", tokenizer.encode(F.col("text"), 30).alias("ids")
        )
        cut = render(turns, style, "conv_id", tokens=30).select(
            "conv_id", tokenizer.encode(F.col("text"), 30).alias("ids")
        )
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))


def test_pad_tokens_that_differ_warn(spark, tokenizer):
    df = spark.createDataFrame([(1, "the cat")], "k int, text string")
    with pytest.warns(UserWarning):
        row = samples.pretrain_samples(df, tokenizer, "k", 6, pad="<|im_end|>").first()
    assert row.input_ids[row.n_real :] == row.labels[row.n_real :] == [2] * (6 - row.n_real)


def test_queries_on_whole_conversations(spark, tmp_path):
    words = [f"w{k % 40}" for k in range(900)]
    answers = {1: " ".join(words), 3: "short <|im_end|> past the end", 5: " ".join(words[:700])}
    rows = [(1, t, "assistant" if t % 2 else "user", answers.get(t, f"question {t}")) for t in range(6)]
    spark.createDataFrame(rows + [(2, 0, "user", None)], "conv_id bigint, turn bigint, role string, text string").fillna(
        "", ["text"]
    ).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in text_queries.marker_match_whole(spark, str(tmp_path)).collect()}
    starts, ends = ([int(p) for p in found[1][c].split(",")] for c in ("starts", "ends"))
    # A default system block and six turns; the last answer starts far behind a sample's end.
    assert len(starts) == 3 and starts[-1] > 900 > samples.MAX_LENGTH
    assert len(ends) == 7 and ends[-1] == found[1].n_ids - 1
    assert found[2].starts == "" and len(found[2].ends.split(",")) == 2
    kept = {r.turn: r.n_ids for r in text_queries.stop_at_end_answers(spark, str(tmp_path)).collect()}
    assert kept == {1: 900, 3: 2, 5: 700}


RULES = "token_id int, content string, special boolean, lstrip boolean, rstrip boolean, single_word boolean"


def test_added_tokens_of_a_table_are_one_id_each(spark):
    rows = [
        (0, "<|endoftext|>", True, False, False, False),
        (1, "<think>", False, False, False, False),
        (2, "</think>", False, False, True, False),
        (3, "<think>deep", False, False, False, False),
        (4, "[MASK]", False, True, False, False),
        (5, "yes", False, False, False, True),
    ]
    added = AddedTokens.of(spark.createDataFrame(rows, RULES))
    texts = spark.createDataFrame([("so be it, so be it",)], "text string")
    tokenizer = added.tokenizer(texts, size=400)
    assert tokenizer.byte_base == 6
    cases = {
        "<think>": [1],
        "<think>deep": [3],
        "a<think>": [6 + ord("a"), 1],
        "so</think> \n so": [*tokenizer.ids_of("so"), 2, *tokenizer.ids_of("so")],
        "so  [MASK]so": [*tokenizer.ids_of("so"), 4, *tokenizer.ids_of("so")],
        "yes": [5],
        "yesno": [6 + b for b in b"yesno"],
        "(yes)": [6 + ord("("), 5, 6 + ord(")")],
        "<thin": [6 + b for b in b"<thin"],
        "": [],
    }
    df = spark.createDataFrame([(text,) for text in cases], "text string")
    found = {r.text: r for r in df.select("text", tokenizer.encode(F.col("text")).alias("ids")).collect()}
    assert {text: list(row.ids) for text, row in found.items()} == cases
    back = df.select("text", tokenizer.decode(tokenizer.encode(F.col("text"))).alias("back")).collect()
    assert all(r.back == r.text for r in back if "</think>" not in r.text and "MASK" not in r.text)


def test_added_tokens_need_ids_from_zero(spark):
    rows = [(1, "<think>", False, False, False, False)]
    with pytest.raises(ValueError):
        AddedTokens.of(spark.createDataFrame(rows, RULES))


def test_default_byte_base_comes_from_the_vocabulary(spark):
    vocab = build_vocab(spark.createDataFrame([("x",)], "text string"), size=300, kept=KEPT_TOKENS)
    tokenizer = Tokenizer(vocab)
    assert tokenizer.ids_of("<think>") == [3] and tokenizer.ids_of("q") == [9 + ord("q")]
