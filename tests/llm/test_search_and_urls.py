"""Top-k search and URL filters against brute force."""

import math
from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import bit_sliced, url_filter

VECTOR = "vec_id bigint, embedding array<double>, rank string, score string"


def brute(rows, k, asks):
    good = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in good:
        if asks(q):
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b)]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def search(spark, rows, k=5, block=40):
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], VECTOR)
    return sorted(map(tuple, bit_sliced.top_k(df, F.col("vec_id") % 10 == 0, k, block_rows=block).collect()))


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(150)]
    rows += [(200, [0.0] * 6), (201, rows[3][1]), (202, rows[3][1]), (210, None), (211, [1.0, None] * 3)]
    rows += [(212, [math.nan] * 6), (213, [math.inf] * 6), (None, [1.0] * 6), (220, [1.0, 2.0]), (221, [3.0, 4.0])]
    rows += [(7, rows[7][1]), (30, rows[31][1])]
    assert search(spark, rows) == brute(rows, 5, lambda i: i % 10 == 0)


def test_ties_few_candidates_and_no_rows(spark):
    rows = [(i, [1.0, -1.0]) for i in range(9)]
    assert search(spark, rows) == brute(rows, 5, lambda i: i % 10 == 0)
    assert search(spark, rows[:3]) == [(0, 1, 1, 131072), (0, 2, 2, 131072)]
    assert search(spark, rows[:1]) == []
    assert search(spark, []) == []


def test_components_of_any_finite_size(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=3) * 10.0 ** rng.integers(0, 7)).tolist()) for i in range(60)]
    rows += [(60, [70000.0, -70000.0, 1.0]), (61, [2.0**22, 2.0**22, 2.0**21])]
    assert search(spark, rows, block=20) == brute(rows, 5, lambda i: i % 10 == 0)


def test_scores_beyond_64_bits_rank_by_their_exact_size(spark):
    rows = [(0, [2.0**40, 2.0**40]), (1, [2.0**40, 0.0]), (2, [2.0**40, 2.0**39]), (3, [-(2.0**40), -1.0]), (4, [1e300, 0.0])]
    found = search(spark, rows, block=2)
    assert [r[2] for r in found] == [4, 2, 1, 3]
    assert [r[3] for r in found] == [2**63 - 1] * 3 + [-(2**63)]


def test_empty_vectors_meet_empty_vectors(spark):
    rows = [(i, []) for i in range(4)]
    assert search(spark, rows) == [(0, 1, 1, 0), (0, 2, 2, 0), (0, 3, 3, 0)]


def test_slices_add_up():
    rng = np.random.default_rng(2)
    values, weights = rng.integers(-300, 300, (200, 5)), [7, -13, 0, 255, -256]
    total, constant = bit_sliced.add_slices(weights, *bit_sliced.slice_up(values))
    sums = np.array(bit_sliced._sums(total, np.arange(200))) + constant
    assert (sums == values @ np.array(weights)).all()


ENTRY = "list_id string, kind string, pattern string, action string, at timestamp"
CAPTURE = "page_id bigint, url string, fetched timestamp, kind string, decision string"


def day(n):
    return datetime(2024, 1, n)


def judge(spark, captures, entries):
    pages = spark.createDataFrame([(*c, "x", "y") for c in captures], CAPTURE)
    rows = url_filter.filter_captures(pages, spark.createDataFrame(entries, ENTRY)).collect()
    return {(r.page_id, r.url, r.fetched): (r.decision, r.n_active, r.list_id) for r in rows}


def test_entries_hold_from_their_time_to_the_next_one(spark):
    entries = [
        ("a", "host", "x.example", "block", day(5)), ("a", "host", "x.example", "remove", day(10)),
        ("a", "host", "x.example", "block", day(20)), ("b", "domain", "example", "allow", day(6)),
        ("b", "prefix", "x.example/p/q", "block", day(1)), (None, "host", "x.example", "block", day(1)),
    ]
    urls = {"h": "http://User@X.example:80/", "p": "https://x.example/p//q/r?s#t", "d": "http://y.example/p"}
    captures = [(k, urls[u], day(d)) for k, (u, d) in enumerate([("h", 4), ("h", 5), ("h", 9), ("h", 10), ("h", 25), ("p", 2), ("p", 8), ("d", 5), ("d", 7)])]
    captures += [(90, None, day(5)), (91, urls["h"], None), (92, "no url", day(5)), (None, urls["h"], day(9)), (1, urls["h"], day(5))]
    found = judge(spark, captures, entries)
    expected = [("keep", 0, None), ("drop", 1, "a"), ("drop", 2, "a"), ("keep", 1, "b"), ("drop", 2, "a"), ("drop", 1, "b"), ("drop", 3, "b"), ("keep", 0, None), ("keep", 1, "b")]
    assert [found[c] for c in captures[:9]] == expected
    assert [found[c][0] for c in captures[9:13]] == ["keep", "keep", "keep", "drop"]
    assert len(found) == 13


def test_allow_wins_a_tie_and_empty_tables(spark):
    entries = [("a", "host", "x.example", "block", day(1)), ("b", "host", "x.example", "allow", day(1))]
    capture = (1, "http://x.example/", day(3))
    assert judge(spark, [capture], entries) == {capture: ("keep", 2, "b")}
    assert judge(spark, [capture], []) == {capture: ("keep", 0, None)}
    assert judge(spark, [], entries) == {}


def test_every_repeated_capture_comes_back(spark):
    entries = spark.createDataFrame([("a", "host", "x.example", "block", day(1))], ENTRY)
    rows = [(1, "http://x.example/", day(3), "x", "y")] * 3 + [(None, None, None, "x", "y")] * 2
    found = url_filter.filter_captures(spark.createDataFrame(rows, CAPTURE), entries).collect()
    assert sorted((r.decision, r.n_active) for r in found) == [("drop", 1)] * 3 + [("keep", 0)] * 2


def test_hosts_of_addresses(spark):
    urls = ["http://[2001:DB8::1]:80/a", "http://me@[::1]/", "http://1.2.3.4:5/", "http://X.example.:1"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(url_filter.host_of(F.col("url")).alias("h"))
    assert [r.h for r in rows.collect()] == ["[2001:db8::1]", "[::1]", "1.2.3.4", "x.example"]
