"""Near duplicates and decontamination against brute force over all pairs and windows."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import components as contraction, decontamination, jaccard_join, shingles as hashed
from millrace.llm.components import components
from millrace.llm.partenum import PartEnum, similar
from millrace.llm.shingles import shingle_sets
from tests.llm.helpers import AWKWARD, SCHEMA, clashing, hit_words, linked_components, prose, shingles


def edited(text: str, changes: int, seed: int) -> str:
    words, rng = text.split(), random.Random(seed)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"changed{rng.randrange(10**6)}"
    return " ".join(words)


def corpus() -> list[tuple]:
    """Copies, near copies on both sides of the threshold, and a passage that many share."""
    passage = prose(99, 60)
    rows = list(AWKWARD) + [(100 + k, prose(5, 200)) for k in range(5)]
    rows += [(200 + k, edited(prose(5, 200), k % 7, k)) for k in range(40)]
    rows += [(300 + k, f"{prose(k, 12 + k % 9)} {passage}") for k in range(60)]
    rows += [(400 + k, f"{prose(k, 150)} {passage}") for k in range(30)]
    rows += [(500 + k, edited(passage, k % 3, k)) for k in range(40)]
    rows += [(600 + k, f"tiny {k % 4} text") for k in range(8)]
    return rows + [(700, prose(8, 90)), (None, prose(8, 90).upper()), (701, "x" * 20_000)]


def test_shingle_sets_are_those_of_words():
    texts = [text for _, text in corpus()] + ["\x0ba\x0c b\tc\x1cd\r\ne f", "É é É é É"]
    for text, found in zip(texts, shingle_sets(texts), strict=True):
        assert len(found) == len(shingles(text))
    assert shingle_sets(["A b c D e f"])[0].tolist() == shingle_sets(["a B\nc d  e f"])[0].tolist()


@pytest.mark.parametrize("size", [1, 3, 5, 12, 60, 400])
def test_similar_sets_share_enough_signatures(size):
    scheme, rng = PartEnum(), np.random.default_rng(size)
    met = 0
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        cut = rng.integers(0, size // 7 + 2)
        more = rng.integers(0, 2**64, rng.integers(0, size // 3 + 1), dtype=np.uint64)
        b = np.unique(np.concatenate((rng.permutation(a)[cut:], more)))
        if not similar(a, b, 75, 100):
            continue
        met += 1
        mine = {band: (set(s.tolist()), need) for band, s, need in scheme.signatures(a)}
        other = {band: (set(s.tolist()), need) for band, s, need in scheme.signatures(b)}
        shared = {band: len(mine[band][0] & other[band][0]) for band in mine.keys() & other.keys()}
        assert any(n >= max(mine[b][1], other[b][1], 1) for b, n in shared.items())
    assert met


@pytest.mark.parametrize(("cold", "signatures"), [(16, 2_000_000), (2, 500)])
def test_near_duplicates(spark, monkeypatch, cold, signatures):
    monkeypatch.setattr(jaccard_join, "COLD", cold)
    monkeypatch.setattr(jaccard_join, "BUCKET_SIGNATURES", signatures)
    rows = corpus()
    df = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    got = jaccard_join.near_duplicates(df).collect()
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in got)
    expected = linked_components(rows)
    assert found == Counter(
        (key, expected[i][0], expected[i][1] if expected[i][0] else key) for i, (key, _) in enumerate(rows)
    )


def test_no_documents_no_groups(spark):
    assert jaccard_join.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    empty = spark.createDataFrame([(1, None), (2, "")], SCHEMA)
    assert sorted(r.component_id for r in jaccard_join.near_duplicates(empty).collect()) == [1, 2]


def test_components_of_chains_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, 100 + k) for k in range(1, 50)] + [(203, 201), (201, 202), (202, 203)]
    links += [(300, 300), (100, 101)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    expected = {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 150)} | {k: 201 for k in (201, 202, 203)}
    assert found == expected


@pytest.mark.parametrize(("held", "rounds"), [(1 << 18, 0), (8, 1)])
def test_components_need_few_rounds(spark, monkeypatch, held, rounds):
    rng, done, star = random.Random(4), [], contraction._large_star
    monkeypatch.setattr(contraction, "HELD", held, raising=False)
    monkeypatch.setattr(contraction, "_large_star", lambda links: done.append(1) or star(links))
    # A long chain in random order, and sparse random links that repeat and run both ways.
    ids = rng.sample(range(1_000), 80)
    links = list(zip(ids, ids[1:])) + [(rng.randrange(2_000, 2_200), rng.randrange(2_000, 2_200)) for _ in range(120)]
    links += [(v, u) for u, v in links[::7]]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "u bigint, v bigint").repartition(16)
    got = [(r.node, r.label) for r in components(df).collect()]
    label = {x: x for link in links for x in link if link[0] != link[1]}
    for _ in label:
        for u, v in links:
            if u != v:
                label[u] = label[v] = min(label[u], label[v])
    assert sorted(got) == sorted(label.items())
    assert len(done) == 0 if not rounds else len(done) >= rounds


def test_candidates_are_worked_out_once(spark, monkeypatch):
    counted, enough = [], jaccard_join._enough

    def watched(pairs, needs):
        seen = spark.sparkContext.accumulator(0)

        def pass_on(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        found = enough(pairs, needs)
        counted.append((seen, found.count()))
        return found.mapInArrow(pass_on, found.schema)

    monkeypatch.setattr(jaccard_join, "_enough", watched)
    rows = [(k, prose(k % 30, 80)) for k in range(60)] + [(100 + k, edited(prose(k, 80), 1, k)) for k in range(30)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = linked_components(rows)
    assert {r.doc_id: r.component_id for r in got} == {key: expected[i][1] for i, (key, _) in enumerate(rows)}
    ((seen, once),) = counted
    assert seen.value == once > 0


ITEMS = [
    (1, prose(50, 40)), (2, prose(51, 13)), (3, "short item of Six words"), (4, "alone"), (5, "two words"),
    (6, None), (7, " ,;"), (None, prose(52, 20)), (8, prose(50, 40)), (9, "echo echo echo echo"), (2, prose(53, 30)),
]


@pytest.mark.parametrize("block", [500_000, 30])
def test_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", block)
    a, b = prose(50, 40).split(), prose(53, 30).split()
    docs = AWKWARD + [
        (20, " ".join(a)), (21, f"{prose(60, 300)} {' '.join(a[5:18])}"), (22, " ".join(a[:12])),
        (23, prose(51, 13).upper() + "!"), (24, "the SHORT item, of six words. Alone"), (25, "echo " * 9),
        (26, ", ".join(a) + " mid " + ". ".join(b)), (27, prose(61, 100)), (28, prose(52, 20)), (29, "É two words é"),
        (30, " ".join(a * 3)), (31, " ".join(a[10:] + a[:10])), (20, " ".join(a)),
    ]
    df = clashing(spark.createDataFrame(docs, SCHEMA)).repartition(3)
    items = clashing(spark.createDataFrame(ITEMS, "item_id bigint, text string"))
    got = Counter(tuple(r) for r in decontamination.contamination(df, items).drop("text_hash").collect())
    expected = Counter()
    for key, text in docs:
        n, hit, ids = hit_words(text, ITEMS)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        expected[key, n, hit, len(ids), digest, hit > 0 and 20 * hit >= n] += 1
    assert got == expected


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame(AWKWARD, SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = decontamination.contamination(docs, items.limit(0)).collect()
    assert len(rows) == len(AWKWARD) and not any(r.contaminated or r.n_hit for r in rows)
    assert decontamination.contamination(docs.limit(0), items).count() == 0


def test_decontamination_runs_no_python(spark):
    docs = spark.createDataFrame(AWKWARD, SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    plan = decontamination.contamination(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def just_below() -> list[tuple]:
    """Many texts that share a passage: similar to few others, or to none by a little."""
    base = prose(7, 120)
    rows = [(k, edited(base, 4 + k % 9, k)) for k in range(120)]
    rows += [(1000 + k, f"{prose(k, 26)} {prose(99, 80)}") for k in range(60)]
    rows += [(2000 + k, f"{prose(k // 2, 26)} {prose(99, 80)} {k}") for k in range(40)]
    return rows


@pytest.mark.parametrize("features", [1 << 20, 2_000])
def test_large_groups_just_below_the_threshold(spark, monkeypatch, features):
    monkeypatch.setattr(jaccard_join, "COLD", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK_FEATURES", features)
    rows = just_below()
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = linked_components(rows)
    names = {key: expected[i][1] for i, (key, _) in enumerate(rows)}
    assert {r.doc_id: r.component_id for r in got} == names
    assert 20 < len(set(names.values())) < len(rows) - 20


def test_signatures_take_no_more_room_in_more_buckets(spark, monkeypatch):
    dealt, deal = [], jaccard_join._dealt
    monkeypatch.setattr(jaccard_join, "_dealt", lambda *a: dealt.append(deal(*a)) or dealt[-1])
    rows = [(k, prose(k, 200)) for k in range(60)]
    rows += [(100 + k, rows[k % 20][1]) for k in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for signatures in (2_000_000, 100):
        monkeypatch.setattr(jaccard_join, "BUCKET_SIGNATURES", signatures)
        jaccard_join.near_duplicates(df)
    packed = [[F.sum(F.length(c)) for c, kind in one.dtypes if kind == "binary"] for one in dealt]
    few, many = (sum(one.agg(*sums).first()) for one, sums in zip(dealt, packed, strict=True))
    assert many <= 1.1 * few
    # Copies in several tasks are dealt once.
    sets = {frozenset(shingle_sets([text])[0].tolist()) for _, text in rows}
    signs = PartEnum().of_sets([np.array(sorted(s), dtype=np.uint64) for s in sets])
    assert many <= 6.5 * sum(len(found) for one in signs for _, found, _ in one)


def test_hashing_many_texts_takes_little_memory(monkeypatch):
    monkeypatch.setattr(hashed, "_KNOWN", {})
    texts = [prose(k, 500) for k in range(1_500)]
    assert sum(map(len, texts)) > 4 << 20
    tracemalloc.start()
    for start, end in hashed.chunks(texts):
        shingle_sets(texts[start:end])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6, peak
