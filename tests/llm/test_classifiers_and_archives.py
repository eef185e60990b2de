"""Toxicity and quality on held-out rows, and archives on round trips."""

import base64
import gzip
import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality, toxicity, warc
from millrace.llm.linear import Rows, fit, predict
from millrace.session import load, scratch_folder
from tests.llm.helpers import AWKWARD, SCHEMA, clashing

SF = "/root/testdata/sf0.01"


def test_fit_separates_and_knows_constant_targets():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 20, 6)) for _ in range(300)]
    target = np.array([float(3 in row) for row in rows])
    x, none = Rows.of(rows), np.zeros((300, 0))
    assert ((predict(x, none, fit(x, none, target, 20)) > 0.5) == (target > 0.5)).all()
    assert predict(x, none, fit(x, none, np.zeros(300), 20)).max() < 0.01
    assert fit(Rows.of([]), np.zeros((0, 0)), np.zeros(0), 3).shape == (4,)


LABELS = "doc_id bigint, toxic int, n string"


def test_chain_finds_held_out_toxic_rows(spark):
    rng = random.Random(4)
    rows, flags = [], {}
    for k in range(600):
        lang, words = ("en", "de")[k % 2], [f"w{rng.randrange(400)}" for _ in range(5 + k % 200)]
        flags[k] = int(k % 5 == 0)
        if flags[k]:
            words.insert(rng.randrange(len(words)), ("nasty", "schlimm")[k % 2])
        rows.append((k, " ".join(words), lang))
    docs = spark.createDataFrame(rows, SCHEMA + ", lang string")
    labels = spark.createDataFrame(
        [(k, flags[k], "x") for k in range(400)] + [(None, 1, "x"), (3, None, "x"), (5, 0, "x")], LABELS
    )
    chain = toxicity.train(docs, labels)
    assert chain.categories[-1] == "toxic" and set(chain.categories) == {"toxic_en", "toxic_de", "toxic"}
    found = {r.doc_id: r for r in toxicity.score(docs, chain).collect()}
    assert {k: int(r.is_toxic) for k, r in found.items()} == flags
    assert found[0].probabilities["toxic_en"] > 0.5 > found[0].probabilities["toxic_de"]


def test_toxicity_of_awkward_rows_and_without_labels(spark):
    docs = clashing(spark.createDataFrame(AWKWARD, SCHEMA)).withColumn("lang", F.lit(None).cast("string"))
    docs = docs.withColumn("is_toxic", F.lit("old"))
    chain = toxicity.train(docs, spark.createDataFrame([], LABELS))
    rows = toxicity.score(docs, chain).collect()
    assert len(rows) == len(AWKWARD) and not any(r.is_toxic for r in rows)
    chain = toxicity.train(docs, spark.createDataFrame([(1, 1, "x"), (6, 0, "x")], LABELS))
    assert toxicity.score(docs, chain).count() == len(AWKWARD)
    assert toxicity.score(docs.limit(0), chain).count() == 0
    assert toxicity.train(docs.limit(0), spark.createDataFrame([(1, 1, "x")], LABELS)).categories == ["toxic"]


def test_label_model_finds_the_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(40_000) < 0.8
    m = len(quality.LABELLERS)
    votes = np.zeros((len(good), m), dtype=np.int64)
    for k in range(m):
        sides = quality.LABELLERS[k][2] is not None
        right = rng.random(len(good)) < 0.85
        vote = np.where(good == right, quality.GOOD, quality.POOR)
        one = np.where(~good & right, quality.POOR, quality.ABSTAIN)
        votes[:, k] = vote if sides else one
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, counts.astype(float))
    assert abs(model.good - 0.8) < 0.03
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.98
    assert quality.fit_label_model(np.zeros((0, m), np.int64), np.zeros(0)).good == 0.85


def test_quality_agrees_with_labels(spark):
    docs = load(spark, SF, "documents", "doc_id", "text")
    labels = load(spark, SF, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = quality.score(docs, quality.train(docs)).join(labels, "doc_id").collect()
    kept = [r.is_good for r in rows if r.label == 1]
    dropped = [not r.is_good for r in rows if r.label == 0]
    assert sum(kept) / len(kept) > 0.985 and sum(dropped) / len(dropped) > 0.9


def test_quality_of_awkward_rows(spark):
    docs = clashing(spark.createDataFrame(AWKWARD, SCHEMA))
    rows = quality.score(docs, quality.train(docs)).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.quality <= 1 for r in rows)
    assert [c for c in docs.columns if c != "is_good"] == [c for c in rows[0].asDict() if c in docs.columns and c != "is_good"]
    empty = docs.limit(0)
    assert quality.score(empty, quality.train(empty)).count() == 0


PAGES = "page_id bigint, url string, html string, n string"
ROWS = [
    (5, "http://a.example/", "same"), (3, "http://b.example/x y", "same"), (9, None, "same"), (4, "http://c/", None),
    (6, "http://c/", ""), (7, "http://d/", "line\r\n\r\nWARC/1.0\r\n\nURL 1 2 3\n" * 50), (8, "u", "日本語 🙂"),
    (None, "http://e/", "only once"), (None, "http://e/", "same"), (10, "http://f/", "z" * 30_000), (10, "http://f/", "z" * 30_000),
]


def through_archives(spark, pages, least=0):
    arcs, warcs = scratch_folder(spark), scratch_folder(spark)
    warc.write_arcs(pages.withColumn("fetched", F.timestamp_seconds(F.lit(1704067205))), arcs)
    files = warc.archive_files(spark, arcs)
    warc.convert(files, warc.decide(warc.captures(files), least), warcs)
    return warc.read_warcs(warc.archive_files(spark, warcs))


@pytest.mark.parametrize(("least", "size"), [(0, 1 << 24), (0, 900), (5, 900)])
def test_archives_round_trip(spark, monkeypatch, least, size):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", size)
    pages = spark.createDataFrame([(*row, "x") for row in ROWS], PAGES).repartition(2)
    rows = through_archives(spark, pages, least).collect()
    assert len(rows) == len(ROWS)
    by_id, groups = {r.record_id: r for r in rows}, defaultdict(list)
    for row in rows:
        groups[row.payload_digest].append(row)
    texts = defaultdict(list)
    for key, _, html in ROWS:
        texts[base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()].append((key, html or ""))
    for digest, own in groups.items():
        keys = [key for key, _ in texts[digest]]
        payload = texts[digest][0][1].encode()
        assert sorted((r.page_id for r in own), key=str) == sorted(keys, key=str)
        assert {r.payload_bytes for r in own} == {len(payload)}
        stored = [r for r in own if r.record_type == "response"]
        assert all(bytes(r.payload) == payload for r in stored)
        assert len(stored) == (1 if len(payload) >= least else len(own))
        for row in own:
            assert row.date == "2024-01-01T00:00:05Z"
            if row.record_type == "revisit":
                first = by_id[row.to_record]
                assert first.record_type == "response" and first.payload_digest == digest
                assert first.page_id == min(k for k in keys if k is not None)


def test_no_pages_no_records(spark):
    assert through_archives(spark, spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_of_either_version(version):
    head = warc.arc_head(version, "a.arc")
    body = b"HTTP/1.0 404 No\r\n\r\n\nhttp://x/ 0.0.0.0 20200101000000 text/html 3\nabc"
    record = warc.arc_record(version, "http://x/ y", "1.2.3.4", "20200102030405", "text/html", body, len(head), "a.arc")
    (found,) = warc.parse_arc(head + record + b"\n")
    assert found == (version, len(head), "http://x/%20y", "1.2.3.4", "20200102030405", "text/html", body)
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse_arc(head + record[:-10]))
    with pytest.raises(ValueError, match="header line"):
        list(warc.parse_arc(head + b"no header\n"))
    assert list(warc.parse_arc(b"")) == []
    assert gzip.decompress(gzip.compress(head)) == head


def test_equal_rows_stay_good(spark):
    """The scorer's sample is never empty, and equal rows are one of it."""
    good = "This is a plain and quiet sentence about the weather, as people write it in a letter. "
    docs = spark.range(60_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(good * 4).alias("text"))
    scorer = quality.train(docs)
    assert quality.score(docs, scorer).where("is_good").count() == 60_000


def test_the_labelled_sample_is_bounded(spark, monkeypatch):
    """Few labelled ids with many documents: no more rows are collected than the bound."""
    words = F.concat(F.lit("text "), F.col("id").cast("string"), F.when(F.col("id") % 2 == 0, " vile").otherwise(" kind"))
    docs = spark.range(3_000).select((F.col("id") % 2).alias("doc_id"), words.alias("text"), F.lit("en").alias("lang"))
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")
    seen = []
    whole = toxicity.fit_chain
    monkeypatch.setattr(toxicity, "fit_chain", lambda sample, names: seen.append(sample.count()) or whole(sample, names))
    chain = toxicity.train(docs.unionByName(docs), labels, rows=500)
    assert seen == [500]
    found = toxicity.score(docs, chain).groupBy("doc_id").agg(F.avg(F.col("is_toxic").cast("int")).alias("share"))
    assert {row["doc_id"]: row["share"] for row in found.collect()} == {0: 1.0, 1: 0.0}


def test_rare_languages_share_a_category(spark):
    rows = [(k, f"{'bad' if k % 2 else 'good'} words {k}", f"l{k % 11}") for k in range(220)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(220)], "doc_id long, toxic int")
    chain = toxicity.train(docs, labels)
    assert len(chain.categories) == toxicity.LANGUAGES + 2 and chain.categories[-1] == "toxic"
