"""Periodic runs, languages and collocations against brute force, SQL and held-out rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import pytest

from millrace.llm import collocations, language, periodic_runs
from millrace.session import load
from tests.llm.helpers import AWKWARD, SCHEMA, clashing
from tests.oracle import compare, oracle_connection

SF = "/root/testdata/sf0.001"


def brute_runs(words: list, least: int = 12) -> list[tuple]:
    """All runs, by comparing words a period apart."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda run: (run[0], run[2]))


def some_words(rng: random.Random) -> list[bytes]:
    n, kinds = rng.choice([0, 1, 5, 11, 12, 13, 30, 100, 300]), rng.choice([1, 2, 3, 20])
    words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.5:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_are_those_of_brute_force(monkeypatch):
    monkeypatch.setattr(periodic_runs, "TRIED", 500)
    rng = random.Random(11)
    for _ in range(150):
        texts = [some_words(rng) for _ in range(rng.randint(1, 6))]
        for words, runs in zip(texts, periodic_runs.find_runs(texts), strict=True):
            assert [tuple(run) for run in runs.tolist()] == brute_runs(words)
            dropped = {i for s, n, q in brute_runs(words) for i in range(s + q, s + n)}
            kept = [word for i, word in enumerate(words) if i not in dropped]
            assert periodic_runs.kept_words(words, runs) == kept


def brute_digest(doc_id, text) -> tuple:
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda run: (run[1], -run[0], -run[2])) if runs else (None,) * 3
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(word for i, word in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    digests = (hashlib.sha256(x).hexdigest() for x in (lines.encode(), kept))
    return (doc_id, len(runs), *best, milli, *digests)


def runs_of(spark, rows, tmp_path) -> list[tuple]:
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(row) for row in periodic_runs.op11_periodic_runs(spark, str(tmp_path)).collect()]


def test_digests_of_awkward_rows(spark, tmp_path):
    periodic = [(k, " ".join(f"w{(k * i) % (k % 7 + 1)}" for i in range(k))) for k in range(8, 120)]
    rows = AWKWARD + periodic + [(10_000, "a b c " * 700), (10_001, "\x1c \x85\xa0 ok" * 20)]
    found = runs_of(spark, rows, tmp_path)
    assert Counter(found) == Counter(brute_digest(*row) for row in rows)


def test_digests_of_the_table(spark):
    rows = load(spark, SF, "documents", "doc_id", "text").collect()
    found = periodic_runs.op11_periodic_runs(spark, SF).collect()
    short = [tuple(row) for row in rows if len((row[1] or "").split()) < 800]
    assert len(found) == len(rows) and len(short) > 100
    expected = {doc_id: brute_digest(doc_id, text) for doc_id, text in short}
    assert all(tuple(row) == expected[row["doc_id"]] for row in found if row["doc_id"] in expected)
    assert any(row["n_runs"] for row in found)


def test_runs_of_an_empty_table(spark, tmp_path):
    assert runs_of(spark, [], tmp_path) == []


# --- languages ------------------------------------------------------------------------------


def test_new_words_fall_back_to_shorter_grams():
    langs = ["a", "b"]
    known = language.Frequencies.of(langs, [("a", "stone", 5), ("b", "stein", 5)])
    tables = []
    for n in range(language.LONGEST, 0, -1):
        rows = [(lang, g, 5) for lang, word in (("a", "stone"), ("b", "stein")) for g in language.grams(word, n)]
        tables.append((n, language.Frequencies.of(langs, [(x, g, 5) for x, g in {(x, g) for x, g, _ in rows}])))
    model = language.Model(langs, known, tables)
    scorer = language.Scorer(model)
    assert scorer("Stone")[0] == "a" and scorer("STEIN!")[0] == "b"
    # "tone" has known five-letter ends; "xyo" only the single letter o; "qqq" nothing.
    assert scorer("tone")[0] == "a" and scorer("xyo")[0] == "a" and scorer("vein")[0] == "b"
    assert scorer("qqq") == ("a", 0.5)
    assert scorer("12 !?") == scorer(None) == scorer("") == (language.UNKNOWN, 0.0)


def test_held_out_documents(spark):
    rows = language.op12_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r for r in load(spark, "/root/testdata/sf0.01", "documents").collect()}
    assert len(rows) == len(truth)
    held = [row for row in rows if row["held_out"]]
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) for row in rows)
    right = sum(row["lang_pred"] == truth[row["doc_id"]]["lang"] for row in held)
    assert len(held) > 100 and right >= 0.98 * len(held)
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_learning_reads_no_held_out_row(spark):
    rows = [(k, f"wort{k} eins zwei", "de") if zlib.crc32(b"%d" % k) % 5 else (k, "held", "xx") for k in range(60)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de"] and "held" not in model.words.rows


def test_the_sample_is_bounded_and_fair(spark):
    rows = [(k, "one equal text", "en") for k in range(3000)]
    rows += [(k, f"text number w{k}x{k % 7}", "en") for k in range(3000, 3400)]
    rows += [(k, f"seltener satz y{k}", "de") for k in range(4000, 4030)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = language._sample(docs.select("lang", "text"), 40, 1 << 20).collect()
    assert len(few) == 40 and len(set(few)) == 40
    assert Counter(row["lang"] for row in few)["de"] >= 18
    small = language._sample(docs.select("lang", "text"), 40, 200).collect()
    assert small and sum(len(row["text"]) for row in small) <= 200


def test_languages_of_awkward_rows(spark):
    rows = [(i, t, None if i == 6 else "en") for i, t in AWKWARD] * 2
    docs = clashing(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    found = language.identify(docs, language.train(docs)).collect()
    assert Counter(row["doc_id"] for row in found) == Counter(i for i, _, _ in rows)
    assert all((row["lang_pred"] == "und") == (row["score"] == 0) for row in found)
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert language.identify(none, language.train(none)).count() == 0
    assert language.identify(docs, language.train(none)).first()["lang_pred"] == "und"


# --- collocations ---------------------------------------------------------------------------


def test_collocations_are_those_of_sql(spark):
    good, note = compare(spark, oracle_connection(SF), "op13_collocations", SF)
    assert good, note


def random_docs(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    fixed = ["in the long run of it", "as it was told", "new york city hall", "zz zz zz zz zz"]
    rows = []
    for k in range(300):
        words = []
        for _ in range(rng.randrange(60)):
            if rng.random() < 0.2:
                words.extend(rng.choice(fixed).split())
            words.append(rng.choice("the of a b c d e f g h i j k l".split()))
            if rng.random() < 0.05:
                words[-1] += rng.choice([".", ";\t", "\n", "?!", "\r"])
        rows.append((rng.choice(["en", "en", "de", None, ""]), " ".join(words)))
    return rows + [(None, None), ("fr", ""), ("en", " . \t,")] + rows[:20]


@pytest.mark.parametrize("kept,least,first,batch", [(20, 5, 5, 50), (5, 3, 1, 1_000_000), (4000, 30, 7, 10)])
def test_rounds_and_batches_change_nothing(spark, tmp_path, kept, least, first, batch):
    rows = random_docs(kept)
    docs = spark.createDataFrame(rows, "lang string, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = collocations.collocations(clashing(docs), kept=kept, least=least, first=first, batch=batch)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = collocations._SQL.replace("count(*) >= 30", f"count(*) >= {least}").replace("rank <= 2000", f"rank <= {kept}")
    expected = con.execute(sql).fetchall()
    assert len(expected) >= 20 or kept == 4000
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_no_frequent_phrases(spark):
    docs = spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(docs.limit(0)).count() == 0
    lone = spark.createDataFrame([("en", "a. " * 40)], "lang string, text string")
    assert collocations.collocations(lone).count() == 0


def test_wide_products_stay_exact(spark):
    big = 9_000_000_000_000_000
    row = spark.range(1).select(collocations._share(f"cast({big} as bigint)", f"cast({2 * big + 1} as bigint)"))
    assert row.first()[0] == 2_000_000 * big // (2 * big + 1)
