"""The pipeline's stages on a small corpus, against brute force, and the queries with SQL."""

import importlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import catalog
from millrace.llm.base import tokenizer_file
from millrace.llm.encoding import load_tokenizer
from millrace.session import load
from tests.llm.helpers import AWKWARD, SCHEMA, hit_words, linked_components, prose
from tests.oracle import compare, oracle_connection

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = load(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "decontamination", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    for name in names[:2]:
        kept = stages[name](spark, docs, SF)
        assert kept.columns == docs.columns
        assert 0 < kept.count() < docs.count()
        assert kept.exceptAll(docs).count() == 0


def test_stages_take_columns_of_any_name(spark):
    taken = ("_id", "_hash", "_own", "is_good", "quality", "p_toxic", "is_toxic", "probabilities", "hash", "n", "h")
    docs = load(spark, SF, "documents").where("doc_id < 120").withColumns({c: F.lit("mine") for c in taken})
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes, name
        assert 0 < kept.count() and kept.exceptAll(docs).count() == 0, name


def test_one_document_of_each_group_stays(spark):
    docs = load(spark, SF, "documents")
    # Repeated rows, and texts without words.
    more = docs.limit(3).unionByName(docs.limit(2).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 9000))
    rows = [(r.doc_id, r.text) for r in docs.unionByName(more).collect()]
    kept = corpus_pipeline.keep_one_of_group(spark, docs.unionByName(more), SF)
    expected = linked_components(rows)
    heads = {expected[i][1] for i in expected if expected[i][0]}
    empty = {key for i, (key, _) in enumerate(rows) if not expected[i][0]}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(heads | empty)
    assert kept.columns == docs.columns


def test_groups_with_null_or_equal_ids_are_kept_apart(spark):
    near = lambda text, word: text.replace(text.split()[0], word, 1)
    a, b, c = prose(5, 200), prose(8, 90), prose(11, 120)
    # Two groups under one id, each with a near copy of a larger id; groups of null ids only.
    groups = [[(1, a), (20, near(a, "other"))], [(1, b), (21, near(b, "other"))]]
    groups += [[(None, c), (None, c)], [(None, "no id either")], [(None, "and one more without an id"), (30, "and one more without an id")]]
    rows = AWKWARD + [row for group in groups for row in group]
    expected = set(AWKWARD) | {(1, a), (1, b), (None, c), (None, "no id either"), (30, "and one more without an id")}
    kept = corpus_pipeline.keep_one_of_group(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), SF)
    got = [tuple(r) for r in kept.collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_contaminated_documents_go(spark):
    docs, items = load(spark, SF, "documents"), load(spark, SF, "benchmark")
    known = [(r.item_id, r.text) for r in items.collect()]
    expected = set()
    for row in docs.collect():
        n, hit, _ = hit_words(row.text, known)
        if not (hit and 20 * hit >= n):
            expected.add(row.doc_id)
    kept = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} == expected and len(expected) < docs.count()


def test_packing_covers_every_token(spark):
    docs = load(spark, SF, "documents").where("doc_id < 60")
    library = load_tokenizer(tokenizer_file("word_bpe_49k.json"))
    totals = {}
    for row in corpus_pipeline.pack(spark, docs, SF).collect():
        totals[row.doc_id] = totals.get(row.doc_id, 0) + row.length
    assert totals == {
        r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect()
    }


def test_run_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        load(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_against_sql(spark, name):
    good, note = compare(spark, oracle_connection(SF), name, SF)
    assert good, note


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES)
    assert numbers == list(range(1, 14))
    assert importlib.import_module("__spark_entry__").queries()["pipeline"] is corpus_pipeline.run
