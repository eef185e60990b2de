"""From raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, jaccard_join, packing, quality, toxicity
from millrace.llm.base import tokenizer_file
from millrace.session import load, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: What stages read of a document; any other column only travels along.
READ = ("doc_id", "text", "lang")


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with numbered names for the columns no stage reads, so that none can clash."""
    names = [c if c in READ else f"_column{k}" for k, c in enumerate(docs.columns)]
    return docs.toDF(*names)


def _back(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.select(*_apart(docs).columns).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a chain fitted on the labelled ones does not find toxic.

    Rows are judged one by one: repeated rows stay or go together, null and empty texts are
    judged by the bias alone. Columns of any names come out as they were.
    """
    own = _apart(docs)
    chain = toxicity.train(own, load(spark, sf_dir, "labels", "doc_id", "toxic"))
    return _back(toxicity.score(own, chain).where("NOT is_toxic"), docs)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality under weak labels of the documents themselves.

    Repeated rows stay or go together; null and empty texts stay if most documents are good.
    Columns of any names come out as they were.
    """
    own = _apart(docs)
    return _back(quality.score(own, quality.train(own)).where("is_good"), docs)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Documents without words are no duplicates and all stay. Rows of a group that share its
    smallest id are one document if their texts are equal too, else the one with the
    smallest text hash stays. Groups are what links connect: null or equal ids alone do not
    put documents into one group. Columns of any names come out as they were.
    """
    own = _apart(docs)
    found = jaccard_join.near_duplicates(own)
    wordless = found.where("n_shingles = 0").select("doc_id", "text_hash").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    heads = found.where("n_shingles > 0").groupBy("component").agg(first.alias("head"))
    stay = heads.select("head.doc_id", "head.text_hash").unionByName(wordless)
    stay = written(stay.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))
    hashed = own.withColumn("_own", F.xxhash64("text"))
    kept = hashed.join(stay, (F.col("_own") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    # Repeated rows of one document are a single one here; they need not be compared in full.
    return _back(kept.dropDuplicates(["doc_id", "_own"]), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages.

    Rows with equal ids and texts stay or go together; null and empty texts have no words and
    stay. Columns of any names come out as they were.
    """
    own = _apart(docs)
    items = load(spark, sf_dir, "benchmark", "item_id", "text")
    bad = decontamination.contamination(own, items).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = (F.xxhash64("text") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return _back(own.join(bad, same, "left_anti"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of at most 4096 tokens: a row for each piece.

    A null text is one end token, repeated rows are packed each; other columns are not read.
    """
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_group),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Tokenizers and fitted models are no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
