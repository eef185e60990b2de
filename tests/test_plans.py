"""The plans that matter at scale: exchanges, broadcasts, pushed columns and filters."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.catalog import base
from millrace.operators import samples, scores, templates
from millrace.operators.tokenizer import Tokenizer, build_vocab
from millrace.session import load

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin", plan(df)))


@pytest.fixture(scope="module")
def turns(spark):
    return base.turns(spark, SF)


@pytest.fixture(scope="module")
def tokenizer(spark):
    return Tokenizer(build_vocab(load(spark, SF, "documents", "text"), size=600))


def test_pretrain_samples_need_no_exchange(spark, tokenizer):
    docs = load(spark, SF, "documents")
    text = plan(samples.pretrain_samples(docs, tokenizer, "doc_id"))
    assert "Exchange" not in text and "Join" not in text and "Python" not in text
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", text)


def test_encode_and_decode_are_narrow(spark, tokenizer):
    docs = load(spark, SF, "documents")
    ids = docs.select(tokenizer.encode(F.col("text")).alias("ids"))
    text = plan(ids.select(tokenizer.decode(F.col("ids"))))
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("length", [340, 1024])
def test_chat_samples_shuffle_once_and_limit_before(spark, turns, tokenizer, length):
    df = samples.chat_samples(turns, tokenizer, templates.PLAIN, "conv_id", length=length)
    assert exchanges(df) == 1
    text = plan(df)
    # The rank filter runs once before and once after the exchange.
    assert text.count("WindowGroupLimit") == 2
    assert "Python" not in text


def test_rendering_shuffles_turns_once(spark, turns):
    assert exchanges(templates.render(turns, templates.PLAIN, "conv_id")) == 1
    # The reasoning style adds only the pre-aggregated facts.
    assert exchanges(templates.render(turns, templates.REASONING, "conv_id")) == 2


def test_routing_limits_before_the_exchange(spark):
    df = load(spark, SF, "embeddings").select(
        "vec_id", F.posexplode("embedding").alias("expert", "score")
    )
    routed = scores.route(df, ["vec_id"], 2)
    assert plan(routed).count("WindowGroupLimit") == 2 and exchanges(routed) == 1


def windows_over_all(text):
    """Windows that stand right above an exchange into a single partition."""
    lines = [line for line in text.splitlines() if "Sort" not in line and "InputAdapter" not in line]
    return [a for a, b in zip(lines, lines[1:]) if "SinglePartition" in b and "Window" in a]


def test_no_window_over_a_whole_table(spark):
    assert windows_over_all(plan(spark.range(9).select(F.row_number().over(Window.orderBy("id")))))
    queries = base_queries()
    for name in ("rank_candidates", "history_window", "render_chat", "turn_segments", "top_p",
                 "until_stop", "supervised_counts", "apply_updates", "masked_cross_entropy"):
        text = plan(queries[name](spark, SF))
        assert not windows_over_all(text), name
        assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text, name


def base_queries():
    from millrace.catalog import load_all

    return load_all().QUERIES


def test_filters_and_columns_reach_the_scan(spark):
    probs = scores.softmax(
        load(spark, SF, "events").where(F.col("value") > 100), ["event_type"], "value"
    )
    text = plan(probs.select("event_id", "prob"))
    assert "GreaterThan(value,100.0)" in text
    assert "props" not in text


def test_ranks_read_their_source_once(spark):
    ranked = scores.rank_candidates(load(spark, SF, "events"), ["event_type"], "value", "event_id")
    assert f"{SF}/events" not in plan(ranked)
    assert len(re.findall(r"FileScan parquet", plan(ranked))) == 2
