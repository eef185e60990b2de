import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import scores


def table(spark, *groups):
    rows = [(g, c, float(x)) for g, xs in enumerate(groups) for c, x in enumerate(xs)]
    return spark.createDataFrame(rows, "g int, candidate int, logit double")


def by_key(df, value):
    return {(r.g, r.candidate): r[value] for r in df.collect()}


def test_softmax_of_wide_ranges(spark):
    groups = [[1, 2, 3], [1000, 1000], [-5000, -5003], [0, -900, 700], [5, float("-inf")], [31.9, 32.1, 96.5]]
    for temperature in (1.0, 0.5):
        got = by_key(scores.softmax(table(spark, *groups), ["g"], temperature=temperature), "prob")
        for g, xs in enumerate(groups):
            top = max(xs)
            weights = [math.exp((x - top) / temperature) for x in xs]
            for c, w in enumerate(weights):
                assert got[(g, c)] == pytest.approx(w / sum(weights), abs=1e-12)


def test_top_p(spark):
    probs = table(spark, [0.2, 0.5, 0.3], [0.9, 0.1], [0.25] * 4).withColumnRenamed("logit", "prob")

    def kept(p):
        return {k: round(v, 6) for k, v in by_key(scores.top_p(probs, ["g"], p), "prob").items()}

    assert kept(0.6) == {
        (0, 1): 0.625, (0, 2): 0.375, (1, 0): 1.0,
        (2, 0): 0.333333, (2, 1): 0.333333, (2, 2): 0.333333,
    }
    assert kept(1e-9) == {(0, 1): 1.0, (1, 0): 1.0, (2, 0): 1.0}
    assert kept(-1.0) == kept(1e-9)
    assert len(kept(1.0)) == 9


def test_draws_follow_the_weights(spark):
    weights = [0.5, 0.3, 0.2, 0.0]
    n = 20_000
    probs = spark.range(n).select(
        F.col("id").alias("g"), F.posexplode(F.array(*[F.lit(w) for w in weights])).alias("candidate", "prob")
    )
    first = scores.draw(probs, ["g"], 7)
    counts = Counter(r.candidate for r in first.collect())
    assert sum(counts.values()) == n and counts[3] == 0
    for c, w in enumerate(weights[:3]):
        assert counts[c] / n == pytest.approx(w, abs=0.015)
    assert first.exceptAll(scores.draw(probs, ["g"], 7)).isEmpty()
    assert not first.exceptAll(scores.draw(probs, ["g"], 8)).isEmpty()


def test_routing_and_balance(spark):
    rows = [(0, 0, e, s) for e, s in enumerate([0.4, 0.3, 0.2, 0.1])]
    df = spark.createDataFrame(rows, "seq_id int, row int, expert int, score double")
    chosen = {r.expert: r.weight for r in scores.route(df, ["row"], 2).collect()}
    assert chosen == {0: pytest.approx(4 / 7), 1: pytest.approx(3 / 7)}
    assert scores.route(df, ["row"], 1).first().weight == 0.4

    rows = [(0, 0, 0, 0.8), (0, 0, 1, 0.2), (0, 1, 0, 0.6), (0, 1, 1, 0.4)]
    df = spark.createDataFrame(rows, "seq_id int, row int, expert int, score double")
    routes = scores.route(df, ["seq_id", "row"], 1)
    for form in (True, False):
        loss = scores.load_balance(routes, df, 2, 1, per_sequence=form).first().loss
        assert loss == pytest.approx(0.014)
    counts = scores.expert_counts(routes, 3).orderBy("expert").collect()
    assert [tuple(r) for r in counts] == [(0, 2, 2), (1, 0, 2), (2, 0, 2)]


def test_ties_prefer_the_lower_expert(spark):
    df = spark.createDataFrame([(0, e, 0.25) for e in range(4)], "row int, expert int, score double")
    assert {r.expert for r in scores.route(df, ["row"], 2).collect()} == {0, 1}


def test_combine(spark):
    routes = spark.createDataFrame([(0, 0, 0.25), (0, 1, 0.75), (1, 1, 1.0)], "row int, expert int, weight double")
    values = spark.createDataFrame([(0, 0, 8.0), (0, 1, 4.0), (1, 1, 2.0), (1, 0, 9.0)], "row int, expert int, value double")
    assert {r.row: r.combined for r in scores.combine(routes, values, ["row"]).collect()} == {0: 5.0, 1: 2.0}


def test_cross_entropy(spark):
    df = table(spark, *[[math.log(p) for p in ps] for ps in ([0.5, 0.5], [0.75, 0.25], [0.1, 0.9])])
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, -100)], "g int, label int")
    row = scores.cross_entropy(df, labels, ["g"]).first()
    assert row.n_rows == 2 and row.loss == pytest.approx(1.039721, abs=1e-6)
    none = scores.cross_entropy(df, labels.withColumn("label", F.lit(-100)), ["g"]).first()
    assert none.n_rows == 0 and math.isnan(none.loss)


def test_cross_entropy_on_random_scores(spark):
    rng = random.Random(4)
    groups = [[rng.uniform(-200, 200) for _ in range(9)] for _ in range(50)]
    targets = [rng.randrange(9) for _ in groups]
    labels = spark.createDataFrame(list(enumerate(targets)), "g int, label int")
    expected = sum(
        max(xs) + math.log(sum(math.exp(x - max(xs)) for x in xs)) - xs[t]
        for xs, t in zip(groups, targets)
    ) / len(groups)
    assert scores.cross_entropy(table(spark, *groups), labels, ["g"]).first().loss == pytest.approx(expected)


def test_finite_guard(spark):
    values = [1.0, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "loss double")
    row = scores.finite_report(df, "loss").first()
    assert (row.n_rows, row.n_bad) == (5, 3)
    assert scores.assert_finite(df.where("loss = 1 or loss is null"), "loss").count() == 2
    with pytest.raises(Exception, match="loss is not finite"):
        scores.assert_finite(df, "loss").collect()


def test_missing_targets_values_and_experts_fail(spark):
    table = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.5), (2, 0, 1.0), (2, 1, 0.0)], "g int, candidate int, logit double")
    labels = spark.createDataFrame([(1, 7), (2, 0)], "g int, label int")
    with pytest.raises(Exception, match="no score for 1, 7"):
        scores.cross_entropy(table, labels, ["g"]).collect()
    routes = spark.createDataFrame([(1, 0, 0.5), (1, 9, 0.5)], "g int, expert int, weight double")
    values = spark.createDataFrame([(1, 0, 2.0)], "g int, expert int, value double")
    with pytest.raises(Exception, match="no value for 1, 9"):
        scores.combine(routes, values, ["g"]).collect()
    with pytest.raises(Exception, match="no such expert: 9"):
        scores.expert_counts(routes, 4).collect()
