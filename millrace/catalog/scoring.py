"""Score-table analytics on embedding elements (candidates of a vector) and event values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.base import query
from millrace.operators import scores
from millrace.session import load

# Every element of a vector is a candidate expert; tables hold vectors of one length.
TEMPERATURE, P, SEED, EXPERTS, K = 0.1, 0.6, 2026, 64, 2

_SCORES = """
scores AS (
  SELECT vec_id, label, (generate_subscripts(embedding, 1) - 1)::INT AS candidate,
         unnest(embedding)::DOUBLE AS logit FROM embeddings)"""
_PROBS = f"""{_SCORES},
weights AS (
  SELECT *, exp((logit - max(logit) OVER (PARTITION BY vec_id)) / {TEMPERATURE}) AS w FROM scores),
probs AS (SELECT *, w / sum(w) OVER (PARTITION BY vec_id) AS prob FROM weights)"""
_KEPT = f"""{_PROBS},
running AS (
  SELECT *, coalesce(sum(prob) OVER (PARTITION BY vec_id ORDER BY prob DESC, candidate
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM probs),
kept AS (
  SELECT vec_id, candidate, prob / sum(prob) OVER (PARTITION BY vec_id) AS prob
  FROM running WHERE before <= {P})"""
_ROUTES = f"""{_SCORES},
router AS (
  SELECT vec_id, label, candidate AS expert,
    exp(logit) / sum(exp(logit)) OVER (PARTITION BY vec_id) AS score
  FROM scores),
best AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, expert) AS nth FROM router),
routes AS (
  SELECT vec_id, label, expert, score / (sum(score) OVER (PARTITION BY vec_id) + 1e-20) AS weight
  FROM best WHERE nth <= {K})"""


def score_table(spark: SparkSession, folder: str) -> DataFrame:
    table = load(spark, folder, "embeddings")
    return table.select("vec_id", "label", F.posexplode("embedding").alias("candidate", "_x")).select(
        "vec_id", "label", "candidate", F.col("_x").cast("double").alias("logit")
    )


def _probs(spark: SparkSession, folder: str) -> DataFrame:
    return scores.softmax(score_table(spark, folder), ["vec_id"], "logit", TEMPERATURE)


def router_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Softmax over all elements, one per expert."""
    return scores.softmax(score_table(spark, folder), ["vec_id"]).select(
        "vec_id", "label", F.col("candidate").alias("expert"), F.col("prob").alias("score")
    )


def routes(spark: SparkSession, folder: str) -> DataFrame:
    return scores.route(router_scores(spark, folder), ["vec_id"], K)


@query(
    "softmax_temperature",
    f"WITH {_PROBS} SELECT vec_id, candidate, round(prob, 6) AS prob FROM probs",
)
def softmax_temperature(spark: SparkSession, folder: str) -> DataFrame:
    return _probs(spark, folder).select("vec_id", "candidate", F.round("prob", 6).alias("prob"))


@query(
    "rank_candidates",
    """SELECT event_type, event_id, row_number() OVER (
         PARTITION BY event_type ORDER BY value DESC, event_id) AS rank FROM events""",
)
def rank_candidates(spark: SparkSession, folder: str) -> DataFrame:
    table = load(spark, folder, "events", "event_type", "event_id", "value")
    ranked = scores.rank_candidates(table, ["event_type"], "value", "event_id")
    return ranked.select("event_type", "event_id", "rank")


@query("top_p", f"WITH {_KEPT} SELECT vec_id, candidate, round(prob, 6) AS prob FROM kept")
def top_p(spark: SparkSession, folder: str) -> DataFrame:
    kept = scores.top_p(_probs(spark, folder), ["vec_id"], P)
    return kept.select("vec_id", "candidate", F.round("prob", 6).alias("prob"))


@query(
    "sample_one",
    f"""WITH {_KEPT}, arrivals AS (
          SELECT vec_id, candidate, -ln((('0x' || substr(md5(
            '{SEED}:' || vec_id || ':' || candidate), 1, 12))::BIGINT + 0.5) / 281474976710656.0)
            / prob AS at_time FROM kept)
        SELECT vec_id, arg_min(candidate, at_time) AS candidate FROM arrivals GROUP BY vec_id""",
)
def sample_one(spark: SparkSession, folder: str) -> DataFrame:
    kept = scores.top_p(_probs(spark, folder), ["vec_id"], P)
    return scores.draw(kept, ["vec_id"], SEED)


@query(
    "topk_route",
    f"WITH {_ROUTES} SELECT vec_id, expert, round(weight, 6) AS weight FROM routes",
)
def topk_route(spark: SparkSession, folder: str) -> DataFrame:
    return routes(spark, folder).select("vec_id", "expert", F.round("weight", 6).alias("weight"))


@query(
    "load_balance",
    f"""WITH {_ROUTES},
        chosen AS (SELECT label, expert, count(*) AS n FROM routes GROUP BY label, expert),
        means AS (SELECT label, expert, avg(score) AS mean, count(*) AS len FROM router
                  GROUP BY label, expert),
        per_seq AS (
          SELECT means.label, sum(coalesce(n, 0) * {EXPERTS}.0 / (len * {K}) * mean) AS t
          FROM means LEFT JOIN chosen ON means.label = chosen.label AND means.expert = chosen.expert
          GROUP BY means.label),
        chosen_all AS (SELECT expert, count(*) AS n FROM routes GROUP BY expert),
        means_all AS (SELECT expert, avg(score) AS mean, count(*) AS len FROM router GROUP BY expert)
        SELECT 'sequence' AS form, round(0.01 * avg(t), 9) AS loss FROM per_seq
        UNION ALL
        SELECT 'global', round(0.01 * sum(coalesce(n, 0) * {EXPERTS}.0 / (len * {K}) * mean), 9)
        FROM means_all LEFT JOIN chosen_all ON means_all.expert = chosen_all.expert""",
)
def load_balance(spark: SparkSession, folder: str) -> DataFrame:
    table = router_scores(spark, folder)
    chosen = scores.route(table, ["vec_id"], K)

    def loss(form: str, per_sequence: bool) -> DataFrame:
        result = scores.load_balance(
            chosen, table, EXPERTS, K, "label", per_sequence=per_sequence
        )
        return result.select(F.lit(form).alias("form"), F.round("loss", 9).alias("loss"))

    return loss("sequence", True).unionByName(loss("global", False))


@query(
    "expert_counts",
    f"""WITH {_ROUTES}, counts AS (
          SELECT e.expert, count(routes.expert) AS n_rows
          FROM (SELECT unnest(range({EXPERTS}))::INT AS expert) e LEFT JOIN routes USING (expert)
          GROUP BY e.expert)
        SELECT expert, n_rows, (sum(n_rows) OVER (ORDER BY expert))::BIGINT AS end_offset
        FROM counts""",
)
def expert_counts(spark: SparkSession, folder: str) -> DataFrame:
    return scores.expert_counts(routes(spark, folder), EXPERTS)


@query(
    "weighted_combine",
    f"""WITH {_ROUTES}
        SELECT routes.vec_id, round(sum(weight * logit), 6) AS combined
        FROM routes JOIN scores
          ON routes.vec_id = scores.vec_id AND scores.candidate = {EXPERTS} - 1 - routes.expert
        GROUP BY routes.vec_id""",
)
def weighted_combine(spark: SparkSession, folder: str) -> DataFrame:
    """The values are the vector's elements from the last one backwards."""
    values = score_table(spark, folder).select(
        "vec_id",
        (EXPERTS - 1 - F.col("candidate")).alias("expert"),
        F.col("logit").alias("value"),
    )
    combined = scores.combine(routes(spark, folder), values, ["vec_id"])
    return combined.select("vec_id", F.round("combined", 6).alias("combined"))


@query(
    "masked_cross_entropy",
    f"""WITH {_SCORES},
        losses AS (
          SELECT vec_id, ln(sum(exp(logit))) - sum(CASE WHEN candidate = label THEN logit END) AS loss
          FROM scores WHERE label <> 0 GROUP BY vec_id)
        SELECT count(*) AS n_rows, round(avg(loss), 6) AS loss FROM losses""",
)
def masked_cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    table = score_table(spark, folder)
    masked = F.when(F.col("label") == 0, F.lit(scores.IGNORE)).otherwise(F.col("label"))
    labels = load(spark, folder, "embeddings").select("vec_id", masked.alias("label"))
    loss = scores.cross_entropy(table.drop("label"), labels, ["vec_id"])
    return loss.select("n_rows", F.round("loss", 6).alias("loss"))


@query(
    "finite_guard",
    """SELECT count(*) AS n_rows, count(*) FILTER (event_type IN ('error', 'view')) AS n_bad
       FROM events""",
)
def finite_guard(spark: SparkSession, folder: str) -> DataFrame:
    value = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("event_type") == "view", F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    losses = load(spark, folder, "events").select(value.alias("loss"))
    return scores.finite_report(losses, "loss")


@query("finite_values", "SELECT event_id, value FROM events")
def finite_values(spark: SparkSession, folder: str) -> DataFrame:
    return scores.assert_finite(load(spark, folder, "events", "event_id", "value"), "value")
