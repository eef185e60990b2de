"""Analytics over score tables: softmax, top-p, draws, top-k routing, balance, loss.

A score table is long: one row per (group, candidate) with a logit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.labels import IGNORE
from millrace.plans.positions import hash_order
from millrace.plans.skew import rank_with_sums

# Exponents are summed in bins this wide, far inside the range of a double.
_BIN = 64.0
# Fixed value: keeps the weight sum off zero.
_TINY = 1e-20
_DRAW_DIGITS = 12


def log_sum_exp(scores: DataFrame, keys: list[str], x: Column, name: str = "lse") -> DataFrame:
    """log(sum(exp(x))) per group in one pass, combined before the exchange.

    Instead of finding the group's maximum first, terms are summed per bin of ``x``, scaled
    by the bin; the few bins of a group are then put together under the largest one.
    """
    binned = (
        scores.select(*keys, x.cast("double").alias("_x"))
        .where(F.col("_x") > float("-inf"))
        .withColumn("_bin", F.rint(F.col("_x") / _BIN))
        .groupBy(*keys, "_bin")
        .agg(F.sum(F.exp(F.col("_x") - F.col("_bin") * _BIN)).alias("_sum"))
    )
    top = F.max("_bin").over(Window.partitionBy(*keys))
    return (
        binned.withColumn("_top", top)
        .groupBy(*keys)
        .agg(
            (
                F.first("_top") * _BIN
                + F.ln(F.sum(F.col("_sum") * F.exp((F.col("_bin") - F.col("_top")) * _BIN)))
            ).alias(name)
        )
    )


def softmax(
    scores: DataFrame, keys: list[str], logit: str = "logit", temperature: float = 1.0
) -> DataFrame:
    """Add ``prob``, the softmax of logit / temperature inside each group.

    The outer join drops out of plans that do not read ``prob``, such as group counts.
    """
    x = F.col(logit) if temperature == 1.0 else F.col(logit) / temperature
    return (
        scores.join(log_sum_exp(scores, keys, x), keys, "left")
        .withColumn("prob", F.exp(x - F.col("lse")))
        .drop("lse")
    )


def rank_candidates(
    scores: DataFrame, keys: list[str], logit: str = "logit", candidate: str = "candidate"
) -> DataFrame:
    """Add ``rank``, one for the best; equal scores rank the lower candidate first.

    Null scores come last, whatever the size of their group.
    """
    return rank_with_sums(scores, keys, logit, candidate)


def top_p(probs: DataFrame, keys: list[str], p: float, candidate: str = "candidate") -> DataFrame:
    """Keep candidates while the mass before them is at most ``p``; renormalise the rest.

    The best one always stays, and ``p`` of one or more keeps everything.
    """
    if p >= 1.0:
        return probs
    ranked = rank_with_sums(probs, keys, "prob", candidate, {"_mass_before": "prob"})
    kept = ranked.where((F.col("_mass_before") <= p) | (F.col("rank") == 1))
    kept = kept.join(kept.groupBy(*keys).agg(F.sum("prob").alias("_mass")), keys)
    return kept.withColumn("prob", F.col("prob") / F.col("_mass")).drop(
        "_mass", "_mass_before", "rank"
    )


def uniform(seed: int, *parts: Column) -> Column:
    """A reproducible number in (0, 1) from an MD5 of the seed and the parts."""
    digits = F.substring(hash_order(F.lit(seed), *parts), 1, _DRAW_DIGITS)
    whole = F.conv(digits, 16, 10).cast("double")
    return (whole + 0.5) / float(16**_DRAW_DIGITS)


def draw(
    probs: DataFrame, keys: list[str], seed: int, candidate: str = "candidate"
) -> DataFrame:
    """One weighted draw per group: the candidate with the earliest exponential arrival.

    An arrival is -ln(u) / prob, and the first one falls on a candidate with its
    probability. That is a plain minimum, combined before the exchange.
    """
    u = uniform(seed, *[F.col(k) for k in keys], F.col(candidate))
    arrivals = probs.where(F.col("prob") > 0).select(
        *keys, F.struct((-F.ln(u) / F.col("prob")).alias("at"), F.col(candidate).alias("c")).alias("_a")
    )
    return arrivals.groupBy(*keys).agg(F.min("_a")["c"].alias(candidate))


def route(
    scores: DataFrame, keys: list[str], k: int, score: str = "score", expert: str = "expert"
) -> DataFrame:
    """The ``k`` best experts per row with weights; for more than one they sum to one.

    The rank filter also runs before the exchange, so a row sends at most ``k`` candidates
    per task.
    """
    best = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(expert))
    chosen = scores.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= k)
    weight = F.col(score)
    if k > 1:
        weight = weight / (F.sum(score).over(Window.partitionBy(*keys)) + _TINY)
    return chosen.withColumn("weight", weight).drop("_nth", score)


def load_balance(
    routes: DataFrame,
    scores: DataFrame,
    experts: int,
    k: int,
    seq: str = "seq_id",
    alpha: float = 0.01,
    per_sequence: bool = True,
) -> DataFrame:
    """(loss): how unevenly rows are routed, weighted by the mean scores.

    ``scores`` holds every expert of every row, so its counts are the sequence lengths.
    """
    keys = [seq] if per_sequence else []
    chosen = routes.groupBy(*keys, "expert").agg(F.count(F.lit(1)).alias("_n"))
    means = scores.groupBy(*keys, "expert").agg(
        F.avg("score").alias("_mean"), F.count(F.lit(1)).alias("_len")
    )
    share = F.coalesce("_n", F.lit(0)) * float(experts) / (F.col("_len") * k)
    terms = means.join(chosen, [*keys, "expert"], "left").withColumn("_t", share * F.col("_mean"))
    if per_sequence:
        terms = terms.groupBy(seq).agg(F.sum("_t").alias("_t"))
        return terms.agg((F.avg("_t") * alpha).alias("loss"))
    return terms.agg((F.sum("_t") * alpha).alias("loss"))


def expert_counts(routes: DataFrame, experts: int) -> DataFrame:
    """(expert, n_rows, end_offset) for every expert; only the ``experts`` rows are ordered.

    An expert outside the range fails.
    """
    spark = routes.sparkSession
    inside = F.col("expert").between(0, experts - 1)
    wrong = F.concat(F.lit("no such expert: "), F.col("expert").cast("string"))
    checked = F.when(inside, F.col("expert")).otherwise(F.raise_error(wrong).cast("int"))
    counts = routes.select(checked.alias("expert")).groupBy("expert").agg(F.count(F.lit(1)).alias("n_rows"))
    every = spark.range(experts).select(F.col("id").cast("int").alias("expert"))
    filled = every.join(counts, "expert", "left").select(
        "expert", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )
    up_to = Window.orderBy("expert").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return filled.withColumn("end_offset", F.sum("n_rows").over(up_to))


def _found(value: Column, what: str, *key: Column) -> Column:
    """``value``, or a failure that names the row for which there is none."""
    named = F.concat_ws(", ", *[part.cast("string") for part in key])
    message = F.concat(F.lit(f"no {what} for "), named)
    return F.when(value.isNull(), F.raise_error(message).cast("double")).otherwise(value)


def combine(
    routes: DataFrame, values: DataFrame, keys: list[str], value: str = "value"
) -> DataFrame:
    """Per row the weighted sum over its experts' values; a missing value fails."""
    joined = routes.join(values, [*keys, "expert"], "left")
    own = _found(F.col(value).cast("double"), "value", *[F.col(k) for k in [*keys, "expert"]])
    return joined.groupBy(*keys).agg(F.sum(F.col("weight") * own).alias("combined"))


def cross_entropy(
    scores: DataFrame,
    labels: DataFrame,
    keys: list[str],
    logit: str = "logit",
    candidate: str = "candidate",
    ignore: int = IGNORE,
) -> DataFrame:
    """(n_rows, loss): mean of -log softmax(target), rows labelled ``ignore`` left out.

    A target that is no candidate fails. With every row ignored the loss is NaN.
    """
    counted = labels.where(F.col("label") != ignore).select(*keys, F.col("label").alias(candidate))
    # Ignored groups leave before anything is summed.
    wanted = scores.join(counted.select(*keys), keys, "left_semi")
    target = scores.select(*keys, candidate, F.col(logit).cast("double").alias("_target"))
    named = [F.col(k) for k in [*keys, candidate]]
    losses = (
        counted.join(target, [*keys, candidate], "left")
        .join(log_sum_exp(wanted, keys, F.col(logit)), keys, "left")
        .select((F.col("lse") - _found(F.col("_target"), "score", *named)).alias("_loss"))
    )
    return losses.agg(
        F.count("_loss").alias("n_rows"),
        F.coalesce(F.avg("_loss"), F.lit(float("nan"))).alias("loss"),
    )


def not_finite(value: Column) -> Column:
    return F.isnan(value) | (F.abs(value) == float("inf"))


def finite_report(df: DataFrame, column: str) -> DataFrame:
    bad = not_finite(F.col(column).cast("double"))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).alias("n_bad"),
    )


def assert_finite(df: DataFrame, column: str) -> DataFrame:
    """Fail the job at the first NaN or infinite value that it reaches."""
    message = F.concat(F.lit(f"{column} is not finite: "), F.col(column).cast("string"))
    kind = df.schema[column].dataType
    return df.withColumn(
        column,
        F.when(not_finite(F.col(column)), F.raise_error(message).cast(kind)).otherwise(
            F.col(column)
        ),
    )
