"""Training samples: fixed-length ids with labels, and what of them is supervised."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.labels import (
    IGNORE,
    answer_labels,
    fit_length,
    mask_value,
    next_pairs,
)
from millrace.operators.templates import ANSWER_START, TURN_END, ChatStyle, render
from millrace.operators.tokenizer import PAD, Tokenizer

MAX_LENGTH = 340


def pretrain_samples(
    texts: DataFrame,
    tokenizer: Tokenizer,
    key: str,
    length: int = MAX_LENGTH,
    column: str = "text",
    pad: str = PAD,
    hidden: str = PAD,
    ignore: int = IGNORE,
) -> DataFrame:
    """(key, input_ids, labels, n_real) per text, without any exchange.

    ``pad`` fills up the ids and ``hidden`` is masked in the labels, wherever it stands.
    """
    if pad != hidden:
        warnings.warn(f"padding {pad!r} stays in the labels, {hidden!r} is masked", stacklevel=2)
    pad_id, hidden_id = tokenizer.ids_of(pad)[0], tokenizer.ids_of(hidden)[0]
    encoded = texts.select(key, tokenizer.encode(F.col(column), length).alias("_ids"))
    padded = encoded.select(
        key,
        fit_length(F.col("_ids"), length, pad_id).alias("input_ids"),
        F.size("_ids").alias("n_real"),
    )
    return padded.select(
        key,
        "input_ids",
        mask_value(F.col("input_ids"), hidden_id, ignore).alias("labels"),
        "n_real",
    )


def chat_samples(
    turns: DataFrame,
    tokenizer: Tokenizer,
    style: ChatStyle,
    *keys: str,
    length: int = MAX_LENGTH,
    **options,
) -> DataFrame:
    """Samples from a flat table of turns; one exchange by conversation."""
    texts = render(turns, style, *keys, tokens=length)
    return label_chats(texts, tokenizer, *keys, length=length, **options)


def label_chats(
    texts: DataFrame,
    tokenizer: Tokenizer,
    *keys: str,
    length: int = MAX_LENGTH,
    pad: str = PAD,
    ignore: int = IGNORE,
    markers_only: bool = False,
) -> DataFrame:
    """(keys, input_ids, labels, n_real) per rendered conversation, without any exchange.

    The text is cut after ``length`` ids, so late turns are lost, not early ones.
    """
    start, end = tokenizer.ids_of(ANSWER_START), tokenizer.ids_of(TURN_END)
    pad_id = tokenizer.ids_of(pad)[0]
    encoded = texts.select(*keys, tokenizer.encode(F.col("text"), length).alias("_ids"))
    padded = encoded.select(
        *keys,
        fit_length(F.col("_ids"), length, pad_id).alias("input_ids"),
        F.size("_ids").alias("n_real"),
    )
    labels = answer_labels(F.col("input_ids"), start, end, length, ignore, markers_only)
    return padded.select(*keys, "input_ids", labels.alias("labels"), "n_real")


def supervision(samples: DataFrame, *keys: str, ignore: int = IGNORE) -> DataFrame:
    """(keys, n_tokens, n_supervised, share): tokens that count for the loss.

    Labels are read one position ahead, so the first one never counts. ``keys`` may be a
    sample or a batch.
    """
    shifted = F.slice(F.col("labels"), F.lit(2), F.greatest(F.size("labels") - 1, F.lit(0)))
    counted = F.size(F.filter(shifted, lambda x: x != ignore))
    sums = samples.groupBy(*keys).agg(
        F.sum(F.greatest(F.size("labels") - 1, F.lit(0))).alias("n_tokens"),
        F.sum(counted).alias("n_supervised"),
    )
    return sums.withColumn("share", F.try_divide(F.col("n_supervised"), F.col("n_tokens")))


def next_token_pairs(samples: DataFrame, *keys: str) -> DataFrame:
    """(keys, pos, input_id, target_id): what each position is trained to predict."""
    pairs = next_pairs(F.col("input_ids"), F.col("labels"))
    return samples.select(*keys, F.posexplode(pairs).alias("pos", "_p")).select(
        *keys,
        "pos",
        F.col("_p.input").alias("input_id"),
        F.col("_p.target").alias("target_id"),
    )
