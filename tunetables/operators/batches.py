"""Batches of token rows: assignment, padding, audit and termination reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunetables.functions import tokens as K
from tunetables.operators.mixture import hash_index, ordered_index


def assign_batches(
    df: DataFrame, size: int, key: str, order: list[str | Column] | None = None, seed: int = 0
) -> DataFrame:
    """``batch_id`` of consecutive rows: in the shuffled order of a sampler
    (default) or in a stated total order, e.g. by length to cut padding."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    rows = hash_index(df, key, seed, "_i") if order is None else ordered_index(df, *order, name="_i")
    return rows.withColumn("batch_id", F.floor(F.col("_i") / size).cast("bigint")).drop("_i")


def pad_batch(
    df: DataFrame,
    fills: dict[str, int],
    length_of: str = "input_ids",
    multiple: int | None = None,
    batch: str = "batch_id",
) -> DataFrame:
    """Right-pad the listed arrays to the longest row of the batch. A window
    partition is one batch, so it holds as many rows as a batch has."""
    longest = F.max(F.size(length_of)).over(W.partitionBy(batch))
    df = df.withColumn("_to", K.round_up(longest, multiple))
    return df.withColumns({c: K.pad_to(F.col(c), F.col("_to"), v) for c, v in fills.items()}).drop("_to")


def sequence_fills(pad_id: int) -> dict[str, int]:
    return {"input_ids": pad_id, "labels": K.IGNORED, "attention_mask": 0}


def label_mask_batch_report(df: DataFrame, report: str, by: list[str]) -> DataFrame:
    """Sample and error counts over a set of rows (a batch, a source, or all)."""
    r = F.col(report)
    names = ("assistant_label_tokens", "prompt_label_leaks", "padding_label_leaks", "target_label_mismatches")
    return df.groupBy(*by).agg(
        F.count("*").alias("num_samples"),
        F.sum(F.size(r["errors"])).alias("num_errors"),
        F.count_if(r["truncated_assistant"]).alias("truncated_assistant"),
        *[F.sum(r[n]).alias(n) for n in names],
    )


def label_mask_errors(df: DataFrame, report: str, by: list[str]) -> DataFrame:
    """The flattened errors of a set of rows, as counted lines."""
    # the outer form: the inner one adds a filter on the array, which is pushed
    # below the projections and repeats the whole audit expression there
    lines = df.select(*by, F.explode_outer(F.col(report)["errors"]).alias("error")).where("error is not null")
    return lines.groupBy(*by, "error").agg(F.count("*").alias("rows"))


def termination_metrics(
    df: DataFrame, terminated: Column, ids: str, tool_mask: str | None = None, by: list[str] = ()
) -> DataFrame:
    """Clipped ratio, and length statistics over terminated rows (0 when none)."""
    if tool_mask is None:
        length = F.size(ids)
    else:
        length = F.aggregate(F.col(tool_mask), F.lit(0), lambda a, x: a + x)
    done = F.when(terminated, length.cast("double"))
    rate = F.avg(F.when(terminated, 0.0).otherwise(1.0))
    return df.groupBy(*by).agg(
        rate.alias("clipped_ratio"),
        F.coalesce(F.avg(done), F.lit(0.0)).alias("mean_terminated_length"),
        F.coalesce(F.min(done), F.lit(0.0)).alias("min_terminated_length"),
        F.coalesce(F.max(done), F.lit(0.0)).alias("max_terminated_length"),
    )
