"""Multi-turn conversations in long form (one row per turn).

A conversation may be of any length. What fits a limit is its leading turns, and
each turn adds something, so the limit itself bounds how many can count: a ranked
filter keeps those, which Spark applies on both sides of the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed value: generation recorded when the prompt no longer fits.
OVERLONG = "MODEL_MAX_LENGTH_EXCEEDED"


def running_total(
    df: DataFrame, key: str, position: str, value: Column, name: str, span: int = 4096, buckets: int = 64
) -> DataFrame:
    """Sum of ``value`` over the rows of a key up to and including this one.

    Rows with the same position are ordered by a hash of the row. Positions are
    cut into spans and repeated positions into hash buckets; sums of these cells
    are added first, so no window holds more than one cell's rows or one span's
    cells, and the join is on the cell, never on the key alone.
    """
    rows = df.withColumn("_v", value).withColumn("_h", F.xxhash64(*df.columns))
    rows = rows.withColumn("_b", F.pmod("_h", F.lit(buckets))).withColumn("_span", F.floor(F.col(position) / span))
    cell = [key, "_span", position, "_b"]
    cells = rows.groupBy(*cell).agg(F.sum("_v").alias("_sum"))
    sums = cells.groupBy(key, "_span").agg(F.sum("_sum").alias("_sum"))
    none = F.lit(0)
    earlier = W.partitionBy(key).orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    spans = sums.select(key, "_span", F.coalesce(F.sum("_sum").over(earlier), none).alias("_far"))
    inside = W.partitionBy(key, "_span").orderBy(position, "_b").rowsBetween(W.unboundedPreceding, -1)
    near = cells.select(*cell, F.coalesce(F.sum("_sum").over(inside), none).alias("_near")).join(spans, [key, "_span"])
    own = W.partitionBy(*cell).orderBy("_h").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_own", F.sum("_v").over(own)).join(near, cell)
    return rows.withColumn(name, F.col("_far") + F.col("_near") + F.col("_own")).select(*df.columns, name)


def leading_turns(
    turns: DataFrame, key: str, order: list[str], length: Column, max_length: int, least: int = 1, name: str = "start", more: int = 0
) -> DataFrame:
    """The turns of each key that start below ``max_length``, with the length
    before them in ``name``. ``least`` is what the shortest turn adds: no more than
    ``max_length / least`` turns of a key are looked at. ``more`` turns beyond the
    limit come along."""
    at = W.partitionBy(key).orderBy(*order)
    rows = turns.withColumn("_at", F.row_number().over(at)).where(F.col("_at") <= -(-max_length // least) + more).drop("_at")
    rows = rows.withColumn(name, F.coalesce(F.sum(length).over(at.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return rows if more else rows.where(F.col(name) < max_length)


def replay_turns(
    turns: DataFrame,
    key: str,
    order: list[str],
    user_length: Column,
    generation_length: Column,
    generation: str,
    max_length: int,
    prompt_overhead: int = 0,
    least: int = 1,
) -> DataFrame:
    """Recorded generations as an evaluation run would have produced them.

    ``user_length`` and ``generation_length`` are the lengths a turn adds to the
    conversation (together at least ``least``), ``prompt_overhead`` what the
    generation prompt adds. The first turn whose prompt reaches ``max_length`` gets
    the overlong marker and later turns are dropped. Prompts only grow, so a turn
    is kept if the prompt of the one before it fitted: one pass over the turns
    that the limit lets count.
    """
    rows = leading_turns(turns, key, order, user_length + generation_length, max_length, least, "_start", more=1)
    rows = rows.withColumn("prompt_length", F.col("_start") + user_length + prompt_overhead)
    before = F.lag("prompt_length").over(W.partitionBy(key).orderBy(*order))
    kept = rows.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") < max_length))
    text = F.when(F.col("prompt_length") >= max_length, F.lit(OVERLONG)).otherwise(F.col(generation))
    return kept.withColumn(generation, text).drop("_start", "_before")


def pop_last_turn(turns: DataFrame, key: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(prompts, labels) of conversations of any length: the last turn of each key
    is its label, the turns before it are its prompt, as rows. ``order`` must tell
    the turns of a key apart; turns equal in it count as one."""
    last = turns.groupBy(key).agg(F.max(F.struct(*order)).alias("_last")).select(key, "_last.*")
    labels = turns.join(last, [key, *order], "left_semi").dropDuplicates([key, *order])
    return turns.join(last, [key, *order], "left_anti"), labels
