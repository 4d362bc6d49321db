"""Reward reports and log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reward_metrics(scored: DataFrame, names: list[str], by: list[str] = ()) -> DataFrame:
    """Coverage and mean per reward (and group): one partial aggregation over
    all reward columns, unpivoted after it. Empty input gives no line, zero
    coverage no mean."""
    sums = [F.count("*").alias("_rows")]
    for i, n in enumerate(names):
        c = F.col(f"`{n}`")
        sums += [F.count(c).alias(f"_n{i}"), F.avg(c).alias(f"_m{i}")]
    totals = scored.groupBy(*by).agg(*sums).where("_rows > 0")
    lines = [
        F.struct(
            F.lit(n).alias("reward"),
            F.col("_rows").alias("rows"),
            (F.col(f"_n{i}") / F.col("_rows")).alias("coverage"),
            F.col(f"_m{i}").alias("mean"),
        )
        for i, n in enumerate(names)
    ]
    return totals.select(*by, F.inline(F.array(*lines)))


def metric_lines(metrics: DataFrame, by: list[str] = ()) -> DataFrame:
    """(name, value) with names 'reward/coverage' and 'reward/mean'."""
    cells = F.array(
        *[F.struct(F.concat("reward", F.lit(f"/{m}")).alias("name"), F.col(m).alias("value")) for m in ("coverage", "mean")]
    )
    return metrics.select(*by, F.inline(cells)).where("value is not null")


def stringify_nested(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, other columns unchanged."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return df.select(
        *[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema]
    )


def pivot_rewards(long: DataFrame, key: str, names: list[str]) -> DataFrame:
    """One column per reward from (key, reward, value). The names are given, so
    no extra pass finds them."""
    return long.groupBy(key).pivot("reward", names).agg(F.first("value"))


def completion_log(
    scored: DataFrame,
    key: str,
    step: int,
    names: list[str],
    prompt: str = "prompt",
    completion: str = "completion",
    advantage: str = "advantage",
    extras: list[str] = (),
    images: str | None = None,
) -> DataFrame:
    """Log table of rows that carry their reward columns: key, step, prompt,
    completion, rewards, extras, advantage, optional images. A projection."""
    wide = [F.col(f"`{n}`") for n in (*names, *extras)]
    tail = [F.col(images).alias("image_artifacts")] if images else []
    head = [F.col(key), F.lit(step).alias("step"), F.col(prompt).alias("prompt"), F.col(completion).alias("completion")]
    return scored.select(*head, *wide, F.col(advantage).alias("advantage"), *tail)
