"""Lazy single-pass reads: bounded file streams with stateless shaping."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tunetables.operators.staging import stage_path
from tunetables.sources.files import FileSpec, reader_options


def stream_files(
    spark: SparkSession, specs: list[FileSpec], schema: T.StructType | str, files_per_trigger: int = 1000
) -> DataFrame:
    """Union of file streams under one given schema. Weights are refused: a
    stream cannot be resampled."""
    if any(s.weight is not None for s in specs):
        raise ValueError("streams cannot be resampled")
    frames = []
    for s in specs:
        source, options = reader_options(s.format)
        reader = spark.readStream.schema(schema).options(**options).option("maxFilesPerTrigger", files_per_trigger)
        frames.append(reader.format(source).load(as_pattern(s.path)))
    return reduce(DataFrame.unionByName, frames)


def as_pattern(path: str) -> str:
    """A path as a glob of itself: the file source takes a plain path for a
    folder, a glob for whatever it matches."""
    if any(ch in path for ch in "*?[{"):
        return path
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/{{{name}}}"


def check_stream_options(validation: list[FileSpec] | None, use_validation: bool, max_steps: int, resampling: bool) -> None:
    if resampling:
        raise ValueError("streams cannot be resampled")
    if use_validation and validation is None:
        raise ValueError("a stream needs explicit validation files")
    if max_steps <= 0:
        raise ValueError("a stream needs a positive step limit")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Everything there is now, into parquet, with progress kept in ``checkpoint``."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def step_rows(max_steps: int, batch_size: int, accumulation: int = 1, workers: int = 1) -> int:
    """Rows that a bounded run takes from its stream."""
    if min(max_steps, batch_size, accumulation, workers) <= 0:
        raise ValueError("a stream needs a positive step limit and batch sizes")
    return max_steps * batch_size * accumulation * workers


def shaped_stream(
    spark: SparkSession,
    specs: list[FileSpec],
    schema: T.StructType | str,
    shape: Callable[[DataFrame], DataFrame],
    max_rows: int | None = None,
) -> DataFrame:
    """The shaped rows of a finished stream, read back from where they were written.
    ``max_rows`` (see ``step_rows``) ends it after so many rows."""
    out, progress = stage_path(spark, "stream"), stage_path(spark, "progress")
    shaped = shape(stream_files(spark, specs, schema))
    if max_rows is not None:
        shaped = shaped.limit(max_rows)
    run_available(shaped, out, progress)
    return spark.read.schema(shaped.schema).parquet(out)
