"""Dataset files: five formats, unions, summaries, result files."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunetables.operators.mixture import Source, weighted_mixture
from tunetables.operators.shape import fill_missing

FORMATS = ("parquet", "json", "jsonl", "csv", "tsv")


@dataclass(frozen=True)
class FileSpec:
    path: str
    format: str
    weight: float | None = None

    def __post_init__(self) -> None:
        if not self.path.strip() or not self.format.strip():
            raise ValueError("path and format must not be empty")
        if self.weight is not None and (isinstance(self.weight, bool) or self.weight <= 0):
            raise ValueError("weight must be positive")


@dataclass(frozen=True)
class DatasetInput:
    """Where a dataset lies: one of a default name, one path, a path list, or
    file specs. A file named otherwise than the dataset needs the opt-out."""

    name: str
    format: str
    root: str
    subdir: str | None = None
    path: str | None = None
    paths: tuple[str, ...] | None = None
    files: tuple[FileSpec, ...] | None = None
    allow_other_names: bool = False
    allow_weight: bool = True

    def specs(self) -> list[FileSpec] | None:
        """Resolved specs; null when nothing but the default is given and there
        is no default folder (an optional input)."""
        given = [x for x in (self.path, self.paths, self.files) if x is not None]
        if len(given) > 1:
            raise ValueError("give only one of path, paths and files")
        if any(not x for x in given):
            raise ValueError("path lists and file lists must not be empty")
        if self.files is not None and not self.allow_weight and any(f.weight is not None for f in self.files):
            raise ValueError("these files do not take a weight")
        if self.files is not None:
            listed = list(self.files)
        elif self.paths is not None:
            listed = [FileSpec(p, self.format) for p in self.paths]
        elif self.path is not None:
            listed = [FileSpec(self.path, self.format)]
        else:
            folder = os.path.join(self.root, self.subdir) if self.subdir else self.root
            return [FileSpec(os.path.normpath(os.path.join(folder, f"{self.name}.{self.format}")), self.format)]
        return [self._resolved(f) for f in listed]

    def _resolved(self, f: FileSpec) -> FileSpec:
        path = os.path.normpath(f.path if os.path.isabs(f.path) else os.path.join(self.root, f.path))
        if os.path.basename(path) != f"{self.name}.{f.format}" and not self.allow_other_names:
            raise ValueError(f"{path} is not named {self.name}.{f.format}; allow other names to opt out")
        return FileSpec(path, f.format, f.weight)


def reader_options(fmt: str) -> tuple[str, dict[str, str]]:
    """Spark source and options of a format. Quoted line breaks are legal in
    csv and a json file is one document, so both are read per file."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported dataset format: {fmt}")
    if fmt in ("csv", "tsv"):
        sep = "\t" if fmt == "tsv" else ","
        return "csv", {"sep": sep, "header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
    if fmt == "json":
        return "json", {"multiLine": "true"}
    return ("json", {}) if fmt == "jsonl" else ("parquet", {})


def read_file(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None, splittable_csv: bool = False
) -> DataFrame:
    """One file or folder. Give a schema for large text inputs: without one
    Spark reads them twice. ``splittable_csv`` is for files known to hold no
    quoted line breaks."""
    source, options = reader_options(fmt)
    if source == "csv" and splittable_csv:
        options["multiLine"] = "false"
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif source == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.format(source).load(path)


def union(frames: list[DataFrame], mode: str = "outer") -> DataFrame:
    """outer: all columns, null where absent. first: every frame must have the
    first one's columns and is cast to its types."""
    if not frames:
        raise ValueError("nothing to read")
    if mode == "outer":
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if mode != "first":
        raise ValueError("mode must be 'outer' or 'first'")
    schema = frames[0].schema
    for f in frames[1:]:
        if set(f.columns) != set(schema.names):
            raise ValueError(f"columns differ: {sorted(f.columns)} against {sorted(schema.names)}")
    cast = [f.select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in schema]) for f in frames]
    return reduce(DataFrame.unionByName, cast)


def read_files(
    spark: SparkSession, specs: list[FileSpec], mode: str = "outer", schema: T.StructType | str | None = None, splittable_csv: bool = False
) -> DataFrame:
    return union([read_file(spark, s.path, s.format, schema, splittable_csv) for s in specs], mode)


def read_weighted(
    spark: SparkSession,
    specs: list[FileSpec],
    key: str,
    seed: int,
    replacement: bool = False,
    target_size: int | None = None,
    schema: T.StructType | str | None = None,
    splittable_csv: bool = False,
) -> DataFrame:
    if any(s.weight is None for s in specs):
        raise ValueError("every file needs a weight when resampling")
    sources = [Source(read_file(spark, s.path, s.format, schema, splittable_csv), s.weight) for s in specs]
    return weighted_mixture(sources, key, seed, replacement, target_size)


def read_validation(spark: SparkSession, specs: list[FileSpec] | None, mode: str = "outer") -> DataFrame | None:
    """Explicit validation files, never weighted; null: split from train."""
    if specs is None:
        return None
    if any(s.weight is not None for s in specs):
        raise ValueError("validation files do not take a weight")
    return read_files(spark, specs, mode)


def read_test(spark: SparkSession, specs: list[FileSpec]) -> DataFrame:
    return fill_missing(read_files(spark, specs, "outer"))


def read_items(spark: SparkSession, spec: FileSpec, columns: list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """The columns of an item table (its id, candidate and vector); a missing one
    is an error."""
    items = read_file(spark, spec.path, spec.format, schema)
    missing = [c for c in columns if c not in items.columns]
    if missing:
        raise ValueError(f"item columns not found: {missing}")
    return items.select(*columns)


def _spec_mode(specs: list[FileSpec]) -> str:
    if len(specs) == 1:
        return "single_file"
    return "multi_file" if len({s.format for s in specs}) == 1 else "multi_format"


def input_modes(
    train: list[FileSpec],
    val: list[FileSpec] | None,
    use_validation: bool = True,
    resampling: bool = False,
    streaming: bool = False,
) -> tuple[str, str, bool]:
    """(train mode, validation mode, from_train_split)."""
    train_mode = "weighted_resampled" if resampling else _spec_mode(train)
    if not use_validation:
        val_mode = "disabled"
    else:
        val_mode = "sampled_from_train" if val is None else f"external_{_spec_mode(val)}"
    if streaming:
        train_mode = f"streaming_{train_mode}"
        val_mode = val_mode if val_mode == "disabled" else f"streaming_{val_mode}"
    return train_mode, val_mode, use_validation and val is None and not streaming


def file_counts(df: DataFrame) -> DataFrame:
    """Rows per input file of a freshly read frame."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"))


def input_summary(
    spark: SparkSession,
    train: list[FileSpec],
    val: list[FileSpec] | None,
    use_validation: bool = True,
    resampling: bool = False,
    streaming: bool = False,
    schema: T.StructType | str | None = None,
    splittable_csv: bool = False,
) -> DataFrame:
    """One line per configured file, with its row count and the input modes. Give
    a schema where counting should not read text files twice."""
    train_mode, val_mode, from_train = input_modes(train, val, use_validation, resampling, streaming)
    parts = []
    for split, mode, specs in (("train", train_mode, train), ("validation", val_mode, val or [])):
        for s in specs:
            counts = read_file(spark, s.path, s.format, schema, splittable_csv).agg(F.count("*").alias("rows"))
            facts = {"split": split, "mode": mode, "path": s.path, "format": s.format}
            parts.append(counts.select(*[F.lit(v).alias(k) for k, v in facts.items()], "rows"))
    if not val:
        row = [("validation", val_mode, None, None, None)]
        parts.append(spark.createDataFrame(row, "split string, mode string, path string, format string, rows bigint"))
    return reduce(DataFrame.unionByName, parts).withColumn("from_train_split", F.lit(from_train))


def write_results(df: DataFrame, path: str, layout: str = "records") -> None:
    """``lines``: one object per line. ``records``: every part file is one JSON
    array, written as a stream of lines, so nothing is gathered; coalesce
    before the call for a single file."""
    if layout == "lines":
        df.write.json(path)
        return
    if layout != "records":
        raise ValueError("layout must be 'records' or 'lines'")

    def bracket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = "["
        for batch in batches:
            lines = []
            for text in batch["value"]:
                lines.append(lead + text)
                lead = ","
            yield pd.DataFrame({"value": lines})
        yield pd.DataFrame({"value": ["]" if lead == "," else "[]"]})

    options = {"ignoreNullFields": "false"}
    df.select(F.to_json(F.struct("*"), options).alias("value")).mapInPandas(bracket, "value string").write.text(path)
