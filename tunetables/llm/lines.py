"""Repeated lines or paragraphs: each normalised unit's digest is grouped over the
whole corpus, the earliest occurrence stays, the others go. Offsets are those of
the original text, in code points."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.llm.tables import join_unique
from tunetables.llm.words import blocks
from tunetables.operators.staging import materialise

_GAP = re.compile(r"[\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: characters of scripts that put no spaces between words
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")
#: what parts the units of a text
SEPARATORS = {"line": "\n", "paragraph": "\n\n"}


def normalise(unit: str) -> str:
    return _GAP.sub(" ", unit.translate(_LOWER)).strip(" ")


def n_words(plain: str) -> int:
    """Words of a normalised unit; two characters of an unspaced script are one."""
    return plain.count(" ") + 1 + len(_UNSPACED.findall(plain)) // 2


def units(df: DataFrame, kind: str, least_words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, row, unit, start, stop, digest) of every unit of at least ``least_words``
    words. Shorter ones recur by chance and are never touched. ``row`` tells the
    texts of one id apart."""
    separator = SEPARATORS[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            row, nth, start, stop, digest = [], [], [], [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                at = 0
                for k, unit in enumerate((text or "").split(separator)):
                    plain = normalise(unit)
                    if plain and n_words(plain) >= least_words:
                        row.append(i), nth.append(k), start.append(at), stop.append(at + len(unit))
                        digest.append(xxhash.xxh3_128_digest(plain.encode("utf-8", "surrogatepass")))
                    at += len(unit) + len(separator)
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(row, pa.int64())), part.column("row").take(pa.array(row, pa.int64())),
                 pa.array(nth, pa.int64()), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array(digest, pa.binary())],
                ["id", "row", "unit", "start", "stop", "digest"],
            )

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, row long, unit long, start long, stop long, digest binary"
    )


def repeated_units(df: DataFrame, kind: str = "line", least_words: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, unit, start, stop, copies, first_id, first_unit) of every unit to
    remove: all but the earliest by (id, unit) of those equal once A-Z are a-z and
    white space is single; rows without an id come last.

    Null and empty texts have no units. Rows that repeat an id and a text are one
    document: a unit at the same place is the same occurrence. Different texts of one
    id are told apart by ``row``. Other columns are not read; an empty table gives no
    rows. A text of any length is split in one task, next to its own bytes."""
    found = materialise(units(df, kind, least_words, id_col, text_col), "units")
    place = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("unit"), F.col("row"))
    groups = found.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    met = join_unique(found, materialise(groups, "groups"), ["digest"])
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("unit") == F.col("first.unit")) & (F.col("row") == F.col("first.row"))
    return met.filter(~same).select(
        F.col("id").alias(id_col), "row", "unit", "start", "stop", "copies", F.col("first.id").alias(f"first_{id_col}"), F.col("first.unit").alias("first_unit")
    )


_REMOVED = "array<struct<start: bigint, stop: bigint, first: {0}, first_unit: bigint>>"


def without_repeats(df: DataFrame, removed: DataFrame, kind: str = "line", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, removed) of every row of ``df``: the text without its removed
    units and one separator after each, and their places (start, stop) in the
    original with the id and unit that stay. Null texts stay null; repeated rows
    each give a row."""
    width = len(SEPARATORS[kind])
    id_type = df.schema[id_col].dataType.simpleString()
    place = F.struct("start", "stop", F.col(f"first_{id_col}").alias("first"), "first_unit")
    spans = removed.groupBy(F.col(id_col).alias("_id"), F.col("row").alias("_row")).agg(F.sort_array(F.collect_set(place)).alias("removed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist(), strict=True):
                if text is not None and spans:
                    at, parts = 0, []
                    for s in spans:
                        parts.append(text[at : s["start"]])
                        at = s["stop"] + width
                    text = "".join([*parts, text[at:]])
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string()), batch.column("removed")], ["id", "text", "removed"])

    docs = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"))
    none = F.array().cast(_REMOVED.format(id_type))
    met = F.col("id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))
    joined = docs.join(materialise(spans, "spans"), met, "left").select("id", "text", F.coalesce("removed", none).alias("removed"))
    return joined.mapInArrow(run, f"id {id_type}, text string, removed {_REMOVED.format(id_type)}").withColumnRenamed("id", id_col)
