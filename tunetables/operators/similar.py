"""Pairs of similar texts without comparing all of them.

The similarity is the ratio 2m / (|a| + |b|) of characters m in matching blocks. With
a ratio of at least t, |a| + |b| - 2m <= (1 - t)(|a| + |b|) characters are unmatched.
So lengths are near each other, and as an unmatched character or a border of blocks
spoils at most ``size`` of the grams that cover it, two similar texts share all but so
many grams. Hence among the rarest ``size * unmatched + 1`` grams of each there is a
common one (or the texts share the rarest characters, the grams of size one). An
inverted index on these few grams, split by bands of lengths, gives the candidates;
each is then compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.operators.staging import materialise

#: cells of the histogram that orders grams from rare to frequent
CELLS = 1 << 16


def ratio(a: str, b: str, floor: float = 0.0) -> float:
    """Share of characters in matching blocks; a value below ``floor`` may be 0."""
    if a == b:
        return 1.0
    matcher = SequenceMatcher(a=a, b=b)
    if matcher.real_quick_ratio() < floor or matcher.quick_ratio() < floor:
        return 0.0  # both are upper bounds
    return matcher.ratio()


def unmatched(length: int, least: float) -> int:
    """Most characters that lie outside the matching blocks, of a text of this length
    and any other: the longest similar one has length * (2 - least) / least."""
    return int((1 - least) * 2 * length / least + 1e-9)


def gram_size(least: float) -> int:
    """Longer grams are rarer, but too many of them may be spoilt: at 0.8 both
    pairs of three characters are, if the middle one goes."""
    return 3 if least >= 0.9 else 2 if least >= 0.81 else 1


def _hashes(raw: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(raw) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + raw[k : k + len(out)] + np.uint64(1)
        out ^= out >> np.uint64(29)
    return out


def numbered_grams(text: str, size: int) -> np.ndarray:
    """Hashes of the grams of a text, the second of equal ones unlike the first."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(raw) < size:
        return np.zeros(0, np.uint64)
    grams = np.sort(_hashes(raw, size))
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    nth = np.arange(len(grams)) - np.repeat(first, np.diff(np.append(first, len(grams))))
    return (grams + nth.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) * np.uint64(0xBF58476D1CE4E5B9)


def rarest(text: str, least: float, frequency: np.ndarray) -> np.ndarray:
    """The grams of which a similar text has at least one. Few enough grams are all
    there are: then a text shares one with each similar one as well, if any is shared
    at all; ``gram_size`` sees to that."""
    size = gram_size(least)
    grams = numbered_grams(text, size)
    order = np.lexsort([grams, frequency[(grams >> np.uint64(48)).astype(np.int64)]])
    return grams[order[: size * unmatched(len(text), least) + 1]]


def band(length: int, least: float) -> int:
    """Texts that are similar lie in one band of lengths or in neighbouring ones."""
    return int(math.log(max(length, 1)) / math.log((2 - least) / least) + 1e-9) if least < 1 else length


def _histogram(texts: DataFrame, size: int) -> np.ndarray:
    """Grams in each cell, ``CELLS`` numbers whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts += np.bincount((numbered_grams(text, size) >> np.uint64(48)).astype(np.int64), minlength=CELLS)
        cell = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(counts[cell])], ["cell", "n"])

    out = np.zeros(CELLS, np.int64)
    for r in texts.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out


def candidates(texts: DataFrame, least: float) -> DataFrame:
    """(a, b): ids of pairs of distinct texts (id, text) whose lengths are near and
    that share one of their rarest grams; each pair once, in no order."""
    size, frequency = gram_size(least), _histogram(texts, gram_size(least))
    if size * unmatched(1000, least) + size > 1000:
        raise ValueError("no gram need be shared below this similarity")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, grams, lengths, bands = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                if not unmatched(len(text), least):
                    continue  # similar to itself only
                own = rarest(text, least, frequency)
                rows.append(np.full(len(own), i)), grams.append(own)
                lengths.append(np.full(len(own), len(text))), bands.append(np.full(len(own), band(len(text), least)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(grams).view(np.int64)),
                     pa.array(np.concatenate(lengths)), pa.array(np.concatenate(bands))],
                    ["id", "gram", "n", "band"],
                )

    kind = texts.schema["id"].dataType.simpleString()
    index = materialise(texts.select("id", "text").mapInArrow(run, f"id {kind}, gram long, n long, band long"), "grams")
    # a gram that many texts have meets itself band by band; written tables let Spark split what is still large
    near = index.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    left, right = index.alias("l"), near.alias("r")
    met = left.join(right, ["gram", "band"]).filter(
        ((F.col("r.n") < F.col("l.n")) | (F.col("r.n") == F.col("l.n")) & (F.col("r.id") < F.col("l.id")))
        & (F.col("l.n") * least <= F.col("r.n") * (2 - least) + 1e-9)
    )
    return met.select(F.col("r.id").alias("a"), F.col("l.id").alias("b")).distinct()


def similar_texts(texts: DataFrame, least: float = 0.95, compare: Callable[[str, str, float], float] = ratio) -> DataFrame:
    """(a, b, similarity): pairs of ids of distinct texts (id, text), the lesser text
    first, whose similarity is at least ``least`` (from 0.7 on). Null texts take no
    part, texts equal to another of another id are pairs of their own and must be
    grouped before: ``similar_values`` does."""
    found = materialise(candidates(texts.filter("text is not null"), least), "pairs")
    one, other = texts.select(F.col("id").alias("a"), F.col("text").alias("s")), texts.select(F.col("id").alias("b"), F.col("text").alias("t"))
    return compared(found.join(one, "a").join(other, "b"), least, compare)


def compared(pairs: DataFrame, least: float, compare: Callable[[str, str, float], float] = ratio) -> DataFrame:
    """Of pairs (a, s, b, t) the similar ones, (a, b, similarity), the lesser text first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, s, b, t in zip(*(batch.column(c).to_pylist() for c in "asbt"), strict=True):
                if t < s:
                    a, s, b, t = b, t, a, s
                score = compare(s, t, least)
                if score >= least:
                    found.append((a, b, score))
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field("a").type), pa.array(columns[1], batch.schema.field("b").type), pa.array(columns[2], pa.float64())],
                ["a", "b", "similarity"],
            )

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.select("a", "s", "b", "t").mapInArrow(run, f"a {kind}, b {kind}, similarity double")


def text_id(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text))


def similar_values(df: DataFrame, text: str, least: float = 0.95) -> DataFrame:
    """(value, other, copies, other_copies, similarity): pairs of different values of a
    text column, the lesser first, that are similar, and how often each occurs. A value
    that is repeated is one value, so copies make no pairs; null is no value."""
    values = df.groupBy(F.col(text).alias("text")).agg(F.count("*").alias("copies")).filter("text is not null")
    values = materialise(values.select(text_id(F.col("text")).alias("id"), "text", "copies"), "values")
    found = materialise(similar_texts(values.select("id", "text"), least), "similar")
    one = values.select(F.col("id").alias("a"), F.col("text").alias("value"), "copies")
    other = values.select(F.col("id").alias("b"), F.col("text").alias("other"), F.col("copies").alias("other_copies"))
    return found.join(one, "a").join(other, "b").select("value", "other", "copies", "other_copies", "similarity")
