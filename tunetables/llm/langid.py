"""Language of a text by the nearest of several centroids per language.

A text's letters, lower-cased, make character n-grams (one to three, words apart),
hashed into ``DIM`` places; their counts, damped and weighted by rarity, make a
vector of length one. Each language's training vectors are clustered into a few
centroids. A text gets the language of the centroid with the largest cosine;
it is marked rejected if it lies farther from it than nearly all of the centroid's
own training texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tunetables.llm.words import blocks
from tunetables.operators.staging import materialise

U = np.uint64
DIM_BITS = 12
DIM = 1 << DIM_BITS
_K = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)]
#: rows whose dense vectors are held at once
ROWS = 512


@dataclass
class Model:
    """Classifier: rarity weights, centroids with their language, and the least
    cosine that each accepts."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    accept: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and its lower case."""
    alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    lower = np.arange(0x110000, dtype=U)
    for i in np.flatnonzero(alpha).tolist():
        c = chr(i).lower()
        if len(c) == 1:
            lower[i] = ord(c)
    return alpha, lower


def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts of each text, and whether it has a letter."""
    alpha, lower = _letters()
    raw = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    letter = alpha[raw]
    edge = np.ones(len(raw), bool)  # a gap is its first sign only, at a text's start too
    edge[1:] = letter[:-1] | (row[1:] != row[:-1])
    keep = letter | edge
    code, row = np.where(letter, lower[raw], U(32))[keep], row[keep]
    has = np.zeros(len(texts), bool)
    has[row[code != U(32)]] = True
    out = np.zeros(len(texts) * DIM, np.float32)
    key = np.zeros(len(code), U)
    for n in range(3):
        end = len(code) - n
        if end <= 0:
            break
        key = key[:end] * U(31) + code[n:] * _K[n]
        inside = row[n:] == row[:end]
        place = ((key * _K[1]) ^ (key >> U(29)) * _K[0]) >> U(64 - DIM_BITS)
        if n == 0:
            inside &= code != U(32)
        out += np.bincount(row[:end][inside] * DIM + place[inside].astype(np.int64), minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), DIM), has


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means; starts far apart, so it is the same for the same rows."""
    centres = [unit(x.mean(axis=0))]
    for _ in range(min(k, len(x)) - 1):
        centres.append(x[int(np.argmin(np.max(x @ np.array(centres).T, axis=1)))])
    c = np.array(centres)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.array([unit(x[own == i].mean(axis=0)) if (own == i).any() else c[i] for i in range(len(c))])
    return c


def training_sample(df: DataFrame, lang_col: str, text_col: str, per_language: int) -> DataFrame:
    """(lang, text): at most ``per_language`` distinct labelled texts of a language,
    those with the lowest hashes. Counts of distinct texts thin them out before they are
    ranked."""
    rows = df.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        "lang is not null and text is not null"
    ).withColumn("h", F.xxhash64("text"))
    # a language may be made of copies: what counts is its distinct texts
    sizes = rows.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    # three times the share, out of 2**20 hash cells: fewer rows than asked for is all but impossible
    share = F.lit(float(3 * per_language * (1 << 20))) / F.col("n")
    thin = rows.join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, "lang").filter(
        F.pmod(F.col("h"), F.lit(1 << 20)) < F.greatest(share, F.lit(2.0**20 * 64) / F.col("n"))
    )
    ranked = thin.dropDuplicates(["lang", "h"]).withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    return ranked.filter(F.col("r") <= per_language).select("lang", "text")


def fit(df: DataFrame, lang_col: str = "lang", text_col: str = "text", per_language: int = 1000, clusters: int = 4, reject: float = 0.001) -> Model:
    """A model from labelled rows: at most ``per_language`` texts of each language
    are learned from, read whole. ``reject`` is the share of training texts that a
    centroid may leave outside. The labels are a closed set of some thousands at
    most; the driver holds ``clusters`` vectors for each."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            x, has = counts(part.column("text").to_pylist())
            kept = np.flatnonzero(has)
            yield pa.RecordBatch.from_arrays(
                [part.column("lang").take(pa.array(kept)), pa.array([x[i].tobytes() for i in kept], pa.binary())], ["lang", "x"]
            )

    def read(table: pa.Table) -> np.ndarray:
        return np.log1p(np.frombuffer(b"".join(table.column("x").to_pylist()), np.float32).reshape(-1, DIM))

    def frequency(key: tuple, table: pa.Table) -> pa.Table:
        x = read(table)
        return pa.table({"n": [len(x)], "df": [(x > 0).sum(axis=0).astype(np.float64).tobytes()]})

    spark = df.sparkSession
    sample = materialise(training_sample(df, lang_col, text_col, per_language).mapInArrow(vectors, "lang string, x binary"), "sample")
    rows = sample.groupBy("lang").applyInArrow(frequency, "n long, df binary").collect()
    if not rows:
        return Model(np.zeros(DIM, np.float32), np.zeros((0, DIM), np.float32), [], np.zeros(0))
    n = sum(r["n"] for r in rows)
    seen = np.sum([np.frombuffer(r["df"], np.float64) for r in rows], axis=0)
    idf = np.log((1 + n) / (1 + seen)).astype(np.float32) + 1
    shared = spark.sparkContext.broadcast(idf)

    def centroids(key: tuple, table: pa.Table) -> pa.Table:
        x = unit(read(table) * shared.value)
        x = x[np.lexsort(x.T[:8])]  # the same order for any partitioning
        c = cluster(x, clusters)
        near = x @ c.T
        own = np.argmax(near, axis=1)
        accept = [float(np.quantile(near[own == i, i], reject)) if (own == i).any() else 1.0 for i in range(len(c))]
        return pa.table({"lang": [key[0].as_py()] * len(c), "nth": list(range(len(c))), "c": [v.astype(np.float32).tobytes() for v in c], "accept": accept})

    found = sample.groupBy("lang").applyInArrow(centroids, "lang string, nth long, c binary, accept double").collect()
    found.sort(key=lambda r: (r["lang"], r["nth"]))
    return Model(idf, np.array([np.frombuffer(r["c"], np.float32) for r in found]), [r["lang"] for r in found], np.array([r["accept"] for r in found]))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in blocks(batches):
        for i in range(0, part.num_rows, ROWS):
            yield part.slice(i, ROWS)


def predict(df: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of each row of ``df`` with lang_pred, score and
    rejected. Only the text is looked at. A null text, or one without a letter, is
    ``und`` with score 0; so is every text if nothing was learned. The score is the
    cosine, at least 0; rejected texts keep their nearest language. Of equally near
    centroids the first in the order of languages counts."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for part in _parts(batches):
            x, has = counts([t or "" for t in part.column("text").to_pylist()])
            n = part.num_rows
            if m.langs:
                near = unit(np.log1p(x) * m.idf) @ m.centroids.T
                best = np.argmax(near, axis=1)
                score = np.clip(near[np.arange(n), best], 0, 1).astype(np.float64)
                rejected = score < m.accept[best]
                langs = [m.langs[b] if ok else "und" for b, ok in zip(best.tolist(), has.tolist(), strict=True)]
            else:
                score, rejected, langs = np.zeros(n), np.ones(n, bool), ["und"] * n
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.array(langs), pa.array(np.where(has, score, 0.0)), pa.array(rejected | ~has)],
                [*keep, "lang_pred", "score", "rejected"],
            )

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return df.select(*keep, F.col(text_col).alias("text")).mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")
