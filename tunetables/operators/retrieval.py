"""Vector retrieval: exact top-k, hit-rank and nDCG rewards.

Top-k is exact in all three forms of the search:

* a query set whose vectors are proven small is sent to the item tasks;
* otherwise queries are hashed into blocks of bounded size, and the items stream
  through every block, which keeps the k best of each query as it goes. Only k
  rows per query leave it, and no task holds more than its block;
* item sets large enough for it are cut into cells around sample vectors. For a
  cell of centre p and radius r no item scores above q.p + |q| r, so a first
  search of the nearest cells gives every query a bar, and only cells that can
  pass the bar of a query are sent to its block and multiplied with its group.

Products are taken in single precision and only tell which items may be among
the k best, with room for their rounding; those are scored in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunetables.config import HitOptions, NdcgOptions
from tunetables.functions.jsonx import string_list
from tunetables.functions.text import has_category_token
from tunetables.operators.staging import materialise

#: scores are compared in single precision: digits kept of a score as a share of
#: the largest that the query's norm and the items' largest norm allow
DIGITS = 7
#: what a query block holds, in bytes: vectors and the best items so far
BLOCK_BYTES = 256 << 20
SMALL_QUERY_BYTES = 32 << 20
#: queries that share a bound on cells; items multiplied at once, as rows and as bytes
GROUP_ROWS = 512
CHUNK_ROWS = 32_768
CHUNK_BYTES = 32 << 20
#: query blocks a core gets at least, so that cores end together
BLOCKS_PER_CORE = 3
#: items per cell aimed at, and the bytes of centres that every task holds
CELL_ROWS = 4_000
CENTRE_BYTES = 64 << 20
#: numbers in a temporary matrix
CELLS_AT_ONCE = 2 << 20
#: items and queries that tell whether cells are worth while
SAMPLE_ROWS, SAMPLE_QUERIES = 4096, 256
#: shares as whole numbers, and the bits they take beside a row's number
_UNITS = 10**DIGITS
_BITS = 26


class _Best:
    """The k best items of a group of queries, best first, ties by item id, over
    as many chunks of items as are added. ``longest`` is the items' largest norm;
    ``bar`` a share that the k-th best is known to reach."""

    def __init__(self, mat: np.ndarray, k: int, longest: float, bar: np.ndarray | None = None):
        norm = np.linalg.norm(mat, axis=1)
        self.mat, self.k, self.reach, self.norm = mat, k, _reach(mat, longest), norm
        able = norm * longest > 0
        self.unit = np.where(able[:, None], mat / np.where(able, norm, 1.0)[:, None], 0.0).astype(np.float32)
        self.slack = 6e-8 * (mat.shape[1] + 4) + 1.0 / _UNITS
        self.bar = np.full(len(mat), -np.inf) if bar is None else bar - self.slack
        self.rows: list[tuple] = []  # key (row, then share downwards), score, id, whether the id is null
        self.pooled, self.limit = 0, 2 * len(mat) * k + (1 << 16)

    def add(self, ids: np.ndarray, null: np.ndarray, mat: np.ndarray, unit: np.ndarray) -> None:
        n = len(ids)
        some, step = max(1, CELLS_AT_ONCE // max(1, n)), max(1, CELLS_AT_ONCE // max(1, mat.shape[1]))
        for start in range(0, len(self.unit), some):
            part = slice(start, start + some)
            share = self.unit[part] @ unit.T
            if n > self.k:
                self.bar[part] = np.fmax(self.bar[part], self._reached(share) - 2 * self.slack)
            low = np.nextafter(self.bar[part].astype(np.float32), np.float32(-np.inf))
            at = np.flatnonzero(share >= low[:, None])
            for a in range(0, len(at), step):
                row, col = np.divmod(at[a : a + step], n)
                row += start
                score = np.einsum("ij,ij->i", self.mat[row], mat[col])
                place = np.rint(score / self.reach[row] * _UNITS).astype(np.int64)
                self.rows.append(((row << _BITS) + (2 * _UNITS - place), score, ids[col], null[col]))
            self.pooled += len(at)
        if self.pooled > self.limit:
            self._keep()

    def _reached(self, share: np.ndarray) -> np.ndarray:
        """A share that k items of each row reach: the k-th of the best of some 4k
        classes of items, as each class has an item that reaches its best."""
        width = max(1, share.shape[1] // (4 * self.k))
        classes = share.shape[1] // width
        best = np.fmax.reduce(share[:, : width * classes].reshape(len(share), width, classes), axis=1)
        best[np.isnan(best)] = -np.inf
        return np.partition(best, classes - self.k, axis=1)[:, classes - self.k].astype(np.float64)

    def _keep(self) -> None:
        if not self.rows:
            return
        key, score, ids, null = (np.concatenate(c) for c in zip(*self.rows))
        order = np.lexsort((ids, ~null, key))
        row = key[order] >> _BITS
        rank = np.arange(len(row)) - np.searchsorted(row, np.arange(len(self.mat)))[row]
        order = order[rank < self.k]
        key, score, ids, null = key[order], score[order], ids[order], null[order]
        last = key[rank[rank < self.k] == self.k - 1]
        self.bar[last >> _BITS] = np.fmax(self.bar[last >> _BITS], _share(last) - self.slack)
        self.rows, self.pooled = [(key, score, ids, null)], len(key)

    def found(self) -> tuple[np.ndarray, ...] | None:
        """Row, score, id, whether it is null, and key, ordered by key and id."""
        self._keep()
        if not self.rows:
            return None
        key, score, ids, null = self.rows[0]
        return key >> _BITS, score, ids, null, key


def _share(key: np.ndarray) -> np.ndarray:
    return (2 * _UNITS - (key & ((1 << _BITS) - 1))) / _UNITS


def _reach(qmat: np.ndarray, longest: float) -> np.ndarray:
    """The largest score that each query could have; 1 where that is nothing."""
    most = np.linalg.norm(qmat, axis=1) * longest
    return np.where(most > 0, most, 1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows of doubles."""
    flat = column.flatten()
    if column.null_count or len(flat) % max(1, len(column)) or len(set(np.diff(column.offsets))) > 1:
        raise ValueError("vectors must be given and of one length")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and whether they are null; null ids come first, as Spark sorts them."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    if null.any():
        held = column.drop_null()
        column = column.fill_null(held[0]) if len(held) else pa.array([0] * len(column))
    return column.to_numpy(zero_copy_only=False), null


def _chunks(ids: pa.Array, vectors: pa.Array, rows: int, longest: float, *more: np.ndarray) -> Iterator[tuple]:
    """Ids, null ids, vectors and their shares of the longest, ``rows`` at a time."""
    mat, (names, null) = _matrix(vectors), _ids(ids)
    unit = (mat / (longest if longest > 0 else 1.0)).astype(np.float32)
    for a in range(0, len(mat), rows):
        at = slice(a, a + rows)
        yield names[at], null[at], mat[at], unit[at], *(m[at] for m in more)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together, as long as they have no more than ``rows``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(map(len, held)) + len(batch) > rows:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def _results(qids: pa.Array, groups: list[_Best], k: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The best items of a block's groups, a row per query. Rows that share a qid are one query."""
    codes = qids.dictionary_encode(null_encoding="encode").indices.to_numpy()
    repeated = len(np.unique(codes)) < len(codes)
    starts = np.cumsum([0, *(len(g.mat) for g in groups)])
    parts = []
    for start, group in zip(starts, groups):
        if (f := group.found()) is None:
            continue
        row, score, ids, null, key = f
        if not repeated:
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            rank = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)])) + 1
            yield _batch(qids, row + start, score, ids, null, _share(key), rank, k, kind)
        else:
            parts.append((row + start, score, ids, null, key))
    if parts:
        yield _batch(qids, *_ranked_rows(codes, *(np.concatenate(c) for c in zip(*parts))), k, kind)


def _ranked_rows(codes: np.ndarray, row, score, ids, null, key) -> tuple:
    down = key & ((1 << _BITS) - 1)
    order = np.lexsort((ids, ~null, down, codes[row]))
    row, code = row[order], codes[row[order]]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    rank = np.arange(len(code)) - np.repeat(first, np.diff(np.r_[first, len(code)])) + 1
    return row, score[order], ids[order], null[order], _share(key[order]), rank


def _batch(qids: pa.Array, row, score, ids, null, place, rank, k: int, kind: pa.DataType) -> pa.RecordBatch:
    at = rank <= k
    items = pa.array(ids[at], kind, mask=null[at]) if len(null) and not null.all() else pa.nulls(int(at.sum()), kind)
    first = np.flatnonzero(rank[at] == 1)
    ends = pa.array(np.r_[first, at.sum()].astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, c) for c in (items, pa.array(score[at]), pa.array(place[at]))]
    return pa.record_batch([qids.take(pa.array(row[at][first])), *lists], names=["qid", "item_id", "score", "place"])


def knn(queries: DataFrame, items: DataFrame, k: int, **options) -> DataFrame:
    """(qid, item_id, score, rank): the rows of ``knn_lists``, which has the options."""
    lists = knn_lists(queries, items, k, **options)
    rows = lists.select("qid", F.posexplode(F.arrays_zip("item_id", "score")).alias("_at", "_found"))
    return rows.select("qid", "_found.item_id", "_found.score", (F.col("_at") + 1).alias("rank"))


def knn_lists(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    qid: str = "qid",
    query: str = "vector",
    item_id: str = "item_id",
    item: str = "embedding",
    item_block: int | None = None,
    query_block: int | None = None,
    small_query_bytes: int = SMALL_QUERY_BYTES,
    cell_rows: int | None = None,
) -> DataFrame:
    """(qid, item_id, score): the k items of highest inner product as lists, best
    first, a row per query that has any. What is done once per query is best done
    to these rows; there are k times fewer than candidates. Scores that differ by less than rounding of their possible range are ties, which the
    item id decides. Fewer than k items give shorter lists. Rows of one qid are one
    query. Blocks are rows: the queries that a task holds, by default as many as
    ``BLOCK_BYTES`` hold, and the items multiplied at once. Cells are used where a
    sample says that they spare a query most items, and always with ``cell_rows``;
    the result is the same."""
    if k <= 0:
        raise ValueError("k must be >= 1")
    q = queries.select(F.col(qid).alias("qid"), F.col(query).alias("vector"))
    i = items.select(F.col(item_id).alias("item_id"), F.col(item).alias("embedding"))
    schema = (
        f"qid {q.schema['qid'].dataType.simpleString()}, item_id array<{i.schema['item_id'].dataType.simpleString()}>, "
        "score array<double>, place array<double>"
    )
    asked, held = _facts(q, "vector"), _facts(i, "embedding")
    item_block = item_block or max(1, min(CHUNK_ROWS, CHUNK_BYTES // (12 * max(1, held.d))))
    query_block = query_block or max(1, BLOCK_BYTES // (8 * 3 * (max(1, asked.d, held.d) + 3 * min(k, max(1, held.n)))))
    if asked.n * (asked.d + 2 * k) * 8 <= small_query_bytes:
        found = _sent_to_items(q, i, k, schema, item_block, held.longest)
        found = found.select("qid", F.inline(F.arrays_zip("item_id", "score", "place")))
        best = W.partitionBy("qid").orderBy(F.desc("place"), "item_id")
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        found = found.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rank", "item_id", "score"))).alias("_found"))
        return found.select("qid", "_found.item_id", "_found.score")
    else:
        least = min(BLOCKS_PER_CORE * q.sparkSession.sparkContext.defaultParallelism, math.ceil(asked.n / GROUP_ROWS))
        blocks = max(1, least, math.ceil(asked.n / query_block))
        cells = min(CENTRE_BYTES // (8 * max(1, held.d)), held.n // (cell_rows or CELL_ROWS))
        if cells > 1 and (cell_rows or _cells_spare(q, i, k, cells, held.n, held.d)):
            found = _cell_search(q, i, k, schema, item_block, asked.n, blocks, cells, held.longest)
        else:
            q = q.withColumn("_qb", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int"))
            every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_qb")
            found = _product(q, i.select("*", every), k, schema, item_block, blocks, held.longest)
    return found.select("qid", "item_id", "score")


def _facts(df: DataFrame, vector: str):
    """Rows, dimensions and the largest norm of a table of vectors, in one scan."""
    square = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return df.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.size(vector)), F.lit(0)).alias("d"), F.coalesce(F.sqrt(F.max(square)), F.lit(0.0)).alias("longest")
    ).first()


def _sent_to_items(q: DataFrame, i: DataFrame, k: int, schema: str, item_block: int, longest: float) -> DataFrame:
    local = q.toArrow().combine_chunks()  # the caller has checked its size
    if not len(local):
        return q.sparkSession.createDataFrame([], schema)
    qids, qmat = (local[c].combine_chunks() for c in ("qid", "vector"))
    qmat = _matrix(qmat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, kind = [_Best(qmat[a : a + GROUP_ROWS], k, longest) for a in range(0, len(qmat), GROUP_ROWS)], None
        for batch in _gathered(batches, item_block):
            kind = batch["item_id"].type
            for chunk in _chunks(batch["item_id"], batch["embedding"], item_block, longest):
                for group in groups:
                    group.add(*chunk)
        if kind is not None:
            yield from _results(qids, groups, k, kind)

    return i.mapInArrow(run, schema)


def _product(
    q: DataFrame, i: DataFrame, k: int, schema: str, item_block: int, blocks: int, longest: float, cells: Broadcast | None = None
) -> DataFrame:
    """The k best of ``i``'s rows in each query's block ``_qb``. A task holds the
    queries of a block, and the block's items pass by. Of tables with cells, only
    those go into a product that can reach the bar of a query of the group."""
    kinds = {q.schema["vector"].dataType, i.schema["embedding"].dataType}
    vector = lambda c: F.col(c) if len(kinds) == 1 else F.col(c).cast("array<double>")
    none = F.lit(None)
    cell = F.col("cell") if cells else F.lit(0).alias("cell")
    bar = F.col("bar") if "bar" in q.columns else none.cast("double").alias("bar")
    q = q.select("_qb", F.lit(0).alias("_side"), cell, bar, "qid", none.cast(i.schema["item_id"].dataType).alias("item_id"), vector("vector").alias("vector"))
    i = i.select("_qb", F.lit(1).alias("_side"), cell, none.cast("double").alias("bar"), none.cast(q.schema["qid"].dataType).alias("qid"), "item_id", vector("embedding").alias("vector"))
    dealt = q.unionAll(i).repartitionById(blocks, "_qb").sortWithinPartitions("_side", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[pa.RecordBatch] = []
        groups: list[_Best] | None = None
        qids = kind = None

        def opened() -> list[_Best]:
            nonlocal qids
            both = pa.Table.from_batches(asked).combine_chunks()
            asked.clear()
            qids = both["qid"].combine_chunks()
            mat = _matrix(both["vector"].combine_chunks())
            bars = both["bar"].to_numpy()
            bars = np.where(np.isnan(bars), -np.inf, bars)
            return [_Best(mat[a : a + GROUP_ROWS], k, longest, bars[a : a + GROUP_ROWS]) for a in range(0, len(mat), GROUP_ROWS)]

        def streamed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                first = int((batch["_side"].to_numpy() == 0).sum())
                if first:
                    asked.append(batch.slice(0, first).select(["qid", "vector", "bar"]))
                if len(batch) > first and (asked or groups):
                    yield batch.slice(first).select(["cell", "item_id", "vector"])

        for rest in _gathered(streamed(), item_block):
            groups, kind = groups or opened(), rest["item_id"].type
            for ids, null, mat, unit, cell in _chunks(rest["item_id"], rest["vector"], item_block, longest, rest["cell"].to_numpy()):
                if cells is None:
                    for group in groups:
                        group.add(ids, null, mat, unit)
                    continue
                named, of = np.unique(cell, return_inverse=True)
                centre, radius = cells.value[0][named], cells.value[1][named]
                for group in groups:
                    bound = (group.mat @ centre.T + group.norm[:, None] * radius) / group.reach[:, None] + 1e-6
                    at = (bound >= group.bar[:, None]).any(axis=0)[of]
                    if at.all():
                        group.add(ids, null, mat, unit)
                    elif at.any():
                        group.add(ids[at], null[at], mat[at], unit[at])
        if groups:
            yield from _results(qids, groups, k, kind)

    return dealt.mapInArrow(run, schema)


def _cells_spare(q: DataFrame, i: DataFrame, k: int, cells: int, n: int, d: int) -> bool:
    """Whether cells leave a query less than half of the items, as far as samples
    tell: radii of sample cells, and the bars that sample items set."""
    most = CENTRE_BYTES // (8 * max(1, d))
    if 4 * cells > most:
        return True

    def sample(df: DataFrame, name: str, vector: str, rows: int) -> np.ndarray:
        return _matrix(df.orderBy(F.md5(F.col(name).cast("string"))).limit(rows).select(vector).toArrow()[vector].combine_chunks())

    m = sample(i, "item_id", "embedding", min(most, max(SAMPLE_ROWS, 4 * cells)))
    asked, p = sample(q, "qid", "vector", SAMPLE_QUERIES), m[:cells]
    half, step = 0.5 * np.sum(p * p, axis=1), max(1, CELLS_AT_ONCE // cells)
    near = np.concatenate([np.argmax(m[a : a + step] @ p.T - half, axis=1) for a in range(0, len(m), step)])
    radius = np.zeros(len(p))
    np.maximum.at(radius, near, np.linalg.norm(m - p[near], axis=1))
    size, nth = np.bincount(near, minlength=len(p)), min(len(m), max(1, round(k * len(m) / n)))
    left = []
    for v in asked:
        bar = np.partition(m @ v, len(m) - nth)[len(m) - nth]
        left.append(size[p @ v + np.linalg.norm(v) * radius >= bar].sum())
    return 2 * np.mean(left) < len(m) if left else False


def _into_cells(df: DataFrame, vector: str, centres: Broadcast) -> DataFrame:
    """Nearest centre of every vector and the distance to it, written out: it
    is read several times and must not change between the readings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = centres.value
        half, step = 0.5 * np.sum(p * p, axis=1), max(1, CELLS_AT_ONCE // len(p))
        for batch in batches:
            if len(batch):
                m = _matrix(batch[vector])
                near = np.concatenate([np.argmax(m[a : a + step] @ p.T - half, axis=1) for a in range(0, len(m), step)])
                gap = np.linalg.norm(m - p[near], axis=1)
                yield pa.record_batch([*batch.columns, pa.array(near.astype(np.int32)), pa.array(gap)], names=[*batch.schema.names, "cell", "gap"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return materialise(df.mapInArrow(run, f"{fields}, cell int, gap double"), "cells")


def _cell_search(
    q: DataFrame, i: DataFrame, k: int, schema: str, item_block: int, q_rows: int, blocks: int, cells: int, longest: float
) -> DataFrame:
    spark = q.sparkSession
    sample = i.orderBy(F.md5(F.col("item_id").cast("string"))).limit(cells).collect()  # CENTRE_BYTES at most
    p = np.stack([r.embedding for r in sample]).astype(np.float64)
    some = p[: max(1, math.isqrt(cells))]  # cells near each other get numbers near each other
    p = p[np.argsort(np.argmax(p @ some.T - 0.5 * np.sum(some * some, axis=1), axis=1), kind="stable")]
    centres = spark.sparkContext.broadcast(p)
    items, queries = _into_cells(i, "embedding", centres), _into_cells(q, "vector", centres)
    count, radius = np.zeros(cells), np.full(cells, -np.inf)
    for f in items.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("r")).collect():  # one row per cell
        count[f.cell], radius[f.cell] = f.n, f.r
    known = spark.sparkContext.broadcast((p, radius))
    # cells in a row share a block, and a large one has several; rows of one qid stay together
    queries = queries.withColumn("cell", F.min("cell").over(W.partitionBy("qid")))
    size, end, homes = math.ceil(q_rows / blocks), 0, []
    for f in queries.groupBy("cell").count().orderBy("cell").collect():
        first, end = end // size, end + f["count"]
        homes.append((f.cell, first, (end - 1) // size - first + 1))
    homes = spark.createDataFrame(homes, "cell int, _first int, _parts int")
    home = F.col("_first") + F.pmod(F.xxhash64("qid"), F.col("_parts")).cast("int")
    queries = queries.join(F.broadcast(homes), "cell").select("qid", "vector", "cell", home.alias("_qb"))

    def search(asked: DataFrame, choose) -> DataFrame:
        """Top-k over the cells ``choose`` names for any query of a block."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, CELLS_AT_ONCE // cells)
            for batch in batches:
                m, at, bar = _matrix(batch["vector"]), batch["_qb"].to_numpy(), batch["bar"].to_numpy(zero_copy_only=False)
                for home in np.unique(at):
                    rows, named = np.flatnonzero(at == home), np.zeros(cells, bool)
                    for a in range(0, len(rows), step):
                        r = rows[a : a + step]
                        named |= choose(m[r] @ p_of(), m[r], bar[r])
                    cell = np.flatnonzero(named).astype(np.int32)
                    yield pa.record_batch([pa.array(np.full(len(cell), home, np.int32)), pa.array(cell)], names=["_qb", "cell"])

        def p_of() -> np.ndarray:
            return centres.value.T

        pairs = asked.select("vector", "_qb", "bar").mapInArrow(run, "_qb int, cell int").distinct()
        return _product(asked, items.select("item_id", "embedding", "cell").join(pairs, "cell"), k, schema, item_block, blocks, longest, known)

    def nearest(scores: np.ndarray, m: np.ndarray, bar: np.ndarray) -> np.ndarray:
        """The cells of best centre score that hold k items together."""
        order = np.argsort(-scores, axis=1)
        before = np.cumsum(count[order], axis=1) - count[order]
        return np.bincount(order[before < k], minlength=cells) > 0

    def passing(scores: np.ndarray, m: np.ndarray, bar: np.ndarray) -> np.ndarray:
        """The cells whose bound reaches the bar, less rounding."""
        share = (scores + np.linalg.norm(m, axis=1)[:, None] * radius) / _reach(m, longest)[:, None]
        bar = np.where(np.isnan(bar), -np.inf, bar)[:, None]
        return (np.isfinite(share) & (share + 1e-6 >= bar)).any(axis=0)

    first = search(queries.withColumn("bar", F.lit(None).cast("double")), nearest)
    bars = materialise(first.where(F.size("place") == k).select("qid", F.get("place", F.lit(k - 1)).alias("bar")), "bars")
    return search(queries.join(bars, "qid", "left"), passing)


VERSIONS = ("original", "rewritten")


def knn_pairs(queries: DataFrame, items: DataFrame, k: int, key: str, original: str, rewritten: str, **item_options) -> DataFrame:
    """(key, version, item_id, score, rank): the rows of ``knn_pair_lists``."""
    lists = knn_pair_lists(queries, items, k, key, original, rewritten, **item_options)
    rows = lists.select(key, "version", F.posexplode(F.arrays_zip("item_id", "score")).alias("_at", "_found"))
    return rows.select(key, "version", "_found.item_id", "_found.score", (F.col("_at") + 1).alias("rank"))


def knn_pair_lists(queries: DataFrame, items: DataFrame, k: int, key: str, original: str, rewritten: str, **item_options) -> DataFrame:
    """Candidates of both query versions in one search: (key, version, item_id,
    score), the last two as lists, best first. A null vector is a version that
    need not be searched."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(v).alias("version"), F.col(c).alias("vector")) for v, c in zip(VERSIONS, (original, rewritten))])
    )
    both = queries.select(F.col(key).alias("_key"), pairs.alias("p")).where("p.vector is not null")
    both = both.select(
        F.concat_ws("|", "p.version", F.col("_key").cast("string")).alias("qid"), "_key", "p.version", "p.vector"
    )
    lists = knn_lists(both, items, k, **item_options)
    name = F.split("qid", r"\|", 2)
    back = F.get(name, F.lit(1)).cast(queries.schema[key].dataType)
    return lists.select(back.alias(key), F.get(name, F.lit(0)).alias("version"), "item_id", "score")


def mark_relevant(ranked: DataFrame, relevance: DataFrame, key: str, item: str) -> DataFrame:
    """``relevant`` flag from (key, item) pairs."""
    pairs = relevance.select(key, item).distinct().withColumn("relevant", F.lit(True))
    return ranked.join(pairs, [key, item], "left").fillna(False, ["relevant"])


def relevant_counts(relevance: DataFrame, key: str, item: str) -> DataFrame:
    return relevance.select(key, item).distinct().groupBy(key).agg(F.count("*").alias("num_relevant"))


def hit_locations(ranked: DataFrame, key: str) -> DataFrame:
    """Rank of the first relevant candidate per version, 0 if none. Rows of one
    key are at most 2k."""
    def first(version: str) -> Column:
        hit = F.min(F.when((F.col("version") == version) & F.col("relevant"), F.col("rank")))
        return F.coalesce(hit, F.lit(0)).alias(f"{version}_rank")

    return ranked.groupBy(key).agg(*map(first, VERSIONS))


def hit_reward(original_rank: Column, rewritten_rank: Column, opt: HitOptions = HitOptions()) -> Column:
    miss = F.lit(opt.top_k + 1)
    o, r = (F.when(c > 0, c).otherwise(miss) for c in (original_rank, rewritten_rank))
    base = (F.ln(o) - F.ln(r)) / math.log(opt.top_k + 1)
    if opt.rank_margin > 0:
        base = F.when(F.abs(o - r) <= opt.rank_margin, 0.0).otherwise(base)
    bonus, drop = F.lit(0.0), F.lit(0.0)
    # widest stage first, so that the tightest one that applies decides; of
    # equal cutoffs the first listed decides
    for s in sorted(reversed(opt.stages), key=lambda s: -s.k):
        bonus = F.when(r <= s.k, float(s.bonus)).otherwise(bonus)
        drop = F.when((o <= s.k) & (r > s.k), float(s.drop)).otherwise(drop)
    total = base * float(opt.shaping_weight) + bonus - drop
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), total))


def dcg_sums(ranked: DataFrame, by: list[str], top_ks: tuple[int, ...]) -> DataFrame:
    """Gain per cutoff and number of candidates, one row per ranking."""
    gain = F.when(F.col("relevant"), 1.0 / F.log2(F.col("rank") + 1)).otherwise(0.0)
    sums = [F.sum(F.when(F.col("rank") <= k, gain).otherwise(0.0)).alias(f"dcg_{k}") for k in top_ks]
    return ranked.groupBy(*by).agg(F.count("*").alias("candidates"), *sums)


def ndcg(dcg: Column, candidates: Column, num_relevant: Column, k: int) -> Column:
    ideal_hits = F.least(num_relevant, F.lit(k), candidates).cast("int")
    sums, total = [0.0], 0.0
    for rank in range(1, k + 1):
        total += 1.0 / math.log2(rank + 1)
        sums.append(total)
    ideal = F.get(F.array(*map(F.lit, sums)), ideal_hits)
    return F.when(ideal > 0, dcg / ideal).otherwise(0.0)


def headroom_delta(original: Column, rewritten: Column, epsilon: float) -> Column:
    d = rewritten - original
    return F.when(d >= 0, d / ((1.0 - original) + epsilon)).otherwise(d / (original + epsilon))


def cached_ndcg(cache: Column, opt: NdcgOptions) -> Column:
    """True when a map of cutoff text -> nDCG has a finite number for every cutoff."""
    ok = cache.isNotNull()
    for k in opt.top_ks:
        v = F.try_element_at(cache, F.lit(str(k)))
        ok = ok & v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return F.coalesce(ok, F.lit(False))


def searched_versions(
    queries: DataFrame, opt: NdcgOptions, original: str, cache: str | None = None
) -> DataFrame:
    """Original vectors nulled where no search is needed: absolute mode, or a
    full cache. The search then skips them."""
    if opt.reward_mode == "absolute":
        return queries.withColumn(original, F.lit(None).cast(queries.schema[original].dataType))
    if cache is None:
        return queries
    return queries.withColumn(original, F.when(~cached_ndcg(F.col(cache), opt), F.col(original)))


def ndcg_rewards(
    ranked: DataFrame, totals: DataFrame, key: str, opt: NdcgOptions = NdcgOptions(), cache: str | None = None
) -> DataFrame:
    """nDCG reward per key. ``ranked`` has key, version, rank, relevant;
    ``totals`` has key, num_relevant and the cache map when one is named. Keys
    without a relevant item get null."""
    ranked = ranked.where(F.col("rank") <= max(opt.top_ks))
    sums = dcg_sums(ranked, [key, "version"], opt.top_ks)
    fields = ["candidates", *[f"dcg_{k}" for k in opt.top_ks]]
    wide = sums.groupBy(key).agg(
        *[F.max(F.when(F.col("version") == v, F.col(f))).alias(f"{v}_{f}") for v in VERSIONS for f in fields]
    )
    rows = totals.join(wide, key, "left")

    def score(version: str, k: int) -> Column:
        c = F.coalesce(F.col(f"{version}_candidates"), F.lit(0))
        return ndcg(F.coalesce(F.col(f"{version}_dcg_{k}"), F.lit(0.0)), c, F.col("num_relevant"), k)

    total = F.lit(0.0)
    for k, w in zip(opt.top_ks, opt.weights):
        new = score("rewritten", k)
        if opt.reward_mode == "relative":
            old = score("original", k)
            if cache is not None:
                stored = F.try_element_at(F.col(cache), F.lit(str(k)))
                old = F.when(cached_ndcg(F.col(cache), opt), stored).otherwise(old)
            new = headroom_delta(old, new, opt.epsilon)
        total = total + w * new
    clipped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), total))
    value = F.when(F.col("num_relevant") > 0, clipped)
    return rows.select(*totals.columns, value.alias("ndcg_reward"))


def _truth(df: DataFrame, key: str, query: str, truth: str, category: str) -> DataFrame:
    """(key, candidates) of the rows that a retrieval reward applies to: the
    category token, a query, and a truth text; lists in it are flattened."""
    applies = has_category_token(F.col(category), "retrieval") & (F.col(query) != "") & (F.col(truth) != "")
    return df.where(applies).select(key, string_list(F.col(truth)).alias("_truth"))


def _judged(ranked: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """Ranked candidates of the truth's keys, marked relevant or not."""
    pairs = truth.select(key, F.explode("_truth").alias("candidate"))
    return mark_relevant(ranked.join(truth.select(key), key, "left_semi"), pairs, key, "candidate")


def score_retrieval_hit(
    df: DataFrame,
    ranked: DataFrame,
    opt: HitOptions = HitOptions(),
    key: str = "id",
    query: str = "query",
    truth: str = "truth",
    category: str = "category",
    output: str = "retrieval_hit_reward",
) -> DataFrame:
    """Hit-rank reward of each row from the candidates (key, version, candidate,
    rank) that a search of its two query versions ranked. Null for rows of other
    categories and rows without a query or a truth; a row whose candidates are
    missing, or hold nothing true, is a double miss and scored as one."""
    asked = _truth(df, key, query, truth, category)
    hits = asked.select(key, F.explode("_truth").alias("candidate")).distinct().withColumn("relevant", F.lit(True))
    at = hit_locations(ranked.where(F.col("rank") <= opt.top_k).join(hits, [key, "candidate"]), key)
    scored = asked.select(key).join(at, key, "left").fillna(0, [f"{v}_rank" for v in VERSIONS])
    value = hit_reward(F.col("original_rank"), F.col("rewritten_rank"), opt)
    return df.join(scored.select(key, value.alias(output)), key, "left")


def score_retrieval_ndcg(
    df: DataFrame,
    ranked: DataFrame,
    opt: NdcgOptions = NdcgOptions(),
    key: str = "id",
    query: str = "query",
    truth: str = "truth",
    category: str = "category",
    cache: str | None = None,
    output: str = "retrieval_ndcg_reward",
) -> DataFrame:
    """nDCG reward of each row, from the same table. Null as well where the truth
    holds no item; rows without candidates score as if nothing was found."""
    asked = _truth(df, key, query, truth, category)
    totals = asked.select(key, F.size("_truth").cast("bigint").alias("num_relevant"))
    if cache is not None:
        totals = totals.join(df.select(key, cache), key)
    scored = ndcg_rewards(_judged(ranked, asked, key), totals, key, opt, cache)
    return df.join(scored.select(key, F.col("ndcg_reward").alias(output)), key, "left")
