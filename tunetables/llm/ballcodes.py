"""Vectors as short codes: integer product quantisation by ball k-means.

A vector's parts are assigned to the entries of a codebook for each part, in rounds
that each end with new entries. The parts assigned to an entry are a ball around it.
Of two entries whose distance is more than twice a ball's radius the other can hold
nothing of the ball, so only neighbours are looked at. A part nearer to its entry
than half the way to the nearest neighbour lies in the stable core and stays. Other
parts lie in rings: the neighbours sorted by distance, those within twice the part's
own distance are its candidates, compared exactly.

Every number is a whole one, so results do not depend on how rows are dealt out.
Radii and sums are aggregated; a round writes rows with their codes, and the table
of the round before goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.operators.staging import materialise

#: candidates of a ring that are compared at once
RING = 16
#: largest component whose squared distances, summed, are exact
LARGEST = 1 << 27


@dataclass(frozen=True)
class Plan:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024

    def __post_init__(self) -> None:
        if not 1 <= self.entries <= 256 or min(self.parts, self.rounds + 1, self.scale) < 1:
            raise ValueError("1 to 256 entries, and positive parts, rounds and scale are needed")


@dataclass
class Codebook:
    """Entries (part, entry, component), and a bound of each ball's squared radius."""

    entries: np.ndarray
    reach: np.ndarray | None = None


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows of whole numbers, exact."""
    largest = max(int(np.abs(a).max(initial=0)) for a in (x, c))
    if x.shape[1] * (2 * largest) ** 2 < 1 << 53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in c], axis=1)


@dataclass
class Neighbours:
    """Of each entry: the others that its ball can touch, nearest first, and how far."""

    order: list[np.ndarray]
    far: list[np.ndarray]

    @classmethod
    def of(cls, entries: np.ndarray, reach: np.ndarray) -> Neighbours:
        between = distances(entries, entries)
        order, far = [], []
        for i in range(len(entries)):
            near = np.flatnonzero(between[i] <= 4 * reach[i])
            near = near[near != i]
            near = near[np.argsort(between[i][near], kind="stable")]
            order.append(near), far.append(between[i][near])
        return cls(order, far)


def reassign(x: np.ndarray, own: np.ndarray, entries: np.ndarray, near: Neighbours) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the lower one of equals, and its squared distance."""
    best = ((x - entries[own]) ** 2).sum(1)
    out = own.copy()
    order = np.argsort(own, kind="stable")
    ends = np.searchsorted(own[order], np.arange(len(entries) + 1))
    for i in range(len(entries)):
        rows = order[ends[i] : ends[i + 1]]
        if not len(rows) or not len(near.order[i]):
            continue
        ring = np.searchsorted(near.far[i], 4 * best[rows], "right")  # 0: the stable core
        for start in range(0, int(ring.max()), RING):
            open_ = rows[ring > start]
            candidates = np.sort(near.order[i][start : start + RING])
            d = distances(x[open_], entries[candidates])
            nth = d.argmin(1)  # the first of equals, so the lower entry
            d, entry = d[np.arange(len(open_)), nth], candidates[nth]
            better = (d < best[open_]) | (d == best[open_]) & (entry < out[open_])
            best[open_[better]], out[open_[better]] = d[better], entry[better]
    return out, best


def assign(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``reassign`` without an entry to start from: against every entry."""
    d = distances(x, entries)
    nth = d.argmin(1)
    return nth, d[np.arange(len(x)), nth]


class Totals:
    """Sums, counts and the largest squared distance of every entry's parts."""

    def __init__(self, shape: tuple[int, ...]):
        self.sums, self.n, self.far = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64), np.zeros(shape[:2], np.int64)

    def add(self, part: int, x: np.ndarray, own: np.ndarray, d: np.ndarray) -> None:
        np.add.at(self.sums[part], own, x)
        self.n[part] += np.bincount(own, minlength=self.n.shape[1])
        np.maximum.at(self.far[part], own, d)

    def rows(self) -> pa.RecordBatch:
        part, entry = np.nonzero(self.n)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * self.sums.shape[2]), pa.array(self.sums[part, entry].ravel()))
        return pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(self.n[part, entry]), sums, pa.array(self.far[part, entry])],
            ["part", "entry", "n", "sums", "far"],
        )


_TOTALS = "part int, entry int, n long, sums array<long>, far long"


def _filled(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """The batch with the schema's other columns as nulls."""
    columns = [batch.column(f.name).cast(f.type) if f.name in batch.schema.names else pa.nulls(batch.num_rows, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def run_round(rows: DataFrame, book: Codebook, last: bool, label: str) -> DataFrame:
    """Rows (id, label, q, code, error) with new codes, and rows of totals (part,
    entry, n, sums, far) that the tasks end with; the last round has no totals and
    keeps no vectors. Written."""
    entries, reach = book.entries, book.reach
    kinds = {f.name: f.dataType for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = None if reach is None else [Neighbours.of(e, r) for e, r in zip(entries, reach, strict=True)]
        totals, schema = Totals(entries.shape), None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            q = batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(n, len(entries), -1)
            if int(np.abs(q).max(initial=0)) > LARGEST:
                raise ValueError("components beyond 2**27 steps have no error that a long holds")
            codes, error = np.empty((n, len(entries)), np.uint8), np.zeros(n, np.int64)
            before = None if near is None else np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, -1)
            for p, own_entries in enumerate(entries):
                x = np.ascontiguousarray(q[:, p])
                own, d = assign(x, own_entries) if near is None else reassign(x, before[:, p].astype(np.int64), own_entries, near[p])
                totals.add(p, x, own, d)
                codes[:, p] = own
                error += d
            code = pa.array([c.tobytes() for c in codes], pa.binary())
            out = {"id": batch.column("id"), "label": batch.column("label"), "code": code, "error": pa.array(error)}
            if not last:
                out["q"] = batch.column("q")
            schema = schema or _schema(batch.schema, last)
            yield _filled(pa.RecordBatch.from_pydict(out), schema)
        if not last and schema is not None:
            yield _filled(totals.rows(), schema)

    base = f"id {kinds['id'].simpleString()}, label {kinds['label'].simpleString()}, code binary, error long"
    out = rows.mapInArrow(run, base if last else f"{base}, q array<long>, {_TOTALS}")
    return materialise(out, label)


def _schema(given: pa.Schema, last: bool) -> pa.Schema:
    own = [given.field("id"), given.field("label"), pa.field("code", pa.binary()), pa.field("error", pa.int64())]
    if last:
        return pa.schema(own)
    totals = [("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("far", pa.int64())]
    return pa.schema([*own, pa.field("q", pa.list_(pa.int64())), *(pa.field(n, t) for n, t in totals)])


def updated(book: Codebook, written: DataFrame) -> Codebook:
    """Entries at the floor of the mean of their parts; unused ones stay. Tasks'
    totals are summed by Spark, a number for every component of the codebook
    comes back. A ball's radius grows by no more than its entry moved."""
    totals = written.filter("part is not null").select("part", "entry", "n", "far", F.posexplode("sums").alias("at", "value"))
    whole = totals.groupBy("part", "entry", "at").agg(F.sum("value").alias("value"), F.sum("n").alias("n"), F.max("far").alias("far"))
    sums, n, far = np.zeros(book.entries.shape, np.int64), np.zeros(book.entries.shape[:2], np.int64), np.zeros(book.entries.shape[:2], np.int64)
    for r in whole.collect():  # parts x entries x components of a part
        sums[r.part, r.entry, r["at"]], n[r.part, r.entry], far[r.part, r.entry] = r.value, r.n, r.far
    used = n > 0
    entries = book.entries.copy()
    entries[used] = sums[used] // n[used][:, None]
    moved = ((entries - book.entries) ** 2).sum(2)
    reach = np.where(used, np.ceil((np.sqrt(far) + np.sqrt(moved)) ** 2 * (1 + 1e-9)) + 1, 0).astype(np.int64)
    return Codebook(entries, reach)


def drop(df: DataFrame) -> None:
    """Remove a table that ``materialise`` wrote and nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def digest(entries: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, entries.ravel().tolist())).encode()).hexdigest()


def whole_vectors(df: DataFrame, plan: Plan, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, q): vectors whose components are all there and finite, as
    floors of ``scale`` times their components."""
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    q = F.transform(vector_col, lambda x: F.floor(x.cast("double") * plan.scale).cast("long"))
    return df.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & fine).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), q.alias("q")
    )


def compress(
    df: DataFrame, plan: Plan = Plan(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"  # noqa: B008
) -> tuple[DataFrame, Codebook | None]:
    """((id, label, code, error), codebook): a byte per part, and the squared
    distance to the entries, of every vector that ``whole_vectors`` keeps.

    The codebook starts as the vectors of the smallest ids, null ids last and equal
    ids by their components; with fewer vectors than entries it is smaller. All
    vectors must be as long as the first of these, a multiple of ``parts``; others
    are dropped. Repeated rows are rows of their own; null labels are kept; other
    columns are not read. An empty table gives no rows and no codebook."""
    kept = materialise(whole_vectors(df, plan, id_col, vector_col, label_col), "vectors")
    order = [F.col("id").asc_nulls_last(), F.col("q")]
    fitting = kept.filter(F.size("q") % plan.parts == 0)
    head = fitting.orderBy(*order).limit(1).select(F.size("q")).collect()
    none = kept.select("id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    if not head:
        return none, None
    rows = fitting.filter(F.size("q") == head[0][0])
    start = np.array([r.q for r in rows.orderBy(*order).limit(plan.entries).select("q").collect()], np.int64)
    book = Codebook(np.ascontiguousarray(start.reshape(len(start), plan.parts, -1).swapaxes(0, 1)))
    held = kept
    for _ in range(plan.rounds):
        written = run_round(rows, book, False, "codes")
        book = updated(book, written)
        drop(held)
        held, rows = written, written.filter("part is null").select("id", "label", "q", "code")
    final = run_round(rows, book, True, "codes")
    drop(held)
    return final, book


def label_errors(codes: DataFrame) -> DataFrame:
    """The rows of ``compress`` with ``label_error``, the error summed over equal
    labels, nulls together. Labels are summed before anything moves; the sums
    are written, so that their join is planned by their size."""
    named = codes.withColumn("_none", F.col("label").isNull())
    totals = materialise(named.groupBy("label", "_none").agg(F.sum("error").alias("label_error")), "label-errors")
    right = totals.withColumnsRenamed({"label": "_label", "_none": "_gone"})
    return named.join(right, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_none") == F.col("_gone")), "left").drop("_label", "_none", "_gone")


def decompress(codes: DataFrame, book: Codebook, scale: int = 1024) -> DataFrame:
    """(id, vector): the vector that each code stands for. The codebook travels
    with the tasks; it has ``entries`` vectors at most."""
    entries = book.entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(batch.num_rows, len(entries))
            rows = np.concatenate([entries[p][code[:, p]] for p in range(len(entries))], axis=1) / scale
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(list(rows), pa.list_(pa.float64()))], ["id", "vector"])

    return codes.select("id", "code").mapInArrow(run, f"id {codes.schema['id'].dataType.simpleString()}, vector array<double>")
