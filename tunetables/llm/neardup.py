"""Near-duplicate documents by MinHash with sequential Bayesian verification.

1. Every text becomes its set of word shingles (64-bit hashes), a MinHash
   signature and band keys, in one pass. Documents with equal sets form a class;
   only the class's smallest id goes on.
2. Documents that share a band key are candidates. A bucket links its members to
   one pivot, the member that shares most buckets, so candidates grow with a
   bucket, not with its square.
3. Signatures of a pair are compared a batch at a time. After each batch the
   posterior of the similarity (uniform prior, Beta) prunes the pair if reaching
   the threshold is less probable than ``miss``.
4. Survivors are compared on their full sets.
5. Links make components. Buckets whose members still lie in several components
   get all their remaining pairs compared in the same way, block against block,
   inside tasks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.llm.tables import components, join_unique
from tunetables.llm.words import blocks, mix, shingles, signed, word_hashes
from tunetables.operators.staging import materialise

U = np.uint64
#: signature values compared before the posterior is looked at again
BATCH = 32
#: members of a bucket that are compared with each other at once
BLOCK = 400


@dataclass(frozen=True)
class Plan:
    """Shingle length in words, similarity in hundredths, rows of a band, and the
    probability at which a true pair may be missed by bands or pruned."""

    size: int = 5
    percent: int = 80
    rows: int = 5
    miss: float = 1e-6

    @property
    def bands(self) -> int:
        s = self.percent / 100
        return math.ceil(math.log(self.miss) / math.log1p(-(s**self.rows)))

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


@lru_cache(maxsize=8)
def multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 63, n, dtype=U) * U(2) + U(1)


def signature(hashes: np.ndarray, n: int) -> np.ndarray:
    """The minima of n permutations of a non-empty set, block by block."""
    by, least = multipliers(n)[:, None], np.full(n, np.iinfo(U).max, U)
    for i in range(0, len(hashes), 2048):
        least = np.minimum(least, (hashes[None, i : i + 2048] * by).min(axis=1))
    return least


def cuts(percent: int, total: int, miss: float) -> list[tuple[int, int]]:
    """(values compared, least matches) of each batch: with fewer matches the
    posterior probability of the threshold, P(Binomial(n + 1, t) <= matches), is
    below ``miss``."""
    t, out = percent / 100, []
    for n in [*range(BATCH, total, BATCH), total]:
        logs = [
            math.lgamma(n + 2) - math.lgamma(k + 1) - math.lgamma(n + 2 - k) + k * math.log(t) + (n + 1 - k) * math.log1p(-t)
            for k in range(n + 2)
        ]
        below = np.cumsum(np.exp(logs))
        out.append((n, int(np.searchsorted(below, miss))))
    return out


def survivors(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Indices of the signature pairs that no batch prunes."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, least in steps:
        matches = matches + (a[alive, done:n] == b[alive, done:n]).sum(axis=1)
        kept = matches >= least
        alive, matches, done = alive[kept], matches[kept], n
        if not len(alive):
            break
    return alive


def sketch(df: DataFrame, plan: Plan, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, same, sig, bands): ``same`` digests the full set; the last
    two are null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            sets = shingles(*word_hashes(part.column("text")), plan.size)
            same, sig, bands = [], [], []
            for s in sets:
                if len(s):
                    full = signature(s, plan.hashes)
                    rows = full.reshape(plan.bands, plan.rows)
                    key = np.arange(plan.bands, dtype=U)
                    for j in range(plan.rows):
                        key = mix(key + rows[:, j])
                    same.append(xxhash.xxh3_128_digest(s))
                    # a minimum's high bits are small in large sets, whatever the sets
                    sig.append((mix(full) & U(0xFFFF)).astype("<u2").tobytes())
                    bands.append(signed(key))
                else:
                    same.append(None), sig.append(None), bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(same, pa.binary()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                ],
                ["id", "n_shingles", "same", "sig", "bands"],
            )

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, n_shingles long, same binary, sig binary, bands array<long>"
    )


def full_sets(df: DataFrame, size: int) -> DataFrame:
    """(id, shingles) of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            sets = [signed(s) for s in shingles(*word_hashes(part.column("text")), size)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    return df.mapInArrow(run, "id long, shingles array<long>")


def posterior_filter(pairs: DataFrame, sigs: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) that sequential verification keeps."""
    steps = cuts(plan.percent, plan.hashes, plan.miss)
    width = plan.hashes * 2

    def read(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, plan.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, max(1, (8 << 20) // width)):
                part = batch.slice(i, max(1, (8 << 20) // width))
                kept = survivors(read(part.column("sa")), read(part.column("sb")), steps)
                yield part.select(["a", "b"]).take(pa.array(kept))

    with_a = pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a")
    with_b = with_a.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
    return with_b.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def exact_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b"
    )
    shared = F.size(F.array_intersect("x", "y"))
    return (
        both.withColumn("shared", shared)
        .filter(100 * F.col("shared") >= percent * (F.size("x") + F.size("y") - F.col("shared")))
        .select("a", "b")
    )


def block_links(members: DataFrame, sigs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Links between different components of the same bucket. ``members``: (key,
    n, id, root). The rows outside a bucket's largest component (the minor ones)
    are compared with all its rows, a block of minor rows against a block of all
    rows in a task. A first pass over signatures leaves the rows of each pair of
    blocks that have an unpruned partner; these get their full sets and are
    verified where they lie, so that no pair is ever a row of a table. Components
    that a task has linked are not compared again in it."""
    steps = cuts(plan.percent, plan.hashes, plan.miss)
    by_root = members.groupBy("key", "root").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    main = by_root.groupBy("key").agg(F.max(F.struct("c", "root")).alias("m"), F.first("n").alias("_all")).select(
        "key", F.col("m.root").alias("main"), F.ceil((F.col("_all") - F.col("m.c")) / BLOCK).cast("int").alias("minors"),
        F.ceil(F.col("_all") / (4 * BLOCK)).cast("int").alias("parts"),
    )
    placed = join_unique(members, materialise(main, "main"), ["key"])

    def dealt(rows: DataFrame, own: str, other: str, count: str) -> DataFrame:
        return rows.withColumn(own, F.pmod(F.xxhash64("id"), {"i": "minors", "j": "parts"}[own]).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(count) - 1))
        ).select("key", "i", "j", "id", "root", F.lit(own == "i").alias("minor"))

    copies = dealt(placed.filter("root <> main"), "i", "j", "parts").unionByName(dealt(placed, "j", "i", "minors"))

    def partners(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
        """Each minor row with the rows of other components that no batch prunes."""
        roots = table.column("root").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u2").reshape(-1, plan.hashes)
        minor = table.column("minor").to_numpy(zero_copy_only=False)
        right = np.flatnonzero(~minor)
        for x in np.flatnonzero(minor).tolist():
            fit = right[roots[right] != roots[x]]
            kept = fit[survivors(np.broadcast_to(sig[x], (len(fit), plan.hashes)), sig[fit], steps)]
            if len(kept):
                yield x, kept

    def likely(table: pa.Table) -> pa.Table:
        met = np.zeros(table.num_rows, bool)
        for x, kept in partners(table):
            met[x] = True
            met[kept] = True
        return table.filter(pa.array(met)).select(["key", "i", "j", "id", "root", "minor"])

    def verify(table: pa.Table) -> pa.Table:
        ids, roots = table.column("id").to_pylist(), table.column("root").to_pylist()
        full = [np.array(s.as_py(), np.int64) for s in table.column("shingles")]
        head: dict[int, int] = {}

        def find(r: int) -> int:
            while r in head:
                r = head[r]
            return r

        links = []
        for x, kept in partners(table):
            for y in kept.tolist():
                a, b = find(roots[x]), find(roots[y])
                if a == b:
                    continue
                shared = len(np.intersect1d(full[x], full[y], assume_unique=True))
                if 100 * shared >= plan.percent * (len(full[x]) + len(full[y]) - shared):
                    links.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                    head[max(a, b)] = min(a, b)
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    rows = copies.join(sigs, "id").groupBy("key", "i", "j")
    met = materialise(rows.applyInArrow(likely, "key long, i int, j int, id long, root long, minor boolean"), "unpruned")
    return met.join(sigs, "id").join(sets, "id").groupBy("key", "i", "j").applyInArrow(verify, "a long, b long").distinct()


def near_duplicates(df: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``df``.

    Null and empty texts, and texts without words, have an empty set, are their
    own component and are kept. Rows that repeat an id are one document: their
    sets are linked through it. A row without an id is returned with a null
    component and kept true. Other columns are not read; an empty table gives no
    rows. A component's smallest id is the one kept."""
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketches = materialise(sketch(texts, plan, "id", "text"), "sketch")
    filled = sketches.filter("same is not null and id is not null")
    # a class of equal sets stands behind its smallest id
    classes = materialise(
        filled.groupBy("same").agg(F.min("id").alias("rep"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "classes"
    )
    reps = classes.select(F.col("rep").alias("id"), "sig", "bands")
    spread = reps.select(F.explode("bands").alias("key"), "id")
    shared = materialise(spread.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    members = materialise(spread.join(shared, "key"), "members")
    # the pivot is the member that meets most others over all its buckets
    degree = members.groupBy("id").agg(F.sum("n").alias("degree"))
    pivots = materialise(
        members.join(degree, "id").groupBy("key").agg(F.max(F.struct("degree", F.negative("id").alias("back"))).alias("p")).select(
            "key", F.negative("p.back").alias("pivot")
        ), "pivots"
    )
    stars = join_unique(members.select("key", "id"), pivots, ["key"]).filter("id <> pivot")
    pairs = materialise(stars.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct(), "pairs")
    wanted = materialise(members.select("id").distinct(), "wanted")
    sigs = materialise(reps.join(wanted, "id", "left_semi").select("id", "sig"), "sigs")
    sets = materialise(full_sets(texts.join(wanted, "id", "left_semi"), plan.size).distinct(), "sets")
    likely = materialise(posterior_filter(pairs, sigs, plan).distinct(), "likely")
    links = materialise(exact_links(likely, sets, plan.percent).distinct(), "links")
    first = components(links)

    # what the stars leave open: buckets of three or more, in several components
    labelled = materialise(
        members.filter("n > 2").join(first, F.col("id") == F.col("node"), "left").select(
            "key", "n", "id", F.coalesce("root", "id").alias("root")
        ), "labelled"
    )
    split = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    unsure = materialise(join_unique(labelled, materialise(split, "split"), ["key"]), "open")
    more = block_links(unsure, sigs, sets, plan) if unsure.head(1) else links.limit(0)

    # rows that repeat an id with another set
    several = filled.groupBy("id").agg(F.min("same").alias("lo"), F.max("same").alias("hi")).filter("lo <> hi").select("id")
    same_id = filled.join(several, "id").select("id", "same").join(classes.select("same", "rep"), "same").select(
        F.col("id").alias("a"), F.col("rep").alias("b")
    )
    rest = materialise(more.unionByName(same_id), "links")
    stars = first.select(F.col("node").alias("a"), F.col("root").alias("b"))
    found = components(stars.unionByName(rest)) if rest.head(1) else first
    class_root = classes.join(found, F.col("rep") == F.col("node"), "left").select("same", F.coalesce("root", "rep").alias("root"))
    rows = materialise(filled.select("id", "n_shingles", "same"), "rows")
    joined = join_unique(rows, materialise(class_root, "class_roots"), ["same"]).select("id", "n_shingles", "root")
    alone = sketches.filter("same is null or id is null").select("id", "n_shingles", F.col("id").alias("root"))
    return joined.unionByName(alone).select(
        F.col("id").alias(id_col), "n_shingles", F.col("root").alias("component_id"),
        F.coalesce(F.col("id") == F.col("root"), F.lit(True)).alias("kept"),
    )
