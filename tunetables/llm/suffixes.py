"""Repeated long byte strings by a logarithmic family of sparse suffix arrays.

Of every window of ``length`` bytes, the position whose next few bytes (its gram)
hash lowest is its anchor; equal windows have it at the same place. Only suffixes
that start at anchors are indexed, about two in ``length``. An array holds them in
the order of the hash of their gram, which puts suffixes that begin alike side by
side, all that a scan for long matches asks of the order.

Texts come in batches. A batch gets its array, is merge-scanned against the
arrays of the family, and joins it as a level; levels of equal size are merged
before the next scan, so that a suffix is rewritten a logarithmic number of times.

Suffixes that meet in a scan are candidates. A suffix stands for the run of
windows that it anchors. If all suffixes of a beginning have the same run, byte
for byte, every window of it repeats. Otherwise the distinct runs are compared
window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.llm.tables import join_unique
from tunetables.llm.words import _BYTE, blocks, mix, powers, signed, text_bytes, word_bounds
from tunetables.operators.staging import materialise, stage_path

U = np.uint64
_B = 0xD1342543DE82EF95
_BINV = pow(_B, -1, 1 << 64)
#: low bits of a masked hash that hold a position; a longer text is cut into overlapping stretches
_AT = 24
_MASK = U((1 << _AT) - 1)
#: distinct runs with one beginning that a task compares; more are compared through a shuffle
RUNS = 20_000
RUN = "key long, lo int, hi int, fp long"
SUFFIX = "key long, uid long, lo int, hi int, fp long, at array<int>"


def gram_of(length: int) -> int:
    """Bytes of a gram: long enough to meet by chance rarely, short enough that a
    window has many."""
    return min(64, max(16, length // 6))


def sums_of(raw: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hash`` takes the hash of any span."""
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum(_BYTE[raw] * powers(len(raw), _B)[: len(raw)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(len(sums), _BINV)[start])


def window_anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of its least (the first, if equal)."""
    parts, step = [], int(_MASK) // 2
    for cut in range(0, len(grams) - width + 1, step):
        part = grams[cut : cut + step + width - 1]
        n = len(part)
        marked = np.full(-(-n // width) * width, np.iinfo(U).max, U)
        marked[:n] = (part & ~_MASK) | np.arange(n, dtype=U)
        rows = marked.reshape(-1, width)
        upto = np.minimum.accumulate(rows, axis=1).ravel()
        onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(onward[: n - width + 1], upto[width - 1 : n])
        parts.append((least & _MASK).astype(np.int64) + cut)
    return np.concatenate(parts)


def suffixes(texts: DataFrame, length: int) -> DataFrame:
    """(key, uid, lo, hi, fp, at) of (uid, text): the suffixes at the bytes ``at``
    begin with what ``key`` hashes and anchor the windows that start ``lo`` to
    ``hi`` bytes before them; ``fp`` hashes the bytes of that run of windows. A
    text that repeats itself has many suffixes alike: they are one row."""
    gram = gram_of(length)
    width = length - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            raw, at = text_bytes(part.column("text"))
            if len(raw) < length:
                continue
            sums = sums_of(raw)
            grams = mix((sums[gram:] - sums[:-gram]) * powers(len(sums), _BINV)[: len(raw) - gram + 1])
            rows, anchors, first, last = [], [], [], []
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                if b - a < length:
                    continue
                where = window_anchors(grams[a : b - gram + 1], width)
                new = np.flatnonzero(np.diff(where)) + 1
                starts = np.concatenate([[0], new])
                rows.append(np.full(len(starts), i))
                anchors.append(where[starts] + a)
                first.append(starts + a)
                last.append(np.concatenate([new, [len(where)]]) - 1 + a)
            if not rows:
                continue
            row, anchor, first, last = map(np.concatenate, (rows, anchors, first, last))
            columns = [row, grams[anchor], span_hash(sums, first, last + length), anchor - first, anchor - last]
            order = np.lexsort([anchor, *columns[::-1]])
            columns = [c[order] for c in columns]
            new = np.ones(len(order), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            starts = np.flatnonzero(new)
            row, key, fp, lo, hi = (c[starts] for c in columns)
            place = (anchor[order] - at[columns[0]]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)).astype(np.int32)), pa.array(place))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key)), part.column("uid").take(pa.array(row)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
                 pa.array(signed(fp)), lists],
                ["key", "uid", "lo", "hi", "fp", "at"],
            )

    return texts.mapInArrow(run, SUFFIX)


@dataclass
class Family:
    """Levels of sorted suffix arrays, each a written table with the number of
    batches in it; they outlive the batches, so a crawl can go on."""

    spark: SparkSession
    levels: list[tuple[int, str]] = field(default_factory=list)
    hits: list[DataFrame] = field(default_factory=list)

    def _write(self, rows: DataFrame) -> str:
        path = stage_path(self.spark, "suffix-array")
        rows.repartition(F.col("key")).sortWithinPartitions("key").write.parquet(path)
        return path

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(SUFFIX).parquet(path)

    def add(self, batch: DataFrame) -> None:
        """Index a batch of suffixes, and scan it for beginnings that it has twice
        or shares with a level."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * n, self._write(self._read(a).unionByName(self._read(b)))))
        path = self._write(batch)
        own = self._read(path).groupBy("key").agg(F.sum(F.size("at")).alias("n"))
        found = [own.filter("n > 1").select("key")]
        for _, level in self.levels:
            found.append(own.select("key").join(self._read(level).select("key").distinct(), "key"))
        for keys in found:
            self.hits.append(materialise(keys, "hits"))
        self.levels.append((1, path))

    def candidates(self) -> DataFrame:
        """The suffixes of all levels whose beginning some scan met."""
        keys = self.hits[0]
        for more in self.hits[1:]:
            keys = keys.unionByName(more)
        keys = materialise(keys.distinct(), "hits")
        every = self._read(self.levels[0][1])
        for _, path in self.levels[1:]:
            every = every.unionByName(self._read(path))
        return join_unique(every, keys, ["key"])


def window_hashes(contexts: list[bytes], lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of some runs: the run's index, the distance ``back`` from
    the window's start to the anchor, and the hash of its bytes."""
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    sums, counts = sums_of(raw), (lo - hi + 1).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])[:-1]
    run = np.repeat(np.arange(len(contexts)), counts)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = begin[run] + nth
    return run, lo[run] - nth, span_hash(sums, start, start + length)


def spans(run: np.ndarray, nth: np.ndarray, length: int, n: int) -> list[list[dict]]:
    """Per run, the byte spans that marked windows cover, from the run's start."""
    out: list[list[dict]] = [[] for _ in range(n)]
    if len(run):
        cut = np.flatnonzero((np.diff(run) != 0) | (np.diff(nth) != 1)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(run)], strict=True):
            out[run[a]].append({"s": int(nth[a]), "e": int(nth[b - 1]) + length})
    return out


_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def compare_runs(runs: DataFrame, length: int) -> DataFrame:
    """(key, lo, hi, fp, spans) for distinct runs (key, lo, hi, fp, n, context):
    the spans of a run, from its start, whose windows occur more than once."""

    def settle(rows: pa.Table) -> pa.RecordBatch:
        lo, hi = rows.column("lo").to_numpy().astype(np.int64), rows.column("hi").to_numpy().astype(np.int64)
        key, many = rows.column("key").to_numpy().view(U), rows.column("n").to_numpy() > 1
        run, back, hashes = window_hashes(rows.column("context").to_pylist(), lo, hi, length)
        same = mix(hashes + mix(key[run] + back.astype(U) * U(_B)))
        _, inverse, counts = np.unique(same, return_inverse=True, return_counts=True)
        marked = np.flatnonzero((counts[inverse] > 1) | many[run])
        found = spans(run[marked], lo[run[marked]] - back[marked], length, rows.num_rows)
        return pa.RecordBatch.from_arrays(
            [rows.column(c).combine_chunks() for c in ("key", "lo", "hi", "fp")] + [pa.array(found, _SPANS)], ["key", "lo", "hi", "fp", "spans"]
        )

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            ends = np.flatnonzero(np.diff(batch.column("key").to_numpy())) + 1
            cut = int(ends[-1]) if len(ends) else 0
            if cut and sum(b.nbytes for b in held) + batch.slice(0, cut).nbytes > 4 << 20:
                yield settle(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, batch = [], batch.slice(cut)  # a key never lies in two comparisons
            held.append(batch)
        if held:
            yield settle(pa.Table.from_batches(held))

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                lo, hi = part.column("lo").to_numpy().astype(np.int64), part.column("hi").to_numpy().astype(np.int64)
                run, back, hashes = window_hashes(part.column("context").to_pylist(), lo, hi, length)
                at = pa.array(run)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(at) for c in ("key", "lo", "hi", "fp", "n")] + [pa.array(back.astype(np.int32)), pa.array(signed(hashes))],
                    ["key", "lo", "hi", "fp", "n", "back", "h"],
                )

    def join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lo, backs in zip(batch.column("lo").to_pylist(), batch.column("backs").to_pylist(), strict=True):
                nth = np.sort(lo - np.array(backs))
                found.append(spans(np.zeros(len(nth), np.int64), nth, length, 1)[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("key", "lo", "hi", "fp")] + [pa.array(found, _SPANS)], ["key", "lo", "hi", "fp", "spans"]
            )

    schema = f"{RUN}, spans array<struct<s: int, e: int>>"
    sizes = materialise(runs.groupBy("key").agg(F.count("*").alias("runs")), "run-counts")
    large = sizes.filter(F.col("runs") > RUNS).select("key")
    placed = runs if not large.head(1) else join_unique(runs, sizes, ["key"])
    small = placed if not large.head(1) else placed.filter(F.col("runs") <= RUNS)
    out = small.select("key", "lo", "hi", "fp", "n", "context").repartition(F.col("key")).sortWithinPartitions("key").mapInArrow(near, schema)
    if large.head(1):
        every = materialise(
            placed.filter(F.col("runs") > RUNS).select("key", "lo", "hi", "fp", "n", "context").mapInArrow(far, f"{RUN}, n long, back int, h long"), "windows"
        )
        twice = every.groupBy("key", "back", "h").agg(F.sum("n").alias("m")).filter("m > 1").select("key", "back", "h")
        marked = every.join(twice, ["key", "back", "h"])
        lists = marked.groupBy("key", "lo", "hi", "fp").agg(F.collect_set("back").alias("backs"))
        out = out.unionByName(lists.mapInArrow(join_spans, schema))
    return out


def repeated_passages(texts: DataFrame, words: int, length: int) -> DataFrame:
    """(uid, spans) of (uid, text): the byte spans covered by ``words`` words that
    also stand elsewhere, with the same white space between them, in fewer than
    ``length`` bytes. Only passages of short words are so short, so few are hashed;
    those of one text that are alike are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            raw, at = text_bytes(part.column("text"))
            starts, ends = word_bounds(raw, at)
            if len(starts) < words:
                continue
            row = np.searchsorted(at, starts, "right") - 1
            last = len(starts) - words + 1
            near = np.flatnonzero((row[:last] == row[words - 1 :]) & (ends[words - 1 :] - starts[:last] < length))
            held: dict[tuple[int, bytes], list[list[int]]] = {}
            counts: dict[tuple[int, bytes], int] = {}
            for i, s, e in zip(row[near].tolist(), starts[near].tolist(), ends[near + words - 1].tolist(), strict=True):
                key = i, xxhash.xxh3_128_digest(raw[s:e])
                counts[key] = counts.get(key, 0) + 1
                s, e = s - int(at[i]), e - int(at[i])
                own = held.setdefault(key, [])
                if own and s <= own[-1][1]:
                    own[-1][1] = e
                else:
                    own.append([s, e])
            if held:
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid").take(pa.array([i for i, _ in held])), pa.array([h for _, h in held], pa.binary()),
                     pa.array([counts[k] for k in held], pa.int64()), pa.array([[{"s": s, "e": e} for s, e in x] for x in held.values()], _SPANS)],
                    ["uid", "h", "n", "spans"],
                )

    found = materialise(texts.mapInArrow(run, "uid long, h binary, n long, spans array<struct<s: int, e: int>>"), "passages")
    twice = found.groupBy("h").agg(F.sum("n").alias("m")).filter("m > 1").select("h")
    return join_unique(found, materialise(twice, "passages-twice"), ["h"]).select("uid", "spans")


def repeated_spans(
    df: DataFrame, length: int, batches: int, id_col: str, text_col: str, whole: bool = False, words: int | None = None
) -> DataFrame:
    """(uid, id, rest, n_bytes, text, sha, spans) for each row of ``df``: the byte
    spans covered by a ``length``-byte string that also starts elsewhere, and with
    ``words`` those covered by so many words that do, however short. Rows
    without any have their text's digest in ``sha`` and, unless ``whole``, a null
    text. ``rest`` has the row's other columns if ``whole``."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    others = F.struct(*[F.col(c) for c in df.columns if c not in (id_col, text_col)]) if whole and len(df.columns) > 2 else F.lit(None)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("given"), text.alias("text"), others.alias("rest")).withColumn(
        "uid", F.xxhash64("id", "text")
    )
    family = Family(spark)
    for i in range(batches):
        family.add(suffixes(docs.filter(F.pmod("uid", F.lit(batches)) == i).filter(F.octet_length("text") >= length).select("uid", "text"), length))
    met = materialise(family.candidates(), "candidates")
    stats = met.groupBy("key").agg(
        F.min(F.struct("lo", "hi", "fp")).alias("least"), F.max(F.struct("lo", "hi", "fp")).alias("most")
    ).select("key", (F.col("least") != F.col("most")).alias("mixed"))
    known = join_unique(met, materialise(stats, "beginnings"), ["key"])
    per_text = known.groupBy("uid").agg(
        F.flatten(F.transform(
            F.collect_set(F.when(~F.col("mixed"), F.struct("lo", "hi", "at"))),
            lambda x: F.transform(x["at"], lambda p: F.struct((p - x["lo"]).alias("s"), (p - x["hi"] + length).alias("e"))),
        )).alias("sure"),
        F.collect_set(F.when(F.col("mixed"), F.struct("key", "lo", "hi", "fp", "at"))).alias("open"),
    )
    joined = docs.join(materialise(per_text, "texts-met"), "uid", "left")
    touched = F.col("sure").isNotNull()
    rows = joined.select(
        "uid", "id", F.octet_length("text").cast("long").alias("n_bytes"), (F.col("given") if whole else F.when(touched, F.col("text"))).alias("text"),
        F.when(~touched, F.sha2("text", 256)).alias("sha"), "sure", "open", *(["rest"] if whole else []),
    )
    # in buckets of the uid, so that the text is shuffled once
    name, buckets = f"rows_{stage_path(spark, 'x').rsplit('-', 1)[1]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, "uid").option("path", stage_path(spark, "rows")).saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"drop table {name}")  # the name only: the files lie under the path and are read from there
    members = rows.select("uid", F.explode("open").alias("o"), "text").select("uid", "o.*", "text").withColumn(
        "context", F.substring(F.encode("text", "UTF-8"), F.get("at", 0) - F.col("lo") + 1, F.col("lo") - F.col("hi") + length)
    )
    runs = materialise(
        members.groupBy("key", "lo", "hi", "fp").agg(F.sum(F.size("at")).alias("n"), F.first("context").alias("context")), "runs"
    )
    settled = materialise(compare_runs(runs, length).filter(F.size("spans") > 0), "settled")
    owners = materialise(rows.select("uid", F.explode("open").alias("o")).select("uid", "o.*"), "owners")
    moved = F.transform("at", lambda p: F.transform("spans", lambda x: F.struct((x["s"] + p - F.col("lo")).alias("s"), (x["e"] + p - F.col("lo")).alias("e"))))
    found = join_unique(owners, settled, ["key", "lo", "hi", "fp"]).select("uid", F.flatten(moved).alias("spans"))
    if words:
        found = found.unionByName(repeated_passages(docs.filter(F.octet_length("text") >= 2 * words - 1).select("uid", "text"), words, length))
    per_text = found.groupBy("uid").agg(F.flatten(F.collect_set("spans")).alias("found"))
    none = F.array().cast("array<struct<s: int, e: int>>")
    return rows.join(per_text, "uid", "left").select(
        "uid", "id", "n_bytes", "text", "sha", *(["rest"] if whole else []),
        F.array_sort(F.concat(F.coalesce("sure", none), F.coalesce("found", none))).alias("spans"),
    )


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for x in spans:  # sorted by start
        if out and x["s"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], x["e"])
        else:
            out.append([x["s"], x["e"]])
    return [(s, e) for s, e in out]


def remove_repeats(
    df: DataFrame, length: int = 400, batches: int = 3, id_col: str = "doc_id", text_col: str = "text", whole: bool = False
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept, removed) for each row of
    ``df``: every byte covered by a ``length``-byte string that also starts anywhere
    else is removed, judged on the input; ``kept`` holds the remaining bytes of the
    touched texts (null: the text is whole) and ``removed`` the (s, e) spans. With
    ``whole`` there is a ``text`` too: that of every row without the characters that
    lie wholly in the spans, null if it was null.

    Null texts are empty. Equal rows repeat each other like any two texts. Other
    columns are not read; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, count, sha, kept, where, texts = [], [], [], [], [], []
            for text, digest, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "sha", "spans")), strict=True):
                merged = _merged(spans)
                removed.append(sum(e - s for s, e in merged))
                count.append(len(merged))
                where.append([{"s": s, "e": e} for s, e in merged])
                if digest is not None or text is None:
                    sha.append(digest), kept.append(None), texts.append(text)
                    continue
                raw, at, parts = text.encode(), 0, []
                for s, e in merged:
                    parts.append(raw[at:s])
                    at = e
                parts.append(raw[at:])
                left = b"".join(parts)
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left if merged else None)
                texts.append(whole_characters(raw, merged).decode() if whole else None)
            columns = [batch.column("id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
                       pa.array(sha, pa.string()), pa.array(kept, pa.binary()), pa.array(where, _SPANS), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns[: len(names)], names)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, removed array<struct<s: int, e: int>>"
    schema += ", text string" if whole else ""
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "removed", *(["text"] if whole else [])]
    found = repeated_spans(df.select(id_col, text_col), length, batches, id_col, text_col, whole)
    return found.select("id", "n_bytes", "text", "sha", "spans").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """UTF-8 bytes without the characters that lie wholly in the spans."""
    at, parts = 0, []
    for s, e in spans:
        while s < e and raw[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(raw) and raw[e] & 0xC0 == 0x80:
            e -= 1
        parts.append(raw[at:s])
        at = e
    return b"".join([*parts, raw[at:]])


def cut_texts(
    df: DataFrame, length: int = 400, batches: int = 3, id_col: str = "doc_id", text_col: str = "text", words: int | None = None
) -> DataFrame:
    """The rows of ``df``, their texts without the characters that lie wholly in
    repeated spans, and ``n_removed`` characters. Null texts stay null. With
    ``words``, a passage of so many words is a repeat at any length in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                kept = text
                if text is not None and spans:
                    kept = whole_characters(text.encode(), _merged(spans)).decode()
                texts.append(kept)
                removed.append(len(text or "") - len(kept or ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(texts, pa.string()), batch.column("rest"), pa.array(removed, pa.int64())], ["id", "text", "rest", "n_removed"]
            )

    found = repeated_spans(df, length, batches, id_col, text_col, whole=True, words=words).select("id", "text", "rest", "spans")
    kinds = {f.name: f.dataType.simpleString() for f in found.schema.fields}
    cut = found.mapInArrow(run, f"id {kinds['id']}, text string, rest {kinds['rest']}, n_removed long")
    return cut.select(*[
        F.col({id_col: "id", text_col: "text"}[c]).alias(c) if c in (id_col, text_col) else F.col("rest").getField(c).alias(c) for c in df.columns
    ], "n_removed")
