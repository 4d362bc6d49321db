"""Best-fit packing of tokenised documents into sequences.

Vector best-fit: a sequence has a capacity of tokens, of documents, and of
attention cost (the sum of squared lengths). Pieces are placed from the longest to
the shortest, each into the sequence that it fits under every constraint and that
scores best: by the least weighted norm of what is left, or by the largest
weighted dot product of piece and room. Both are over shares of the capacities.

Pieces of one length are alike, so the plan is made on the histogram of lengths:
sequences in the same state form a class with consecutive numbers, and a length's
pieces go to whole classes at a time. There are at most as many lengths as a
sequence has tokens, so the plan is as small for any number of documents and is
the one that placing piece by piece would give. Spark numbers the pieces of each
length and looks their places up.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tunetables.llm.words import blocks
from tunetables.operators.staging import materialise

#: distinct space-separated strings whose ids a worker remembers before it starts afresh
MEMO = 900_000
#: pieces of one length that are numbered in one task
NUMBERED = 200_000


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence. A single piece may always stand alone."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.2)
    score: str = "norm"

    def __post_init__(self) -> None:
        if self.score not in ("norm", "dot") or min(self.tokens, self.documents, self.attention) < 1:
            raise ValueError("capacities are positive and the score is norm or dot")


@dataclass
class PackPlan:
    """For the pieces of a length in the order of their numbers, from ``rank``
    on: the sequence of the first, the next ones' following, and the offset."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for n in np.unique(length):
            own = np.flatnonzero(length == n)
            lo, hi = np.searchsorted(self.length, [n, n + 1])
            at = lo + np.searchsorted(self.rank[lo:hi], rank[own], "right") - 1
            sequence[own] = self.sequence[at] + rank[own] - self.rank[at]
            offset[own] = self.offset[at]
        return sequence, offset


def plan_packing(counts: dict[int, int], capacity: Capacity) -> PackPlan:
    """Vector best-fit decreasing over a histogram of piece lengths."""
    size = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    weight = np.array(capacity.weights)
    # classes of sequences: first number, how many, room left; full classes drop out
    first, many = np.zeros(0, np.int64), np.zeros(0, np.int64)
    room = np.zeros((0, 3), np.int64)
    opened = 0
    out: list[tuple[int, int, int, int]] = []
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        if length > capacity.tokens:
            raise ValueError("cut longer documents first")
        fits = np.flatnonzero((room >= need).all(axis=1)) if len(room) else np.zeros(0, np.int64)
        left = counts[length]
        rank = 0
        added: list[tuple[int, int, np.ndarray]] = []
        gone: list[int] = []
        share = (room[fits] - need) / size if capacity.score == "norm" else -(room[fits] / size) * (need / size)
        scores = ((share**2) @ weight) if capacity.score == "norm" else share @ weight
        for at in fits[np.argsort(scores, kind="stable")].tolist():
            if not left:
                break
            # as many as fit into each: a sequence only gets tighter and stays the best
            each = int(min((room[at] // need).min(), left))
            used = min(int(many[at]), left // each)
            for k in range(each):
                out.append((length, rank, int(first[at]), int(capacity.tokens - room[at, 0]) + k * length))
                rank += used
            added.append((int(first[at]), used, room[at] - each * need))
            left -= each * used
            start, rest = int(first[at]) + used, int(many[at]) - used
            if rest and left:  # fewer than ``each`` are left for one more
                for k in range(left):
                    out.append((length, rank + k, start, int(capacity.tokens - room[at, 0]) + k * length))
                rank += left
                added.append((start, 1, room[at] - left * need))
                start, rest, left = start + 1, rest - 1, 0
            if rest:
                first[at], many[at] = start, rest
            else:
                gone.append(at)
        if left:
            whole = np.array([capacity.tokens, capacity.documents, capacity.attention], np.int64)
            each = max(1, int((whole // need).min()))
            for part, used in ((each, left // each), (left % each, 1)):
                if part and used:
                    for k in range(part):
                        out.append((length, rank, opened, k * length))
                        rank += used
                    added.append((opened, used, np.maximum(whole - part * need, 0)))
                    opened += used
        keep = np.ones(len(first), bool)
        keep[gone] = False
        new = [(a, n, r) for a, n, r in added if r.min() > 0]
        first = np.concatenate([first[keep], np.array([a for a, _, _ in new], np.int64)])
        many = np.concatenate([many[keep], np.array([n for _, n, _ in new], np.int64)])
        room = np.concatenate([room[keep], np.array([r for *_, r in new], np.int64).reshape(-1, 3)])
    table = np.array(sorted(out), np.int64).reshape(-1, 4)
    return PackPlan(*table.T)


# letters that composing leaves alone; a sign between one of them and white space is a token of its own
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[{_LETTER}]+")
_SIGN = rf"([{_LETTER}])([.,;:!?|])(\s|$)"
#: plain words that the library gets as one text
JOINED = 2000


class _Words:
    """Ids of texts whose tokenizer drops white space and case: each space-separated
    string is encoded by the library on its own, and remembered. Plain words are
    given to it many at a time; their ids end where a token has the end-of-word mark."""

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for token, i in names.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encode(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of plain words in pieces, and how many each word has."""
        ids, sizes = [], [np.zeros(0, np.int64)]
        for i in range(0, len(words), JOINED):
            part = words[i : i + JOINED]
            (own,) = self._encode([" ".join(part)])
            cuts = np.flatnonzero(self.ends[own]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(own):
                ids.append(own)
                sizes.append(np.diff(cuts, prepend=0))
            else:
                each = self._encode(part)
                ids += each
                sizes.append(np.array([len(x) for x in each], np.int64))
        return ids, np.concatenate(sizes)

    def _learn(self, words: list[str]) -> None:
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > MEMO:
            self._forget()
            new = words
        plain = [w for w in new if _PLAIN.fullmatch(w)]
        other = [w for w in new if not _PLAIN.fullmatch(w)]
        ids, sizes = self._joined(plain)
        each = self._encode(other)
        sizes = np.concatenate([sizes, np.array([len(x) for x in each], np.int64)])
        self.words.update(zip([*plain, *other], range(len(self.size), len(self.size) + len(new)), strict=True))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, *ids, *each])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and each row's offsets among them."""
        texts = texts.cast(pa.large_string()).fill_null("")
        # fewer distinct strings, the same tokens: signs apart, and one case unless that could make a special token
        texts = pc.replace_substring_regex(texts, pattern=_SIGN, replacement=r"\1 \2\3")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        known = words.dictionary.to_pylist()
        self._learn(known)
        code = np.array([self.words[w] for w in known], np.int64)[words.indices.to_numpy(zero_copy_only=False)]
        n = self.size[code]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        tokens = self.flat[np.repeat(self.begin[code] - (ends - n), n) + np.arange(total)]
        offsets = lists.offsets.to_numpy()
        return tokens, np.concatenate([[0], ends])[offsets - offsets[0]]


@lru_cache(maxsize=2)
def _words(vocabulary: str) -> _Words:
    return _Words(vocabulary)


def pieces(df: DataFrame, vocabulary: str, tokens: int, end: int, id_col: str, text_col: str, with_ids: bool = False) -> DataFrame:
    """(id, row, piece, start, length, ids_crc32[, ids]) of every document: its ids
    and then ``end``, cut after each ``tokens`` ids. The vocabulary must drop white
    space, so that strings between it are encoded independently."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _words(vocabulary)
        for part in blocks(batches, limit=8 << 20):
            ids, at = coder.encode(part.column("text"))
            which, piece, start, length, crc, held = [], [], [], [], [], []
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                own = np.append(ids[a:b], np.uint32(end)).astype("<u4")
                for k, s in enumerate(range(0, len(own), tokens)):
                    cut = own[s : s + tokens]
                    which.append(i), piece.append(k), start.append(s), length.append(len(cut))
                    crc.append(zlib.crc32(cut.tobytes()))
                    if with_ids:
                        held.append(cut.view(np.int32))
            row = pa.array(which, pa.int64())
            columns = [part.column("id").take(row), part.column("row").take(row), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "row", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(held, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, row long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("row"), text.alias("text")).mapInArrow(run, schema)


def pack(cut: DataFrame, capacity: Capacity) -> DataFrame:
    """``cut`` with sequence_id and offset: pieces share sequences under every
    capacity, offsets are gapless. Needs the columns row, piece and length."""
    cut = materialise(cut, "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most capacity.tokens rows
    if not counts:
        return cut.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    plan = plan_packing(counts, capacity)
    spread = {n: -(-c // NUMBERED) for n, c in counts.items() if c > NUMBERED}
    parts = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in spread.items() for x in kv]), F.col("length")), F.lit(1)) if spread else F.lit(1)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("row", "piece"), parts.cast("long")))
    sizes = defaultdict(list)
    for r in salted.filter(F.col("length").isin(list(spread))).groupBy("length", "salt").count().orderBy("length", "salt").collect() if spread else []:
        sizes[r["length"]].append((r["salt"], r["count"]))
    # numbers before each salt of a length; a row per NUMBERED pieces at most
    before = {n: dict(zip([s for s, _ in x], np.cumsum([0, *[c for _, c in x]])[:-1].tolist(), strict=True)) for n, x in sizes.items()}
    names = cut.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy().astype(np.int64)
            if before:
                salt = batch.column("salt").to_numpy()
                rank = rank + np.array([before[n][s] if n in before else 0 for n, s in zip(length.tolist(), salt.tolist(), strict=True)], np.int64)
            sequence, offset = plan.place(length, rank)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row", "piece")) - 1
    numbered = salted.withColumn("rank", rank.cast("long"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return numbered.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(
    df: DataFrame, vocabulary: str, capacity: Capacity = Capacity(), end: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) for every
    piece of every row of ``df``. Null and empty texts are the end id alone. Rows
    that repeat are packed each; rows without an id are packed too. Other columns
    are not read; an empty table gives no rows."""
    cut = pieces(df, vocabulary, capacity.tokens, end, id_col, text_col, with_ids)
    return pack(cut, capacity).drop("row").withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from packed pieces with their ids: at most a capacity of
    tokens for a row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
