"""Fill-in-the-middle documents: whole units are moved behind marked borders.

A document has n units (lines, or code points). Its cuts are numbers of units, so
what is needed of a text is how many units it has and where the k-th one ends. Texts
are cut into chunks where a rolling hash of the last 16 bytes says so: the same
passage gives the same chunks wherever it stands. What a chunk holds (marks, their
places, code points) is summarised once and remembered under the digest of its bytes;
a chunk found again is compared with the remembered bytes before its summary is used.
Running totals over a document's chunks tell which chunk holds a cut, and that
chunk's places tell where.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.llm.words import blocks, text_bytes

#: sizes of a chunk in bytes: none is shorter (but for a text's last), none longer, and the mean beyond the shortest
LEAST, MOST, MEAN = 256, 8192, 1024
#: bytes of chunks that a worker remembers; the ones not met for longest go first
MEMO_BYTES = 32 << 20

_GEAR = np.random.default_rng(20260101).integers(0, 1 << 32, 256, dtype=np.uint32)


@dataclass(frozen=True)
class Plan:
    """How documents are cut. ``rate`` and ``spm`` are percentages: of documents
    that are transformed, and of those that have the suffix first."""

    seed: int = 7
    unit: str = "line"
    rate: int = 100
    spm: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        if self.unit not in ("line", "char"):
            raise ValueError("a unit is a line or a char")
        marks = (self.prefix, self.suffix, self.middle)
        if not all(marks) or len(set(marks)) < 3:
            raise ValueError("three different marks are needed")
        for a in marks:
            for b in marks:
                # else the end of one piece and the start of a mark could look like a mark
                if any(a.endswith(b[:k]) for k in range(1, len(b) + (a != b))) or (a != b and b in a):
                    raise ValueError("no mark may end as another begins")


@dataclass(frozen=True)
class Summary:
    """Of a chunk's bytes: offsets of its marks, and its code points."""

    marks: np.ndarray
    codes: int


def code_points(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def summarise(raw: np.ndarray, unit: str) -> Summary:
    """Marks are line feeds, or the first bytes of code points."""
    marks = np.flatnonzero(raw == 10 if unit == "line" else (raw & 0xC0) != 0x80).astype(np.int32)
    return Summary(marks, code_points(raw))


class Memo:
    """Summaries by the bytes of a chunk, within ``MEMO_BYTES``."""

    def __init__(self, unit: str, limit: int = MEMO_BYTES):
        self.unit, self.limit = unit, limit
        self.held: OrderedDict[int, tuple[bytes, Summary]] = OrderedDict()
        self.size = self.hits = self.misses = 0

    def summary(self, raw: np.ndarray) -> Summary:
        key, content = xxhash.xxh3_64_intdigest(raw), raw.tobytes()
        known = self.held.get(key)
        if known is not None and known[0] == content:
            self.hits += 1
            self.held.move_to_end(key)
            return known[1]
        self.misses += 1
        made = summarise(raw, self.unit)
        if known is None:  # of two chunks with one digest the first is remembered
            self.held[key] = content, made
            self.size += len(content) + made.marks.nbytes
            while self.size > self.limit and len(self.held) > 1:
                _, (old, gone) = self.held.popitem(last=False)
                self.size -= len(old) + gone.marks.nbytes
        return made


def border_candidates(raw: np.ndarray) -> np.ndarray:
    """Places whose last 16 bytes hash below the cut, one in ``MEAN``."""
    h = _GEAR[raw]
    for k in (1, 2, 4, 8):  # sums of 2, 4, 8, 16 shifted bytes
        h[k:] += h[:-k] << np.uint32(k)
    return np.flatnonzero((h >> np.uint32(8)) % np.uint32(MEAN) == 0) + 1


def chunk_ends(candidates: list[int], start: int, stop: int) -> list[int]:
    """Ends of the chunks of one text between two places of a block."""
    ends, at = [], start
    while stop - at > LEAST:
        nth = bisect_left(candidates, at + LEAST)
        end = min(candidates[nth] if nth < len(candidates) else stop, at + MOST, stop)
        ends.append(end)
        at = end
    if at < stop:
        ends.append(stop)
    return ends


class Chunked:
    """One text as chunks: units in all, and where a number of units ends."""

    def __init__(self, raw: np.ndarray, start: int, ends: list[int], memo: Memo):
        self.raw, self.memo = raw, memo
        self.borders = [start, *ends]
        self.parts = [memo.summary(raw[a:b]) for a, b in zip(self.borders[:-1], ends, strict=True)]
        self.marks = np.cumsum([0, *(len(p.marks) for p in self.parts)])
        self.codes = np.cumsum([0, *(p.codes for p in self.parts)])
        open_line = bool(ends) and raw[ends[-1] - 1] != 10
        self.n = int(self.marks[-1]) + (memo.unit == "line" and open_line)

    def end_of(self, units: int) -> tuple[int, int]:
        """(place in the block, code points before it) after so many units."""
        nth = units - 1 if self.memo.unit == "line" else units  # a line ends after its mark, a char before the next one
        if units == 0:
            return self.borders[0], 0
        if nth >= self.marks[-1]:
            return self.borders[-1], int(self.codes[-1])
        part = int(np.searchsorted(self.marks, nth, "right")) - 1
        inside = int(self.parts[part].marks[nth - self.marks[part]]) + (self.memo.unit == "line")
        at = self.borders[part]
        return at + inside, int(self.codes[part]) + code_points(self.raw[at : at + inside])


_memos: dict[str, Memo] = {}


def fill_in_middle(df: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:  # noqa: B008
    """(id, n, form, prefix_chars, middle_chars, output) for each row of ``df``.

    Four numbers come from the SHA-256 of ``seed:id``. A document stays ``plain`` if
    it is empty, holds a mark, or its third number is beyond the rate; else its
    first two choose the cuts and the fourth the form. Null text is empty; a null id
    counts as an empty one. Rows that repeat an id or a text each give a row. Other
    columns are not read; an empty table gives no rows. A text of any length is
    worked on as chunks, next to its own bytes."""
    marks = [m.encode() for m in (plan.prefix, plan.suffix, plan.middle)]
    first, last, mid = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memos.setdefault(plan.unit, Memo(plan.unit))
        for part in blocks(batches):
            raw, at = text_bytes(part.column("text"))
            candidates = border_candidates(raw).tolist()
            whole = raw.tobytes()
            counts, forms, before, inner, out = [], [], [], [], []
            for h, a, b in zip(part.column("h").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                text = Chunked(raw, a, chunk_ends(candidates, a, b), memo)
                counts.append(text.n)
                h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
                if a == b or h3 % 100 >= plan.rate or any(whole.find(m, a, b) >= 0 for m in marks):
                    forms.append("plain"), before.append(None), inner.append(None), out.append(whole[a:b])
                    continue
                cuts = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
                (p, p_codes), (m, m_codes) = text.end_of(cuts[0]), text.end_of(cuts[1])
                before.append(p_codes), inner.append(m_codes - p_codes)
                if h4 % 100 < plan.spm:
                    forms.append("spm"), out.append(b"".join([last, whole[m:b], first, whole[a:p], mid, whole[p:m]]))
                else:
                    forms.append("psm"), out.append(b"".join([first, whole[a:p], last, whole[m:b], mid, whole[p:m]]))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(counts, pa.int64()), pa.array(forms, pa.string()), pa.array(before, pa.int64()),
                 pa.array(inner, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    key = F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = df.select(F.col(id_col).alias("id"), F.sha2(key, 256).alias("h"), F.col(text_col).alias("text"))
    schema = f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def restore(output: Column | str, form: Column | str, plan: Plan = Plan()) -> Column:  # noqa: B008
    """The text that ``fill_in_middle`` was given, from what it made: the output is
    parted at the marks, which stand in no transformed text."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))

    def after(c: Column, mark: str) -> Column:
        return F.substr(c, F.instr(c, mark) + F.lit(len(mark)))

    def until(c: Column, mark: str) -> Column:
        return F.substring_index(c, mark, 1)

    middle = after(output, plan.middle)
    psm = F.concat(until(after(output, plan.prefix), plan.suffix), middle, until(after(output, plan.suffix), plan.middle))
    spm = F.concat(until(after(output, plan.prefix), plan.middle), middle, until(after(output, plan.suffix), plan.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
