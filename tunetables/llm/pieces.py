"""SentencePiece ids of whole texts under a merge-type (BPE) vocabulary, and back.

The characters of a text are symbols. An agenda holds every adjacent pair whose
joined string is a piece, best score first and leftmost among equals; the pair on
top is merged and its new neighbours enter, until the agenda is empty. Symbols that
are no piece are spelled in bytes.

A merge joins characters that stand side by side in some piece. Where two
neighbours do so in none, no merge can reach across, and the text on both sides is
merged apart with the same result. The vocabulary proves such borders, before a
space mark above all, so the agenda runs over short segments, each distinct one once
per worker as long as the bounded memo holds it. The library checks every batch.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tunetables.llm.words import blocks

#: distinct segments that a worker remembers before it starts afresh; longer ones than
#: ``SHORT`` are merged by a heap of their own and not remembered
MEMO, SHORT = 300_000, 48
SPACE = "▁"
_NONE = 1 << 20
# Types of pieces, and the type of a merge vocabulary, in model files.
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of one protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7)
        size = number() if size is None else size
        yield tag >> 3, raw[at : at + size]
        at += size


class Vocabulary:
    """Pieces of a model file with what encoding and decoding ask of them."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, kind = [], 1
        for n, value in fields(self.library.serialized_model_proto()):
            if n == 1:
                piece = dict(fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif n == 2:
                kind = dict(fields(value)).get(3, 1)
        if kind != BPE or {t for _, _, t in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a merge vocabulary without pieces of the user's or unused ones is needed")
        self.ids = {p: i for i, (p, _, t) in enumerate(pieces) if t == NORMAL}
        self.scores = {p: s for p, s, t in pieces if t == NORMAL}
        self.unknown = next(i for i, (_, _, t) in enumerate(pieces) if t == UNKNOWN)
        of_byte = {int(p[1:-1], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.of_byte = [of_byte[b] for b in range(256)] if len(of_byte) == 256 else None
        self.bos, self.eos = self.library.bos_id(), self.library.eos_id()
        self.side_by_side = {(a, b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        self.segment = self._pattern()
        self.byte_ids = {i: b for b, i in of_byte.items()}
        self.shown = [self._shown(i, p, t) for i, (p, _, t) in enumerate(pieces)]
        self.controls = {i for i, (_, _, t) in enumerate(pieces) if t == CONTROL}
        self.memo: dict[str, bytes] = {}
        self._symbols()

    def _shown(self, i: int, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == CONTROL:
            return b""
        return self.library.decode([i]).encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    def _pattern(self) -> re.Pattern:
        """Segments that no merge leaves: a space mark follows nothing but space
        marks in any piece, and some signs stand in no longer piece at all."""
        lone = "".join(c for c in "\n\t\r" if not any(c in pair for pair in self.side_by_side))
        if any(b == SPACE and a != SPACE for a, b in self.side_by_side):
            return re.compile("(?s).+")
        return re.compile(f"{SPACE}*[^{SPACE}{re.escape(lone)}]+|{SPACE}+" + (f"|[{re.escape(lone)}]+" if lone else ""))

    def _symbols(self) -> None:
        """Every string that can be a symbol gets a number, and every pair of
        symbols that joins to a piece an entry, in the order of their keys."""
        numbers = {c: n for n, c in enumerate(sorted({c for p in self.ids for c in p}))}
        self.code = np.full(0x110000, -1, np.int32)
        for c, n in numbers.items():
            self.code[ord(c)] = n
        for p in self.ids:
            numbers.setdefault(p, len(numbers))
        place = {s: n for n, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        entries = sorted(
            (numbers[p[:k]] << 32 | numbers[p[k:]], place[self.scores[p]], numbers[p])
            for p in self.ids for k in range(1, len(p)) if p[:k] in numbers and p[k:] in numbers
        )
        self.pairs, self.places, self.joined = (np.array([e[i] for e in entries], np.int64) for i in range(3))
        #: ids of each symbol: its own, or those of its bytes
        spelled = [[self.ids[s]] if s in self.ids else self.spell(s) for s in numbers]
        self.out_at = np.cumsum([0, *map(len, spelled)])
        self.out = np.array([i for x in spelled for i in x], "<u4")

    def spell(self, symbol: str) -> list[int]:
        return [self.of_byte[b] for b in symbol.encode()] if self.of_byte else [self.unknown]

    def merge(self, text: str) -> list[str]:
        """The symbols of one run of text, its agenda a heap."""
        parts: list[str | None] = list(text)
        before, after = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        agenda: list[tuple[float, int, int, str]] = []

        def enter(left: int, right: int) -> None:
            if left >= 0 and right >= 0:
                joined = parts[left] + parts[right]
                if joined in self.scores:
                    heapq.heappush(agenda, (-self.scores[joined], left, right, joined))

        for i in range(len(parts) - 1):
            enter(i, i + 1)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            if parts[left] is None or parts[right] is None or parts[left] + parts[right] != joined:
                continue  # one of the two was merged meanwhile
            parts[left], parts[right] = joined, None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            enter(before[left], left)
            enter(left, after[left])
        return [p for p in parts if p is not None]

    def long_ids(self, segment: str) -> bytes:
        """Little-endian ids of a segment of any length, run by run between proved borders."""
        out, start = [], 0
        for end in [*(i for i in range(1, len(segment)) if (segment[i - 1], segment[i]) not in self.side_by_side), len(segment)]:
            for symbol in self.merge(segment[start:end]):
                i = self.ids.get(symbol)
                out += self.spell(symbol) if i is None else [i]
            start = end
        return np.array(out, "<u4").tobytes()

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of pairs of symbols in the order of scores, beyond all where they
        join to no piece, and the symbols that they join to."""
        keys = left << 32 | right
        nth = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[nth] == keys, self.places[nth], _NONE), self.joined[nth]

    def short_ids(self, segments: list[str]) -> list[bytes]:
        """Little-endian ids of many short segments. Their agendas lie side by side
        in arrays; each round takes the top pair of every one that has any left."""
        if not segments:
            return []
        raw = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(s) for s in segments])
        ends, n = np.cumsum(lengths), len(raw)
        starts = ends - lengths
        symbols = np.append(self.code[raw], -1).astype(np.int64)  # the last one stands beyond both ends of a segment
        symbols[:n][symbols[:n] < 0] = -2 - raw[symbols[:n] < 0].astype(np.int64)  # in no piece: joins nothing
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], before[starts] = n, n
        place, joined = self._pair(symbols[:n], symbols[after[:n]])
        agenda = np.append(place, _NONE) * (n + 1) + np.arange(n + 1)  # the leftmost comes first among equals
        joined, alive = np.append(joined, 0), np.ones(n, bool)
        while True:
            top = np.minimum.reduceat(agenda[:n], starts)
            at = top[top < _NONE * (n + 1)] % (n + 1)
            if not len(at):
                break
            gone = after[at]
            symbols[at], alive[gone] = joined[at], False
            after[at] = after[gone]
            before[after[at]] = at
            agenda[gone] = _NONE * (n + 1) + gone
            changed = np.concatenate([at, before[at]])
            changed = changed[changed < n]
            place, joined[changed] = self._pair(symbols[changed], symbols[after[changed]])
            agenda[changed] = place * (n + 1) + changed
            symbols[n] = -1
        owner = np.repeat(np.arange(len(segments)), lengths)[alive]
        ids, counts = self._spelled_out(symbols[:n][alive])
        stops = np.cumsum(np.bincount(owner, weights=counts, minlength=len(segments)).astype(np.int64)).tolist()
        flat = ids.astype("<u4").tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def _spelled_out(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, and how many each has."""
        known = symbols >= 0
        strange = {int(s): self.spell(chr(-2 - int(s))) for s in np.unique(symbols[~known])}
        counts = np.empty(len(symbols), np.int64)
        counts[known] = np.diff(self.out_at)[symbols[known]]
        counts[~known] = [len(strange[s]) for s in symbols[~known].tolist()]
        begin = np.cumsum(counts) - counts
        ids = np.empty(int(counts.sum()), np.int64)
        nth = np.arange(len(ids)) - np.repeat(begin, counts)
        of_known = np.repeat(known, counts)
        ids[of_known] = self.out[np.repeat(self.out_at[np.where(known, symbols, 0)], counts)[of_known] + nth[of_known]]
        ids[~of_known] = [i for s in symbols[~known].tolist() for i in strange[s]]
        return ids, counts

    def encode(self, texts: list[str], bos: bool = True, eos: bool = True) -> list[bytes]:
        """All ids of each text as little-endian unsigned 32-bit numbers."""
        cut = [self.segment.findall(self.library.normalize(t)) for t in texts]
        new = {s for segments in cut for s in segments if s not in self.memo}
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = {s for segments in cut for s in segments}
        short = [s for s in new if len(s) <= SHORT]
        found = dict(zip(short, self.short_ids(short), strict=True)) | {s: self.long_ids(s) for s in new if len(s) > SHORT}
        self.memo.update((s, i) for s, i in found.items() if len(s) <= SHORT)
        edge = lambda on, i: struct.pack("<I", i) if on and i >= 0 else b""
        out = []
        for segments in cut:
            body = b"".join([self.memo[s] if s in self.memo else found[s] for s in segments])
            out.append(edge(bos, self.bos) + (body if self.of_byte else self._one_unknown(body)) + edge(eos, self.eos))
        return out

    def _one_unknown(self, body: bytes) -> bytes:
        """Neighbouring unknown symbols are one, across segments too."""
        ids = np.frombuffer(body, "<u4")
        again = np.zeros(len(ids), bool)
        again[1:] = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
        return ids[~again].tobytes()

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: pieces side by side, space marks as spaces but for
        the one that encoding sets in front, bytes as the characters they spell."""
        start, stop = 0, len(ids)
        while start < stop and ids[start] in self.controls:
            start += 1
        while stop > start and ids[stop - 1] in self.controls:
            stop -= 1
        ids = ids[start:stop]
        if not self.controls.isdisjoint(ids):  # bytes on both sides spell no character together
            return self._spelled(ids)
        first = ids[0] if ids else None
        raw = b"".join(map(self.shown.__getitem__, ids))
        if first is not None and first not in self.byte_ids and first != self.unknown and raw.startswith(b" "):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._spelled(ids)

    def _spelled(self, ids: list[int]) -> str:
        """As ``decode`` where bytes do not spell characters: each stray byte is U+FFFD."""
        out: list[str] = []
        run = bytearray()
        start = True

        def flush() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + size]).decode())
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()

        for i in ids:
            if i in self.byte_ids:
                run.append(self.byte_ids[i])
                start = False
                continue
            if i in self.controls:
                flush()
                continue
            flush()
            shown = self.shown[i].decode()
            out.append(shown[1:] if start and i != self.unknown and shown.startswith(" ") else shown)
            start = False
        flush()
        return "".join(out)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_texts(
    df: DataFrame, model: str, bos: bool = True, eos: bool = True, check: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids, decoded) for each row of ``df``: the ids of the whole text as
    little-endian unsigned 32-bit numbers, and the text that they give back.

    With ``check`` the library encodes every batch too, and a difference ends the
    job. Null text is empty, and an empty text has its begin and end ids only.
    Repeated rows each give a row; other columns are not read; an empty table gives
    no rows. A text of any length is worked on segment by segment. The model file
    must lie at the same path on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(model)
        for part in blocks(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            found = known.encode(texts, bos, eos)
            ids = [np.frombuffer(f, "<u4").tolist() for f in found]
            if check:
                for i, own in zip(known.library.encode(texts, add_bos=bos, add_eos=eos, num_threads=1), ids, strict=True):
                    if i != own:
                        raise ValueError("a text's ids differ from the library's")
            decoded = [known.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(i) for i in ids], pa.int64()), pa.array(found, pa.binary()), pa.array(decoded, pa.string())],
                ["id", "n_tokens", "ids", "decoded"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.selectExpr(f"`{id_col}` as id", f"`{text_col}` as text")
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary, decoded string").withColumnRenamed("id", id_col)
