"""Words, shingles and blocks of Arrow text, hashed without a loop over words.

Words are runs of ``[^\\x20\\x09-\\x0D]``; A-Z count as a-z. A word's hash is a
polynomial over its bytes, taken from one running sum over the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_B = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_BINV = pow(_B, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=U)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _LOWER[97:123]
_powers: dict[int, np.ndarray] = {}

#: text bytes that are hashed at once; a longer text is a block of its own
BLOCK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int, base: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64, n of them at least."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, U)
        while len(have) < max(n, 1 << 16):
            have = np.concatenate([have, have * U(pow(base, len(have), 1 << 64))])
        if n <= BLOCK_BYTES + 1:  # a single huge text must not stay in memory
            _powers[base] = have
    return have


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow text column and the offsets of its rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of batches of at most ``limit`` text bytes, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of rows of bytes start and end, in order."""
    n = len(raw)
    word = ~_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes, in order, and each row's offsets among them."""
    raw, at = text_bytes(texts)
    n = len(raw)
    if not n:
        return np.zeros(0, U), np.zeros(len(at), np.int64)
    starts, ends = word_bounds(raw, at)
    sums = np.zeros(n + 1, U)
    np.cumsum(_LOWER[raw] * powers(n, _B)[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * powers(n, _BINV)[starts] + (ends - starts).astype(U))
    return hashes, np.searchsorted(starts, at)


def shingles(hashes: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row. A row with fewer words than
    ``size`` has its whole sequence as one shingle, a row without words none."""
    joined = np.zeros(max(0, len(hashes) - size + 1), U)
    for k in range(size):
        joined = joined * U(_B) + hashes[k : k + len(joined)]
    joined = mix(joined + U(size))
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(joined[a : b - size + 1]))
        elif b > a:
            h = U(0)
            with np.errstate(over="ignore"):
                for x in hashes[a:b]:
                    h = h * U(_B) + x
                out.append(mix(np.array([h + U(b - a)], U)))
        else:
            out.append(np.zeros(0, U))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
