"""Vectorised words and shingle hashes of a batch of texts.

A batch of UTF-8 texts is one byte array; words are found with array
operations over the whole batch, so the Python cost is per batch, not per
word.  A word's hash is a polynomial of its bytes modulo 2**64 taken from one
running sum, then mixed; a sequence of words is a polynomial of the mixed word
hashes, mixed again.  Equal words or sequences always hash alike; different
ones collide with a chance of about 2**-64 (ordinary text, not text built
against this polynomial).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
SEQ_BASE = 0xC2B2AE3D27D4EB4F | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (xor-shift and multiply)."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(n, U64)
    if n:
        out[0] = 1
        done = 1
        while done < n:
            m = min(done, n - done)
            out[done : done + m] = out[:m] * U64(pow(base, done, 1 << 64))
            done += m
    return out


_BLOCK = 1 << 18
_UP, _DOWN = powers(_BASE, _BLOCK), powers(pow(_BASE, -1, 1 << 64), _BLOCK)


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Each word's polynomial, from running sums over blocks of bytes: bytes are
    weighted by their place in the block, and a word's sum is moved back to
    place zero by the inverse power.  Memory is that of one block."""
    out = np.empty(len(start), U64)
    i = 0
    while i < len(start):
        low = start[i]
        j = max(i + 1, int(np.searchsorted(end, low + _BLOCK, side="right")))
        size = int(end[j - 1] - low)
        up, down = (_UP, _DOWN) if size <= _BLOCK else (powers(_BASE, size), _DOWN)
        total = np.zeros(size + 1, U64)
        np.cumsum((data[low : end[j - 1]].astype(U64) + U64(1)) * up[:size], out=total[1:])
        s, e = start[i:j] - low, end[i:j] - low
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U64))
        i = j
    return out


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20):
    """Parts of a batch whose texts hold about ``limit`` bytes at most (one
    text at least), so that array work on a part stays small."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += int(size)
    if begin < len(sizes):
        yield batch.slice(begin)


@dataclass
class Words:
    """Words of a batch: byte bounds of each word, and each text's word range."""

    data: np.ndarray  # bytes of all texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte behind each word
    first: np.ndarray  # texts + 1: index of each text's first word
    hash: np.ndarray  # 64-bit hash of each word


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each text's byte bounds (null: empty)."""
    column = column.fill_null("").cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column.fill_null(b"")
    n = len(column)
    bounds = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(column: pa.Array, lower: bool = False) -> Words:
    """The words of every text of a batch.  ``lower`` folds A-Z only."""
    data, bounds = text_bytes(column)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(bounds), np.int64), np.zeros(0, U64))
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    # A word starts where the byte before is white space or belongs to another text.
    opens = np.empty(n, bool)
    opens[0] = True
    opens[1:] = ~inside[:-1]
    cuts = bounds[1:-1]
    opens[cuts[cuts < n]] = True
    closes = np.empty(n, bool)
    closes[-1] = True
    closes[:-1] = ~inside[1:]
    closes[cuts[cuts > 0] - 1] = True
    start = np.flatnonzero(opens & inside)
    end = np.flatnonzero(closes & inside) + 1
    first = np.searchsorted(start, bounds)
    hashed = _word_hashes(data, start, end)
    return Words(data, start, end, first, hashed)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive items (over text borders too:
    callers keep the starts that fit in one text)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for i in range(size):
        out += hashes[i : i + n] * U64(pow(SEQ_BASE, i + 1, 1 << 64))
    return mix(out)


def whole(hashes: np.ndarray) -> int:
    """Hash of one whole sequence, apart from those of its windows."""
    n = len(hashes)
    return int(mix((hashes * powers(SEQ_BASE, n + 2)[2:]).sum(dtype=U64) + np.full(1, n, U64))[0])
