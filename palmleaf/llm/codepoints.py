"""Arrow text as numpy code-point arrays: one decode per batch, no string call per row.

All operators on words share this kernel: words are the longest runs of Unicode L, M and N in lower case, each word is
one 64-bit polynomial hash of its lower-cased code points.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa

TABLE = 0x20000  # planes 0 and 1; later planes: ideographs are letters, the rest is not text
U64 = np.uint64
PRIME = U64(0x9E3779B97F4A7C15)
INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@functools.cache
def word_table() -> np.ndarray:
    cat = unicodedata.category
    t = np.fromiter((cat(chr(c))[0] in "LMN" for c in range(TABLE)), bool, TABLE)
    return np.append(t, [True, False])


@functools.cache
def lower_table() -> np.ndarray:
    t = np.arange(TABLE + 2, dtype=np.uint32)
    for c in range(TABLE):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()
        if len(low) == 1:
            t[c] = ord(low)
    return t


def clip(cps: np.ndarray) -> np.ndarray:
    """Indexes for the tables above."""
    if not len(cps) or cps.max() < TABLE:
        return cps
    return np.where(cps < TABLE, cps, np.where(cps < 0x32000, TABLE, TABLE + 1)).astype(np.uint32)


def splitmix(x: np.ndarray) -> np.ndarray:
    x = x.astype(U64) + PRIME
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@functools.cache
def char_mix() -> np.ndarray:
    return splitmix(np.arange(TABLE + 2, dtype=U64))


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        full = np.full(size, base, U64)
        full[0] = 1
        have = np.cumprod(full, dtype=U64)
        if size <= 1 << 23:
            _powers[int(base)] = have
    return have[:n]


def codepoints(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all rows, row offsets into them); a null row has none."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    buf = col.buffers()
    off = np.frombuffer(buf[1], np.int64)[col.offset : col.offset + n + 1]
    if n == 0 or off[-1] == off[0] or buf[2] is None:
        return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
    raw = np.frombuffer(buf[2], np.uint8)[off[0] : off[-1]]
    cps = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(cps) == len(raw):
        return cps, off - off[0]
    lead = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
    return cps, lead[off - off[0]]


def to_strings(cps: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The inverse of codepoints()."""
    n = len(offsets) - 1
    data = cps.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    if not len(cps):
        return pa.array([""] * n, pa.string())
    width = np.where(cps < 0x80, 1, np.where(cps < 0x800, 2, np.where(cps < 0x10000, 3, 4)))
    ends = np.zeros(len(cps) + 1, np.int64)
    np.cumsum(width, out=ends[1:])
    off = ends[offsets]
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of True that stays inside one row."""
    if not len(mask):
        e = np.zeros(0, np.int64)
        return e, e, e
    first = np.zeros(len(mask) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:-1] if len(first) > len(mask) else first
    prev = np.empty_like(mask)
    prev[0] = False
    prev[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~prev | first))
    follow = np.empty_like(mask)
    follow[-1] = False
    follow[:-1] = mask[1:]
    nxt = np.empty_like(first)
    nxt[-1] = True
    nxt[:-1] = first[1:]
    ends = np.flatnonzero(mask & (~follow | nxt)) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hash(mixed: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of the mixed values."""
    total = np.zeros(len(mixed) + 1, U64)
    np.cumsum(mixed * powers(PRIME, len(mixed)), dtype=U64, out=total[1:])
    h = (total[ends] - total[starts]) * powers(INVERSE, len(mixed) + 1)[starts]
    return splitmix(h ^ (ends - starts).astype(U64))


class Words:
    """The words of a column: hash, row, start and end (code-point positions), and first word of each row."""

    def __init__(self, col: pa.Array):
        self.cps, self.offsets = codepoints(col)
        at = clip(self.cps)
        self.starts, self.ends, self.row = runs(word_table()[at], self.offsets)
        self.hash = span_hash(char_mix()[clip(lower_table()[at])], self.starts, self.ends)
        bounds = np.searchsorted(self.row, np.arange(len(self.offsets)))
        self.first, self.count = bounds[:-1], np.diff(bounds)


def gram_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values; len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for j in range(k):
        out = (out + h[j : j + n]) * PRIME
    return splitmix(out)


def chunks(batch: pa.RecordBatch, col: str, chars: int = 1 << 19):
    """Slices of the batch whose texts hold about `chars` bytes each: memory follows the texts, not the row count."""
    c = batch.column(batch.schema.get_field_index(col))
    n = batch.num_rows
    if not n:
        return
    size = np.frombuffer(c.buffers()[1], np.int64 if pa.types.is_large_string(c.type) else np.int32)[c.offset : c.offset + n + 1]
    size = size.astype(np.int64) - size[0]
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + chars, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi
