"""Byte-level text kernels shared by the operators that run inside Arrow batches.

Texts arrive as Arrow string columns; the kernels work on the UTF-8 bytes of
many rows at once, so their cost is a few vector passes a byte and their memory
a small multiple of ``CHUNK_BYTES`` (a longer text is a chunk of its own).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20  # text bytes worked on at once
_BLOCK = 1 << 20  # bytes hashed at once
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _table(chars) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


#: Bytes of words ``[^\x20\x09-\x0D]+``.
NON_SPACE = ~_table([0x20, *range(0x09, 0x0E)])
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased.
ALNUM = _table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])

_rng = np.random.default_rng(20240601)
_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_CODE_LOWER = _CODE.copy()
_CODE_LOWER[0x41:0x5B] = _CODE[0x61:0x7B]


def chunks(batches, text: str = "text", limit: int = CHUNK_BYTES):
    """Slices of record batches with at most ``limit`` bytes of text (or one row):
    (slice, text bytes as uint8, row offsets). A null text has no bytes."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        if col.null_count:
            col = col.fill_null("")
        col = col.cast(pa.large_string())
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1]
        data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] else np.zeros(0, np.uint8)
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
            yield batch.slice(a, b - a), data[off[a]:off[b]], off[a:b + 1] - off[a]
            a = b


def words(data: np.ndarray, off: np.ndarray, table: np.ndarray):
    """Runs of bytes with ``table[byte]``, never across rows: (starts, ends,
    bounds), where row r has the words bounds[r] to bounds[r + 1]."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    inside = table[data]
    full = off[:-1] < off[1:]
    edge = inside.copy()
    edge[1:] &= ~inside[:-1]
    at = off[:-1][full]
    edge[at] = inside[at]
    starts = np.flatnonzero(edge)
    edge = inside.copy()
    edge[:-1] &= ~inside[1:]
    at = off[1:][full] - 1
    edge[at] = inside[at]
    ends = np.flatnonzero(edge) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, _BLOCK)
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            p = np.empty(size, np.uint64)
            p[0] = 1
            done, step = 1, base
            while done < size:  # p[done:2*done] = p[:done] * base**done
                m = min(done, size - done)
                p[done:done + m] = p[:m] * np.uint64(step)
                step = step * step % (1 << 64)
                done += m
            _POWERS[name] = p
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True,
                code: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z folded to a-z if ``lower``; or by
    a code for each byte value)."""
    out = np.empty(len(starts), np.uint64)
    code = (_CODE_LOWER if lower else _CODE) if code is None else code
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + _BLOCK, "right")))
        base = starts[a]
        seg = data[base:ends[b - 1]]
        up, down = _powers(len(seg) + 1)
        total = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(code[seg] * up[:len(seg)], out=total[1:])
        s, e = starts[a:b] - base, ends[a:b] - base
        out[a:b] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        a = b
    return mix(out)


def windows(h: np.ndarray, bounds: np.ndarray, k: int):
    """Hashes of k consecutive words of one row: (hash, index of the first word, row)."""
    n = np.diff(bounds)
    row = np.repeat(np.arange(len(n)), n)
    i = np.arange(len(h))
    first = i[i + k <= bounds[1:][row]] if len(h) else i
    acc = np.zeros(len(first), np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[first + j]
    return mix(acc), first, row[first]


def string_at(data: np.ndarray, a: int, b: int) -> str:
    return data[a:b].tobytes().decode("utf-8", "replace")


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[r]:bounds[r + 1]] for each row r (0 where empty)."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:], dtype=total.dtype)
    return total[bounds[1:]] - total[bounds[:-1]]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
