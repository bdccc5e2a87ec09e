"""Vectorised text kernels over Arrow string buffers.

Every function works on the raw UTF-8 bytes of a bounded chunk of whole texts;
no Python string is built per word.  Word and shingle identities are 64-bit
hashes (random byte table, polynomial in the byte position, then a bijective
mixer), equal on every executor and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are processed in chunks of about this many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 2_000_000
_P = U64(0x9E3779B97F4A7C15)
_P_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = U64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but digits and lower-case letters.
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:0x30] = True
NON_ALNUM[0x3A:0x61] = True
NON_ALNUM[0x7B:0x80] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IDENTITY = np.arange(256, dtype=np.uint8)
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (in place on a fresh array)."""
    h = h ^ (h >> U64(31))
    h *= U64(0x7FB5D329728EA185)
    h ^= h >> U64(27)
    h *= U64(0x81DADEF4BC2DD44D)
    h ^= h >> U64(33)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _P), ("down", _P_INV)):
            a = np.full(size, base, U64)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of len n+1, is_null of len n) of a string column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    null = np.asarray(column.is_null())
    if null.any():
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offs, data = column.buffers()
    if offs is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64), null
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32, len(column) + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0], null


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `limit` bytes each."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = b


def pieces(data: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[np.ndarray]:
    """One text in pieces of about `limit` bytes, cut behind separators: no word crosses a cut (a longer word stays whole)."""
    a = 0
    while a < len(data):
        b = min(a + limit, len(data))
        if b < len(data):
            back = np.flatnonzero(SPACE[data[a:b]])
            if len(back):
                b = a + int(back[-1]) + 1
            else:
                while b < len(data) and not SPACE[data[b - 1]]:
                    ahead = np.flatnonzero(SPACE[data[b : b + limit]])
                    b = b + int(ahead[0]) + 1 if len(ahead) else min(b + limit, len(data))
        yield data[a:b]
        a = b


@dataclass
class Words:
    data: np.ndarray  #: the chunk's bytes after mapping
    starts: np.ndarray  #: byte position of each word
    ends: np.ndarray
    first: np.ndarray  #: index of each row's first word; one more at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE, mapping: np.ndarray = LOWER) -> Words:
    """Maximal runs of non-separator bytes, never across two rows."""
    data = mapping[data]
    n = len(data)
    if not n:
        return Words(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    sep = separator[data]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before = np.empty(n, bool)
    before[0], before[1:] = True, sep[:-1]
    before[edges] = True
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, sep[1:]
    after[edges - 1] = True
    np.logical_not(sep, out=sep)
    starts = np.flatnonzero(sep & before)
    ends = np.flatnonzero(sep & after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(w: Words, separator: np.ndarray = SPACE) -> np.ndarray:
    if not len(w.starts):
        return np.zeros(0, U64)
    table = np.where(separator, U64(0), _TABLE)
    up, down = powers(len(w.data))
    value = table[w.data]
    value *= up[: len(value)]
    return mix(np.add.reduceat(value, w.starts) * down[w.starts])


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries; len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = h[:n].copy()
    for j in range(1, k):
        out *= _GRAM
        out += h[j : j + n]
    return mix(out + U64(k))


def row_grams(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each row's k-grams; a row of 1 to k-1 entries gives one gram of them all."""
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    g = grams(h, k)
    keep = rows[: len(g)] == rows[k - 1 : k - 1 + len(g)]
    g, r = g[keep], rows[: len(g)][keep]
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.concatenate([grams(h[first[i] : first[i + 1]], int(counts[i])) for i in short])
        g, r = np.concatenate([g, extra]), np.concatenate([r, short])
        order = np.argsort(r, kind="stable")
        g, r = g[order], r[order]
    return g, r


def row_sets(g: np.ndarray, r: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, one after another, and their offsets."""
    at = np.searchsorted(r, np.arange(n_rows + 1))
    sets = [np.unique(g[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    offsets = np.zeros(n_rows + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=offsets[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, U64)), offsets


def sketch(values: np.ndarray, offsets: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketch (Dahlgaard, Knudsen and Thorup): rows x t.

    In rounds 0..t-1 each element falls into a hashed bin with a hashed value;
    rounds t..2t-1 serve one bin each, so every coordinate of a non-empty set
    fills.  A coordinate keeps the least (round, value); a set leaves the loop
    once its bins are all full.
    """
    n = len(offsets) - 1
    out = np.full(n * t, np.iinfo(np.uint64).max, U64)
    rows = np.repeat(np.arange(n), np.diff(offsets))
    live = values
    for i in range(2 * t):
        if not len(live):
            break
        h = mix(live + U64((0xA0761D6478BD642F * (i + 1)) & ((1 << 64) - 1)))
        bins = (h & U64(t - 1)).astype(np.int64) if i < t else np.full(len(h), i - t, np.int64)
        np.minimum.at(out, rows * t + bins, (U64(i) << U64(54)) | (h >> U64(10)))
        open_rows = (out.reshape(n, t) == np.iinfo(np.uint64).max).any(axis=1)
        keep = open_rows[rows]
        if not keep.all():
            live, rows = live[keep], rows[keep]
    return out.reshape(n, t)


def bands(sk: np.ndarray, n_bands: int) -> np.ndarray:
    """rows x n_bands hashes of the sketch's bands, the band's number mixed in."""
    n, t = sk.shape
    parts = sk.reshape(n, n_bands, t // n_bands)
    out = np.broadcast_to(np.arange(1, n_bands + 1, dtype=U64), (n, n_bands)).copy()
    for j in range(parts.shape[2]):
        out = mix(out * _GRAM + parts[:, :, j])
    return out
