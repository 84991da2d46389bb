"""Vectorised byte kernels over Arrow string columns.

All functions work on one contiguous byte buffer with document offsets, as Arrow
stores a string column, so that no Python object is made per word.  Word classes
are given as 256-entry byte tables; UTF-8 continuation and lead bytes are all at
least 0x80, so classes that treat every non-ASCII character alike are exact on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.default_rng(20240229)
_RADIX = int(_RNG.integers(1 << 62, 1 << 63)) | 1
_RADIX_INV = pow(_RADIX, -1, 1 << 64)

#: Bytes that are part of a word under ``[^\x20\x09-\x0D]+``.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes that are part of a word under ``[A-Za-z0-9]`` or any non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: One random 64-bit value for each byte, exact and with A-Z folded to a-z.
BYTE_CODE = _RNG.integers(0, 1 << 64, 256, dtype=U64)
FOLDED_CODE = BYTE_CODE.copy()
FOLDED_CODE[0x41:0x5B] = BYTE_CODE[0x61:0x7B]

_powers = np.ones(1, U64), np.ones(1, U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r**i and r**-i mod 2**64 for i < n; kept and grown as needed."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _powers = tuple(np.cumprod(np.concatenate((np.ones(1, U64), np.full(size - 1, r, U64))), dtype=U64) for r in (_RADIX, _RADIX_INV))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U64(30))  # a new array, changed in place from here on
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def string_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = (1 << 20) - 1) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``most`` bytes each; a longer document is a range of its own."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def pieces(buf: np.ndarray, offsets: np.ndarray, overlap: int, most: int = (1 << 20) - 1) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets, number of the first document, shift): slices of about ``most`` bytes.

    A longer document comes in pieces that share ``overlap`` bytes with the next, each a slice of its own
    that begins ``shift`` bytes into the document.
    """
    n, a = len(offsets) - 1, 0
    while a < n:
        size = int(offsets[a + 1] - offsets[a])
        if size > most + overlap:
            for s in range(0, size - overlap, most):
                e = min(size, s + most + overlap)
                yield buf[offsets[a] + s : offsets[a] + e], np.array([0, e - s]), a, s
            a += 1
        else:
            b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1))
            yield buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], a, 0
            a = b


def words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all documents, and the word number at which each document starts."""
    inside = table[buf]
    before, after = np.zeros(len(buf), bool), np.zeros(len(buf), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(buf))]
    before[cuts], after[cuts - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_hash(buf: np.ndarray, code: np.ndarray) -> np.ndarray:
    """h with h[e] - h[s] == r**s times the polynomial hash of buf[s:e]."""
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum(code[buf] * powers(len(buf) + 1)[0][: len(buf)], dtype=U64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans, equal for equal bytes wherever they stand."""
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts] + (ends - starts).astype(U64))


def word_hashes(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray, code: np.ndarray = FOLDED_CODE) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the word number at which each document starts."""
    starts, ends, first = words(buf, offsets, table)
    return span_hash(prefix_hash(buf, code), starts, ends), first


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, size: int = 5, table: np.ndarray = NON_SPACE) -> list[np.ndarray]:
    """The sorted distinct word-shingle hashes of each document; fewer words than ``size`` make one shingle, none make none."""
    hashes, first = word_hashes(buf, offsets, table)
    rolled = np.zeros(max(0, len(hashes) - size + 1), U64)
    for j in range(size):
        rolled += hashes[j : j + len(rolled)] * powers(size)[0][j]
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            out.append(mix((hashes[a:b] * powers(size)[0][: b - a]).sum(dtype=U64, keepdims=True) + U64(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


def owners(first: np.ndarray) -> np.ndarray:
    """For items laid out by ``first``, the document number of each."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def planes(x: np.ndarray) -> bytes:
    """The bytes of an array, first those that are the lowest of each value, and so on: bytes that hardly vary stand together and pack well."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()
