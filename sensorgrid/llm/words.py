"""Words, word hashes and k-gram hashes of a batch of texts, as whole-array work.

A batch is one run of UTF-8 bytes with the offsets of its rows, as Arrow stores it.  All
functions look at every byte of every text; nothing is cut to a prefix.  Hashes are 64 bits
wide and depend on nothing but the bytes, so that tasks on different machines agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = np.asarray(x, dtype=U64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(32))) * U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U64(29))) * U64(0xD6E8FEB86659FD93)
        return x ^ (x >> U64(32))


def numbers(count: int, seed: int) -> np.ndarray:
    """``count`` fixed odd pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=U64) * U64(2 * seed + 1) + U64(seed)) | U64(1)


_LETTERS = numbers(256, 11)
_PLACES = numbers(1 << 12, 12)
_ORDER = numbers(64, 13)


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = _lower_table()
#: Bytes between words: ASCII white space.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes between words: all of ASCII but digits and small letters (applied after lowering).
SYMBOLS = np.array([b < 128 and not (48 <= b <= 57 or 97 <= b <= 122) for b in range(256)])


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64, from 0) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes; a longer row is a run of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes inside words, cut at row ends: marks of first bytes, starts, ends, and the
    first run of each row."""
    n = len(inside)
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = False
    opens = inside & ~before
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(opens)
    return opens, starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offsets)


class Words:
    """The words of some rows: ``starts`` and ``ends`` in bytes, ``hashes``, ``first`` by row.

    ``first[r]`` to ``first[r + 1]`` are the words of row r.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACES):
        global _PLACES
        low = LOWER[data]
        inside = ~between[low]
        opens, self.starts, self.ends, self.first = spans(inside, offsets)
        n = len(low)
        if not len(self.starts):
            self.hashes = np.zeros(0, U64)
            return
        longest = int((self.ends - self.starts).max())
        if longest > len(_PLACES):
            _PLACES = numbers(1 << longest.bit_length(), 12)
        at = np.cumsum(opens, dtype=np.int64)
        place = np.arange(n, dtype=np.int64) - self.starts[np.maximum(at, 1) - 1]
        place[~inside] = 0
        letters = np.where(inside, _LETTERS[low], U64(0))
        with np.errstate(over="ignore"):
            letters *= _PLACES[place]
            self.hashes = mix(np.add.reduceat(letters, self.starts))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-grams in text order, and the first gram of each row.

        With ``whole`` a row of fewer than k words gives one gram of all its words.
        """
        n, counts = len(self.hashes), self.counts()
        if n >= k:
            with np.errstate(over="ignore"):
                total = self.hashes[: n - k + 1] * _ORDER[0]
                for j in range(1, k):
                    total += self.hashes[j : n - k + 1 + j] * _ORDER[j]
            full = mix(total)
        else:
            full = np.zeros(0, U64)
        rows = np.repeat(np.arange(len(counts)), counts)
        keep = (np.arange(n) + k) <= self.first[rows + 1] if n else np.zeros(0, bool)
        out = full[keep[: len(full)]]
        per_row = np.maximum(counts - k + 1, 0)
        first = np.concatenate([[0], np.cumsum(per_row)])
        short = np.flatnonzero((counts > 0) & (counts < k)) if whole else []
        if len(short):
            with np.errstate(over="ignore"):
                extra = np.array(
                    [
                        (self.hashes[self.first[r] : self.first[r + 1]] * _ORDER[: counts[r]]).sum(dtype=U64)
                        + U64(counts[r])
                        for r in short
                    ],
                    U64,
                )
            out = np.insert(out, first[short], mix(extra))
            per_row[short] = 1
            first = np.concatenate([[0], np.cumsum(per_row)])
        return out, first


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each row, and the first of each row."""
    parts = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (
        np.concatenate(parts) if parts else np.zeros(0, U64),
        np.concatenate([[0], np.cumsum(sizes)]),
    )
