"""Texts as numpy arrays inside Arrow tasks: words, lines, 64-bit hashes and a bounded table.

Strings are named by 64-bit hashes where rows are counted or joined. Two of n distinct strings
share a hash with probability n * n / 2 ** 65: 1e-7 for two million, 3e-3 for 300 million.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is taken alone, whole.
CHUNK = 1 << 20

_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _PINV)):
            row = np.full(max(n, 1 << 16), base, np.uint64)
            row[0] = 1
            _powers[k] = np.cumprod(row)
    return _powers[0][:n], _powers[1]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running sums by which ``slice_hash`` knows any slice; values: uint64."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, powers(len(values) + 1)[0][: len(values)], out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return sums


def slice_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each slice; never 0."""
    inverse = powers(len(sums))[1]
    h = (sums[ends] - sums[starts]) * inverse[starts]
    h += (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93)
    h = mixed(h)
    h[h == 0] = 1
    return h


@dataclass
class Flat:
    """Texts of a column, one after another; a null text is empty."""

    data: np.ndarray  # uint8
    bounds: np.ndarray  # int64, one more than texts

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @staticmethod
    def of(column: pa.Array | pa.ChunkedArray) -> Flat:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        if not len(column):
            return Flat(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return Flat(raw[at[0] : at[-1]], at - at[0])

    def sums(self, lower: bool = False) -> np.ndarray:
        return prefix_hash((_BYTE[LOWER] if lower else _BYTE)[self.data])

    def count(self, flags: np.ndarray) -> np.ndarray:
        """Flagged bytes of each text."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


@dataclass
class Spans:
    """Slices of a Flat, in order; doc: the text that each lies in."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def per_doc(self, texts: int) -> np.ndarray:
        return np.bincount(self.doc, minlength=texts)

    def first(self, texts: int) -> np.ndarray:
        """Where each text's spans begin, and the number of all."""
        return np.concatenate([[0], np.cumsum(self.per_doc(texts))])


def runs(flat: Flat, member: np.ndarray) -> Spans:
    """Maximal runs of member bytes within a text; member: whether each of the 256 bytes is one."""
    return flagged_runs(flat, member[flat.data])


def flagged_runs(flat: Flat, inside: np.ndarray) -> Spans:
    """Maximal runs of flagged bytes within a text."""
    inner = flat.bounds[(flat.bounds > 0) & (flat.bounds < len(inside))]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    begins[inner] = inside[inner]
    closes[inner - 1] = inside[inner - 1]
    starts = np.flatnonzero(begins)
    return Spans(starts, np.flatnonzero(closes) + 1, np.searchsorted(flat.bounds, starts, "right") - 1)


def words(flat: Flat) -> Spans:
    """Runs of bytes other than blank, tab, line feed, vertical tab, form feed, return."""
    return runs(flat, ~SPACE)


def lines(flat: Flat) -> Spans:
    """What lies between line feeds and the ends of each text; empty texts have one line."""
    cuts = np.flatnonzero(flat.data == 10)
    starts = np.concatenate([flat.bounds[:-1], cuts + 1])
    doc = np.concatenate([np.arange(len(flat)), np.searchsorted(flat.bounds, cuts, "right") - 1])
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    last = np.append(doc[1:] != doc[:-1], True)
    ends = np.where(last, flat.bounds[doc + 1], np.append(starts[1:] - 1, 0))
    return Spans(starts, ends, doc)


def keys_in_doc(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one text."""
    return mixed(hashes ^ mixed(doc.astype(np.uint64) + _U(0x51ED2701)))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` hashes."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= _U(0xD1342543DE82EF95)
        out += hashes[k : k + n]
    return mixed(out)


def cut_strings(flat: Flat, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The slices as an Arrow array of strings."""
    size = ends - starts
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    source = np.arange(at[-1]) + np.repeat(starts - at[:-1], size)
    data = np.ascontiguousarray(flat.data[source])
    return pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data)]
    ).cast(pa.string())


def chunked(batches, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` bytes in ``column``; rows stay whole."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(size, dtype=np.int64) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
    release()


def release() -> None:
    """Gives free memory back to the system: a Python worker stays for the executor's next tasks.

    Powers are kept for as long a text as a chunk has at most.
    """
    if len(_powers[0]) > 2 * CHUNK:
        _powers[:] = [row[: 2 * CHUNK].copy() for row in _powers]
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


class SlotTable:
    """Bounded map from hashes to row numbers, in numpy; it is emptied when it is half full."""

    def __init__(self, bits: int = 20):
        self.mask = (1 << bits) - 1
        self.most = 1 << (bits - 1)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(self.mask + 1, np.uint64)
        self.rows = np.full(self.mask + 1, -1, np.int32)
        self.size = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where it has none."""
        slot = (keys & _U(self.mask)).astype(np.int64)
        there = self.keys[slot]
        out = np.where(there == keys, self.rows[slot], -1)
        left = np.flatnonzero((there != keys) & (there != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.rows[slot[left[hit]]]
            left = left[~hit & (there != 0)]
        return out

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Rows of distinct new keys, which are numbered on."""
        rows = np.arange(self.size, self.size + len(keys), dtype=np.int32)
        self.size += len(keys)
        slot = (keys & _U(self.mask)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            at = slot[left]
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[left[free]]
            won = free & (self.keys[at] == keys[left])
            self.rows[at[won]] = rows[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & self.mask
        return rows


class Memo:
    """Rows of values by hash, worked out once for each hash that the table holds.

    ``rows_of(keys, make)`` gives each key's row; ``make(first)`` returns arrays with a row for
    each position in ``first``, the first places of keys that are new.
    """

    def __init__(self, bits: int = 20):
        self.table = SlotTable(bits)
        self.values: list[np.ndarray] = []

    def rows_of(self, keys: np.ndarray, make) -> np.ndarray:
        rows = self.table.find(keys)
        miss = np.flatnonzero(rows < 0)
        if not len(miss):
            return rows
        new, first, back = np.unique(keys[miss], return_index=True, return_inverse=True)
        if self.table.size + len(new) > self.table.most:
            miss = np.arange(len(keys))
            new, first, back = np.unique(keys, return_index=True, return_inverse=True)
            bits = max(self.table.mask.bit_length(), len(new).bit_length() + 1)
            self.table, self.values = SlotTable(bits), []
        made = make(miss[first])
        added = self.table.add(new)
        if not self.values:
            self.values = [np.zeros((self.table.most, *m.shape[1:]), m.dtype) for m in made]
        for mine, m in zip(self.values, made, strict=True):
            mine[added] = m
        rows[miss] = added[back.reshape(-1)]
        return rows
