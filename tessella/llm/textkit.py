"""Vectorised helpers that the tasks share: texts as one byte array, words, hashes, packed keys.

Everything here works on one Arrow batch (or a piece of one) inside a task; Spark partitions and
shuffles the work. Null texts count as empty everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = HASH_BYTES = 1 << 19

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_BASE = 0x9E3779B97F4A7C15
_ONE = np.ones(1, np.uint64)
_powers: dict[int, np.ndarray] = {_BASE: _ONE, pow(_BASE, -1, 1 << 64): _ONE}

#: Lower-cases A-Z and leaves every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words: all but blank, tab, line feed, vertical tab, form feed and carriage return.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> _S33)) * _M1
    h = (h ^ (h >> _S33)) * _M2
    return h ^ (h >> _S33)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def one_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a string or binary column one after the other, and len + 1 offsets."""
    column = one_array(column)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if binary else "")
    column = column.cast(pa.large_binary() if binary else pa.large_string())
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `limit` bytes of text; a longer text is a slice by itself."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    slot = (np.cumsum(lengths) - lengths) // limit
    cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes allowed by `table` within each text: starts, ends, and the texts'
    offsets into these lists."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = table[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cut = offsets[:-1][offsets[:-1] < offsets[1:]]
    begin[cut] = inside[cut]
    end[cut[1:] - 1] = inside[cut[1:] - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers_of(base: int, n: int) -> np.ndarray:
    known = _powers[base]
    if len(known) < n:
        known = np.full(max(n, 2 * len(known)), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal bytes wherever they stand.

    Works on the spans that begin in one slice of the data at a time, to bound its memory.
    """
    if len(data) <= HASH_BYTES or not len(starts):
        return _span_hashes(data, starts, ends)
    order = np.argsort(starts, kind="stable")
    cuts = np.searchsorted(starts[order], np.arange(0, len(data) + HASH_BYTES, HASH_BYTES))
    out = np.empty(len(starts), np.uint64)
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            part = order[a:b]
            low = int(starts[part[0]])
            out[part] = _span_hashes(data[low : int(ends[part].max())], starts[part] - low, ends[part] - low)
    return out


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers_of(_BASE, n + 1)[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers_of(pow(_BASE, -1, 1 << 64), n + 1)[starts]
    return mix(h ^ (ends - starts).astype(np.uint64))


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of these lengths: the list number and the place in the list of every element."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def pack40(keys: np.ndarray) -> bytes:
    """40-bit keys in five bytes each."""
    return keys.astype(np.uint32).tobytes() + (keys >> np.uint64(32)).astype(np.uint8).tobytes()


def unpack40(blob: bytes) -> np.ndarray:
    n = len(blob) // 5
    low = np.frombuffer(blob, np.uint32, n).astype(np.uint64)
    return low | (np.frombuffer(blob, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32))


def small_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable node of each of n nodes, by the links a-b: labels sink along the links
    and along themselves until nothing changes."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            break
    return label
