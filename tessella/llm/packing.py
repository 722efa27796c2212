"""Best-fit packing into bins of several permitted sequence lengths."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.mixing import word_count

CAPACITIES = (512, 1024, 2048, 4096)
#: What opening a bin costs besides its length, in tokens.
OVERHEAD = 32
ROWS_PER_PIECE = 20_000

SCHEMA = (
    "doc_id long, copy long, chunk long, start_token long, n_tokens long, "
    "piece long, bin long, capacity long, bin_offset long"
)


def _new_bin(length: int, capacities: Sequence[int], overhead: int, counts: list[int], lengths: int) -> int:
    """The permitted size that costs least a token: each is filled on trial, largest first, with
    items that still wait, and priced at the size to which it could then be cut down."""
    best, choice = None, capacities[-1]
    for capacity in capacities:
        if capacity < length:
            continue
        room, waiting = capacity - length, lengths
        # As many of the longest that fits as there are and fit, then the next shorter ones.
        while fits := waiting & ((1 << (room + 1)) - 1):
            item = fits.bit_length() - 1
            room -= item * min(counts[item], room // item)
            waiting = fits ^ (1 << item)
        filled = capacity - room
        price = (next(c for c in capacities if c >= filled) + overhead) / filled
        if best is None or price < best:
            best, choice = price, capacity
    return choice


def pack_lengths(
    lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD
) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of every item, and the size of every bin. Items are at least 1 and at most
    the largest size; they are dealt by decreasing length, each to the fullest bin that takes it."""
    capacities = sorted(capacities)
    counts = [0] * (capacities[-1] + 1)
    for x in lengths:
        counts[x] += 1
    waiting = sum(1 << x for x, n in enumerate(counts) if n)
    bins, offsets, used = [0] * len(lengths), [0] * len(lengths), []
    rooms: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]
    open_rooms = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        x = lengths[i]
        counts[x] -= 1
        if not counts[x]:
            waiting ^= 1 << x
        fits = open_rooms >> x
        if fits:
            room = x + (fits & -fits).bit_length() - 1
            number = rooms[room].pop()
            if not rooms[room]:
                open_rooms ^= 1 << room
        else:
            number, room = len(used), _new_bin(x, capacities, overhead, counts, waiting)
            used.append(0)
        bins[i], offsets[i] = number, used[number]
        used[number] += x
        room -= x
        if room:
            rooms[room].append(number)
            open_rooms |= 1 << room
    return bins, offsets, [next(c for c in capacities if c >= n) for n in used]


def _pack_piece(table: pa.Table, capacities: Sequence[int], overhead: int) -> Iterator[pa.RecordBatch]:
    """One piece: whole bins of the largest size are cut off long documents, the rests are packed."""
    largest = max(capacities)
    order = [("size", "descending"), ("doc_id", "ascending"), ("copy", "ascending")]
    table = table.sort_by(order)
    size, copy = (table.column(c).to_numpy() for c in ("size", "copy"))
    ids = table.column("doc_id").combine_chunks()
    piece = table.column("piece")[0].as_py()
    rest = size % largest
    row = np.flatnonzero(rest)
    bins, offsets, caps = pack_lengths(rest[row].tolist(), capacities, overhead)
    full = size // largest
    of = np.repeat(np.arange(len(size)), full)
    chunk = np.arange(len(of)) - np.repeat(np.cumsum(full) - full, full)
    empty = np.flatnonzero(size == 0)

    def batch(rows, chunk, tokens, bin_no, capacity, offset):
        n = len(rows)
        arrays = [ids.take(pa.array(rows)), copy[rows], chunk, chunk * largest, tokens, np.full(n, piece), bin_no, capacity, offset]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=[c.split()[0] for c in SCHEMA.split(", ")])

    caps = np.array(caps, np.int64)
    bins = np.array(bins, np.int64)
    yield batch(row, full[row], rest[row], bins, caps[bins], np.array(offsets, np.int64))
    for a in range(0, len(of), 100_000):
        part = slice(a, a + 100_000)
        numbers = len(caps) + np.arange(len(of))[part]
        n = len(numbers)
        yield batch(of[part], chunk[part], np.full(n, largest), numbers, np.full(n, largest), np.zeros(n, np.int64))
    none = pa.nulls(len(empty), pa.int64())
    yield batch(empty, np.zeros(len(empty), np.int64), np.zeros(len(empty), np.int64), none, none, none)


def best_fit_packing(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacities: Sequence[int] = CAPACITIES,
    overhead: int = OVERHEAD,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """One row per chunk of a document: (doc_id, copy, chunk, start_token, n_tokens) and its place
    (piece, bin, capacity, bin_offset). A bin is named by its piece and number.

    Tokens are words. A document longer than the largest permitted length gives whole bins of that
    length and a rest. Only (id, size) is shuffled: equal rows are counted first and numbered as
    copies, then dealt by hash to pieces of about `rows_per_piece` rows, so neither a hot id nor a
    long document makes a piece large; a piece is packed in one task. A document without words
    takes no room: its one row has n_tokens 0 and no bin. Null ids are packed like others.
    """
    if not capacities or min(capacities) < 1:
        raise ValueError("permitted lengths must be positive")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), word_count(F.col(text_col)).alias("size"))
    n_pieces = max(1, -(-docs.count() // rows_per_piece))
    copies = rows.groupBy("doc_id", "size").agg(F.count("*").alias("n"))
    dealt = copies.select("doc_id", "size", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    dealt = dealt.withColumn("piece", F.pmod(F.xxhash64("doc_id", "size", "copy"), F.lit(n_pieces)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pack_piece(pa.Table.from_batches(list(batches)), capacities, overhead)

    return dealt.groupBy("piece").applyInArrow(pack, SCHEMA)
