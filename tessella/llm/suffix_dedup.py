"""Suffix-array deduplication: removes 50-byte strings that an earlier document has too.

1. Every window of `LENGTH` bytes is named by the smallest hash of its `GRAM`-byte substrings. Equal
   windows have equal names wherever they stand, and neighbouring windows mostly share theirs, so a
   text becomes a few stretches ("spans"), each with one name.
2. Names travel to bins of the name range, and the blocks learn which names more than one document
   has. Only these spans travel on, once a block each, to the bin of their name. A name of very many
   documents would make one bin large: its spans are cut into single windows, dealt by their own hash.
3. In a bin, the suffixes at the window starts are sorted in two stages: only those smaller than
   their successors (type B) are compared with each other; the others (type A) are induced by one
   scan over the buckets of first bytes. Adjacent common prefixes of at least `LENGTH` tell which
   windows are equal, and the smallest doc_id among them is the owner of all.
4. Each block removes the windows whose owner is smaller than their document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.textkit import mix, pack40, ragged, span_hashes, text_bytes, unpack40

LENGTH = 50
GRAM = 24
#: Names of more documents than this are dealt out by single windows.
HOT = 4096
#: Windows in a span at most.
SPAN_WINDOWS = 64
#: Text of a block, text for each bin, and bytes that are hashed at once.
BLOCK_BYTES, BIN_BYTES, SLICE = 4 << 20, 2 << 20, 1 << 20
NAME_BITS = 48

NAMES = "deal int, block long, names binary, counts binary"
SPANS = "deal int, block long, bytes binary, lengths binary, lowest binary, counts binary, places binary"
FOUND = "block long, owners binary, ranges binary, counts binary, places binary"
RESULT = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept_sha256 string"

_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _words(data: np.ndarray, order: str) -> np.ndarray:
    """The eight bytes from every position on as one number; the text is padded with zeros."""
    padded = np.concatenate([data, np.zeros(64, np.uint8)])
    return np.ndarray(len(data) + 57, f"{order}u8", padded.tobytes(), strides=(1,)).astype(np.uint64)


def spans(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, name) of the stretches that the windows of all texts fall into.

    Works slice by slice to bound its memory; a stretch may be cut anywhere.
    """
    parts = []
    for low in range(0, len(data), SLICE):
        high = min(low + SLICE + length - 1, len(data))
        a, b = np.searchsorted(offsets, (low, high), "right") - 1
        edges = np.clip(offsets[a : b + 2], low, None) - low
        start, count, name = _slice_spans(data[low:high], edges, length)
        keep = start < SLICE
        parts.append((start[keep] + low, np.minimum(count, SLICE - start)[keep], name[keep]))
    parts = parts or [_slice_spans(data, offsets, length)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _slice_spans(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.astype(np.uint64)
    w = _words(data, "<")
    h = mix(w[: len(data)] * _C[0] + w[8 : 8 + len(data)] * _C[1] + w[16 : 16 + len(data)] * _C[2])
    reach, width = 1, length - GRAM + 1
    while reach * 2 <= width:
        h = np.minimum(h[: len(h) - reach], h[reach:])
        reach *= 2
    if reach < width:
        h = np.minimum(h[: len(h) - (width - reach)], h[width - reach :])
    offsets = np.minimum(offsets, len(data))
    ends = np.repeat(offsets[1:], np.diff(offsets))  # of the text at every byte
    n = min(len(h), len(data))
    valid = ends[:n] - np.arange(n) >= length
    head = valid.copy()
    head[1:] &= (h[1:n] != h[: n - 1]) | ~valid[:-1]
    first = np.flatnonzero(head)
    if not len(first):
        return none, none, none.astype(np.uint64)
    count = np.minimum(np.append(first[1:], n), ends[first] - length + 1) - first
    name = mix(h[first] ^ _C[1])
    owner, part = ragged(-(-count // SPAN_WINDOWS))
    start = first[owner] + part * SPAN_WINDOWS
    return start, np.minimum(count[owner] - part * SPAN_WINDOWS, SPAN_WINDOWS), name[owner] >> np.uint64(64 - NAME_BITS)


def _block(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, bytes, offsets) of a block in an order that does not depend on the shuffle."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    data, offsets = text_bytes(table.column("text"))
    return table.column("doc_id").to_numpy(), data, offsets


def _bins(names: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The bins that occur among sorted names, and the edges of their parts."""
    bins = (names >> np.uint64(NAME_BITS - bits)).astype(np.int64)
    present = np.unique(bins)
    return present, np.append(np.searchsorted(bins, present), len(bins))


def _arrays(schema: str, columns: list) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns, strict=True)})


def _documents_by_name(owner: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names, the place of every span's name among them, and their documents."""
    known, place = np.unique(name, return_inverse=True)
    order = np.lexsort((owner, place))
    p, o = place[order], owner[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (o[1:] != o[:-1])
    return known, place, np.bincount(p[new], minlength=len(known))


def _send_names(table: pa.Table, bits: int) -> pa.Table:
    block = table.column("block")[0].as_py()
    _, data, offsets = _block(table)
    start, _, name = spans(data, offsets)
    known, _, documents = _documents_by_name(np.searchsorted(offsets, start, "right"), name)
    present, edges = _bins(known, bits)
    mask = (np.uint64(1) << np.uint64(NAME_BITS - bits)) - np.uint64(1)
    counts = documents.astype(np.uint32)
    parts = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
    return _arrays(
        NAMES,
        [present, [block] * len(present), [pack40(known[p] & mask) for p in parts], [counts[p].tobytes() for p in parts]],
    )


def _merge_names(table: pa.Table) -> pa.Table:
    """For every name that a block sent: 0 if only one document has it, 1 if more, 2 if very many."""
    names = [unpack40(x.as_buffer()) for x in table.column("names")]
    counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("counts")])
    _, place = np.unique(np.concatenate(names), return_inverse=True)
    total = np.bincount(place, counts)[place]
    kind = ((total > 1).astype(np.uint8) + (total > HOT)).astype(np.uint8)
    edges = np.cumsum([0] + [len(x) for x in names])
    kinds = [kind[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
    return _arrays(NAMES, [table.column("deal"), table.column("block"), [b""] * len(kinds), kinds])


def _send_spans(table: pa.Table, answers: pa.Table, bits: int) -> pa.Table:
    """The distinct spans with a shared name, each with its smallest doc_id and all its places."""
    if not answers.num_rows or not table.num_rows:
        return _arrays(SPANS, [[]] * 7)
    block = table.column("block")[0].as_py()
    ids, data, offsets = _block(table)
    start, count, name = spans(data, offsets)
    _, place = np.unique(name, return_inverse=True)
    answers = answers.sort_by("deal")
    kind = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in answers.column("counts")])[place]
    hot = kind == 2
    owner, part = ragged(count[hot])
    single = start[hot][owner] + part
    start, size = start[kind == 1], count[kind == 1] + LENGTH - 1
    start = np.concatenate([start, single])
    size = np.concatenate([size, np.full(len(single), LENGTH)])
    text = span_hashes(data, start, start + size)
    name = np.concatenate([name[kind == 1], text[len(start) - len(single) :] >> np.uint64(64 - NAME_BITS)])
    order = np.lexsort((start, text, name >> np.uint64(NAME_BITS - bits)))
    start, size, text, name = start[order], size[order], text[order], name[order]
    new = np.ones(len(text), bool)
    new[1:] = text[1:] != text[:-1]
    first = np.flatnonzero(new)
    repeats = np.diff(np.append(first, len(text)))
    # Places are sorted within a span and the block by doc_id, so the first place has the smallest id.
    lowest = ids[np.searchsorted(offsets, start[first], "right") - 1]
    present, edges = _bins(name[first], bits)
    columns = [[], [], [], [], []]
    for a, b in zip(edges, edges[1:], strict=False):
        owner, part = ragged(size[first[a:b]])
        columns[0].append(data[start[first[a:b]][owner] + part].tobytes())
        columns[1].append(size[first[a:b]].astype(np.uint8).tobytes())
        columns[2].append(lowest[a:b].tobytes())
        columns[3].append(repeats[a:b].astype(np.uint32).tobytes())
        columns[4].append(start[first[a] : first[b] if b < len(first) else len(start)].astype(np.uint32).tobytes())
    return _arrays(SPANS, [present, [block] * len(present), *columns])


def _direct_sort(at: np.ndarray, w: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first bytes, eight at a time; only ties go on."""
    order = np.argsort(w[at])
    at = at[order]
    key = w[at]
    tie = np.zeros(len(at) + 1, bool)
    tie[1:-1] = key[1:] == key[:-1]
    for skip in range(8, depth, 8):
        open_ = np.flatnonzero(tie[:-1] | tie[1:])
        if not len(open_):
            break
        group = np.cumsum(~tie[open_])
        sub = at[open_]
        key = w[sub + skip]
        order = np.lexsort((key, group))
        at[open_] = sub[order]
        key, group = key[order], group[order]
        same = np.zeros(len(open_), bool)
        same[1:] = (group[1:] == group[:-1]) & (key[1:] == key[:-1])
        tie[open_] = same
        tie[-1] = False
    return at


def two_stage_sort(data: np.ndarray, wanted: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The positions where `wanted` is set, ordered by their first `depth` bytes (a suffix array of
    bounded depth).

    Suffixes smaller than their successor (type B) are sorted directly. Then the buckets of equal
    first bytes are scanned in order, in each the type A suffixes before the type B ones: whenever
    the suffix before a scanned one is of type A, it is the next one in its own bucket.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    change = np.flatnonzero(data[1:] != data[:-1]) + 1
    run = np.concatenate([[0], change])
    value = data[run].astype(np.int16)
    larger = np.repeat(value > np.append(value[1:], 0), np.diff(np.append(run, n)))  # type A
    # An induced suffix needs its successor in the order, up to the next one of type B.
    need = np.append(wanted, False)
    front = np.flatnonzero(wanted & larger) + 1
    while len(front):
        front = front[front < n]
        front = front[~need[front]]
        need[front] = True
        front = front[larger[front]] + 1
    need = need[:n]
    w = _words(data, ">")
    direct = _direct_sort(np.flatnonzero(need & ~larger), w, depth)
    induced = need & larger
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if induced[n - 1]:  # no successor at all: the smallest of its bucket
        waiting[data[n - 1]].append(np.array([n - 1]))
    edges = np.searchsorted(data[direct], np.arange(257))
    order = []

    def induce(scanned: np.ndarray, c: int) -> np.ndarray:
        before = scanned[scanned > 0] - 1
        before = before[induced[before]]
        char = data[before]
        later = before[char != c]
        if len(later):
            place = np.argsort(data[later], kind="stable")
            later = later[place]
            cuts = np.flatnonzero(np.diff(data[later])) + 1
            for part in np.split(later, cuts):
                waiting[data[part[0]]].append(part)
        return before[char == c]

    for c in range(256):
        front = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(front):
            order.append(front)
            front = induce(front, c)
        part = direct[edges[c] : edges[c + 1]]
        if len(part):
            order.append(part)
            before = part[part > 0] - 1
            before = before[induced[before] & (data[before] > c)]
            induce(before + 1, c)
    every = np.concatenate(order) if order else np.zeros(0, np.int64)
    return every[wanted[every]]


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Common prefix, up to `depth`, of every suffix in the order with the one before it."""
    w = _words(data, ">")
    common = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    for skip in range(0, depth, 8):
        differ = w[order[at] + skip] ^ w[order[at - 1] + skip]
        same = sum((differ < np.uint64(1 << s)).astype(np.int64) for s in range(8, 64, 8)) + (differ == 0)
        common[at] += same
        at = at[same == 8]
    return np.minimum(common, depth)


def window_owners(data: np.ndarray, sizes: np.ndarray, lowest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For spans that stand one after the other: (span, owner) of every window, in reading order.
    The owner is the smallest `lowest` among the spans that hold an equal window."""
    start = np.cumsum(sizes) - sizes
    span, place = ragged(sizes - LENGTH + 1)
    window = start[span] + place
    wanted = np.zeros(len(data), bool)
    wanted[window] = True
    order = two_stage_sort(data, wanted)
    first = np.flatnonzero(common_prefixes(data, order) < LENGTH)
    low = np.zeros(len(data), np.int64)
    low[window] = lowest[span]
    group = np.minimum.reduceat(low[order], first) if len(first) else low[:0]
    owner = np.zeros(len(data), np.int64)
    owner[order] = np.repeat(group, np.diff(np.append(first, len(order))))
    return span, owner[window]


def _find_owners(table: pa.Table) -> pa.Table:
    """A bin: for every block, the owners of its windows as ranges of windows in its spans."""
    def column(name, kind):
        return [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]

    sizes, lowest, counts, places = (column(*x) for x in (("lengths", np.uint8), ("lowest", np.int64), ("counts", np.uint32), ("places", np.uint32)))
    edges = np.cumsum([0] + [len(x) for x in sizes])
    size, low = np.concatenate(sizes).astype(np.int64), np.concatenate(lowest)
    data = np.concatenate(column("bytes", np.uint8))
    start = np.cumsum(size) - size
    # Spans that several blocks sent are sorted once.
    _, first, place = np.unique(span_hashes(data, start, start + size), return_index=True, return_inverse=True)
    smallest = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(smallest, place, low)
    owner, part = ragged(size[first])
    span, window_owner = window_owners(data[start[first][owner] + part], size[first], smallest)
    cut = np.ones(len(span), bool)
    cut[1:] = (span[1:] != span[:-1]) | (window_owner[1:] != window_owner[:-1])
    head = np.flatnonzero(cut)
    base = np.cumsum(size[first] - LENGTH + 1) - (size[first] - LENGTH + 1)
    begin = head - base[span[head]]
    end = np.append(head[1:], len(span)) - base[span[head]]
    ranges = np.bincount(span[head], minlength=len(first))
    range_edge = np.cumsum(ranges) - ranges
    rows = [[], [], [], [], []]
    for i in range(len(sizes)):
        mine = place[edges[i] : edges[i + 1]]
        own, part = ragged(ranges[mine])
        at = range_edge[mine][own] + part
        # A span at one place loses nothing to its own document.
        of = window_owner[head[at]]
        keep = (counts[i][own] > 1) | (of < lowest[i][own])
        own, at, of = own[keep], at[keep], of[keep]
        many = counts[i][own].astype(np.int64)
        o, part = ragged(many)
        edge = np.cumsum(counts[i].astype(np.int64)) - counts[i]
        rows[0].append(table.column("block")[i].as_py())
        rows[1].append(of.tobytes())
        rows[2].append(np.stack([begin[at], end[at]]).astype(np.uint8).tobytes())
        rows[3].append(many.astype(np.uint32).tobytes())
        rows[4].append(places[i][edge[own][o] + part].tobytes())
    return _arrays(FOUND, rows)


def _remove(table: pa.Table, found: pa.Table) -> pa.Table:
    """A block: removes the windows whose owner is smaller than their document."""
    if not table.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()), "removed": pa.array([], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept_sha256": pa.array([], pa.string())})
    ids, data, offsets = _block(table)
    step = np.zeros(len(data) + 1, np.int32)
    for i in range(found.num_rows):
        owner, ranges, counts, places = (
            np.frombuffer(found.column(c)[i].as_buffer(), kind)
            for c, kind in (("owners", np.int64), ("ranges", np.uint8), ("counts", np.uint32), ("places", np.uint32))
        )
        begin, end = ranges.astype(np.int64).reshape(2, -1)
        owner, begin, end = (np.repeat(x, counts) for x in (owner, begin, end))
        places = places.astype(np.int64)
        lost = owner < ids[np.searchsorted(offsets, places, "right") - 1]
        np.add.at(step, places[lost] + begin[lost], 1)
        np.add.at(step, places[lost] + end[lost] + LENGTH - 1, -1)
    gone = np.cumsum(step[:-1]) > 0
    edge = gone.copy()
    edge[1:] &= ~gone[:-1]
    text_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    edge[text_starts] = gone[text_starts]
    first = np.flatnonzero(edge)
    last = gone.copy()
    last[:-1] &= ~gone[1:]
    last[text_starts[1:] - 1] = gone[text_starts[1:] - 1]
    end = np.flatnonzero(last) + 1
    text = np.searchsorted(offsets, first, "right") - 1
    kept = data[~gone].tobytes()
    kept_edge = np.append(0, np.cumsum(~gone))[offsets]
    structs = pa.StructArray.from_arrays([pa.array(first - offsets[text]), pa.array(end - offsets[text])], names=["start", "end"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(ids) + 1)), pa.int32()), structs)
    hashes = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(kept_edge, kept_edge[1:], strict=False)]
    return pa.table({"doc_id": ids, "n_bytes": np.diff(offsets), "removed": lists, "kept_sha256": hashes})


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, removed, kept_sha256), one row per row of `docs`.

    `removed` has the maximal runs [start, end) of UTF-8 bytes covered by a 50-byte string that also
    starts in a document with a smaller id; kept_sha256 is that of the other bytes. Strings are judged
    on the input. Null texts count as empty. Rows with equal ids are rows of their own that take
    nothing from each other. A row with a null id takes part in nothing and keeps its whole text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = rows.where("doc_id IS NOT NULL")
    volume = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, max(8, int(volume // BIN_BYTES).bit_length()))
    n_blocks = int(volume // BLOCK_BYTES) + 1
    blocks = known.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)))

    names = blocks.groupBy("block").applyInArrow(lambda t: _send_names(t, bits), NAMES)
    answers = names.groupBy("deal").applyInArrow(_merge_names, NAMES)
    sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda t, a: _send_spans(t, a, bits), SPANS
    )
    found = sent.groupBy("deal").applyInArrow(_find_owners, FOUND)
    result = blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_remove, RESULT)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return result.unionByName(
        rows.where("doc_id IS NULL").select(
            "doc_id",
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.array().cast("array<struct<start:long,end:long>>").alias("removed"),
            F.sha2(text, 256).alias("kept_sha256"),
        )
    )
