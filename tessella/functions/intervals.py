"""Interval tests on the node arrays of pages, as Arrow column functions.

Every node of a page carries its pre-order number `no` and `end`, the number of its last
descendant, so that "y lies inside x" is x.no < y.no <= x.end. The functions here take whole
Arrow batches of node arrays (one list per page, pages one after the other) and answer such
questions for all nodes of all pages in one vectorised sweep: a running maximum of the ends of
chosen nodes, prefix sums, or a sorted search of numbers. Nothing compares a node with a list of
other nodes, so the work is linear (or n log n) in the nodes of a batch, not in their product.

Arrays must hold their nodes in document order (increasing `no`), which every page operator
keeps: they remove, relabel or unwrap nodes, and never reorder them. A null array gives a null
result; a null flag counts as false; a null number is never inside or flagged.
"""

from __future__ import annotations

from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

#: Pages are told apart by adding page index x SPAN to node numbers, which stay below 2^31.
SPAN = np.int64(1 << 33)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list array as numpy (nulls as 0 / False) and offsets from 0."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    values = pc.list_flatten(lists)
    if pa.types.is_boolean(values.type):
        flat = np.asarray(values.fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)
    else:
        flat = np.asarray(values.fill_null(-1).to_numpy(zero_copy_only=False), dtype=np.int64)
    return flat, offsets


def _pages(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))


def _lists(like: pa.Array, values: np.ndarray, kind: pa.DataType, offsets: np.ndarray) -> pa.Array:
    if isinstance(like, pa.ChunkedArray):
        like = like.combine_chunks()
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32), pa.int32()), pa.array(values, kind), mask=like.is_null()
    )


#: Nodes worked on at once.
PIECE = 1 << 16


def _in_pieces(function):
    """`function` on ranges of pages with about PIECE nodes, so that a worker's memory is that of a
    range and not of a batch, however many pages a batch has."""

    @wraps(function)
    def run(*columns: pa.Array) -> pa.Array:
        arrays = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        ends = np.cumsum(pc.list_value_length(arrays[0]).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        parts, start = [], 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            end = max(int(np.searchsorted(ends, before + PIECE, side="right")), start + 1)
            parts.append(function(*[a.slice(start, end - start) for a in arrays]))
            start = end
        return pa.concat_arrays(parts) if parts else function(*arrays)

    return run


def strictly_inside_np(no: np.ndarray, end: np.ndarray, flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each node: whether a flagged node before it in its page has end >= its number."""
    page = _pages(offsets) * SPAN
    key = np.where(flag & (no >= 0), page + end, page - 1)
    reach = np.maximum.accumulate(key) if len(key) else key
    before = np.concatenate([[np.int64(-1)], reach[:-1]]) if len(key) else key
    return (before >= page + no) & (no >= 0)


def has_inside_np(no: np.ndarray, end: np.ndarray, flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each node: whether a flagged node lies in [no, end] of its page (itself included)."""
    page = _pages(offsets) * SPAN
    keys = page + no
    counts = np.concatenate([[0], np.cumsum(flag)])
    last = np.searchsorted(keys, page + np.maximum(end, no), side="right")
    return (counts[last] - counts[np.arange(len(no))] > 0) & (no >= 0)


def first_inside_np(no: np.ndarray, end: np.ndarray, flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each node: the index in its page of the first flagged node strictly inside it, else -1."""
    n = len(no)
    page = _pages(offsets) * SPAN
    last = np.searchsorted(page + no, page + end, side="right")
    at = np.where(flag, np.arange(n), n)
    nxt = np.minimum.accumulate(at[::-1])[::-1] if n else at
    nxt = np.concatenate([nxt[1:], [n]]) if n else nxt
    found = (nxt < last) & (no >= 0)
    return np.where(found, nxt - offsets[:-1][_pages(offsets)] if n else nxt, -1)


def parent_in_np(parent: np.ndarray, no: np.ndarray, flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each node: whether its parent (by number) is a flagged node of the same page."""
    page = _pages(offsets) * SPAN
    chosen = np.sort(page[flag & (no >= 0)] + no[flag & (no >= 0)])
    return np.isin(page + parent, chosen) & (parent >= 0)


def child_count_np(parent: np.ndarray, no: np.ndarray, flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each node: how many flagged nodes of its page have it as parent."""
    page = _pages(offsets) * SPAN
    keys = page + no
    target = page + parent
    at = np.searchsorted(keys, target)
    ok = flag & (parent >= 0) & (at < len(keys))
    ok[ok] &= keys[at[ok]] == target[ok]
    return np.bincount(at[ok], minlength=len(no)).astype(np.int64)


@_in_pieces
def entries_flagged(paths: pa.Array, no: pa.Array, flag: pa.Array) -> pa.Array:
    """list<list<boolean>>: for each entry of each node's path, whether that entry's node is flagged."""
    if isinstance(paths, pa.ChunkedArray):
        paths = paths.combine_chunks()
    nos, offsets = _flat(no)
    flags, _ = _flat(flag)
    page = _pages(offsets) * SPAN
    chosen = np.sort(page[flags & (nos >= 0)] + nos[flags & (nos >= 0)])
    inner_lists = pc.list_flatten(paths)
    entry_no, inner = _flat(inner_lists)
    outer = offsets
    # Page of every entry: the page of the node whose path holds it (`page` is per node).
    entry_page = np.repeat(page, np.diff(inner))
    hit = np.isin(entry_page + entry_no, chosen) & (entry_no >= 0)
    inner_out = pa.ListArray.from_arrays(pa.array(inner.astype(np.int32), pa.int32()), pa.array(hit, pa.bool_()), mask=inner_lists.is_null())
    return pa.ListArray.from_arrays(pa.array(outer.astype(np.int32), pa.int32()), inner_out, mask=paths.is_null())


def _unary(kernel, kind: pa.DataType):
    @_in_pieces
    def work(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        x, offsets = _flat(a)
        y, _ = _flat(b)
        z, _ = _flat(c)
        return _lists(a, kernel(x, y, z, offsets), kind, offsets)

    def run(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        return work(a, b, c)

    return run


@_in_pieces
def _live(no: pa.Array, end: pa.Array, parent: pa.Array, alive: pa.Array, leaf: pa.Array) -> pa.Array:
    """array<bigint> per node: 4 if it is inside a `leaf` node; else 1 if it or a node inside it
    is alive (alive nodes inside leaf nodes do not count), plus 2 if its parent is so."""
    nos, offsets = _flat(no)
    ends, _ = _flat(end)
    parents, _ = _flat(parent)
    flags, _ = _flat(alive)
    leaves, _ = _flat(leaf)
    hidden = strictly_inside_np(nos, ends, leaves, offsets)
    live = has_inside_np(nos, ends, flags & ~hidden, offsets)
    code = live.astype(np.int64) + 2 * parent_in_np(parents, nos, live, offsets).astype(np.int64)
    return _lists(no, np.where(hidden, 4, code), pa.int64(), offsets)


def last_inside_np(no: np.ndarray, end: np.ndarray, _unused: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each node: the index in its page of the last node in [no, end] (itself for a leaf)."""
    page = _pages(offsets) * SPAN
    last = np.searchsorted(page + no, page + np.maximum(end, no), side="right") - 1
    return last - (offsets[:-1][_pages(offsets)] if len(no) else 0)


@_in_pieces
def _caption_texts(no: pa.Array, end: pa.Array, holder: pa.Array, text: pa.Array) -> pa.Array:
    """list<string> per node: the text of the first caption of its page (in caption order) that is
    not empty and whose holder is the node or a node around it; else null.

    Captions are (holder number, text) lists per page. One pass over the nodes of a page that has
    captions, with a stack of the holders around the current node: linear in the nodes."""
    nos, offsets = _flat(no)
    ends, _ = _flat(end)
    holders, caption_offsets = _flat(holder)
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    texts = pc.list_flatten(text).to_pylist()
    out: list = [None] * len(nos)
    for p in range(len(offsets) - 1):
        first: dict = {}
        for k in range(caption_offsets[p], caption_offsets[p + 1]):
            if holders[k] >= 0 and texts[k] and holders[k] not in first:
                first[holders[k]] = k
        if not first:
            continue
        around: list = []
        for i in range(offsets[p], offsets[p + 1]):
            while around and around[-1][0] < nos[i]:
                around.pop()
            best = around[-1][1] if around else None
            own = first.get(nos[i])
            if own is not None and (best is None or own < best):
                best = own
            if best is not None:
                out[i] = texts[best]
            around.append((ends[i], best))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), pa.int32()), pa.array(out, pa.string()), mask=no.is_null() if not isinstance(no, pa.ChunkedArray) else no.combine_chunks().is_null())


def unwrapped_parent_np(parent: np.ndarray, no: np.ndarray, unwrapped: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each node: the number of the nearest node around it that is not unwrapped, else -1."""
    n = len(no)
    keys = _pages(offsets) * SPAN
    target = keys + parent
    keys = keys + no
    at = np.searchsorted(keys, target)
    known = (parent >= 0) & (at < n)
    known[known] &= keys[at[known]] == target[known]
    # Index n stands for no node. Unwrapped nodes point further out, and every round doubles the way.
    out = np.where(known, at, n)
    jump = np.append(np.where(unwrapped, out, np.arange(n)), n)
    while not np.array_equal(further := jump[jump], jump):
        jump = further
    return np.append(no, -1)[jump[out]]


#: What a node is, as bits of a code (see html.simplify).
DROPPED, REPLACED, UNWRAPPED, DATED, TEXT, ALIVE, ALIVE_AS_TEXT, LEAF, SOURCE, USABLE, ASKS_INNER, ROOT = (1 << i for i in range(12))


#: What becomes of a node; paths of nodes inside unwrapped ones change.
GONE, STAYS, INSIDE_UNWRAPPED = 0, 1, 2


@_in_pieces
def _simplified(no: pa.Array, end: pa.Array, parent: pa.Array, code: pa.Array) -> pa.Array:
    """list<bigint> per node: GONE or one of STAYS and INSIDE_UNWRAPPED when dropped subtrees, the content
    of replaced nodes, unwrapped nodes, texts of dated parents and then empty nodes are taken out."""
    nos, offsets = _flat(no)
    ends, _ = _flat(end)
    parents, _ = _flat(parent)
    codes, _ = _flat(code)

    def has(bit: int) -> np.ndarray:
        return codes & bit != 0

    replaced = has(REPLACED)
    dropped = has(DROPPED)
    unwrapped = has(UNWRAPPED) & ~replaced
    text = has(TEXT) | replaced
    wrapped = strictly_inside_np(nos, ends, unwrapped, offsets)
    stays = ~(dropped | unwrapped | strictly_inside_np(nos, ends, dropped | replaced, offsets))
    parents = unwrapped_parent_np(parents, nos, unwrapped, offsets)
    stays &= ~(text & parent_in_np(parents, nos, has(DATED) & ~replaced & stays, offsets))
    # What is left, as pages of their own.
    left = np.flatnonzero(stays)
    offsets_left = np.concatenate([[0], np.cumsum(stays)])[offsets]
    codes, nos, parents = codes[left], nos[left], parents[left]
    replaced, text = replaced[left], text[left]
    ends = np.where(replaced, nos, ends[left])
    first = first_inside_np(nos, ends, has(SOURCE) & ~replaced, offsets_left)
    source = np.where(first >= 0, first + offsets_left[:-1][_pages(offsets_left)], -1)
    inner = np.append(has(USABLE), False)[source]
    alive = np.where(replaced, has(ALIVE_AS_TEXT), has(ALIVE) | (has(ASKS_INNER) & inner))
    hidden = strictly_inside_np(nos, ends, has(LEAF) & ~replaced, offsets_left)
    live = has_inside_np(nos, ends, alive & ~hidden, offsets_left)
    within = parent_in_np(parents, nos, live, offsets_left)
    stays[left] = ~hidden & np.where(text, within, live | has(ROOT))
    return _lists(no, np.where(stays, np.where(wrapped, INSIDE_UNWRAPPED, STAYS), GONE), pa.int64(), offsets)


#: Bits of the codes that `collapsed` takes.
ELEMENT, FILLED_TEXT, SAME_AS_PARENT = 1, 2, 4


@_in_pieces
def _collapsed(paths: pa.Array, no: pa.Array, parent: pa.Array, code: pa.Array) -> pa.Array:
    """list<list<boolean>>: for each entry of each node's path, whether that entry's node has one element
    of its own tag as its only content; null for nodes without such an entry."""
    nos, offsets = _flat(no)
    parents, _ = _flat(parent)
    codes, _ = _flat(code)
    elements, texts, same = (
        child_count_np(parents, nos, codes & bit != 0, offsets) for bit in (ELEMENT, FILLED_TEXT, SAME_AS_PARENT)
    )
    outer = (elements == 1) & (texts == 0) & (same == 1) & (nos >= 0)
    page = _pages(offsets) * SPAN
    entry_no, inner = _flat(pc.list_flatten(paths))
    keys = page + nos
    target = np.repeat(page, np.diff(inner)) + entry_no
    at = np.minimum(np.searchsorted(keys, target), max(len(keys) - 1, 0))
    hit = (keys[at] == target) & outer[at] & (entry_no >= 0) if len(keys) else np.zeros(0, bool)
    counts = np.concatenate([[0], np.cumsum(hit)])[inner]
    flags = pa.ListArray.from_arrays(
        pa.array(inner.astype(np.int32), pa.int32()), pa.array(hit, pa.bool_()), mask=pa.array(np.diff(counts) == 0)
    )
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), pa.int32()), flags, mask=paths.is_null())


@_in_pieces
def _figure_captions(no: pa.Array, end: pa.Array, holder: pa.Array, text: pa.Array) -> pa.Array:
    """list<string> per node: `holder` is a number for captions, else null; `text` is the stripped text
    of leaves inside captions, else null. The texts inside a caption are joined by blanks, and every
    node gets the first caption as in _caption_texts."""
    nos, offsets = _flat(no)
    ends, _ = _flat(end)
    holders, _ = _flat(holder)
    last = last_inside_np(nos, ends, nos, offsets) + offsets[:-1][_pages(offsets)]
    captions = np.flatnonzero(holders >= 0)
    values = pc.list_flatten(text)
    filled = np.flatnonzero(pc.fill_null(pc.not_equal(values, ""), False).to_numpy(zero_copy_only=False))
    words = values.take(pa.array(filled)).to_pylist()
    starts = np.searchsorted(filled, captions, side="right")
    stops = np.searchsorted(filled, last[captions], side="right")
    joined = [" ".join(words[a:b]) for a, b in zip(starts, stops)]
    per_page = pa.array(np.searchsorted(captions, offsets).astype(np.int32), pa.int32())
    return _caption_texts(
        no,
        end,
        pa.ListArray.from_arrays(per_page, pa.array(holders[captions], pa.int64())),
        pa.ListArray.from_arrays(per_page, pa.array(joined, pa.string())),
    )


_TYPES = {pa.bool_(): "array<boolean>", pa.int64(): "array<bigint>"}


def lazy_udf(function, kind: str):
    """The Arrow UDF is made on first use: making one needs an active session.

    It is marked nondeterministic, though it is not: a page step refers to its input array
    several times, and otherwise Catalyst would paste the previous step's whole expression into
    each reference, growing plan and work exponentially with the number of steps."""
    made = []

    def call(*columns: Column) -> Column:
        if not made:
            made.append(arrow_udf(function, kind).asNondeterministic())
        return made[0](*columns)

    return call


def _udf(kernel, kind: pa.DataType):
    return lazy_udf(_unary(kernel, kind), _TYPES[kind])


_strictly_inside = _udf(strictly_inside_np, pa.bool_())
_has_inside = _udf(has_inside_np, pa.bool_())
_first_inside = _udf(first_inside_np, pa.int64())
_parent_in = _udf(parent_in_np, pa.bool_())
_child_count = _udf(child_count_np, pa.int64())
_simplified_udf = lazy_udf(_simplified, "array<bigint>")
_collapsed_udf = lazy_udf(_collapsed, "array<array<boolean>>")
_figure_captions_udf = lazy_udf(_figure_captions, "array<string>")


def simplified(no: Column, end: Column, parent: Column, code: Column) -> Column:
    """array<bigint>: GONE, STAYS or INSIDE_UNWRAPPED; `code` holds the bits DROPPED to ROOT."""
    return _simplified_udf(no, end, parent, code)


def collapsed(path_nos: Column, no: Column, parent: Column, code: Column) -> Column:
    """array<array<boolean>>: per path entry, whether its node holds nothing but one element of its
    tag; null for a node without such an entry. `code` holds ELEMENT, FILLED_TEXT, SAME_AS_PARENT."""
    return _collapsed_udf(path_nos, no, parent, code)


def figure_captions(no: Column, end: Column, holder: Column, text: Column) -> Column:
    """array<string>: per node, the first non-empty caption whose holder is the node or around it."""
    return _figure_captions_udf(no, end, holder, text)


_entries_flagged = lazy_udf(entries_flagged, "array<array<boolean>>")


_live_udf = lazy_udf(_live, "array<bigint>")


def live_codes(no: Column, end: Column, parent: Column, alive: Column, leaf: Column) -> Column:
    """array<bigint>: 4 inside a leaf node, else 1 when a node or one inside it is alive, + 2 when
    its parent is live."""
    return _live_udf(no, end, parent, alive, leaf)


def path_flags(path_nos: Column, no: Column, flag: Column) -> Column:
    """array<array<boolean>>: per path entry, whether its node is flagged."""
    return _entries_flagged(path_nos, no, flag)


def strictly_inside(no: Column, end: Column, flag: Column) -> Column:
    """array<boolean>: inside a flagged node other than itself."""
    return _strictly_inside(no, end, flag)


def has_inside(no: Column, end: Column, flag: Column) -> Column:
    """array<boolean>: itself or a node inside it is flagged."""
    return _has_inside(no, end, flag)


def first_inside(no: Column, end: Column, flag: Column) -> Column:
    """array<bigint>: 0-based index of the first flagged node strictly inside, else -1."""
    return _first_inside(no, end, flag)


def parent_in(parent: Column, no: Column, flag: Column) -> Column:
    """array<boolean>: its parent is flagged."""
    return _parent_in(parent, no, flag)


def child_count(parent: Column, no: Column, flag: Column) -> Column:
    """array<bigint>: number of flagged children."""
    return _child_count(parent, no, flag)
