"""Counts of n-grams inside texts, as Arrow column functions.

The grams of many texts are counted in one vectorised pass: characters (or words) get small
numbers, as many of them as fit are packed into one integer, and longer grams are named by the
ranks of their halves. Equal names mean equal grams: nothing is hashed. Batches are worked through
in pieces of about PIECE characters or words, so the memory of a Python worker does not grow with
the rows of a batch.

Every function takes texts (or word arrays) at any depth of arrays and gives a value for each.
They stand in projections, never inside a lambda.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column

from tessella.functions.intervals import lazy_udf

#: Characters or words worked on at once.
PIECE = 1 << 17
#: Code points are below 2^21, so three of them make a 63-bit key.
POINT_BITS = 21


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts (null: none) and the texts' offsets into them."""
    strings = ["" if t is None else t for t in texts.to_pylist()]
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return points, np.concatenate([[0], np.cumsum(lengths)])


def _ranks(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Values as numbers from 0 in their order, and how many there are."""
    if not len(values):
        return values, 1
    top = int(values.max())
    if top < 4 * len(values) + (1 << 16):
        seen = np.bincount(values, minlength=top + 1) > 0
        return (np.cumsum(seen) - 1)[values], int(seen.sum())
    found, inverse = np.unique(values, return_inverse=True)
    return inverse.reshape(-1).astype(np.int64), len(found)


def gram_names(symbols: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """A number for the n symbols from each place on, equal for equal grams, and a bound above them.

    Places too near the end of the array are left out."""
    names, bound = _ranks(symbols)
    width = 1
    while width < n and len(names):
        # As many grams of the present width as fit into 62 bits are packed side by side.
        fit, room = 1, bound
        while room * bound < 1 << 62 and width * fit < n:
            fit, room = fit + 1, room * bound
        if fit == 1:
            names, bound = _ranks(names)
            continue
        wide = min(n, width * fit)
        count = max(len(names) - (wide - width), 0)
        packed = np.zeros(count, np.int64)
        for k in range(fit):
            at = min(k * width, wide - width)
            packed = packed * bound + names[at : at + count]
        names, bound, width = packed, room, wide
    return names, bound


def grams_by_text(symbols: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams of each text: text, count and a place of each; and the texts' numbers of grams."""
    texts = len(offsets) - 1
    total = np.maximum(np.diff(offsets) - n + 1, 0)
    names, bound = gram_names(symbols, n)
    owner = np.repeat(np.arange(texts), total)
    first = np.repeat(offsets[:-1] - (np.cumsum(total) - total), total)
    places = np.arange(len(owner)) + first
    names = names[places]
    if bound * max(texts, 1) >= 1 << 62:
        names, bound = _ranks(names)
    keys = owner * bound + names
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([starts, [len(keys)]]))
    return owner[order[starts]], counts, places[order[starts]], total


def _char_ratios(points: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    owner, counts, _, total = grams_by_text(points, offsets, n)
    texts = len(total)
    distinct = np.bincount(owner, minlength=texts)
    again = counts > 1
    owner, counts = owner[again], counts[again]
    order = np.lexsort((-counts, owner))
    owner, counts = owner[order], counts[order]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    top = place < np.floor(np.sqrt(distinct))[owner]
    return np.bincount(owner[top], counts[top], texts) / np.maximum(total, 1)


def _word_ratios(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    owner, counts, _, total = grams_by_text(words, offsets, n)
    again = counts > 1
    return np.bincount(owner[again], counts[again], len(total)) / np.maximum(total, 1)


def pieces(sizes: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items with about `most` (PIECE) in all, at least one item each."""
    most = most or PIECE
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        end = max(int(np.searchsorted(ends, before + most, side="right")), start + 1)
        yield start, end
        start = end


def _nested(values: pa.Array, leaf, work) -> pa.Array:
    """`work` on the innermost items of an array of any depth, its result in the same arrays."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if leaf(values.type):
        return work(values)
    lengths = pc.list_value_length(values).fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    inner = _nested(pc.list_flatten(values), leaf, work)
    return pa.ListArray.from_arrays(pa.array(offsets), inner, mask=values.is_null())


def _is_string(kind: pa.DataType) -> bool:
    return pa.types.is_string(kind) or pa.types.is_large_string(kind)


def _is_words(kind: pa.DataType) -> bool:
    return pa.types.is_list(kind) and _is_string(kind.value_type)


def char_ratios(texts: pa.Array, n: int) -> pa.Array:
    """Char repetition of every text: see metrics.char_repetition_ratio."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    parts = [_char_ratios(*code_points(texts.slice(a, b - a)), n) for a, b in pieces(sizes)]
    return pa.array(np.concatenate(parts) if parts else np.zeros(0))


def word_ratios(texts: pa.Array, n: int) -> pa.Array:
    """Word repetition of every word array: see metrics.word_repetition_ratio."""
    sizes = pc.list_value_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = []
    for a, b in pieces(sizes):
        words = pc.list_flatten(texts.slice(a, b - a)).dictionary_encode()
        numbers = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        parts.append(_word_ratios(numbers, np.concatenate([[0], np.cumsum(sizes[a:b])]), n))
    return pa.array(np.concatenate(parts) if parts else np.zeros(0))


def _function(leaf, kernel, n: int):
    def run(values: pa.Array) -> pa.Array:
        return _nested(values, leaf, lambda x: kernel(x, n))

    return run


_UDFS: dict = {}


def _ratio_udf(leaf, kernel, n: int, depth: int):
    key = (kernel.__name__, n, depth)
    if key not in _UDFS:
        _UDFS[key] = lazy_udf(_function(leaf, kernel, n), "array<" * depth + "double" + ">" * depth)
    return _UDFS[key]


def char_repetition(texts: Column, n: int, depth: int = 0) -> Column:
    """Char repetition of a text, or of all texts in arrays of this depth."""
    return _ratio_udf(_is_string, char_ratios, n, depth)(texts)


def word_repetition(words: Column, n: int, depth: int = 0) -> Column:
    """Word repetition of a word array, or of all word arrays in arrays of this depth."""
    return _ratio_udf(_is_words, word_ratios, n, depth)(words)


# --- Counted keys for the models ----------------------------------------------------------


def _char_keys(points: np.ndarray, places: np.ndarray, n: int) -> pa.Array:
    """Keys of the grams at these places: up to three code points in one bigint, more as UTF-32."""
    if n <= 3:
        keys = np.zeros(len(places), np.int64)
        for k in range(n):
            keys = (keys << POINT_BITS) | points[places + k]
        return pa.array(keys)
    grams = points.astype("<u4")[places[:, None] + np.arange(n)[None, :]]
    offsets = np.arange(len(places) + 1, dtype=np.int32) * (4 * n)
    return pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(grams.tobytes())])


def char_key_type(n: int) -> str:
    return "bigint" if n <= 3 else "binary"


def char_counts(texts: pa.Array, n: int) -> pa.Array:
    """list<struct<key, c>>: the distinct grams of every text with their counts."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    lists = []
    for a, b in pieces(sizes):
        points, offsets = code_points(texts.slice(a, b - a))
        owner, counts, places, total = grams_by_text(points, offsets, n)
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(total)))])
        items = pa.StructArray.from_arrays([_char_keys(points, places, n), pa.array(counts)], ["key", "c"])
        lists.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items))
    return pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.struct([("key", pa.int64() if n <= 3 else pa.binary()), ("c", pa.int64())])))


def summed_chars(n: int):
    """mapInArrow function: (label, text) to (label, key, n), summed over the texts of a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = batch.column("text"), batch.column("label").dictionary_encode("encode")
            label = labels.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(label, kind="stable")
            texts, label = texts.take(pa.array(order)), label[order]
            sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in pieces(sizes, 4 * PIECE):
                points, offsets = code_points(texts.slice(a, b - a))
                # The grams of a label's texts are counted as those of one text; none crosses a border.
                names, bound = gram_names(points, n)
                total = np.maximum(np.diff(offsets) - n + 1, 0)
                places = np.arange(total.sum()) + np.repeat(offsets[:-1] - (np.cumsum(total) - total), total)
                names = names[places]
                if bound * len(labels.dictionary) >= 16 * PIECE:
                    names, bound = _ranks(names)
                keys = np.repeat(label[a:b], total) * bound + names
                if not len(keys):
                    continue
                counts = np.bincount(keys)
                where = np.zeros(len(counts), np.int64)
                where[keys] = places
                found = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [labels.dictionary.take(pa.array(found // bound)), _char_keys(points, where[found], n), pa.array(counts[found])],
                    names=["label", "key", "n"],
                )

    return run


# A text is looked up by pieces of many texts: each piece asks once for each of its grams.


def piece_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: rows with `_text` get `_piece`, which neighbours of a task share up to 8 PIECE bytes."""
    first, before = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        # A row counts a little besides its text, so that short texts fill a piece too.
        sizes = pc.binary_length(batch.column("_text")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
        ends = before + np.cumsum(sizes)
        yield batch.append_column("_piece", pa.array(first + (ends - sizes) // (8 * PIECE)))
        before = int(ends[-1]) if len(ends) else before


def _named_grams(texts: pa.Array, n: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """For each gram of the texts its place in the second result, the keys; and the texts' numbers of grams."""
    points, offsets = code_points(texts)
    names, _ = gram_names(points, n)
    total = np.maximum(np.diff(offsets) - n + 1, 0)
    places = np.arange(total.sum()) + np.repeat(offsets[:-1] - (np.cumsum(total) - total), total)
    if not len(places):
        return places, _char_keys(points, places, n), total
    names, distinct = _ranks(names[places])
    where = np.zeros(distinct, np.int64)
    where[names] = places
    return names, _char_keys(points, where, n), total


def piece_keys(n: int):
    """mapInArrow function: (_piece, _text) to the distinct (_piece, key)."""

    def asked(piece: int, texts: list[pa.Array]) -> pa.RecordBatch:
        keys = _named_grams(pa.chunked_array(texts), n)[1]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), piece)), keys], names=["_piece", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = 0, []
        for batch in batches:
            piece = batch.column("_piece").to_numpy(zero_copy_only=False)
            borders = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(piece)] if len(piece) else []
            for a, b in zip(borders, borders[1:]):
                if texts and piece[a] != held:
                    yield asked(held, texts)
                    texts = []
                held = piece[a]
                texts.append(batch.column("_text").slice(a, b - a))
        if texts:
            yield asked(held, texts)

    return run


def piece_sums(n: int, ids: list[str], weights: list[str]):
    """applyInArrow function on the texts of a piece and its (key, weights): for each text (ids, m,
    sums of the weights), with m grams; unknown grams and NULL weights count 0."""

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        names, keys, total = _named_grams(texts["_text"], n)
        ends = np.cumsum(total)
        at = pc.index_in(keys, known["key"].combine_chunks()).fill_null(-1).to_numpy(zero_copy_only=False)
        sums = []
        for w in weights:
            # Place -1 is the weight of an unknown gram.
            of_key = np.append(known[w].fill_null(0).to_numpy().astype(np.int64), 0)[at]
            running = np.concatenate([[0], np.cumsum(of_key[names])])
            sums.append(pa.array(running[ends] - running[ends - total]))
        return pa.table([*[texts[c] for c in ids], pa.array(total), *sums], names=[*ids, "m", *weights])

    return run


START, END = "<s>", "</s>"


def line_bigrams(text: str) -> Iterator[tuple[str, str]]:
    """Neighbouring tokens of every line of a text, with the border tokens around each line."""
    lines = [[START, *filter(None, line.split(" ")), END] for line in text.replace("\t", " ").split("\n")]
    return chain.from_iterable(zip(tokens, tokens[1:]) for tokens in lines)
