"""Bigrams of large corpora as packed blobs: counting them, and asking for their counts.

A bigram is hardly shorter than its share of the text, so rows of strings cost a shuffle many times
the text. Here texts are cut into pieces of about PIECE bytes and each piece is tokenized once. It
sends one blob to every bucket (a hash of the bigram): its distinct bigrams of that bucket as a list
of tokens and two numbers each, compressed. A bucket adds up the blobs of all pieces, or answers
a piece with the counts alone, in the order of the question. Tokens are compared, never their hashes.

All rows are (at, kind, part, data): `at` is the bucket or piece that works on them; the stream of
an `at` is sorted by kind and part, and a worker holds the rows of one `at` at most.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

from tessella import constants as C
from tessella.functions.ngrams import END, START, pieces

#: Bytes of text worked on at once; a worker takes about 40 times as much besides its Arrow batch.
PIECE = 1 << 22
#: Keys looked up at once in a bucket.
ASKED = 1 << 19
ROWS = "at bigint, kind int, part bigint, data binary"
NAMES = ["at", "kind", "part", "data"]
#: Kinds of rows: what is looked up in comes before what asks.
KNOWN, ASKING = 0, 1


# --- Blobs ---------------------------------------------------------------------------------


def pack(*parts: np.ndarray | bytes) -> bytes:
    """Arrays of integers from 0 and byte strings as one compressed blob.

    The bytes of an array's numbers are laid out by significance, which high zeros need not be."""
    head, raw = [len(parts)], []
    for part in parts:
        width = 0
        if not isinstance(part, bytes):
            width = max(int(part.max()).bit_length() + 7 >> 3, 1) if len(part) else 1
            part = b"".join([(part >> 8 * i).astype(np.uint8).tobytes() for i in range(width)])
        head += [width, len(part)]
        raw.append(part)
    data = b"".join(raw)
    return np.array(head, "<u4").tobytes() + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def unpack(blob: bytes) -> list[np.ndarray | bytes]:
    count = int(np.frombuffer(blob, "<u4", 1)[0])
    head = np.frombuffer(blob, "<u4", 2 * count, 4).reshape(-1, 2).tolist()
    total, parts, at = sum(n for _, n in head), [], 0
    data = pa.decompress(memoryview(blob)[8 * count + 4 :], total, codec="zstd", asbytes=True) if total else b""
    for width, n in head:
        parts.append(_numbers(data, at, n, width) if width else data[at : at + n])
        at += n
    return parts


def _numbers(data: bytes, at: int, size: int, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, size, at).reshape(width, -1)
    found = planes[0].astype(np.int64)
    for i in range(1, width):
        found |= planes[i].astype(np.int64) << 8 * i
    return found


def _spelled(tokens: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of all tokens, and their lengths."""
    lengths = pc.binary_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
    data = tokens.buffers()[2]
    start = int(np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset]) if len(tokens) else 0
    return (data.slice(start, int(lengths.sum())).to_pybytes() if data is not None else b""), lengths


def _tokens(data: bytes, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _row(at: int, kind: int, part: int, data: bytes) -> pa.RecordBatch:
    return rows([at], [kind], [part], [data])


def rows(at, kind, part, data) -> pa.RecordBatch:
    arrays = [pa.array(at, pa.int64()), pa.array(kind, pa.int32()), pa.array(part, pa.int64()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=NAMES)


def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, int, bytes]]]]:
    """(at, its rows as (kind, part, data)) of a partition sorted by at."""

    def all_rows():
        for batch in batches:
            at, kind, part, data = (batch.column(n) for n in NAMES)
            for i in range(batch.num_rows):
                yield at[i].as_py(), kind[i].as_py(), part[i].as_py(), data[i].as_py()

    for at, group in groupby(all_rows(), key=lambda row: row[0]):
        yield at, (row[1:] for row in group)
    # An idle worker would keep what it has taken.
    pa.default_memory_pool().release_unused()


# --- Texts as token numbers ----------------------------------------------------------------


#: What stands in a normalized text for each code point, and what is a blank at its ends.
_PLAIN, _BLANK = np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, bool)
#: First bytes of characters above ASCII that are changed, and what stands for each ASCII byte.
_ODD, _ASCII = np.zeros(256, bool), bytearray(range(256))
_LONG = {mark: plain for mark, plain in C.UNICODE_PUNCTUATION.items() if len(plain) > 1}


def _fill_tables() -> None:
    every = np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    controls = [p for p in C.NON_PRINTING_CODE_POINTS if p != 10]
    for points, plain in ((map(ord, re.findall(r"\d", every)), "0"), (controls, " "), (map(ord, C.SPACE_LIKE), " ")):
        _PLAIN[list(points)] = ord(plain)
    for mark, plain in C.UNICODE_PUNCTUATION.items():
        _PLAIN[ord(mark)] = ord(plain[0])
    _BLANK[controls] = True
    _BLANK[[*map(ord, re.findall(r"\s", every))]] = True
    changed = np.flatnonzero(_BLANK | (_PLAIN != np.arange(len(_PLAIN))))
    _ODD[[chr(p).encode()[0] for p in changed if p >= 0x80]] = True
    _ASCII[:128] = _PLAIN[:128].astype(np.uint8).tobytes()


def normalized(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of text.normalize(keep_newlines=True) of all texts (null: none) and their offsets in it; blanks
    that belong to no token, at the ends of a text, are spaces and not cut off."""
    if not _BLANK[32]:
        _fill_tables()
    texts = pc.fill_null(pc.cast(texts, pa.large_binary()), b"")
    texts = _whole(texts) if isinstance(texts, pa.ChunkedArray) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2] or b"")[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    at = np.flatnonzero(_ODD[np.frombuffer(data, np.uint8)])
    odd = np.unique(np.searchsorted(offsets, at, side="right") - 1)
    if len(odd):
        plain, of_plain = _by_points(pc.cast(texts.take(pa.array(odd)), pa.large_string()).to_pylist())
        parts, done = [], 0
        for i, a, b in zip(odd, of_plain, of_plain[1:]):
            parts += [data[done : offsets[i]], plain[a:b]]
            done = offsets[i + 1]
        data = b"".join([*parts, data[done:]])
        sizes = np.diff(offsets)
        sizes[odd] = np.diff(of_plain)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
    found = np.frombuffer(bytearray(bytes(data).translate(_ASCII)), np.uint8)
    edges = np.zeros(len(offsets) - 1, bool)
    full = np.flatnonzero(np.diff(offsets))
    edges[full] = (found[offsets[full]] <= 32) | (found[offsets[full + 1] - 1] <= 32)
    edges[odd] = False
    for i in np.flatnonzero(edges):
        text = found[offsets[i] : offsets[i + 1]]
        solid = np.flatnonzero(text > 32)
        # Newlines among the blanks at an end begin no line.
        text[: solid[0] if len(solid) else len(text)] = 32
        text[solid[-1] + 1 if len(solid) else 0 :] = 32
    return found, offsets


def _by_points(strings: list[str]) -> tuple[bytes, np.ndarray]:
    for mark, plain in _LONG.items():
        strings = [t.replace(mark, plain) if mark in t else t for t in strings]
    ends = np.cumsum(np.fromiter(map(len, strings), np.int64, len(strings)))
    starts = np.concatenate([[0], ends[:-1]])
    points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = _BLANK[points]
    solid, blanks = np.flatnonzero(~blank), np.flatnonzero(blank)
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    text = np.searchsorted(ends, blanks, side="right")
    number = blanks - np.arange(len(blanks))
    points = _PLAIN[points]
    points[blanks[(number == first[text]) | (number == last[text])]] = 32
    data = points.astype("<u4", copy=False).tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    widths = np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int64))
    return data, np.concatenate([[0], widths])[np.concatenate([[0], ends])]


class Piece:
    """The lines of some texts: sorted distinct `tokens`, their numbers in `seq` with the border tokens
    around each line, how many tokens a line has, and how many lines a text."""

    def __init__(self, tokens: pa.Array, inner: np.ndarray, of_line: np.ndarray, of_text: np.ndarray):
        self.tokens, self.inner, self.of_line, self.of_text = tokens, inner, of_line, of_text
        border = pa.array([START.encode(), END.encode()], pa.binary())
        start, end = pc.index_in(border, value_set=tokens).to_pylist()
        ends = np.cumsum(of_line + 2) - 1
        self.is_end = np.zeros(len(inner) + 2 * len(of_line), bool)
        is_start = self.is_end.copy()
        self.is_end[ends] = True
        is_start[ends - of_line - 1] = True
        self.seq = np.empty(len(self.is_end), np.int64)
        self.seq[self.is_end], self.seq[is_start] = end, start
        self.seq[~(self.is_end | is_start)] = inner
        # Bigrams of a text: one more than tokens in each line.
        lines = np.concatenate([[0], np.cumsum(of_line + 1)])
        last = np.concatenate([[0], np.cumsum(of_text)])
        self.ends = lines[last]

    @classmethod
    def of(cls, texts: pa.Array) -> Piece:
        known = pc.is_valid(texts).to_numpy(zero_copy_only=False)
        data, offsets = normalized(texts)
        newline = data == 10
        inside = ~(newline | (data == 32) | (data == 9))
        # A border lies before each first byte of a text that has bytes.
        border = np.zeros(len(data) + 1, bool)
        border[offsets] = True
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        starts = np.flatnonzero(inside & ~(before & ~border[:-1]))
        stops = np.flatnonzero(inside & ~(after & ~border[1:])) + 1
        words = _tokens(data[inside].tobytes(), stops - starts)
        coded = pa.concat_arrays([words, pa.array([START.encode(), END.encode()], pa.binary())]).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy().astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        inner = rank[coded.indices.to_numpy()[:-2]]
        breaks = np.flatnonzero(newline)
        of_text = np.where(known, np.diff(np.searchsorted(breaks, offsets)) + 1, 0)
        base = np.cumsum(of_text) - of_text
        text = np.searchsorted(offsets, starts, side="right") - 1
        line = base[text] + np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[:-1])[text]
        return cls(coded.dictionary.take(pa.array(order)), inner, np.bincount(line, minlength=int(of_text.sum())), of_text)

    def blob(self, ids: pa.RecordBatch) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, ids.schema) as out:
            out.write_batch(ids)
        return pack(*_spelled(self.tokens), self.inner, self.of_line, self.of_text, sink.getvalue().to_pybytes())

    @classmethod
    def read(cls, blob: bytes) -> tuple[Piece, pa.Table]:
        data, lengths, inner, of_line, of_text, ids = unpack(blob)
        return cls(_tokens(data, lengths), inner, of_line, of_text), pa.ipc.open_stream(ids).read_all()

    def bigrams(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes (a V + b) of the distinct bigrams by bucket and code, how often each stands here, and the
        bucket of each."""
        codes, counts = np.unique(self._codes(), return_counts=True)
        order, bucket = self._dealt(codes, buckets)
        return codes[order], counts[order], bucket

    def places(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """For every bigram of the texts its place among the distinct ones, and the bucket of each of those."""
        codes, inverse = np.unique(self._codes(), return_inverse=True)
        order, bucket = self._dealt(codes, buckets)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return place[inverse.reshape(-1)], bucket

    def contexts(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers by bucket and token, and the bucket of each."""
        return _by_bucket(_bucket(self._hashes, np.zeros(len(self.tokens), np.uint64), buckets), buckets)

    def _codes(self) -> np.ndarray:
        at = np.flatnonzero(~self.is_end)
        return self.seq[at] * len(self.tokens) + self.seq[at + 1]

    def _dealt(self, codes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        first, second = np.divmod(codes, len(self.tokens))
        return _by_bucket(_bucket(self._hashes[first], self._hashes[second], buckets), buckets)

    @cached_property
    def _hashes(self) -> np.ndarray:
        data, lengths = _spelled(self.tokens)
        starts = np.cumsum(lengths) - lengths
        powers = np.cumprod(np.full(int(lengths.max()), 0x100000001B3, np.uint64))
        points = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        return np.add.reduceat(points * powers[np.arange(len(data)) - np.repeat(starts, lengths)], starts)


def _bucket(first: np.ndarray, second: np.ndarray, buckets: int) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + (second + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _by_bucket(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by bucket, and the buckets in it; numbers of 16 bits are sorted by radix."""
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    return order, bucket[order]


def _cut(bucket: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(bucket, np.arange(buckets + 1))


def _question(tokens: pa.Array, codes: np.ndarray, singles: np.ndarray) -> list[np.ndarray | bytes]:
    """Parts of a blob: the tokens that these bigrams need, the bigrams as pairs of their numbers
    (the first as the difference from the one before), and the single tokens."""
    size = max(len(tokens), 1)
    a, b = np.divmod(codes, size)
    if 8 * (len(codes) + len(singles)) < size:
        used, number = np.unique(np.concatenate([a, b, singles]), return_inverse=True)
        a, b, singles = np.split(number.reshape(-1), [len(a), len(a) + len(b)])
    else:
        held = np.zeros(size, bool)
        held[a], held[b], held[singles] = True, True, True
        used, number = np.flatnonzero(held), np.cumsum(held) - 1
        a, b, singles = number[a], number[b], number[singles]
    return [*_spelled(tokens.take(pa.array(used))), np.diff(a, prepend=0), b, singles]


def _asked(parts: list[np.ndarray | bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    data, lengths, a, b, singles = parts[:5]
    return _tokens(data, lengths), np.cumsum(a), b, singles


# --- Counting ------------------------------------------------------------------------------


def sent_counts(buckets: int):
    """mapInArrow function: (text) to a row for each piece and bucket: bigrams with their counts, and tokens
    with how many bigrams they begin and how many distinct ones they end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, part = TaskContext.get().partitionId() << 32, 0
        for texts in _texts(batches, "text"):
            piece = Piece.of(texts.column("text"))
            codes, counts, bucket = piece.bigrams(buckets)
            singles, of = piece.contexts(buckets)
            size = len(piece.tokens)
            begun = np.bincount(piece.seq[~piece.is_end], minlength=size)
            ended = np.bincount(codes % size, minlength=size)
            pairs, lone, out = _cut(bucket, buckets), _cut(of, buckets), []
            for k in range(buckets):
                x, y = slice(pairs[k], pairs[k + 1]), slice(lone[k], lone[k + 1])
                if x.start < x.stop or y.start < y.stop:
                    s = singles[y]
                    out.append((k, pack(*_question(piece.tokens, codes[x], s), counts[x], begun[s], ended[s])))
            yield rows([k for k, _ in out], [KNOWN] * len(out), [first + part] * len(out), [d for _, d in out])
            part += 1

    return run


def _texts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about PIECE bytes of text, across the borders of Spark's batches."""
    held, size = [], 0
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 16
        for a, b in pieces(sizes, PIECE):
            held.append(batch.slice(a, b - a))
            size += int(sizes[a:b].sum())
            if size >= PIECE // 2:
                yield _one(held)
                held, size = [], 0
    if held:
        yield _one(held)
    pa.default_memory_pool().release_unused()


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    return pa.RecordBatch.from_arrays([_whole(c) for c in table.columns], schema=table.schema)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _merged(blobs: list[bytes]) -> list[np.ndarray | bytes]:
    """The parts of a blob with the sums of these blobs."""
    asked, sums = [], []
    for blob in blobs:
        parts = unpack(blob)
        asked.append(_asked(parts))
        sums.append(parts[5:])
    coded = pa.concat_arrays([x[0] for x in asked]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy().astype(np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    number, size = rank[coded.indices.to_numpy()], max(len(order), 1)
    at = np.cumsum([0, *(len(x[0]) for x in asked)])
    codes = np.concatenate([number[s + a] * size + number[s + b] for s, (_, a, b, _) in zip(at, asked)])
    singles = np.concatenate([number[s + x[3]] for s, x in zip(at, asked)])
    counts, begun, ended = (np.concatenate([s[k] for s in sums]) for k in range(3))
    codes, (counts,) = _summed(codes, counts)
    singles, (begun, ended) = _summed(singles, begun, ended)
    return [*_question(coded.dictionary.take(pa.array(order)), codes, singles), counts, begun, ended]


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], [np.add.reduceat(v[order], starts) if len(starts) else v for v in values]


def summed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: rows of sent_counts, sorted by bucket, to (bucket, data, nexts): one row for each
    bucket with the sums, and how many of its tokens end a bigram."""
    for at, group in streams(batches):
        parts = _merged([data for _, _, data in group])
        yield pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int64()), pa.array([pack(*parts)], pa.binary()), pa.array([int((parts[-1] > 0).sum())])],
            names=["bucket", "data", "nexts"],
        )


# --- Asking --------------------------------------------------------------------------------


def packed_pieces(ids: list[str]):
    """mapInArrow function: (ids, _text) to a row for each piece of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for texts in _texts(batches, "_text"):
            yield _row(at, ASKING, 0, Piece.of(texts.column("_text")).blob(texts.select(ids)))
            at += 1

    return run


def asked_counts(buckets: int, copies: int, low: int, high: int):
    """mapInArrow function: pieces to their questions to the buckets from `low` to below `high`, each of
    which is there `copies` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, group in streams(batches):
            for _, _, data in group:
                piece = Piece.read(data)[0]
                codes, _, bucket = piece.bigrams(buckets)
                singles, of = piece.contexts(buckets)
                pairs, lone, out = _cut(bucket, buckets), _cut(of, buckets), []
                for k in range(low, high):
                    x, y = slice(pairs[k], pairs[k + 1]), slice(lone[k], lone[k + 1])
                    if x.start < x.stop or y.start < y.stop:
                        out.append((k * copies + at % copies, pack(*_question(piece.tokens, codes[x], singles[y]))))
                yield rows([k for k, _ in out], [ASKING] * len(out), [at] * len(out), [d for _, d in out])

    return run


def _answers(known: tuple, asked: list[tuple]) -> list[bytes]:
    """For each question the counts of its bigrams, and of the bigrams that its tokens begin; 0 if unknown."""
    tokens, codes, counts, singles, begun = known
    size = max(len(tokens), 1)
    number = pc.index_in(pa.concat_arrays([x[0] for x in asked]), value_set=tokens).fill_null(-1).to_numpy().astype(np.int64)
    at = np.cumsum([0, *(len(x[0]) for x in asked)])
    out = []
    for s, (_, a, b, lone) in zip(at, asked):
        first, second, lone = number[s + a], number[s + b], number[s + lone]
        pair = _found(codes, counts, np.where((first >= 0) & (second >= 0), first * size + second, -1))
        out.append(pack(pair, _found(singles, begun, lone)))
    return out


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the sorted keys that are wanted, else 0."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def answered_counts(copies: int):
    """mapInArrow function: counts and questions, sorted by bucket, to the answers for each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, group in streams(batches):
            known, held, size = None, [], 0
            for kind, part, data in group:
                if kind == KNOWN:
                    parts = unpack(data)
                    tokens, a, b, singles = _asked(parts)
                    known = tokens, a * max(len(tokens), 1) + b, parts[5], singles, parts[6]
                    continue
                asked = _asked(unpack(data))
                held.append((part, asked))
                size += len(asked[0]) + len(asked[1])
                if size >= ASKED:
                    yield _replies(at // copies, known, held)
                    held, size = [], 0
            if held:
                yield _replies(at // copies, known, held)

    return run


def _replies(bucket: int, known: tuple | None, held: list) -> pa.RecordBatch:
    none = np.zeros(0, np.int64)
    known = known or (pa.array([], pa.binary()), none, none, none, none)
    answers = _answers(known, [asked for _, asked in held])
    return rows([part for part, _ in held], [KNOWN] * len(held), [bucket] * len(held), answers)


def scored_texts(buckets: int, weights, ids: list[str]):
    """mapInArrow function: answers and pieces, sorted by piece, to (ids, hit, m) for each text: the sum of
    its weights and the number of its bigrams, NULL if it has none. `weights` turns counts into weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in streams(batches):
            answers = {}
            for kind, part, data in group:
                if kind == KNOWN:
                    answers[part] = unpack(data)
                    continue
                piece, names = Piece.read(data)
                place, bucket = piece.places(buckets)
                singles, of = piece.contexts(buckets)
                pairs, lone = np.zeros(len(bucket), np.int64), np.zeros(len(singles), np.int64)
                x, y = _cut(bucket, buckets), _cut(of, buckets)
                for k, (of_pairs, of_lone) in answers.items():
                    pairs[x[k] : x[k + 1]], lone[y[k] : y[k + 1]] = of_pairs, of_lone
                begun = np.empty(len(singles), np.int64)
                begun[singles] = weights.of_context(lone)
                summed = np.cumsum(weights.of_bigram(pairs)[place] + begun[piece.seq[~piece.is_end]])
                running = np.concatenate([[0], summed])[piece.ends]
                m = np.diff(piece.ends)
                columns = [*[_whole(names[c]) for c in ids], pa.array(np.diff(running)), pa.array(m, mask=m == 0)]
                yield pa.RecordBatch.from_arrays(columns, names=[*ids, "hit", "m"])

    return run
