"""Quality classifier by co-training.

Two views of a document: what its text says (shares of character and word kinds, repetition, hashed
words) and its page metadata (source, language, lengths, lines). A logistic model of each view is fitted
on labelled documents; over several rounds each labels the unlabelled documents that it is surest of for
the other one. Both are calibrated on labelled documents that neither has seen and combined; the cut is
set there as well, where precision and recall of both classes are best.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.textkit import LOWER, NOT_BLANK, pieces, span_hashes, text_bytes, words

#: Labelled and unlabelled documents the models are fitted on, chosen by a hash of the id.
LABELLED, UNLABELLED = 6000, 6000
ROUNDS, TAUGHT = 5, 0.05
#: A pseudo-label needs this probability. The cut is this one if no other is better by more than one document.
SURE, BALANCED = 0.95, 0.5
WORD_SLOTS, META_SLOTS = 128, 64

_MARKS = b"#$%&*!|@<>{}[]=+_~^\\/"


def text_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of features for every text."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)[:, None]

    def share(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[offsets[1:]] - sums[offsets[:-1]])[:, None] / size

    table = np.zeros((8, 256), bool)
    table[0, 65:91] = table[1, 97:123] = table[2, 48:58] = table[3, 128:] = True
    table[4, list(b".,;:?'\"-()")] = table[5, list(_MARKS)] = table[6, [10]] = table[7, list(b"!|")] = True
    kinds = [share(t[data]) for t in table]
    starts, ends, first = words(data, offsets, NOT_BLANK)
    h = span_hashes(LOWER[data], starts, ends)
    count = np.diff(first)
    owner = np.repeat(np.arange(n), count)
    many = np.maximum(count, 1)[:, None]

    def per_word(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, flags, n)[:, None] / many

    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((h, owner))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (owner[1:] != owner[:-1])
    last = data[np.maximum(ends - 1, 0)] if len(ends) else data[:0]
    head = data[starts]
    length = ends - starts
    slots = np.zeros((n, WORD_SLOTS))
    np.add.at(slots, (owner, (h % np.uint64(WORD_SLOTS)).astype(int)), 1)
    return np.hstack(
        [
            *kinds,
            per_word(length) / 10,
            np.sqrt(np.maximum(per_word(length.astype(float) ** 2) - per_word(length) ** 2, 0)) / 10,
            per_word(again),
            np.bincount(owner[order], new, n)[:, None] / np.sqrt(many) / 30,
            np.bincount(owner[order], new, n)[:, None] / many,
            per_word((head >= 65) & (head <= 90)),
            per_word(np.isin(last, list(_MARKS))),
            per_word((length == 1) & np.isin(head, list(_MARKS))),
            per_word(last == 46),
            np.log1p(count)[:, None] / 10,
            np.sqrt(slots / many),
        ]
    ).astype(np.float32)


def meta_view(source: list, lang: list, n_chars: list, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Source and language as hashed slots, lengths, and the lines of the page."""
    n = len(offsets) - 1
    out = np.zeros((n, META_SLOTS + 6), np.float32)
    for i, (s, g) in enumerate(zip(source, lang, strict=True)):
        out[i, zlib.crc32(f"source {s}".encode()) % META_SLOTS] = 1
        out[i, zlib.crc32(f"lang {g}".encode()) % META_SLOTS] += 1
    size = np.diff(offsets)
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    lines = breaks[offsets[1:]] - breaks[offsets[:-1]] + 1
    chars = np.array([float(x) if x is not None else -1.0 for x in n_chars])
    out[:, META_SLOTS] = np.log1p(size) / 10
    out[:, META_SLOTS + 1] = np.log1p(np.maximum(chars, 0)) / 10
    out[:, META_SLOTS + 2] = chars < 0
    out[:, META_SLOTS + 3] = np.where(chars > 0, chars / np.maximum(size, 1), 0)
    out[:, META_SLOTS + 4] = np.log1p(lines) / 5
    out[:, META_SLOTS + 5] = np.log1p(size / lines) / 10
    return out


def views(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(piece.column("text"))
    meta = meta_view(*(piece.column(c).to_pylist() for c in ("source", "lang", "n_chars")), data, offsets)
    return text_view(data, offsets), meta


class Logistic:
    """A logistic model of standardised features, with a ridge, fitted by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12):
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
        z = self._z(x)
        self.weights = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            slope = z.T @ (y - p) - penalty * self.weights
            curve = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            self.weights += step
            if np.abs(step).max() < 1e-6:
                break

    def _z(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._z(x.astype(np.float64)) @ self.weights, -30, 30)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def balanced_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The cut nearest to BALANCED whose mean F1 of both classes is the best one, or less than that by
    one document of the rarer class at most: so no single label moves it."""
    if not 0 < good.sum() < len(good):
        return BALANCED
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    # Cut number i rejects the i lowest scores; equal scores are not parted.
    lost = np.concatenate([[0], np.cumsum(g)])
    caught = np.arange(len(s) + 1) - lost
    n_good, n_bad = lost[-1], caught[-1]
    wrong = lost + (n_bad - caught)
    f1 = ((n_good - lost) * 2 / ((n_good - lost) * 2 + wrong) + caught * 2 / np.maximum(caught * 2 + wrong, 1)) / 2
    low, high = np.concatenate([[0.0], s]), np.concatenate([s, [1.0]])
    near = np.where((low < BALANCED) & (high >= BALANCED), BALANCED, (low + high) / 2)
    fair = (low < high) & (f1 >= f1[low < high].max() - 0.5 / min(n_good, n_bad))
    return float(near[fair][np.abs(near[fair] - BALANCED).argmin()])


class CoTrained:
    """Both views, their calibrated combination, and the cut."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, y: np.ndarray):
        """y: 1 good, 0 bad, -1 not labelled."""
        known = np.flatnonzero(y >= 0)
        held = known[np.arange(len(known)) % 3 == 0]
        open_ = np.flatnonzero(y < 0)
        labels = [y.copy(), y.copy()]
        for labelled in labels:
            labelled[held] = -1
        seen = (text, meta)
        for round_ in range(ROUNDS + 1):
            self.models = [Logistic(x[own >= 0], own[own >= 0]) for x, own in zip(seen, labels, strict=True)]
            if round_ == ROUNDS or not len(open_):
                break
            for view in (0, 1):
                p = self.models[view].predict(seen[view][open_])
                other = labels[1 - view]
                n = max(1, int(TAUGHT * len(open_)))
                best = np.argsort(-np.abs(p - 0.5), kind="stable")
                best = best[(np.maximum(p, 1 - p)[best] >= SURE) & (other[open_[best]] < 0)][:n]
                other[open_[best]] = (p[best] > 0.5).astype(int)
        margins = np.stack([m.margin(x[held]) for m, x in zip(self.models, seen, strict=True)], 1)
        truth = y[held]
        self.combined = Logistic(margins, truth, ridge=0.1)
        self.cut = balanced_cut(self.combined.predict(margins), truth == 1)

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        margins = np.stack([self.models[0].margin(text), self.models[1].margin(meta)], 1)
        return self.combined.predict(margins), *(1 / (1 + np.exp(-m)) for m in margins.T)


READ = (("doc_id", "long"), ("text", "string"), ("source", "string"), ("lang", "string"), ("n_chars", "double"))


def _read(docs: DataFrame, name: str, kind: str):
    return F.col(name).try_cast(kind) if name in docs.columns else F.lit(None).cast(kind)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*(_read(docs, n, k).alias(n) for n, k in READ))


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            text, meta = views(piece)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("quality"), *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (text, meta))],
                names=["doc_id", "quality", "text", "meta"],
            )


def train(docs: DataFrame, labels: DataFrame) -> CoTrained | None:
    """Fitted on a bounded sample: documents whose id hashes into a share of the range that holds about
    LABELLED labelled and UNLABELLED other ones. None if the labels are not of both classes."""
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    truth = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    share = min(1.0, LABELLED / max(1, truth.count())), min(1.0, UNLABELLED / max(1, docs.count()))
    few = _rows(docs).where(rank < int(max(share) * (1 << 32)))
    few = few.join(truth.where(rank < int(max(share) * (1 << 32))), "doc_id", "left")
    few = few.where(
        (F.col("quality").isNotNull() & (rank < int(share[0] * (1 << 32))))
        | (F.col("quality").isNull() & (rank < int(share[1] * (1 << 32))))
    )
    found = few.mapInArrow(_sample, "doc_id long, quality int, text binary, meta binary").collect()
    found.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), str(r["doc_id"]), r["text"]))
    y = np.array([-1 if r["quality"] is None else r["quality"] for r in found])
    if min((y == 0).sum(), (y == 1).sum()) < 6:
        return None
    text, meta = (np.frombuffer(b"".join(r[c] for r in found), np.float32).reshape(len(found), -1) for c in ("text", "meta"))
    return CoTrained(text, meta, y)


def _score(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model = held.value
    for batch in batches:
        for piece in pieces(batch, "text"):
            score, by_text, by_meta = model.score(*views(piece))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *map(pa.array, (score, by_text, by_meta, score >= model.cut))],
                names=["doc_id", "score", "text_score", "meta_score", "kept"],
            )


def score_quality(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """(doc_id, score, text_score, meta_score, kept), one row per row of `docs`.

    Every whole text is scored where it stands, without a shuffle. Null texts count as empty, a null
    source, language or length is a value of its own; a missing one is null everywhere. Other columns
    are not read. Without a model all rows are kept with score 0.5.
    """
    rows = _rows(docs)
    if model is None:
        half = F.lit(0.5)
        return rows.select("doc_id", half.alias("score"), half.alias("text_score"), half.alias("meta_score"), F.lit(True).alias("kept"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(
        lambda b: _score(b, held), "doc_id long, score double, text_score double, meta_score double, kept boolean"
    )


def _keep(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model = held.value
    for batch in batches:
        row = batch.column("row")
        read = {c: batch.column(c) for c in batch.schema.names if c != "row"}
        flat = pa.RecordBatch.from_arrays([*read.values(), pa.array(np.arange(len(row)))], names=[*read, "at"])
        for piece in pieces(flat, "text"):
            score, _, _ = model.score(*views(piece))
            at = piece.column("at").filter(pa.array(score >= model.cut))
            if len(at):
                yield pa.RecordBatch.from_arrays([row.take(at)], names=["row"])


def keep_good(docs: DataFrame, model: CoTrained | None) -> DataFrame:
    """The rows of `docs`, with all their columns, that the model keeps; nothing is shuffled."""
    if model is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(model)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    read = [c.alias(n) for c, n in ((_read(docs, n, k), n) for n, k in READ)]
    schema = T.StructType([T.StructField("row", docs.schema)])
    return docs.select(*read, whole).mapInArrow(lambda b: _keep(b, held), schema).select("row.*")
