"""Toxicity by a convolutional text classifier, trained in numpy, thresholds calibrated by language.

Words are runs of ASCII letters and digits and of bytes beyond ASCII, A-Z lower-cased; each is
hashed into one of SLOTS rows of an embedding table. Filters of several widths slide over the
word vectors, pass a ReLU and are max-pooled over the whole text; a logistic layer on the pooled
features gives the raw score. Everything is trained here with Adam on weighted cross-entropy.

Thresholds by language: the language is never read for a score; it is *predicted from the text*
by the nearest byte-bigram profile of the languages of all rows that are not held out. On
calibration rows (a hash share of the labelled training rows that the network has not seen) each
predicted language gets the raw threshold with the best F1, or the common one if it has fewer than
MIN_CALIBRATION rows of a class. Raw scores are counted in steps of STEP for that, so what reaches
the driver is bounded, whatever the rows. The score is sigmoid(raw - threshold), so it is 0.5
exactly at the threshold and predicted = 1 there and above.

Training on all rows: every labelled row that is not held out teaches or calibrates. The teaching
rows are dealt into shards of about SHARD_ROWS (at most MAX_SHARDS, longer ones on a large corpus).
In each of EPOCHS rounds every shard trains a copy of the common network on one slice of its rows,
in its own task, and the changes of all shards are averaged in Spark: those of a word's vector over
the shards that changed it, the others over all shards. A small corpus has one slice and sees all
rows in every round; a large one has up to MAX_SLICES and sees every row EPOCHS / MAX_SLICES times.
Changes are summed as whole numbers and rows are in the order of a hash, so reruns agree. A task
holds BUFFER_DOCS documents at once, the driver one network. Scoring reads every whole text where
it lies, without a shuffle; the model is a fixed size (SLOTS x DIM plus filters) whatever the corpus.

Rows and names: a null or empty text has no words and gets the score of an empty window; a null
doc_id is scored and never trained on; labels other than 0/1 are ignored, and a doc_id labelled
twice takes its largest label. Repeated rows are scored each. Other columns are not read. Without
both classes among the training labels the model is None and every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.components import cut
from tessella.llm.textkit import LOWER, pieces, span_hashes, text_bytes, words

SLOTS, DIM, FILTERS, WIDTHS = 1 << 16, 24, 24, (1, 2, 3)
EPOCHS, RATE, BATCH_WORDS, BATCH_DOCS = 12, 0.01, 1 << 14, 16
PROFILE_SLOTS = 1024
MIN_CALIBRATION = 5
#: Share of training rows (by a hash of doc_id) kept for the thresholds.
CALIBRATION_SHARE = 5
#: Rows of a shard, most shards, most slices of a shard, documents a task holds.
SHARD_ROWS, MAX_SHARDS, MAX_SLICES, BUFFER_DOCS = 6144, 128, 4, 2048
#: Fixed-point unit of summed changes and profiles; step and bound of raw scores in calibration.
UNIT, STEP, MOST_RAW = 1 << 32, 1 / 1024, 30.0

#: Bytes of words: ASCII letters and digits and every byte beyond ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the words of every text, and the texts' offsets into them."""
    starts, ends, first = words(data, offsets, WORD)
    h = span_hashes(LOWER[data], starts, ends)
    return (h % np.uint64(SLOTS)).astype(np.int32), first


def profiles(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte-bigram counts of every text in PROFILE_SLOTS slots, unit length."""
    n = len(offsets) - 1
    out = np.zeros((n, PROFILE_SLOTS), np.float32)
    if len(data) < 2:
        return out
    low = LOWER[data].astype(np.int64)
    pair = (low[:-1] * 257 + low[1:]) % PROFILE_SLOTS
    owner = np.repeat(np.arange(n), np.diff(offsets))
    same = owner[1:] == owner[:-1]
    out = np.bincount(owner[:-1][same] * PROFILE_SLOTS + pair[same], minlength=n * PROFILE_SLOTS)
    out = out.reshape(n, PROFILE_SLOTS).astype(np.float32)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norm, 1e-9)


class Network:
    """Embeddings, convolutions of several widths, max pooling over time, a logistic layer."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.E = (rng.standard_normal((SLOTS + 1, DIM)) * 0.1).astype(np.float32)
        self.E[SLOTS] = 0  # padding
        self.K = [(rng.standard_normal((w * DIM, FILTERS)) / np.sqrt(w * DIM)).astype(np.float32) for w in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.w = (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.1).astype(np.float32)
        self.c = np.zeros(1, np.float32)

    def params(self) -> list[np.ndarray]:
        return [self.E, *self.K, *self.b, self.w, self.c]

    def load(self, params: list[np.ndarray]) -> None:
        for x, new in zip(self.params(), params, strict=True):
            x[...] = new

    def _forward(self, tok: np.ndarray, length: np.ndarray):
        """tok: B x L slots (SLOTS pads), L >= max width; the pooled features and what backward needs."""
        x = self.E[tok]
        B, L = tok.shape
        feats, keep = [], []
        for w, K, b in zip(WIDTHS, self.K, self.b, strict=True):
            T = L - w + 1
            win = np.concatenate([x[:, j : j + T] for j in range(w)], axis=2)
            h = np.maximum(win @ K + b, 0)
            valid = np.arange(T)[None, :] <= np.maximum(length - w, 0)[:, None]
            h = np.where(valid[:, :, None], h, -1.0)
            at = h.argmax(axis=1)
            feats.append(np.take_along_axis(h, at[:, None, :], 1)[:, 0])
            keep.append((win, at))
        return np.concatenate(feats, axis=1), keep

    def raw(self, tok: np.ndarray, length: np.ndarray) -> np.ndarray:
        z, _ = self._forward(tok, length)
        return z @ self.w + self.c[0]

    def sparse_gradients(self, tok, length, y, weight):
        """Slots with a gradient and their rows of it, the gradients of the other parameters, the loss."""
        z, keep = self._forward(tok, length)
        logit = z @ self.w + self.c[0]
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        d = ((p - y) * weight / weight.sum()).astype(np.float32)
        gw, gc = z.T @ d, np.array([d.sum()], np.float32)
        dz = np.outer(d, self.w) * (z > 0)
        gK, gb, slots, values = [], [], [], []
        rows = np.arange(len(tok))[:, None]
        for i, (w, K) in enumerate(zip(WIDTHS, self.K, strict=True)):
            win, at = keep[i]
            g = dz[:, i * FILTERS : (i + 1) * FILTERS]
            chosen = win[rows, at]  # B x F x wD
            gK.append(np.einsum("bfk,bf->kf", chosen, g))
            gb.append(g.sum(axis=0))
            dwin = np.einsum("bf,kf->bfk", g, K).reshape(len(tok), FILTERS, w, DIM)
            for j in range(w):
                slots.append(tok[rows, at + j].reshape(-1))
                values.append(dwin[:, :, j].reshape(-1, DIM))
        slot, value = np.concatenate(slots), np.concatenate(values)
        order = np.argsort(slot, kind="stable")
        slot, value = slot[order], value[order]
        starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        slot, value = slot[starts], np.add.reduceat(value, starts)
        used = slot != SLOTS
        loss = -(weight * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / weight.sum()
        return slot[used], value[used], [*gK, *gb, gw, gc], loss

    def gradients(self, tok, length, y, weight):
        slot, value, rest, loss = self.sparse_gradients(tok, length, y, weight)
        gE = np.zeros_like(self.E)
        gE[slot] = value
        return [gE, *rest], loss


def batches(docs: list[np.ndarray], order: np.ndarray, most: int = BATCH_DOCS) -> Iterator[np.ndarray]:
    """Indices of documents in length order, cut so that a batch pads to about BATCH_WORDS words
    and holds at most `most` documents."""
    order = sorted(order, key=lambda i: len(docs[i]))
    start = 0
    while start < len(order):
        end = start + 1
        while end < len(order) and end - start < most and (end - start + 1) * max(len(docs[order[end]]), 3) <= BATCH_WORDS:
            end += 1
        yield np.array(order[start:end])
        start = end


def pad(docs: list[np.ndarray], idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(docs[i]) for i in idx])
    tok = np.full((len(idx), max(int(length.max(initial=0)), max(WIDTHS))), SLOTS, np.int32)
    for r, i in enumerate(idx):
        tok[r, : length[r]] = docs[i]
    return tok, length


class Adam:
    """Adam steps on a network; of the embeddings only the rows with a gradient are touched."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.step = net, rate, 0
        self.m = [np.zeros_like(x) for x in net.params()]
        self.v = [np.zeros_like(x) for x in net.params()]

    def update(self, tok, length, y, weight) -> None:
        slot, value, rest, _ = self.net.sparse_gradients(tok, length, y, weight)
        self.step += 1
        one, two = 1 - 0.9**self.step, 1 - 0.999**self.step
        at = [slot, *[slice(None)] * len(rest)]
        for x, g, a, b, i in zip(self.net.params(), [value, *rest], self.m, self.v, at, strict=True):
            a[i] = 0.9 * a[i] + 0.1 * g
            b[i] = 0.999 * b[i] + 0.001 * g * g
            x[i] -= self.rate * (a[i] / one) / (np.sqrt(b[i] / two) + 1e-8)


def teach(adam: Adam, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> None:
    """One pass over the documents."""
    chunks = list(batches(docs, rng.permutation(len(docs))))
    for k in rng.permutation(len(chunks)):
        idx = chunks[k]
        adam.update(*pad(docs, idx), y[idx], weight[idx])


def raw_scores(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(docs), np.float64)
    for idx in batches(docs, np.arange(len(docs)), 1 << 30):
        tok, length = pad(docs, idx)
        out[idx] = net.raw(tok, length)
    return out


def best_threshold(raw: np.ndarray, y: np.ndarray, copies: np.ndarray | int = 1, width: float = 0.0) -> float:
    """The raw cut with the best F1 (ties: the middle of the best run), between two scores.

    Each score stands for `copies` rows from itself to less than `width` above it."""
    order = np.argsort(-raw, kind="stable")
    s, t, f = raw[order], (y * copies)[order], ((1 - y) * copies)[order]
    tp = np.cumsum(t)
    fp = np.cumsum(f)
    f1 = 2 * tp / np.maximum(tp + fp + t.sum(), 1)
    ends = np.flatnonzero(np.r_[s[1:] != s[:-1], True])
    k = ends[np.argmax(f1[ends])]
    below = s[k + 1] + width if k + 1 < len(s) else s[k] - 1.0
    return float((s[k] + below) / 2)


class Toxicity:
    def __init__(self, net: Network, centroids: np.ndarray, langs: list, cuts: np.ndarray, common: float):
        self.net, self.centroids, self.langs, self.cuts, self.common = net, centroids, langs, cuts, common

    def language(self, prof: np.ndarray) -> np.ndarray:
        return (prof @ self.centroids.T).argmax(axis=1) if len(self.langs) else np.zeros(len(prof), int)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tok, first = tokens(data, offsets)
        docs = [tok[first[i] : first[i + 1]] for i in range(len(first) - 1)]
        raw = raw_scores(self.net, docs)
        lang = self.language(profiles(data, offsets))
        cut = self.cuts[lang] if len(self.langs) else np.full(len(raw), self.common)
        return 1 / (1 + np.exp(-np.clip(raw - cut, -30, 30))), lang


def _profile_sums(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, slot, n): the summed profiles of the texts of a task."""
    sums: dict[str, np.ndarray] = {}
    for batch in found:
        for piece in pieces(batch, "text"):
            prof = np.rint(profiles(*text_bytes(piece.column("text"))) * np.float64(1 << 20)).astype(np.int64)
            names = piece.column("lang").dictionary_encode()
            owner = names.indices.to_numpy(zero_copy_only=False)
            for k, lang in enumerate(names.dictionary.to_pylist()):
                sums[lang] = sums.get(lang, 0) + prof[owner == k].sum(axis=0)
    for lang, total in sums.items():
        slot = np.flatnonzero(total)
        # A language whose texts have no pair of bytes is there all the same.
        slot = slot if len(slot) else np.zeros(1, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(slot), pa.string()), pa.array(slot.astype(np.int32)), pa.array(total[slot])], names=["lang", "slot", "n"]
        )


def language_profiles(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the unit-length mean profile of each, from all rows (lang, text)."""
    sums = rows.select(F.coalesce("lang", F.lit("")).alias("lang"), "text").mapInArrow(_profile_sums, "lang string, slot int, n long")
    found = sums.groupBy("lang", "slot").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["lang"] for r in found})
    centroids = np.zeros((len(langs), PROFILE_SLOTS), np.float32)
    for r in found:
        centroids[langs.index(r["lang"]), r["slot"]] = r["n"] / (1 << 20)
    return langs, centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-9)


def _tokenised(found: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model = held.value
    for batch in found:
        for piece in pieces(batch, "text"):
            data, offsets = text_bytes(piece.column("text"))
            tok, first = tokens(data, offsets)
            tok = tok.astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array([tok[first[i] : first[i + 1]].tobytes() for i in range(len(first) - 1)], pa.binary()),
                    pa.array(model.language(profiles(data, offsets)).astype(np.int32)),
                ],
                names=["doc_id", "tokens", "guess"],
            )


def _words_of(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint16).astype(np.int32)


def training_rows(rows: DataFrame, labels: DataFrame, model: Toxicity) -> DataFrame:
    """(doc_id, tokens, guess, toxic, calibrates) of all rows (doc_id, text) with a 0/1 label."""
    truth = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    held = rows.sparkSession.sparkContext.broadcast(model)
    # Words become slot numbers where the texts lie, so that the join shuffles two bytes a word.
    slots = rows.select("doc_id", "text").mapInArrow(lambda b: _tokenised(b, held), "doc_id long, tokens binary, guess int")
    calibrates = F.crc32(F.concat(F.lit("calibrate:"), F.col("doc_id").cast("string"))) % CALIBRATION_SHARE == 0
    return slots.join(truth, "doc_id").withColumn("calibrates", calibrates)


def _trained(found: Iterator[pa.RecordBatch], held, turn: int, rate: float, weights: tuple[float, float]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, toxic, tokens), the shards one after the other, to the changes (key, delta) of each shard's network: key is a
    slot, or SLOTS for all parameters but the embeddings."""

    def rows() -> Iterator[tuple]:
        for batch in found:
            yield from zip(*(batch.column(c).to_pylist() for c in ("shard", "toxic", "tokens")), strict=True)

    start = held.value
    for shard, mine in groupby(rows(), key=lambda r: r[0]):
        net = Network()
        net.load(start)
        adam, rng = Adam(net, rate), np.random.default_rng([turn, shard])

        def learn(docs: list, toxic: list) -> None:
            y = np.array(toxic, np.float32)
            teach(adam, docs, y, np.where(y == 1, *weights).astype(np.float32), rng)  # noqa: B023

        docs, toxic = [], []
        for _, label, blob in mine:
            docs.append(_words_of(blob))
            toxic.append(label)
            if len(docs) == BUFFER_DOCS:
                learn(docs, toxic)
                docs, toxic = [], []
        if docs:
            learn(docs, toxic)
        change = net.E.astype(np.float64) - start[0]
        slot = np.flatnonzero(change.any(axis=1))
        rest = np.concatenate([(x.astype(np.float64) - old).reshape(-1) for x, old in zip(net.params()[1:], start[1:], strict=True)])
        fixed = [np.rint(c * UNIT).astype(np.int64).tobytes() for c in [*change[slot], rest]]
        yield pa.RecordBatch.from_arrays([pa.array([*slot.tolist(), SLOTS], pa.int32()), pa.array(fixed, pa.binary())], names=["key", "delta"])


def _averaged(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, delta) to one row per key of the task with the mean delta."""
    sums: dict[int, np.ndarray] = {}
    counts: dict[int, int] = {}
    for batch in found:
        for key, blob in zip(batch.column("key").to_pylist(), batch.column("delta").to_pylist(), strict=True):
            delta = np.frombuffer(blob, np.int64)
            sums[key] = sums[key] + delta if key in sums else delta
            counts[key] = counts.get(key, 0) + 1
    if sums:
        mean = [(total / counts[key] / UNIT).astype(np.float32).tobytes() for key, total in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(mean, pa.binary())], names=["key", "delta"])


def fit(rows: DataFrame, counts: tuple[int, int], seed: int = 7) -> Network:
    """The network trained on all rows (doc_id, toxic, tokens); `counts` are those of the labels 0 and 1."""
    n = sum(counts)
    shards = max(1, min(MAX_SHARDS, round(n / SHARD_ROWS)))
    slices = max(1, min(MAX_SLICES, EPOCHS, round(n / SHARD_ROWS)))
    weights = 0.5 * n / max(counts[1], 1), 0.5 * n / max(counts[0], 1)
    dealt = rows.select(
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"),
        F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(slices)).cast("int").alias("slice"),
        F.xxhash64("doc_id", F.lit(3)).alias("place"),
        "doc_id", "toxic", "tokens",
    )
    # Dealt and written once; every round reads a slice where it lies.
    dealt = cut(dealt.repartition(shards, "shard").sortWithinPartitions("shard", "place", "doc_id", "tokens"))
    context = rows.sparkSession.sparkContext
    net = Network(seed)
    for turn in range(EPOCHS):
        held = context.broadcast(net.params())
        rate = RATE * (1 - 0.8 * turn / EPOCHS)
        mine = dealt.where(F.col("slice") == turn % slices).select("shard", "toxic", "tokens")
        changes = mine.mapInArrow(lambda b: _trained(b, held, turn, rate, weights), "key int, delta binary")  # noqa: B023
        # One row for each slot that changed: at most one network.
        found = changes.repartition("key").mapInArrow(_averaged, "key int, delta binary").collect()
        params = [x.copy() for x in net.params()]
        for r in found:
            delta = np.frombuffer(r["delta"], np.float32)
            if r["key"] < SLOTS:
                params[0][r["key"]] += delta
            else:
                at = 0
                for x in params[1:]:
                    x += delta[at : at + x.size].reshape(x.shape)
                    at += x.size
        net.load(params)
        held.destroy()
    return net


def _raw_steps(found: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    """(guess, toxic, tokens) to (guess, toxic, step): raw scores in steps of STEP."""
    net = held.value
    for batch in found:
        raw = raw_scores(net, [_words_of(b) for b in batch.column("tokens").to_pylist()])
        step = np.floor(np.clip(raw, -MOST_RAW, MOST_RAW) / STEP).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("guess"), batch.column("toxic"), pa.array(step)], names=["guess", "toxic", "step"])


def calibrate(model: Toxicity, rows: DataFrame) -> None:
    """Sets the thresholds of the model from all rows (guess, toxic, tokens)."""
    held = rows.sparkSession.sparkContext.broadcast(model.net)
    steps = rows.select("guess", "toxic", "tokens").mapInArrow(lambda b: _raw_steps(b, held), "guess int, toxic int, step int")
    # At most 2 * MOST_RAW / STEP steps for each language and label.
    found = steps.groupBy("guess", "toxic", "step").agg(F.count("*").alias("n")).collect()
    guess, toxic, step, copies = np.array([tuple(r) for r in found], np.int64).reshape(-1, 4).T

    def cut_of(mine: np.ndarray, least: int) -> float | None:
        if min(copies[mine & (toxic == 1)].sum(), copies[mine & (toxic == 0)].sum()) < least:
            return None
        return best_threshold(step[mine] * STEP, toxic[mine], copies[mine], STEP)

    model.common = cut_of(guess >= 0, 1) or 0.0
    for i in range(len(model.langs)):
        own = cut_of(guess == i, MIN_CALIBRATION)
        model.cuts[i] = model.common if own is None else own


def train(docs: DataFrame, labels: DataFrame, held_out) -> Toxicity | None:
    """A model learned from all labelled rows that are not held out; None without both labels among them."""
    rows = docs.where(~held_out).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where("doc_id IS NOT NULL")
    langs, centroids = language_profiles(rows)
    model = Toxicity(Network(), centroids, langs, np.zeros(len(langs)), 0.0)
    taught = cut(training_rows(rows, labels, model))
    counts = {(r["calibrates"], r["toxic"]): r["n"] for r in taught.groupBy("calibrates", "toxic").agg(F.count("*").alias("n")).collect()}
    total = [counts.get((False, t), 0) + counts.get((True, t), 0) for t in (0, 1)]
    if sum(total) < 4 or not all(total):
        return None
    apart = [counts.get((False, t), 0) for t in (0, 1)]
    split = all(apart) and sum(apart) < sum(total)
    model.net = fit(taught.where(~F.col("calibrates")) if split else taught, tuple(apart if split else total))
    calibrate(model, taught.where("calibrates") if split else taught)
    return model


def _score(batches_: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model = held.value
    for batch in batches_:
        for piece in pieces(batch, "text"):
            score, lang = model.score(*text_bytes(piece.column("text")))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array([model.langs[i] for i in lang])],
                names=["doc_id", "score", "predicted", "lang_guess"],
            )


def score_toxicity(docs: DataFrame, model: Toxicity | None) -> DataFrame:
    """(doc_id, score, predicted, lang_guess), one row per row of `docs`, no shuffle."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"), F.lit(None).cast("string").alias("lang_guess"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda b: _score(b, held), "doc_id long, score double, predicted int, lang_guess string")
