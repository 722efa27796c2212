"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to `ORDER` bytes with the counts of what follows them.
A byte that a context has not seen escapes to the next shorter context (method C), whose probabilities
are scaled to the bytes that are still possible, so the probabilities of every context add up to one. The
statistics are frozen: the code length of a text is the sum of its bytes' code lengths, and the language
with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessella.llm.textkit import LOWER, pieces, text_bytes

ORDER = 4
#: Whole training documents are taken in hash order until a language has this much text.
TRAIN_BYTES = 1_000_000
MAX_LANGUAGES = 100
UNKNOWN = "und"

SCHEMA = "doc_id long, lang_pred string, score double"
_SLOT_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with the ORDER bytes before it as one number, and the texts' offsets into them.
    Blanks stand before the first byte of a text."""
    n = np.diff(offsets)
    padded = np.full(len(data) + ORDER * len(n), 32, np.uint8)
    at = np.arange(len(data)) + np.repeat(ORDER * np.arange(1, len(n) + 1), n)
    padded[at] = LOWER[data]
    code = np.zeros(len(data), np.uint64)
    for back in range(ORDER, -1, -1):
        code = (code << np.uint64(8)) | padded[at - back]
    return code, offsets


def count_contexts(table: pa.Table) -> pa.Table:
    """One language's training texts: for every order the n-grams and their counts."""
    code, _ = grams(*text_bytes(table.column("text")))
    rows = {"lang": [], "ord": [], "grams": [], "counts": []}
    for order in range(ORDER + 1):
        keys, counts = np.unique(code & np.uint64((1 << (8 * (order + 1))) - 1), return_counts=True)
        rows["lang"].append(table.column("lang")[0].as_py())
        rows["ord"].append(order)
        rows["grams"].append(keys.tobytes())
        rows["counts"].append(counts.astype(np.int64).tobytes())
    return pa.table({"lang": rows["lang"], "ord": pa.array(rows["ord"], pa.int32()), "grams": pa.array(rows["grams"], pa.binary()), "counts": pa.array(rows["counts"], pa.binary())})


class ContextTree:
    """Code lengths (in bits) of one language, order by order."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]):
        self.grams, self.bits, self.contexts, self.escape = [], [], [], []
        for order, (keys, count) in enumerate(counts):
            context, place = np.unique(keys >> np.uint64(8), return_inverse=True)
            seen = np.bincount(place)
            total = np.bincount(place, count) + seen
            # Exclusion: what the shorter context gives to bytes that were seen here is not needed.
            shorter = np.exp2(-self.cost(keys, order - 1))
            rest = np.maximum(1 - np.bincount(place, shorter), 1e-9)
            self.grams.append(keys)
            self.bits.append(-np.log2(count / total[place]))
            self.contexts.append(context)
            self.escape.append(-np.log2(seen / total / rest))

    def cost(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Code length of the last byte of every code after the `order` bytes before it."""
        bits = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        for k in range(order, -1, -1):
            code = codes[open_] & np.uint64((1 << (8 * (k + 1))) - 1)
            at = np.minimum(np.searchsorted(self.grams[k], code), len(self.grams[k]) - 1)
            hit = self.grams[k][at] == code
            bits[open_[hit]] += self.bits[k][at[hit]]
            open_, code = open_[~hit], code[~hit]
            if not len(open_):
                return bits
            at = np.minimum(np.searchsorted(self.contexts[k], code >> np.uint64(8)), len(self.contexts[k]) - 1)
            known = self.contexts[k][at] == code >> np.uint64(8)
            bits[open_[known]] += self.escape[k][at[known]]
        bits[open_] += 8.0
        return bits


class Model:
    """All languages: a table of the code lengths of the n-grams seen in training, and the trees
    for all others."""

    def __init__(self, trees: dict[str, ContextTree]):
        self.languages = sorted(trees, key=lambda x: x.encode())
        self.trees = [trees[x] for x in self.languages]
        self.codes = np.unique(np.concatenate([t.grams[ORDER] for t in self.trees]))
        self.table = self.costs(self.codes)
        self.slots = np.zeros(1 << _SLOT_BITS, np.int32)
        self.slots[self._slot(self.codes)] = np.arange(len(self.codes))

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * _MIX) >> np.uint64(64 - _SLOT_BITS)

    def costs(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([t.cost(codes) for t in self.trees], 1).astype(np.float32)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text in every language."""
        code, offsets = grams(data, offsets)
        sums = np.zeros((len(offsets) - 1, len(self.languages)))
        if not len(code):
            return sums
        at = self.slots[self._slot(code)]
        missed = np.flatnonzero(self.codes[at] != code)
        rare, place = np.unique(code[missed], return_inverse=True)
        known = np.minimum(np.searchsorted(self.codes, rare), len(self.codes) - 1)
        new = self.codes[known] != rare
        costs = self.table[known]
        costs[new] = self.costs(rare[new])
        filled = np.flatnonzero(np.diff(offsets))
        for k in range(len(self.languages)):
            bits = self.table[:, k][at]
            bits[missed] = costs[place, k]
            sums[filled, k] = np.add.reduceat(bits, offsets[:-1][filled], dtype=np.float64)
        return sums


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order_col: str = "doc_id", train_bytes: int = TRAIN_BYTES) -> Model | None:
    """A model from labelled rows: of every language, whole texts in the order of a hash of
    `order_col` until they reach `train_bytes`. None if no row has both text and language."""
    rows = docs.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(order_col).alias("rank")
    ).where("lang IS NOT NULL AND text != ''")
    rows = rows.withColumn("n", F.octet_length("text").cast("long"))
    totals = rows.groupBy("lang").agg(F.sum("n").alias("total"))
    volume = totals.limit(MAX_LANGUAGES + 1).collect()
    if len(volume) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not volume:
        return None
    # A share of the hash range with about twice the text that is needed, then the exact cut.
    share = F.lit(0.0)
    for r in volume:
        share = F.when(F.col("lang") == r["lang"], min(1.0, 2 * train_bytes / r["total"])).otherwise(share)
    few = rows.where((F.col("rank") / float(1 << 64) + 0.5) <= share)
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("rank", "text").rowsBetween(Window.unboundedPreceding, -1))
    few = few.withColumn("before", before).where(f"coalesce(before, 0) < {train_bytes}")
    counted = few.select("lang", "text").groupBy("lang").applyInArrow(count_contexts, "lang string, ord int, grams binary, counts binary").collect()
    found: dict[str, list] = {}
    for r in sorted(counted, key=lambda r: r["ord"]):
        found.setdefault(r["lang"], []).append((np.frombuffer(r["grams"], np.uint64), np.frombuffer(r["counts"], np.int64)))
    return Model({lang: ContextTree(x) for lang, x in found.items()}) if found else None


def _predict(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model = held.value
    names = pa.array(model.languages)
    for batch in batches:
        for piece in pieces(batch, "text"):
            bits = model.code_lengths(*text_bytes(piece.column("text")))
            best = bits.argmin(1)
            share = 1 / np.exp2(np.maximum(bits[np.arange(len(best)), best][:, None] - bits, -1000)).sum(1)
            letters = piece.column("letters").to_numpy(zero_copy_only=False)
            lang = pc.if_else(pa.array(letters), names.take(pa.array(best)), UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), lang, pa.array(np.where(letters, share, 0.0))], names=["doc_id", "lang_pred", "score"]
            )


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of `docs`; the whole text is scored.

    score is the posterior of the language over the learned ones, each equally likely before. `und` with
    score 0 if the text is null or has no letter, or if nothing was learned. Equal code lengths go to the
    first language by code point. A null id is passed on; other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda batches: _predict(batches, held), SCHEMA)
