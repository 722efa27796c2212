"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its 5-word shingles ("tokens"). All tokens get one global order: by class of
document frequency, rare ones first. Two sets of similarity >= 0.8 share at least k tokens among
their first n - ceil(0.8 n) + k (the extended prefixes, k = 2 here). The first k shared ones hold a rare
token, found by the index of single tokens, or are all frequent, found by the index of k-token
combinations. Tokens of a single document match nothing and are never indexed, so a document more
than a fifth of whose tokens is its own drops out at once.

The index only says which sets may be alike: every key links its sets to its smallest one, which costs
a row for each set however large the group is. The connected clusters hold every similar pair; each
set travels to its cluster once, and the pairs are verified there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.components import components, cut, spread_join
from tessella.llm.textkit import (
    LOWER,
    NOT_BLANK,
    mix,
    pack40,
    pieces,
    ragged,
    signed,
    small_components,
    span_hashes,
    text_bytes,
    unpack40,
    words,
)

WORDS = 5
COMBINED = 2
#: Tokens of more documents than this are frequent.
FREQUENT = 1000
#: Text that a task gathers before it sends its tokens, and text for each bin that merges them.
BLOCK_BYTES, BIN_BYTES = 4 << 20, 8 << 20
#: A verifying task holds at most two tiles of so many sets and bytes.
TILE_SETS, TILE_BYTES = 512, 32 << 20
TOKEN_BITS = 48

_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]

SENT = "deal int, block long, bin int, counts binary, keys binary, ranks binary"
SETS = "doc_id long, n long, fp long, keys array<long>, tokens binary"


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of every shingle, repeats included. A text of fewer than five
    words has one shingle, the whole sequence; a text without words has none."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets, NOT_BLANK)
    n_words = np.diff(first)
    owner, place = ragged(np.where(n_words >= WORDS, n_words - WORDS + 1, np.minimum(n_words, 1)))
    if not len(owner):
        return owner, np.zeros(0, np.uint64)
    hashes = np.concatenate([span_hashes(data, starts, ends), np.zeros(WORDS, np.uint64)])
    at = first[owner] + place
    total = hashes[at] * _STEPS[0]
    short = n_words[owner]
    for j in range(1, WORDS):
        part = hashes[at + j] * _STEPS[j]
        part[short <= j] = 0
        total += part
    return owner, mix(total + np.minimum(short, WORDS).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens by text: (text number, 48-bit token, set sizes, set fingerprints)."""
    n = len(offsets) - 1
    owner, h = shingles(data, offsets)
    bits = max(1, int(n - 1).bit_length())
    packed = (owner.astype(np.uint64) << np.uint64(64 - bits)) | (h >> np.uint64(bits))
    packed.sort()
    if len(packed):
        packed = packed[np.concatenate([[True], packed[1:] != packed[:-1]])]
    owner = (packed >> np.uint64(64 - bits)).astype(np.int64)
    token = ((packed << np.uint64(bits)) >> np.uint64(64 - TOKEN_BITS))
    sizes = np.bincount(owner, minlength=n)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(token + np.uint64(1)))])
    edge = np.concatenate([[0], np.cumsum(sizes)])
    return owner, token, sizes, mix((sums[edge[1:]] - sums[edge[:-1]]) ^ mix(sizes.astype(np.uint64)))


def _rank(df: np.ndarray) -> np.ndarray:
    """Frequency classes, eight to a doubling; 0 for tokens of one document."""
    return np.minimum(np.rint(8 * np.log2(df)), 255).astype(np.uint8)


def _send(batches: Iterator[pa.RecordBatch], bin_bits: int) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: a row with their ids, sizes and fingerprints, and for every bin of the
    token range a row with the tokens of the block's distinct sets."""
    block = TaskContext.get().partitionId() << 32
    local_bits = np.uint64(TOKEN_BITS - bin_bits)
    held: list = []
    size = 0

    def flush():
        ids, sizes, fps = (np.concatenate([x[k] for x in held]) for k in (0, 3, 4))
        base = np.cumsum([0] + [len(x[0]) for x in held])
        owner = np.concatenate([x[1] + b for x, b in zip(held, base, strict=False)])
        token = np.concatenate([x[2] for x in held])
        first = np.zeros(len(ids), bool)
        first[np.unique(fps, return_index=True)[1]] = True
        keep = first[owner]
        owner, token = owner[keep], token[keep]
        bins = (token >> local_bits).astype(np.uint32 if bin_bits > 16 else np.uint16)
        order = np.argsort(bins, kind="stable")
        owner, token, bins = owner[order], token[order] & ((np.uint64(1) << local_bits) - np.uint64(1)), bins[order]
        present = np.unique(bins)
        edges = np.append(np.searchsorted(bins, present), len(bins))
        rows = [(block % (1 << bin_bits), -1, np.stack([ids, sizes, signed(fps), first.astype(np.int64)]).tobytes(), b"")]
        for i, b in enumerate(present.tolist()):
            part = slice(edges[i], edges[i + 1])
            rows.append((b, b, np.bincount(owner[part], minlength=len(ids)).astype(np.uint32).tobytes(), pack40(token[part])))
        n = len(rows)
        deal, number, counts, keys = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(deal, pa.int32()), pa.array([block] * n, pa.int64()), pa.array(number, pa.int32()), pa.array(counts, pa.binary()), pa.array(keys, pa.binary()), pa.nulls(n, pa.binary())],
            names=[c.split()[0] for c in SENT.split(", ")],
        )

    for batch in batches:
        for piece in pieces(batch, "text"):
            data, offsets = text_bytes(piece.column("text"))
            owner, token, sizes, fps = shingle_sets(data, offsets)
            held.append((piece.column("doc_id").to_numpy(), owner, token, sizes, fps))
            size += len(data)
            if size >= BLOCK_BYTES:
                yield flush()
                held, size = [], 0
                block += 1
    if held:
        yield flush()


def _merge(table: pa.Table) -> pa.Table:
    """A bin: the frequency class of every token that more than one set sent, for every block."""
    meta = pc.less(table.column("bin"), 0)
    rows = table.filter(pc.invert(meta))
    keys = [unpack40(k.as_buffer()) for k in rows.column("keys")]
    out = [table.filter(meta)]
    if keys:
        lengths = [len(k) for k in keys]
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        group = np.cumsum(new) - 1
        df = np.empty(len(every), np.int64)
        df[order] = np.bincount(group)[group]
        ranks = _rank(df)
        counts, kept, classes, at = [], [], [], 0
        for n, sent, key in zip(lengths, rows.column("counts"), keys, strict=True):
            sent = np.frombuffer(sent.as_buffer(), np.uint32)
            shared = df[at : at + n] > 1
            counts.append(np.bincount(np.repeat(np.arange(len(sent)), sent)[shared], minlength=len(sent)).astype(np.uint32).tobytes())
            kept.append(pack40(key[shared]))
            classes.append(ranks[at : at + n][shared].tobytes())
            at += n
        out.append(
            pa.Table.from_arrays(
                [rows.column("deal"), rows.column("block"), rows.column("bin"), *(pa.array(x, pa.binary()) for x in (counts, kept, classes))],
                names=table.column_names,
            )
        )
    return pa.concat_tables([t.cast(table.schema) for t in out])


def _index(table: pa.Table, bin_bits: int, frequent: int) -> pa.Table:
    """A block: for every document its index keys and, if it has any, its shared tokens."""
    bins = table.column("bin").to_numpy()
    ids, sizes, fps, first = np.frombuffer(table.column("counts")[int(np.flatnonzero(bins < 0)[0])].as_buffer(), np.int64).reshape(4, -1)
    owner, token, rank = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for i in np.flatnonzero(bins >= 0).tolist():
        counts = np.frombuffer(table.column("counts")[i].as_buffer(), np.uint32)
        owner.append(np.repeat(np.arange(len(ids)), counts))
        token.append(unpack40(table.column("keys")[i].as_buffer()) | (np.uint64(bins[i]) << np.uint64(TOKEN_BITS - bin_bits)))
        rank.append(np.frombuffer(table.column("ranks")[i].as_buffer(), np.uint8))
    owner, token, rank = map(np.concatenate, (owner, token, rank))
    order = np.lexsort((token, rank, owner))
    owner, token, rank = owner[order], token[order], rank[order]
    shared = np.bincount(owner, minlength=len(ids))
    prefix = sizes - (4 * sizes + 4) // 5 + COMBINED
    taken = np.clip(prefix - np.maximum(sizes - shared, 0), 0, shared)
    taken[sizes < 4] = 0  # such a set is only similar to itself
    edge = np.concatenate([[0], np.cumsum(shared)])
    keys, tokens = [], []
    limit = _rank(np.array([frequent]))[0]
    for i in range(len(ids)):
        if not taken[i]:
            keys.append(None)
            tokens.append(None)
            continue
        part = slice(edge[i], edge[i] + taken[i])
        own, often = token[part], rank[part] > limit
        a, b = (own[often][x] for x in np.triu_indices(int(often.sum()), 1))
        pairs = mix(a * _STEPS[1] + b) | np.uint64(1 << 63)
        keys.append(signed(np.concatenate([own[~often], pairs])))
        tokens.append(token[edge[i] : edge[i + 1]].tobytes())
    return pa.table(
        {"doc_id": pa.array(ids), "n": pa.array(sizes), "fp": pa.array(fps), "keys": pa.array(keys, pa.list_(pa.int64())), "tokens": pa.array(tokens, pa.binary())}
    )


def similar_links(fps: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], tile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) whose components are those of all pairs with 100 * shared >= 80 * united. With
    two tiles, only pairs across them count."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    token, place, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = df > 1
    renumber = np.cumsum(often) - 1
    keep = often[place]
    owner, place = owner[keep], renumber[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    shared = np.zeros((n, n), np.float32)
    step = 4096
    for low in range(0, int(often.sum()), step):
        a, b = np.searchsorted(place, (low, low + step))
        x = np.zeros((n, min(step, int(place[b - 1]) - low + 1)), np.float32)
        x[owner[a:b], place[a:b] - low] = 1
        shared += x @ x.T
    linked = 180 * shared.astype(np.int64) >= 80 * (sizes[:, None] + sizes[None, :])
    if tile.min() != tile.max():
        linked &= tile[:, None] != tile[None, :]
    a, b = np.nonzero(np.triu(linked, 1))
    root = small_components(n, a, b)
    moved = root != np.arange(n)
    return fps[moved], fps[root[moved]]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cluster and pair of tiles; a group may go on in the next batch."""
    group, rows = None, []

    def links():
        fps, sizes, tiles = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2))
        a, b = similar_links(fps, sizes, [np.frombuffer(r[3], np.uint64) for r in rows], tiles)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        key = list(zip(*(batch.column(c).to_pylist() for c in ("cluster", "low", "high")), strict=True))
        values = list(zip(*(batch.column(c).to_pylist() for c in ("fp", "n", "tile", "tokens")), strict=True))
        for k, value in zip(key, values, strict=True):
            if k != group:
                if len(rows) > 1:
                    yield links()
                group, rows = k, []
            rows.append(value)
    if len(rows) > 1:
        yield links()


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of `docs`.

    Two documents link when 100 * |A & B| >= 80 * |A | B| for their sets of 5-word shingles (A-Z
    lower-cased, words are runs of non-blank bytes); component_id is the smallest doc_id reachable by
    links. Documents without words (null texts too) have 0 shingles and their own component. Equal sets
    link as one; rows with equal ids are rows of their own. A row with a null id gets nulls.

    Tokens are 48-bit hashes: that two different tokens of one pair agree has odds of some 10^-9.
    `docs` should be read from files, so that a repeated task sees the same rows in the same order.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = rows.where("doc_id IS NOT NULL")
    volume = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bin_bits = min(20, max(8, int(volume // BIN_BYTES).bit_length()))

    sent = known.mapInArrow(lambda batches: _send(batches, bin_bits), SENT)
    merged = sent.groupBy("deal").applyInArrow(_merge, SENT)
    table = cut(merged.groupBy("block").applyInArrow(lambda t: _index(t, bin_bits, frequent), SETS))

    keyed = table.where("keys IS NOT NULL").select("fp", F.explode("keys").alias("key"))
    smallest = keyed.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low != high")
    clusters = components(
        spread_join(keyed, smallest, "key").where("fp != low").select(F.col("fp").alias("a"), F.col("low").alias("b"))
    ).select(F.col("id").alias("fp"), F.col("component").alias("cluster"))

    sets = table.where("tokens IS NOT NULL").join(clusters, "fp").select("cluster", "fp", "n", "tokens").dropDuplicates(["fp"])
    tiles = (
        sets.groupBy("cluster")
        .agg(F.count("*").alias("sets"), F.sum(F.length("tokens")).alias("bytes"))
        .select("cluster", F.greatest(F.ceil(F.col("sets") / TILE_SETS), F.ceil(F.col("bytes") / TILE_BYTES)).alias("tiles"))
    )
    dealt = (
        spread_join(sets, tiles, "cluster")
        .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
        .select("cluster", "low", "high", "fp", "n", "tile", "tokens")
    )
    links = dealt.repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high").mapInArrow(
        _verify, "a long, b long"
    )
    found = components(links).select(F.col("id").alias("fp"), F.col("component").alias("root"))
    rooted = (
        table.where("n > 0")
        .select("doc_id", "n", "fp")
        .join(found, "fp", "left")
        .withColumn("root", F.coalesce("root", "fp"))
    )
    lowest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (
        spread_join(rooted, lowest, "root")
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        .unionByName(table.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
        .unionByName(
            rows.where("doc_id IS NULL").select(
                "doc_id", F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
            )
        )
    )
