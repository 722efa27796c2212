"""Embedding near-duplicates with an inverted multi-index.

Two codebooks, one for each half of the (unit-length) vectors, form a product grid; a vector lies in the
cell of its nearest codewords. A search visits cells in the order of their distance sums
(multi-sequence traversal) until the target recall, which is measured on a sample against brute force,
and verifies by exact cosine. Vectors of every length have an index of their own, whose codebooks are
fitted on a bounded sample; every vector is indexed and searched. Few vectors of a length are one cell.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.components import components, cut
from tessella.llm.textkit import small_components

THRESHOLD = 0.95
#: Vectors the codebooks of all lengths are fitted on, about, and at least for each length that has an
#: index; vectors the traversal is calibrated with.
SAMPLE, LEAST_SAMPLE, PROBES = 20_000, 1000, 400
TARGET_RECALL = 0.99
#: Vectors aimed at in a cell, codewords of a half at most, and rows of a cell that one task compares.
CELL_ROWS, MAX_CODES, CHUNK = 256, 1024, 4096


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """The rows (finite, none of them zero) at unit length, in double precision."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of this length, their vectors)"""
    rows = np.flatnonzero(pc.list_value_length(column).to_numpy(zero_copy_only=False) == dim)
    return rows, column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds from evenly spaced rows; an empty cell keeps its codeword."""
    codes = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = (codes @ codes.T).diagonal()[None, :] - 2 * x @ codes.T
        cell = near.argmin(1)
        counts = np.bincount(cell, minlength=k)
        sums = np.zeros_like(codes)
        np.add.at(sums, cell, x)
        codes[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return codes


class MultiIndex:
    def __init__(self, sample: np.ndarray, rows: int):
        """rows: the vectors to be indexed, from which the size of the grid follows."""
        self.half = max(1, sample.shape[1] // 2)
        k = int(np.clip(np.sqrt(rows / CELL_ROWS), 1, min(MAX_CODES, len(sample))))
        self.codes = [kmeans(x, k) for x in (sample[:, : self.half], sample[:, self.half :])]
        self.visits = k * k
        self.visits = self._calibrate(sample)

    @property
    def dim(self) -> int:
        return sum(c.shape[1] for c in self.codes)

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        parts = (x[:, : self.half], x[:, self.half :])
        return [np.maximum((p**2).sum(1)[:, None] + (c**2).sum(1)[None, :] - 2 * p @ c.T, 0) for p, c in zip(parts, self.codes, strict=True)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * len(self.codes[1]) + b.argmin(1)

    def traverse(self, x: np.ndarray) -> list[list[int]]:
        """The nearest cells of every vector, by increasing sum of the distances of the halves."""
        k = len(self.codes[1])
        out = []
        for a, b in zip(*self.distances(x), strict=True):
            first, second = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
            sa, sb = a[first].tolist(), b[second].tolist()
            found: list[int] = []
            queue, queued = [(sa[0] + sb[0], 0, 0)], {(0, 0)}
            while queue and len(found) < self.visits:
                _, i, j = heapq.heappop(queue)
                found.append(int(first[i]) * k + int(second[j]))
                for p, q in ((i + 1, j), (i, j + 1)):
                    if p < len(sa) and q < len(sb) and (p, q) not in queued:
                        queued.add((p, q))
                        heapq.heappush(queue, (sa[p] + sb[q], p, q))
            out.append(found)
        return out

    def _calibrate(self, sample: np.ndarray) -> int:
        """Cells to be visited so that TARGET_RECALL of the sample's links, by brute force, are found;
        vectors turned to the threshold in a random direction stand for the farthest links."""
        probes = sample[np.linspace(0, len(sample) - 1, min(PROBES, len(sample))).astype(int)]
        a, b = np.nonzero(probes @ sample.T >= THRESHOLD)
        rng = np.random.default_rng(0)
        noise = rng.standard_normal(probes.shape)
        noise -= (noise * probes).sum(1)[:, None] * probes
        noise /= np.maximum(np.linalg.norm(noise, axis=1), 1e-12)[:, None]
        turned = THRESHOLD * probes + np.sqrt(1 - THRESHOLD**2) * noise
        orders = [{c: r for r, c in enumerate(order)} for order in self.traverse(probes)]
        cells = self.cells(sample)
        ranks = [orders[i][cells[j]] for i, j in zip(a.tolist(), b.tolist(), strict=True) if not np.array_equal(probes[i], sample[j])]
        ranks += [order[c] for order, c in zip(orders, self.cells(turned).tolist(), strict=True)]
        return int(np.quantile(ranks, TARGET_RECALL)) + 1 if ranks else 1


def _index(batches: Iterator[pa.RecordBatch], held, single: bool) -> Iterator[pa.RecordBatch]:
    """Distinct vectors with their cell and the cells that their search visits."""
    indexes = held.value
    for batch in batches:
        for dim in pc.unique(pc.list_value_length(batch.column("embedding"))).to_pylist():
            rows, raw = _matrix(batch.column("embedding"), dim)
            x = unit_rows(raw)
            picked = batch.take(pa.array(rows))
            index = indexes.get(dim)
            # Without an index all vectors of the length are in one cell.
            cells, visits = (index.cells(x), index.traverse(x)) if index else (np.zeros(len(x), int), [[0]] * len(x))
            yield pa.RecordBatch.from_arrays(
                [
                    picked.column("rep"),
                    picked.column("copies"),
                    pa.array([v.tobytes() for v in (raw.astype(np.float32) if single else raw)], pa.binary()),
                    pa.array(np.full(len(x), dim), pa.int64()),
                    pa.array(cells, pa.int64()),
                    pa.array(visits, pa.list_(pa.int64())),
                ],
                names=["rep", "copies", "vector", "dim", "cell", "visits"],
            )


def _vectors(column: pa.ChunkedArray, single: bool) -> np.ndarray:
    blob = b"".join(column.to_pylist())
    return unit_rows(np.frombuffer(blob, np.float32 if single else np.float64).reshape(len(column), -1))


def _compare(stored: pa.Table, probes: pa.Table, single: bool) -> pa.Table:
    """A chunk of a cell against all searches that visit it: for every vector the links that this
    chunk adds, and links that connect what it has connected. A pair that would be found from both
    sides counts from one of them for each vector."""
    out = {"rep": [np.zeros(0, np.int64)], "n": [np.zeros(0, np.int64)], "to": [np.zeros(0, np.int64)]}
    if stored.num_rows and probes.num_rows:
        ids, copies = (stored.column(c).to_numpy() for c in ("rep", "copies"))
        cell = stored.column("cell")[0].as_py()
        x = _vectors(stored.column("vector"), single)
        back = [frozenset(v) for v in stored.column("visits").to_pylist()]
        other, many, home = (probes.column(c).to_numpy() for c in ("rep", "copies", "home"))
        for low in range(0, len(other), 1024):
            part = slice(low, low + 1024)
            y = _vectors(probes.column("vector")[low : low + 1024], single)
            i, j = np.nonzero(y @ x.T >= THRESHOLD)
            i += low
            differ = other[i] != ids[j]
            i, j = i[differ], j[differ]
            if not len(i):
                continue
            lone = np.array([home[p] not in back[q] for p, q in zip(i.tolist(), j.tolist(), strict=True)])
            nodes, place = np.unique(np.concatenate([other[i], ids[j]]), return_inverse=True)
            n = np.bincount(place[: len(i)], copies[j], len(nodes)) + np.bincount(place[len(i) :], many[i] * lone, len(nodes))
            root = small_components(len(nodes), place[: len(i)], place[len(i) :])
            out["rep"].append(nodes)
            out["n"].append(n.astype(np.int64))
            out["to"].append(nodes[root])
    return pa.table({k: np.concatenate(v) for k, v in out.items()})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of `vectors`.

    Vectors link at a cosine of 0.95 or more. Equal vectors are one node with a count, so a group of
    copies is searched once and its links are counted without listing them. Cells of many vectors are
    dealt in chunks, each of which meets all searches of the cell. Links are summed up in the tasks,
    pairs never leave them. Only vectors of equal length link. Vectors that are null, zero, or hold null
    or non-finite components link with nothing; they and null ids are kept.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    # -0.0 is 0.0 in every comparison, so it must be in the key of equal vectors.
    distinct = cut(
        rows.where("valid")
        .withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    )
    dim = F.size("embedding").cast("long")
    counts = {r["dim"]: r["count"] for r in distinct.groupBy(dim.alias("dim")).count().collect()}
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not counts:
        return alone
    # Up to a chunk of vectors of one length are compared plainly; the others' lengths are indexed.
    share = F.lit(0.0)
    for length, n in counts.items():
        if n > CHUNK:
            few = max(1.2 * SAMPLE * n / sum(counts.values()), 1.2 * LEAST_SAMPLE)
            share = F.when(dim == length, min(1.0, few / n)).otherwise(share)
    rank = F.xxhash64("rep")
    sample: dict[int, list] = {}
    if max(counts.values()) > CHUNK:
        few = distinct.where(F.pmod(rank, F.lit(1 << 32)) < share * float(1 << 32)).orderBy(rank, "rep").select("embedding")
        for r in few.collect():
            sample.setdefault(len(r["embedding"]), []).append(r["embedding"])
    indexes = {length: MultiIndex(unit_rows(np.array(v)), counts[length]) for length, v in sample.items()}
    # Single-precision vectors travel as such.
    single = vectors.schema[vector_col].dataType.elementType.simpleString() == "float"
    held = vectors.sparkSession.sparkContext.broadcast(indexes)

    indexed = cut(distinct.mapInArrow(lambda b: _index(b, held, single), "rep long, copies long, vector binary, dim long, cell long, visits array<long>"))
    cells = indexed.groupBy("dim", "cell").agg(F.count("*").alias("rows")).select("dim", "cell", F.ceil(F.col("rows") / CHUNK).alias("chunks"))
    stored = indexed.join(cells, ["dim", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    probes = (
        indexed.select("rep", "copies", "vector", "dim", F.col("cell").alias("home"), F.explode("visits").alias("cell"))
        .join(cells, ["dim", "cell"])
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    )
    stored, probes = (x.toDF(*x.columns) for x in (stored, probes))
    found = cut(
        stored.groupBy("dim", "cell", "chunk").cogroup(probes.groupBy("dim", "cell", "chunk")).applyInArrow(
            lambda s, p: _compare(s, p, single), "rep long, n long, to long")
    )
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("to").alias("b"))).select(F.col("id").alias("rep"), F.col("component").alias("root"))
    classes = (
        distinct.select("embedding", "rep", "copies")
        .join(links, "rep", "left")
        .join(roots, "rep", "left")
        .select(
            "embedding",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    members = (
        rows.where("valid")
        .withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
        .join(classes, "embedding")
        .select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    )
    lone = rows.where("NOT valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return members.unionByName(lone)
