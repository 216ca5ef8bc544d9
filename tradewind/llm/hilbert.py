"""Approximate nearest neighbours: windows on several shifted Hilbert orderings of projected vectors."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.session import stored

CURVES, AXES, LEVELS, TIE_BITS = 16, 16, 3, 15  # 16 * 3 bits of key, then bits that spread equal keys
SAMPLE, PROBES = 20_000, 128  # bounds of the sample for block borders and of the queries for the width
BLOCK_ROWS, LEAST_ROWS, BLOCKS = 4096, 32, 128
TARGET = 0.96  # share of the probes' true neighbours that the windows must hold


def hilbert_key(cells: np.ndarray, levels: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``cells`` (integers below ``2**levels``).

    Skilling's transform (2004): undo the turns from the finest level up, Gray-decode, then interleave.
    """
    axes = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    zero = np.uint64(0)
    for level in range(levels - 1, 0, -1):
        bit, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(len(axes)):
            mirrored = (axes[i] & bit) != zero
            swap = np.where(mirrored, zero, (axes[0] ^ axes[i]) & below)
            axes[0] = np.where(mirrored, axes[0] ^ below, axes[0] ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros(len(cells), np.uint64)
    for level in range(levels - 1, 0, -1):
        turn = np.where(axes[-1] & np.uint64(1 << level), turn ^ np.uint64((1 << level) - 1), turn)
    key = np.zeros(len(cells), np.uint64)
    for level in range(levels - 1, -1, -1):
        for axis in axes:
            key = (key << np.uint64(1)) | (((axis ^ turn) >> np.uint64(level)) & np.uint64(1))
    return key


@dataclass
class Curves:
    """Projection, shift and block borders of each ordering. Its size depends on the settings and the number of blocks."""

    projections: list[np.ndarray]
    centres: list[np.ndarray]
    scales: list[np.ndarray]
    shifts: list[np.ndarray]
    borders: list[np.ndarray]

    def keys(self, curve: int, ids: np.ndarray, units: np.ndarray) -> np.ndarray:
        place = (units @ self.projections[curve] - self.centres[curve]) / self.scales[curve]
        share = (1 / (1 + np.exp(-1.7 * np.clip(place, -20, 20))) + self.shifts[curve]) / 2
        cells = np.minimum((share * (1 << LEVELS)).astype(np.int64), (1 << LEVELS) - 1)
        tie = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TIE_BITS)
        return (hilbert_key(cells, LEVELS) << np.uint64(TIE_BITS)) | tie

    def blocks(self, ids: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Block of each vector on each curve: (curves, rows)."""
        return np.stack(
            [np.searchsorted(self.borders[c], self.keys(c, ids, units), "right") for c in range(len(self.borders))]
        )


def make_curves(ids: np.ndarray, units: np.ndarray, blocks: int, seed: int = 11) -> Curves:
    rng, width = np.random.default_rng(seed), units.shape[1]
    curves = Curves([], [], [], [], [])
    for c in range(CURVES):
        basis = np.linalg.qr(rng.normal(size=(width, width)))[0][:, :AXES]
        projected = units @ basis
        curves.projections.append(basis)
        curves.centres.append(projected.mean(axis=0))
        curves.scales.append(projected.std(axis=0) + 1e-9)
        curves.shifts.append(rng.random(basis.shape[1]))
        keys = np.sort(curves.keys(c, ids, units))
        curves.borders.append(keys[np.arange(1, blocks) * len(keys) // blocks])
    return curves


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _units(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores, ties to smaller ids; scores of -inf are left out."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        near = np.arange(len(scores))
    near = near[np.isfinite(scores[near])]
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def usable_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, embedding`` of the vectors that can be compared, as doubles: an id, finite components, not all zero."""
    x = F.col("embedding")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & whole & F.exists(x, lambda v: v != 0))
        .distinct()
    )


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, seed: int = 11) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest by cosine of each query among all other vectors.

    Every vector is indexed. Equal vectors are one class with the ``k + 1`` smallest of its ids, cut
    before anything is shuffled, so a vector that comes a million times costs no more than one.
    Each class lies in one block of each of 16 orderings; a query looks at the blocks around its own on
    all of them, and exact cosines decide. Block borders are quantiles of a sample of 20,000 classes; how
    many blocks around are looked at is what 128 probe queries, compared with every vector, need to find
    96 % of their neighbours, so the width follows the data and its size (small for clustered vectors,
    a few per cent of the rows on either side for vectors without any structure).

    NULL, zero and non-finite vectors take no part, and neither do those of another length than the most
    common one (ties: the longer). Ties go to the smaller id. Repeated rows count once; an id with several
    vectors is a candidate with each and a query with the smallest. Fewer vectors than ``k`` give fewer
    rows, no vector none. A query is each row for which ``is_query`` (on ``vec_id``) holds.
    """
    spark = vectors.sparkSession
    usable = usable_vectors(vectors)
    size = usable.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.where(F.size("embedding") == size["n"])
    by_vector = Window.partitionBy("embedding").orderBy("vec_id")
    classes = stored(
        usable.withColumn("_place", F.row_number().over(by_vector))
        .where(F.col("_place") <= k + 1)
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("class_id"), F.sort_array(F.collect_list("vec_id")).alias("members"))
    )
    rows = classes.count()
    blocks = max(1, math.ceil(rows / BLOCK_ROWS), min(BLOCKS, rows // LEAST_ROWS))
    sample = classes.select("class_id", "embedding").orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE).collect()
    ids = np.array([r["class_id"] for r in sample])
    units = _units(np.array([r["embedding"] for r in sample], np.float64))
    curves = make_curves(ids, units, blocks, seed)
    shared = spark.sparkContext.broadcast(curves)
    width = window_width(classes, ids[:PROBES], units[:PROBES], shared, k)

    def place_classes(batches):
        for batch in batches:
            at = shared.value.blocks(batch.column(0).to_numpy(), _units(_matrix(batch.column(1))))
            for c in range(len(at)):
                both = [pa.array(np.full(len(batch), c)), pa.array(at[c])]
                yield pa.RecordBatch.from_arrays([*both, *batch.columns], names=["curve", "block", "class_id", "embedding", "n"])

    def place_queries(batches):
        for batch in batches:
            at = shared.value.blocks(batch.column(0).to_numpy(), _units(_matrix(batch.column(1))))
            for c in range(len(at)):
                for step in range(-width, width + 1):
                    inside = np.flatnonzero((at[c] + step >= 0) & (at[c] + step < blocks))
                    both = [pa.array(np.full(len(inside), c)), pa.array(at[c][inside] + step)]
                    part = batch.take(pa.array(inside))
                    yield pa.RecordBatch.from_arrays([*both, *part.columns], names=["curve", "block", "query_id", "embedding"])

    def compare(queries: pa.Table, near: pa.Table) -> pa.Table:
        out = ([], [], [])
        if len(queries) and len(near):
            q, c = _matrix(queries["embedding"]), _matrix(near["embedding"])
            q_norm, c_norm = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
            q_ids, c_ids = queries["query_id"].to_numpy(), near["class_id"].to_numpy()
            alone = near["n"].to_numpy() == 1
            for start in range(0, len(q), 256):
                scores = (q[start : start + 256] @ c.T) / c_norm / q_norm[start : start + 256, None]
                for i, line in enumerate(scores, start):
                    same = np.flatnonzero(alone & (line > 1 - 1e-9))
                    line[same[(c[same] == q[i]).all(axis=1)]] = -np.inf  # the query itself, and nothing else
                    best = _best(line, c_ids, k + 1)
                    out[0].append(np.full(len(best), q_ids[i]))
                    out[1].append(c_ids[best])
                    out[2].append((c[best] * q[i]).sum(axis=1) / (c_norm[best] * q_norm[i]))
        columns = [pa.array(np.concatenate(x) if x else np.zeros(0, t), k) for x, t, k in zip(out, (int, int, float), KINDS)]
        return pa.Table.from_arrays(columns, names=["query_id", "class_id", "score"])

    queries = usable.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    left = queries.mapInArrow(place_queries, "curve long, block long, query_id long, embedding array<double>")
    right = classes.select("class_id", "embedding", F.size("members").cast("long").alias("n"))
    right = right.mapInArrow(place_classes, "curve long, block long, class_id long, embedding array<double>, n long")
    found = (
        left.groupBy("curve", "block")
        .cogroup(right.groupBy("curve", "block"))
        .applyInArrow(compare, "query_id long, class_id long, score double")
        .groupBy("query_id", "class_id")
        .agg(F.max("score").alias("score"))
    )
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "class_id")
    top = found.withColumn("_place", F.row_number().over(by_query)).where(F.col("_place") <= k + 1)
    each = top.join(classes.select("class_id", "members"), "class_id").select(
        "query_id", "score", F.explode("members").alias("vec_id")
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        each.where(F.col("vec_id") != F.col("query_id"))
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


KINDS = (pa.int64(), pa.int64(), pa.float64())


def window_width(classes: DataFrame, ids: np.ndarray, units: np.ndarray, shared, k: int) -> int:
    """Blocks to look at on either side so that the probes find ``TARGET`` of their true neighbours.

    The probes are compared with every class, block by block; each partition hands on its ``k`` best.
    """
    home = shared.value.blocks(ids, units)

    def compare(batches):
        for batch in batches:
            own, rows = batch.column(0).to_numpy(), _units(_matrix(batch.column(1)))
            scores = units @ rows.T
            scores[ids[:, None] == own[None, :]] = -np.inf
            best = [_best(line, own, k) for line in scores]
            places = np.concatenate(best)
            probe = np.repeat(np.arange(len(ids)), [len(b) for b in best])
            steps = np.abs(shared.value.blocks(own[places], rows[places]) - home[:, probe]).min(axis=0)
            columns = [pa.array(probe), pa.array(own[places]), pa.array(scores[probe, places]), pa.array(steps)]
            yield pa.RecordBatch.from_arrays(columns, names=["probe", "class_id", "score", "steps"])

    near = classes.select("class_id", "embedding").mapInArrow(compare, "probe long, class_id long, score double, steps long")
    order = Window.partitionBy("probe").orderBy(F.desc("score"), "class_id")
    true = near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k).select("steps").collect()
    return int(np.quantile([r["steps"] for r in true], TARGET, method="higher")) if true else 0


def recall(found: DataFrame, vectors: DataFrame, is_query: Column, k: int = 5) -> float:
    """Share of the true ``k`` nearest that ``found`` has, by comparing every query with every vector in blocks.

    The queries come to the driver: for measuring on a bounded query set.
    """
    usable = usable_vectors(vectors)
    queries = usable.where(is_query).collect()
    if not queries:
        return 1.0
    q_ids = np.array([r["vec_id"] for r in queries])
    units = _units(np.array([r["embedding"] for r in queries], np.float64))

    def compare(batches):
        for batch in batches:
            own = batch.column(0).to_numpy()
            scores = units @ _units(_matrix(batch.column(1))).T
            scores[q_ids[:, None] == own[None, :]] = -np.inf
            best = [_best(line, own, k) for line in scores]
            probe, places = np.repeat(q_ids, [len(b) for b in best]), np.concatenate(best)
            score = np.concatenate([line[b] for line, b in zip(scores, best)])
            yield pa.RecordBatch.from_arrays([pa.array(probe), pa.array(own[places]), pa.array(score)], names=["query_id", "vec_id", "true"])

    order = Window.partitionBy("query_id").orderBy(F.desc("true"), "vec_id")
    true = usable.mapInArrow(compare, "query_id long, vec_id long, true double")
    true = true.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)
    both = true.join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return both.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
