"""Centroid clustering in whole numbers: bit planes of vectors and centroids, compared by AND and popcount.

A component is stored as a whole number in two's complement. Bit ``i`` of 64 components is one 64-bit word, a
vector is one word per bit and 64 components (its planes). With the weight ``2**i`` of each plane (the
highest one's is negative) a dot product is the sum over pairs of planes of both weights times the number of
ones in their AND, and a squared distance is ``|x|^2 - 2 x.c + |c|^2``: exact, whatever order it is added up in.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tradewind.session import stored

CLUSTERS, ROUNDS, SCALE, WIDTH, SEED = 16, 3, 64, 64, 1
MOST_BITS = 27  # of a component, so that a squared distance of up to 256 components fits into 64 bits
BATCH = 4096  # vectors compared at once


def planes(numbers: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of whole numbers ``(rows, width)``: ``(rows, bits, words)`` of 64 components each, padded with 0."""
    rows, width = numbers.shape
    words = -(-width // 64)
    padded = np.zeros((rows, 64 * words), np.int64)
    padded[:, :width] = numbers
    set_bits = (padded[:, None, :] >> np.arange(bits)[:, None]) & 1
    return np.packbits(set_bits.astype(np.uint8), axis=2, bitorder="little").view(np.uint64)


def weights(bits: int) -> np.ndarray:
    """What a one in each plane counts: two's complement."""
    return np.array([1 << i for i in range(bits - 1)] + [-(1 << (bits - 1))], np.int64)


def dot_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``(rows of left, rows of right)`` dot products of the vectors behind two sets of planes."""
    out = np.zeros((len(left), len(right)), np.int64)
    for i, own in enumerate(weights(left.shape[1])):
        for j, other in enumerate(weights(right.shape[1])):
            both = left[:, i, None, :] & right[None, :, j, :]
            out += own * other * np.bitwise_count(both).sum(axis=2, dtype=np.int64)
    return out


def plane_sums(own: np.ndarray, cluster: np.ndarray, clusters: int) -> np.ndarray:
    """``(clusters, words * 64)``: the vectors of each cluster added up, plane by plane."""
    rows, bits, words = own.shape
    order = np.argsort(cluster, kind="stable")
    starts = np.searchsorted(cluster[order], np.arange(clusters))
    filled = np.flatnonzero(np.diff(np.append(starts, rows)))
    out = np.zeros((clusters, words * 64), np.int64)
    for i, weight in enumerate(weights(bits)):
        ones = np.unpackbits(np.ascontiguousarray(own[order, i]).view(np.uint8), axis=1, bitorder="little")
        out[filled] += weight * np.add.reduceat(ones, starts[filled], axis=0, dtype=np.int64)
    return out


def _bits(least: int, most: int) -> int:
    """Planes that hold every whole number from ``least`` to ``most`` in two's complement."""
    return max((-least - 1).bit_length() if least < 0 else 0, most.bit_length() if most > 0 else 0) + 1


def whole_vectors(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``vec_id, numbers`` of the vectors with ``width`` finite components: each as ``floor(scale * x)`` of the double ``x``."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    kept = vectors.where((F.size("embedding") == width) & finite)
    numbers = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.cast("array<bigint>").alias("numbers"))


def first_centroids(whole: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``, in that order; those without an id come last."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = whole.select(drawn.alias("drawn"), "numbers").orderBy(F.col("drawn").asc_nulls_last(), "numbers").limit(clusters)
    return np.array([r["numbers"] for r in rows.collect()], np.int64)


def packed_vectors(whole: DataFrame, bits: int) -> DataFrame:
    """``vec_id, planes, norm`` of each vector, stored once: every round reads only these."""

    def pack(batches):
        for batch in batches:
            numbers = batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
            own = planes(numbers, bits).reshape(len(batch), -1)
            data = pa.array([row.tobytes() for row in own], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), data, pa.array((numbers**2).sum(axis=1))], names=["vec_id", "planes", "norm"])

    return stored(whole.mapInArrow(pack, "vec_id long, planes binary, norm long"))


class Nearest:
    """The nearest centroid of vectors given by their planes; ties go to the smaller number."""

    def __init__(self, centroids: np.ndarray, bits: int):
        self.bits, self.norms, self.planes = bits, (centroids**2).sum(axis=1), planes(centroids, bits)

    def __call__(self, own: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cluster, distance = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for at in range(0, len(own), BATCH):
            part = slice(at, at + BATCH)
            far = norms[part, None] - 2 * dot_products(own[part], self.planes) + self.norms
            cluster[part] = far.argmin(axis=1)
            distance[part] = far.min(axis=1)
        return cluster, distance

    def batch(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Planes, nearest centroid and squared distance of the rows of ``packed_vectors``."""
        own = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(len(batch), self.bits, -1)
        return own, *self(own, batch.column(2).to_numpy())


def _moved(packed: DataFrame, centroids: np.ndarray, nearest: Broadcast) -> np.ndarray:
    """Each centroid as the floor of its vectors' mean; one without vectors stays.

    Every task adds up its own vectors; what is shuffled is a row per task, cluster and component.
    """
    clusters, width = centroids.shape

    def add_up(batches):
        sums, counts = np.zeros((clusters, nearest.value.planes.shape[2] * 64), np.int64), np.zeros(clusters, np.int64)
        for batch in batches:
            own, cluster, _ = nearest.value.batch(batch)
            sums += plane_sums(own, cluster, clusters)
            counts += np.bincount(cluster, minlength=clusters)
        which = np.repeat(np.flatnonzero(counts), width)
        place = np.tile(np.arange(width), np.count_nonzero(counts))
        columns = [pa.array(x) for x in (which, place, sums[which, place], counts[which])]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "place", "total", "rows"])

    parts = packed.mapInArrow(add_up, "cluster long, place long, total long, rows long")
    out = centroids.copy()
    for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows")).collect():
        out[r["cluster"], r["place"]] = r["total"] // r["rows"]
    return out


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, width: int = WIDTH, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every vector of ``vectors(vec_id, embedding)``, and the final centroids.

    Only vectors with exactly ``width`` components, all of them finite numbers, take part, as whole numbers
    ``floor(scale * x)``. The first centroids are the vectors with the smallest hashes of their ids (fewer
    if there are fewer vectors). In each round every vector goes to its nearest centroid by squared
    Euclidean distance, ties to the smaller number, and every centroid with vectors becomes the floor of
    their mean, component by component. ``distance`` is the squared distance to the nearest final centroid.

    Repeated rows count as often as they come; rows without an id are clustered but never a first centroid
    while others are left. An empty table gives no row and no centroid. Numbers beyond 27 bits, whose
    squared distances need not fit into 64 bits, stop the job with a ValueError.

    A round reads the packed planes once. Tasks add up their own vectors, so that a cluster of any size sends
    ``width`` rows per task; centroids (``clusters * width`` numbers) go through the driver.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, width, scale)
    ends = whole.agg(F.min(F.array_min("numbers")), F.max(F.array_max("numbers"))).first()
    if ends[0] is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, width), np.int64)
    bits = _bits(*ends)
    if bits > MOST_BITS or width > 256:
        raise ValueError(f"{width} components from {ends[0]} to {ends[1]}: squared distances may not fit into 64 bits")
    centroids = first_centroids(whole, clusters, seed)
    packed = packed_vectors(whole, bits)
    for _ in range(rounds):
        centroids = _moved(packed, centroids, spark.sparkContext.broadcast(Nearest(centroids, bits)))
    nearest = spark.sparkContext.broadcast(Nearest(centroids, bits))

    def assign(batches):
        for batch in batches:
            _, number, distance = nearest.value.batch(batch)
            columns = [batch.column(0), pa.array(number, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return packed.mapInArrow(assign, "vec_id long, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` (distances added up over the cluster and over all) and
    ``centroid_sha256``, of the final centroid's components as decimal numbers joined by commas.

    One row per cluster is broadcast, of which there are as many as centroids.
    """
    assigned = stored(assigned)
    sums = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    name = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    rows = [(k, sums[k], sum(sums.values()), name(centroids[k])) for k in sorted(sums)]
    kind = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return assigned.join(F.broadcast(assigned.sparkSession.createDataFrame(rows, kind)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, width: int = WIDTH, seed: int = SEED) -> str:
    """The same in SQL, by plain sums over the components; vectors need different ids there."""
    parts = [
        f"""kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = {width}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR))) - 1 AS INTEGER) AS k, v AS c
    FROM kept QUALIFY k < {clusters})"""
    ]
    for n in range(rounds + 1):
        parts.append(
            f"""a{n} AS (SELECT vec_id, any_value(v) AS v, min(struct_pack(d := d, k := k)) AS best FROM (
    SELECT vec_id, v, k, CAST(list_sum(list_transform(range(1, {width + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT) AS d
    FROM kept, c{n}) GROUP BY vec_id)"""
        )
        if n < rounds:
            parts.append(
                f"""m{n} AS (SELECT k, list(m ORDER BY i) AS c FROM (SELECT best.k AS k, i,
    CAST((sum(v[i]) - (((sum(v[i]) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT) AS m
    FROM a{n}, range(1, {width + 1}) AS r(i) GROUP BY ALL) GROUP BY k),
c{n + 1} AS (SELECT o.k, coalesce(m.c, o.c) AS c FROM c{n} o LEFT JOIN m{n} m USING (k))"""
            )
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT vec_id, best.k AS cluster, best.d AS distance,
    CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
    sha256(list_aggregate(list_transform(c, lambda x: CAST(x AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON k = best.k"""
    )


SQL = oracle_sql()
