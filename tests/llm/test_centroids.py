"""Centroid clustering: bit planes against plain whole numbers, clusters against a plain Lloyd iteration."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tradewind.llm import centroids as ct

KIND = "vec_id long, embedding array<double>, cluster string"


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 130), st.integers(1, 6), st.integers(1, 12), st.integers(0, 2**32 - 1))
def test_planes_give_exact_dot_products_and_sums(width, rows, bits, seed):
    rng = np.random.default_rng(seed)
    low, high = -(1 << (bits - 1)), 1 << (bits - 1)
    a, b = rng.integers(low, high, (rows, width)), rng.integers(low, high, (3, width))
    own = ct.planes(a, bits)
    assert (ct.dot_products(own, ct.planes(b, bits)) == a @ b.T).all()
    cluster = rng.integers(0, 4, rows)
    sums = ct.plane_sums(own, cluster, 5)
    assert all((sums[k, :width] == a[cluster == k].sum(axis=0)).all() for k in range(5))


def test_bits_hold_the_ends():
    for least, most, bits in ((0, 0, 1), (-1, 0, 1), (0, 1, 2), (-2, 1, 2), (-3, 1, 3), (-4, 3, 3), (5, 9, 5), (-128, 127, 8), (-1, 128, 9)):
        assert ct._bits(least, most) == bits


def plain(rows, clusters, rounds, width, scale=64):
    """Lloyd's rounds over Python numbers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept)
    found = [v for _, _, v in order[:clusters]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    nearest = lambda v: min((far(v, c), k) for k, c in enumerate(found))
    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        found = [
            [sum(x) // len(own) for x in zip(*own)] if (own := [v for (_, v), k in zip(kept, of) if k == n]) else c for n, c in enumerate(found)
        ]
    out = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in out)
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found]
    return sorted((repr((i, k, d, sum(e for _, e, j in out if j == k), total, name[k])) for i, d, k in out))


def test_clusters_of_odd_rows(spark):
    rng, width = np.random.default_rng(4), 5
    rows = [(k, rng.normal(0, 2, width).tolist()) for k in range(80)]
    rows += [(7, rows[7][1]), (7, rows[3][1]), (900, None), (901, [1.0] * 4), (902, [1.0] * 6), (903, [0.0] * width), (904, [])]
    rows += [(905, [1.0, None, 0.0, 0.0, 0.0]), (906, [float("nan")] * width), (907, [float("inf")] * width), (None, [-3.0] * width), (None, None)]
    rows += [(k, [0.5, 0.5, -0.5, 0.25, 1 / 128]) for k in range(1000, 1100)] + [(-5, rows[0][1]), (2**63 - 1, [-9.0, 9.0, 0.0, 0.0, 0.0]), (-(2**63), [1e4] * width)]
    vectors = spark.createDataFrame([(i, v, "clash") for i, v in rows], KIND)
    for clusters, rounds in ((16, 3), (1, 1), (300, 2)):
        assigned, found = ct.cluster(vectors, clusters, rounds, width=width)
        out = ct.with_inertia(assigned, found)
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert sorted(repr(tuple(r)) for r in out.collect()) == plain(rows, clusters, rounds, width)
    empty = ct.with_inertia(*ct.cluster(vectors.where("vec_id > 5000 AND vec_id < 6000"), width=width))
    assert empty.count() == 0 and empty.columns == out.columns
    only_null = ct.with_inertia(*ct.cluster(vectors.where("vec_id = 900"), width=width))
    assert only_null.count() == 0
    with pytest.raises(ValueError, match="64 bits"):
        ct.cluster(spark.createDataFrame([(1, [1e30] * width, None)], KIND), width=width)


def test_query_equals_plain_numbers(spark):
    from tradewind.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = QUERIES["op13_bit_planes"](spark, sf_dir).collect()
    assert sorted(repr(tuple(r)) for r in got) == plain(rows, 16, 3, 64)
