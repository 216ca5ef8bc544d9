"""Hilbert keys, and neighbours against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import hilbert, queries

VECTORS = "vec_id long, embedding array<float>, score string"


@pytest.mark.parametrize("axes, levels", [(2, 4), (3, 3), (5, 2)])
def test_key_is_a_path_through_all_cells(axes, levels):
    cells = np.array(list(itertools.product(range(1 << levels), repeat=axes)))
    keys = hilbert.hilbert_key(cells, levels)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute_force(rows, k):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, v in rows:
        if q % 50 == 0:
            near = sorted((-float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), i) for i, w in rows if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(25, 160)]
    rows += [(200, rows[0][1]), (250, rows[0][1]), (300, rows[0][1]), *((1000 + i, rows[0][1]) for i in range(40))]
    bad = [(None, rows[0][1]), (400, None), (450, [0.0] * 8), (500, [float("nan")] + [1.0] * 7), (550, [float("inf")] * 8), (600, [1.0, 2.0]), (650, [None] * 8)]
    docs = spark.createDataFrame([(i, v, "clash") for i, v in [*rows, *bad, rows[3]]], VECTORS)
    got = {}
    for r in hilbert.nearest(docs, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    expected = brute_force(rows, 5)
    assert set(got) == set(expected)
    for q, near in expected.items():
        # equal scores differ in the last bits by brute force: compare scores, and ids where they are apart
        assert np.allclose([s for _, s in got[q]], [s for _, s in near], atol=1e-12)
        if near[0][1] < 0.999:
            assert [i for i, _ in got[q]] == [i for i, _ in near]
    assert [i for i, _ in got[200]] == [25, 250, 300, 1000, 1001]  # copies of one vector: the smallest ids


def test_doubles_are_compared_as_doubles(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(1, 90)] + [(100, (rng.normal(size=6) * 1e-3).tolist())]
    near = np.array(rows[-1][1])
    rows += [(i, (near + np.eye(6)[0] * 1e-12 * i).tolist()) for i in range(101, 108)]  # equal as 32-bit numbers
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in hilbert.nearest(docs, F.col("vec_id") == 100).orderBy("rank").collect()]
    score = {i: float(near @ v / np.linalg.norm(near) / np.linalg.norm(v)) for i, v in ((i, np.array(v)) for i, v in rows) if i != 100}
    assert len(got) == 5 and all(abs(s - score[i]) < 1e-15 for i, s in got) and {i for i, _ in got} <= set(range(101, 108))
    whole = docs.select("vec_id", F.transform("embedding", lambda x: F.round(x * 1000).cast("int")).alias("embedding"))
    assert hilbert.nearest(whole, F.col("vec_id") % 50 == 0).count() == 10


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], ""), (1, [1.0, 1.0], "")], VECTORS)
    rows = hilbert.nearest(few, F.col("vec_id") % 50 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in rows] == [(0, 1, 1)] and abs(rows[0]["score"] - 0.5**0.5) < 1e-12
    assert hilbert.nearest(few.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert hilbert.nearest(few.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op3_hilbert_neighbours(spark, folder)
    assert found.groupBy("query_id").count().where("count <> 5").count() == 0
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    assert hilbert.recall(found, vectors, F.col("vec_id") % 50 == 0) >= 0.9
