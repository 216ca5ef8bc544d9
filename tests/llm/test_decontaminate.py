"""Greedy string tiling against a plain version, and every odd row."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_words_and_chars import plain_words
from tradewind.llm import decontaminate as dc
from tradewind.llm import queries
from tradewind.llm.words import mixed


def plain_tiles(doc, item, least):
    """Mark the longest common run of unmarked words, again and again."""
    least, doc_free, item_free, out = min(least, len(item)), [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc_free[i + n] and item_free[j + n] and doc[i + n] == item[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < max(1, least):
            return out
        out.append((i, j, n))
        doc_free[i : i + n] = item_free[j : j + n] = [False] * n


def hashed(words):
    return mixed(np.array(words, np.uint64)) if words else np.zeros(0, np.uint64)


def test_tiles_cover_what_the_plain_version_covers():
    rng = random.Random(5)
    for _ in range(150):
        kinds = rng.choice([2, 5, 40])
        doc = [rng.randint(1, kinds) for _ in range(rng.randint(0, 40))]
        item = [rng.randint(1, kinds) for _ in range(rng.randint(1, 30))]
        if rng.random() < 0.6:  # the item in two parts, the other way round
            k = rng.randint(0, len(item))
            doc = doc[:10] + item[k:] + doc[10:20] + item[:k] + doc[20:]
        found = dc.tiles(hashed(doc), hashed(item))
        assert sum(n for _, _, n in found) == sum(n for _, _, n in plain_tiles(doc, item, dc.LEAST_TILE))
        assert all(doc[d : d + n] == item[t : t + n] for d, t, n in found)
        for side in (0, 1):
            used = [p for f in found for p in range(f[side], f[side] + f[2])]
            assert len(used) == len(set(used))


def plain_matches(doc, item, doc_free, item_free, size):
    out = []
    for d in range(len(doc) - size + 1):
        for t in range(len(item) - size + 1):
            if d and t and doc_free[d - 1] and item_free[t - 1] and doc[d - 1] == item[t - 1]:
                continue
            n = 0
            while d + n < len(doc) and t + n < len(item) and doc_free[d + n] and item_free[t + n] and doc[d + n] == item[t + n]:
                n += 1
            if n >= size:
                out.append((n, d, t))
    return sorted(out)


def test_matches_equal_a_plain_search():
    rng = np.random.default_rng(6)
    for turn in range(400):
        kinds = int(rng.choice([1, 2, 5]))
        doc, item = (mixed(rng.integers(0, kinds, rng.integers(0, 40)).astype(np.uint64)) for _ in range(2))
        doc_free, item_free = (rng.random(len(x)) < rng.choice([0.7, 0.95, 1.0]) for x in (doc, item))
        size = int(rng.integers(1, 6))
        assert sorted(dc._matches(doc, item, doc_free, item_free, size)) == plain_matches(doc, item, doc_free, item_free, size), turn


@pytest.mark.parametrize("words, of", [((20_000, 3000), [1]), ((20_000, 3000), [1, 2]), ((200_000, 1000), [1, 2, 3])])
def test_repeated_words_take_no_square(words, of):
    import time

    doc, item = (hashed([of[k % len(of)] for k in range(n)]) for n in words)
    started = time.process_time()
    found = dc.tiles(doc, item)
    assert sum(n for _, _, n in found) == words[1]
    assert time.process_time() - started < 5  # the pairs of places are 60 million and more


@pytest.fixture(scope="module")
def tables(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    words = passage.split()
    filler = " ".join(f"w{k}" for k in range(40))
    docs = [
        (1, f"{filler} {passage.upper()} {filler}"),
        (2, f"{filler} {' '.join(words[8:])} between {' '.join(words[:8])}"),  # in another order
        (3, f"{filler} {' '.join(words[:5])}"),  # under half
        (4, f"{' '.join(reversed(words))} {filler}"),  # the same words, no run of them
        (5, None), (6, ""), (7, " \t\n"), (None, passage), (1, f"{filler} {passage.upper()} {filler}"),
        (8, "short item"), (9, f"{'x ' * 200_000}{passage}"),
    ]
    items = [(10, passage), (11, "short item"), (12, None), (13, " "), (None, "item of no id at all here"), (10, passage)]
    return (
        spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, coverage string"),
        spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string"),
    )


def test_contaminated_rows(tables):
    docs, items = tables
    found = dc.contaminations(docs, items).collect()
    got = sorted((r["doc_id"] or 0, r["item_id"], r["item_words"], r["matched_words"]) for r in found)
    assert got == [(0, 10, 16, 16), (1, 10, 16, 16), (1, 10, 16, 16), (2, 10, 16, 16), (8, 11, 2, 2), (9, 10, 16, 16)]
    assert {len(r["tiles"]) for r in found if r["doc_id"] == 2} == {2}
    kept = dc.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 7]


def test_several_parts_of_the_benchmark_and_empty_tables(tables, monkeypatch):
    docs, items = tables
    monkeypatch.setattr(dc, "CHUNK_BYTES", 30)
    assert len({(r["doc_id"], r["item_id"]) for r in dc.contaminations(docs, items).collect()}) == 5
    assert sorted(r["doc_id"] for r in dc.without_contaminated(docs, items).collect()) == [3, 4, 5, 6, 7]
    assert dc.contaminations(docs, items.where("false")).count() == 0
    assert dc.contaminations(docs.where("false"), items).count() == 0
    assert dc.without_contaminated(docs, items.where("false")).count() == docs.count()


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], plain_words(r["text"])) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r["item_id"], plain_words(r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    number = {}
    as_numbers = lambda words: [number.setdefault(w, len(number) + 1) for w in words]
    expected = set()
    for i, item in items:
        seeds = {tuple(item[k : k + dc.SEED]) for k in range(len(item) - dc.SEED + 1)}
        for d, doc in docs:
            if any(tuple(doc[k : k + dc.SEED]) in seeds for k in range(len(doc) - dc.SEED + 1)):
                near = plain_tiles(as_numbers(doc), as_numbers(item), dc.LEAST_TILE) if len(doc) < 1500 else dc.tiles(hashed(as_numbers(doc)), hashed(as_numbers(item)))
                covered = sum(n for _, _, n in near)
                if covered >= dc.COVERAGE * len(item):
                    expected.add((d, i, len(item), covered))
    got = {(r["doc_id"], r["item_id"], r["item_words"], r["matched_words"]) for r in queries.op1_string_tiling(spark, folder).collect()}
    assert got == expected


def test_items_without_words_are_left_out():
    made = dc.make_items([1, 2, 3], ["", None, "a b"])
    assert made.ids == [3] and made.sizes == (2,)
    assert list(dc.compared(next(iter(dc.word_hashes(pa.array(["A  b"])))), made, 0.5))[0][:2] == (0, 2)
