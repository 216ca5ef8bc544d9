"""Near duplicates and components against brute force."""

import random

import numpy as np
import pytest

from tests.llm.test_words_and_chars import plain_words
from tradewind.llm import neardup, queries
from tradewind.llm.graph import components
from tradewind.llm.neardup import Settings

DOCS = "doc_id long, text string, component_id string"


def plain_sets(text, size):
    found = plain_words(text)
    size = min(size, len(found))
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1)) if found else frozenset()


def plain_components(pairs):
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(top)}


def brute_force(rows, size):
    """``doc_id: (n, component, kept)`` of rows with distinct ids, comparing every two sets."""
    sets = [(i, plain_sets(t, size)) for i, t in rows]
    links = [(i, i) for i, _ in sets]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if a and b and 100 * both >= 80 * (len(a) + len(b) - both):
                links.append((i, j))
    label = plain_components(links)
    return {i: (len(s), label[i], label[i] == i) for i, s in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.fixture(scope="module")
def family():
    """Copies, chains of edits up to and past the threshold, hubs, unrelated texts."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(3, 120))
        texts.append(base)
        for _ in range(rng.randint(0, 25)):
            own = list(rng.choice([base, texts[-1]]))
            for _ in range(rng.randint(0, max(1, len(own) // 8))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(own)
    texts += [["one"], ["one"], ["ONE"], ["one", "two"]]
    rng.shuffle(texts)
    rows = [(k + 1, " ".join(t)) for k, t in enumerate(texts)]
    return [*rows, (1000, None), (1001, ""), (1002, " \n "), (1003, "x y " * 30_000), (1004, "x y " * 30_001)]


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(spark, family, size):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in family], DOCS)
    assert result(neardup.near_duplicates(docs, Settings(shingle=size))) == brute_force(family, size)


def test_blocks_of_few_rows_give_the_same(spark, family, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in family], DOCS)
    assert result(neardup.near_duplicates(docs, Settings(shingle=2))) == brute_force(family, 2)


@pytest.mark.parametrize("block", [16, 2048])
def test_likely_pairs_that_are_no_links_are_not_made_as_rows(spark, monkeypatch, block):
    """Templated pages at 0.72, each alone, beside a chain of edits as one large component."""
    base = [f"t{k}" for k in range(100)]
    texts = [[*base[:42], *(f"own{d}x{k}" for k in range(15)), *base[57:]] for d in range(150)]
    for k in range(60):  # from the template on, one word after another
        texts.append([*(f"c{j}" for j in range(k)), *base[k:]])
    rows = [(i + 1, " ".join(t)) for i, t in enumerate(texts)]
    made, kept = [], neardup.stored

    def counted(df):
        made.append((kept_df := kept(df)).count())
        return kept_df

    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "stored", counted)
    got = result(neardup.near_duplicates(spark.createDataFrame([(i, t, "") for i, t in rows], DOCS), Settings(shingle=2)))
    assert got == brute_force(rows, 2)
    assert sum(c == i for i, (_, c, _) in got.items()) == 151
    assert max(made[3:]) <= neardup.BANDS * len(rows)  # pages alone have 11,175 likely pairs


def test_no_ids_repeated_rows_and_empty_tables(spark):
    long = "the quick brown fox jumps over the lazy dog near the river bank today"
    rows = [(5, long, "a"), (5, long, "a"), (None, long, "b"), (None, "some other text that has no id at all", "c"), (None, None, None), (3, long + " too", None)]
    docs = spark.createDataFrame(rows, DOCS)
    found = neardup.near_duplicates(docs, Settings(shingle=2)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in found) == [
        (0, 0, True), (0, 0, True), (0, 3, False), (3, 3, True), (5, 3, False), (5, 3, False),
    ]
    kept = neardup.one_of_each(docs, Settings(shingle=2))
    assert kept.columns == docs.columns
    assert sorted(str(r["text"]) for r in kept.collect()) == sorted([long + " too", "some other text that has no id at all", "None"])
    twice = spark.createDataFrame([(8, "alone here", "a"), (8, "alone here", "a"), (9, "quite different words", "b")], DOCS)
    assert sorted(r["doc_id"] for r in neardup.one_of_each(twice, Settings()).collect()) == [8, 9]
    assert neardup.near_duplicates(docs.where("false")).count() == 0
    assert neardup.one_of_each(docs.where("false")).count() == 0


def test_estimate_is_close_and_small_sets_fill_their_registers():
    rng = np.random.default_rng(3)
    for n in (1, 7, 80, 3000):
        whole = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        a, b = whole[: n + n // 3], whole[n // 3 :]
        true = len(np.intersect1d(a, b)) / (2 * n)
        same = (neardup.registers(a) == neardup.registers(b)).sum()
        assert abs(neardup.estimated(np.array([same]))[0] - true) < 0.15
    assert (neardup.registers(np.array([9], np.uint64)) == neardup.registers(np.array([9], np.uint64))).all()


def test_components_of_chains_hubs_and_nothing(spark):
    rng = random.Random(2)
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(150)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = plain_components((a, b) for a, b in pairs if a != b)
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_brute_force_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert result(queries.op9_hyperminhash(spark, folder)) == brute_force(rows, 2)


def test_any_long_is_an_id_and_any_name_a_column(spark):
    long = "the quick brown fox jumps over the lazy dog near the river bank today"
    ids = [2**62 + 5, 2**62 + 6, 2**63 - 1, -(2**63), 0]
    rows = [(i, long if k < 4 else "something else entirely here", 1, 2, 3, 4) for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, _ROW_ int, _id int, _gone int")
    assert result(neardup.near_duplicates(docs)) == brute_force([r[:2] for r in rows], 5)
    twice = docs.unionByName(docs.where("doc_id = 0"))
    kept = neardup.one_of_each(twice)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [-(2**63), 0]
    top = docs.where("doc_id > 0").unionByName(spark.createDataFrame([(None, long, 1, 2, 3, 4)], docs.schema))
    found = {r["doc_id"]: (r["component_id"], r["kept"]) for r in neardup.near_duplicates(top).collect()}
    assert found == {2**62 + 5: (2**62 + 5, True), 2**62 + 6: (2**62 + 5, False), 2**63 - 1: (2**62 + 5, False), None: (2**62 + 5, False)}


def test_a_stray_row_does_not_deal_its_bucket_again(spark):
    n = 20_480
    members = spark.range(n + 2).selectExpr("1L AS key", "0 AS band", "id AS node", "10L AS n", "0L AS leader")
    labels = spark.range(1, n + 1).selectExpr("id AS node", "1L AS label")
    sketches = spark.range(n + 2).selectExpr("id AS node", "10L AS n", "cast('x' AS binary) AS registers")
    dealt = neardup._dealt(members, labels, sketches)
    assert n < dealt.count() < 25_000
    sizes = dealt.groupBy("cell").count()
    assert sizes.where(f"count > {2 * neardup.BLOCK}").isEmpty()
    # Every pair of the stray row and another one meets in exactly one cell, on different sides.
    stray = dealt.where(f"node = {n + 1} AND side = 1").select("cell")
    assert dealt.where("side = 0").join(stray, "cell").select("node").distinct().count() == n


@pytest.mark.parametrize("block", [2, 5])
def test_every_pair_of_labels_meets_in_one_cell(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    label = {k: k % 4 if k < 12 else 0 if k < 25 else k for k in range(1, 31)}
    members = spark.createDataFrame([(1, 0, k, 1, 0) for k in label], "key long, band int, node long, n long, leader long")
    labels = spark.createDataFrame(list(label.items()), "node long, label long")
    sketches = spark.createDataFrame([(k, 1, b"x") for k in label], "node long, n long, registers binary")
    cells = {}
    for r in neardup._dealt(members, labels, sketches).collect():
        cells.setdefault(r["cell"], []).append((r["node"], r["side"]))
    met = {}
    for rows in cells.values():
        for a, s in rows:
            for c, t in rows:
                if a < c and label[a] != label[c] and (s != t or s == 2):
                    met[a, c] = met.get((a, c), 0) + 1
    assert met == {(a, c): 1 for a in label for c in label if a < c and label[a] != label[c]}
