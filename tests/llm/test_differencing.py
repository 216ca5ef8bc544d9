"""Packing by differencing: the partitioning against exhaustive search, whole tables against the library's ids."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tradewind.llm import differencing as df

WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["one text", None, "", " \n ", "a  b\tc\n\nd", "the the the " * 9000, "<|endoftext|> é x", "same text", "same text"]


def sums(lengths, windows):
    return [int(lengths[w].sum()) for w in windows]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=40), st.integers(1, 12))
def test_every_place_is_in_one_window(lengths, windows):
    lengths = np.array(lengths, np.int64)
    found = df.difference(lengths, windows)
    assert len(found) == windows and sorted(p for w in found for p in w) == list(range(len(lengths)))
    spread = max(sums(lengths, found)) - min(sums(lengths, found))
    assert spread <= lengths.max()


def test_differencing_is_near_the_best_partition():
    rng = np.random.default_rng(2)
    for _ in range(40):
        lengths, k = rng.integers(1, 100, 8), int(rng.integers(2, 4))
        best = min(max(np.bincount(list(of), lengths, k)) for of in itertools.product(range(k), repeat=8))
        assert best <= max(sums(lengths, df.difference(lengths, k))) <= 1.2 * best
    assert sorted(sums(np.array([8, 7, 6, 5, 4]), df.difference(np.array([8, 7, 6, 5, 4]), 2))) == [14, 16]  # the textbook's numbers


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(1, 100), max_size=60), st.sampled_from([0.0, 0.005, 0.2, None]))
def test_windows_hold_every_token_once(lengths, padding):
    lengths = np.array(lengths, np.int64)
    found = df.near_equal_windows(lengths, 100, padding)
    held = sorted(part for window in found for part in window)
    for place, parts in itertools.groupby(held, key=lambda part: part[0]):
        at = 0
        for _, start, n in parts:
            assert start == at and n > 0
            at += n
        assert at == lengths[place]
    assert {part[0] for part in held} == set(range(len(lengths)))
    assert all(sum(n for _, _, n in window) <= 100 for window in found)
    if padding is None:
        assert len(held) == len(lengths)
    else:
        assert len(found) <= max(-(-lengths.sum() // 100), lengths.sum() * (1 + padding) / 100)


def test_the_count_rises_before_pieces_are_cut():
    lengths = np.array([60] * 10)  # two do not fit into 100
    assert len(df.near_equal_windows(lengths, 100, None)) == 10
    assert len(df.near_equal_windows(lengths, 100, 0.0)) == 6
    lengths = np.random.default_rng(3).integers(1, 30, 900)
    fewest = -(-lengths.sum() // 100)
    assert max(sums(lengths, df.difference(lengths, fewest))) > 100
    uncut = df.near_equal_windows(lengths, 100, 0.05)
    assert sum(map(len, uncut)) == 900 and fewest < len(uncut) <= 1.05 * lengths.sum() / 100
    assert len(df.near_equal_windows(lengths, 100, 0.0)) == fewest


def checked(rows, docs, capacity, end_id):
    """Pieces against the library's ids; returns the sequences."""
    library = Tokenizer.from_file(WORDS)
    whole = {}
    for doc_id, text in docs:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [end_id], np.uint32)
        whole.setdefault(doc_id, []).append(ids)
    held = {}
    for r in rows:
        fits = [w for w in whole[r["doc_id"]] if len(w) == r["doc_tokens"]]
        assert any(zlib.crc32(w[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for w in fits)
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, versions in whole.items():
        assert sum(r["length"] for r in rows if r["doc_id"] == doc_id) == sum(map(len, versions))
        if len(versions) == 1:
            at = 0
            for start, n in sorted((r["start"], r["length"]) for r in rows if r["doc_id"] == doc_id):
                assert start == at
                at += n
    for parts in held.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert 0 < at <= capacity
    return {k: sum(n for _, n in parts) for k, parts in held.items()}


@pytest.mark.parametrize("group", [4096, 7])
def test_odd_rows(spark, monkeypatch, group):
    monkeypatch.setattr(df, "GROUP", group)
    monkeypatch.setattr(df, "BATCH", 10)
    rng = random.Random(1)
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (3, "again"), (3, "again")]
    rows += [(2**62 + k, " ".join(rng.choices(["a", "few", "words"], k=rng.randint(1, 300)))) for k in range(60)]
    docs = spark.createDataFrame([(i, t, 5, "clash") for i, t in rows], "doc_id long, text string, length long, waiting string").repartition(3)
    packed = df.pack(docs, WORDS, 2, capacity=512, keep_ids=True)
    found = packed.collect()
    lengths = checked(found, rows, 512, 2)
    report = df.padding_report(packed, 512).first()
    assert report["sequences"] == len(lengths) and report["tokens"] == sum(lengths.values())
    assert report["padding"] == sum(0 if n & (n - 1) == 0 else 512 - n for n in lengths.values())
    whole = {r["sequence_id"]: len(r["ids"]) // 4 for r in df.sequences(packed).collect()}
    assert whole == lengths
    if group == 4096:  # one group: never more windows than half a per cent over the fewest
        assert len(lengths) == -(-sum(lengths.values()) // 512)
    assert df.pack(docs.where("false"), WORDS, 2).count() == 0


def test_query_equals_the_library(spark):
    from tradewind.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op11_differencing"](spark, sf_dir).collect()
    lengths = checked(rows, docs, 4096, 2)
    assert len(lengths) == -(-sum(lengths.values()) // 4096)
