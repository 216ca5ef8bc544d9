"""Alignment of two tokenizers against the libraries themselves and a plain count of links."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradewind.llm import alignment as al
from tradewind.session import stored

TOKENIZERS = al.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = ["one text", None, "", " ", "  two  spaces ", "a\tb\n\nc  \n d", "Ünïcödé ½ ﬁ 🙂🙂 日本語", "<|endoftext|> <s> </s> <unk> <0x41>", "mark ▁ inside"]
TEXTS += ["word " * 3000, "x" * 4000, "same text", "same text", "\x00 nul", " lead", "trail ", "é ̀x", "\n", "İstanbul ǅ ß"]


def plain(rows):
    """What the contract says, from the libraries' ids."""
    a_model, b_model = Tokenizer.from_file(TOKENIZERS.byte_level), sentencepiece.SentencePieceProcessor(model_file=TOKENIZERS.pieces)
    a_model.encode_special_tokens = True
    letters = {c: b for b, c in zip([*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)], map(chr, [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]))}
    rest = [b for b in range(256) if chr(b) not in letters]
    letters |= {chr(256 + k): b for k, b in enumerate(rest)}
    a_bytes = lambda i: bytes(letters[c] for c in a_model.id_to_token(i))

    def b_bytes(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    out, counts = [], Counter()
    for doc_id, text in rows:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            a, b = [], []
        ends = [{}, {}]
        for side, ids, size in ((0, a, a_bytes), (1, b, b_bytes)):
            at = 0
            for k, i in enumerate(ids):
                at += len(size(i))
                ends[side][at] = k
        groups, links, last = [], [], (-1, -1)
        for end in sorted(set(ends[0]) & set(ends[1])):
            i, j = ends[0][end], ends[1][end]
            groups.append(",".join(map(str, a[last[0] + 1 : i + 1])) + "|" + ",".join(map(str, b[last[1] + 1 : j + 1])))
            links.append((a[i], b[j]))
            last = i, j
        counts.update(links)
        out.append((doc_id, len(a), len(b), len(groups), groups, links))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return sorted(
        repr((d, n_a, n_b, n, len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x),
              hashlib.sha256(";".join(g).encode()).hexdigest() if n_a else ""))
        for d, n_a, n_b, n, g, x in out
    )


def digest(counted):
    sha = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return sorted(repr(tuple(r)) for r in counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", sha).collect())


@pytest.mark.parametrize("most_pairs", [al.PAIRS_TO_BROADCAST, 0])
def test_odd_rows(spark, most_pairs, monkeypatch):
    monkeypatch.setattr(al, "WINDOWS", 3000)
    rng = random.Random(5)
    parts = ["a", "Bc", " ", "  ", "\n", "é", "'s", "!", "12", " ̀", "🙂", "\x1d", ".", "the ", "token ", "ization", " of", "日本"]
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(100 + k, "".join(rng.choices(parts, k=rng.randint(1, 40)))) for k in range(150)]
    rows += [(None, "no id"), (None, None), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, links string, row int")
    aligned = stored(al.align(docs, TOKENIZERS))
    assert digest(al.link_counts(aligned, TOKENIZERS, most_pairs)) == plain(rows)
    empty = stored(al.align(docs.where("false"), TOKENIZERS))
    assert al.link_counts(empty, TOKENIZERS, most_pairs).count() == 0


def test_windows_end_before_marked_tokens():
    work = al.Aligner(TOKENIZERS)
    text = "some ordinary words, and a longer unbelievably tokenized one"
    a, b = np.frombuffer(work.encode_a(" " + text), np.uint32), np.frombuffer(work.encode_b(text), np.uint32)
    ends_a, ends_b = work.windows(a, b, *work.ends(a, b))
    assert len(ends_a) == len(text.split(" ")) and ends_a[-1] == len(a) and ends_b[-1] == len(b)
    work(text)
    known = len(work.known)
    work(text + " " + text)
    assert len(work.known) == known == len(set(text.split(" ")))


def test_a_window_that_is_known_is_not_encoded_again(monkeypatch):
    work = al.Aligner(TOKENIZERS)
    texts = ["some words, and\nlines of words", "words, of some and some", "and\nlines"]
    first, *rest = map(work, texts)
    whole = [work._whole(t) for t in texts]
    assert [first, *rest] == whole and first.n_a > 5
    monkeypatch.setattr(work.byte_level, "encode", None)
    monkeypatch.setattr(work.byte_level, "learned", None)
    monkeypatch.setattr(work.pieces, "learned", None)
    assert [work(t) for t in texts] == whole


def test_a_text_with_one_bad_window_has_no_tokens():
    work = al.Aligner(TOKENIZERS)
    texts = ["fine words", "fine \u00bd words", "words fine"]  # one half has other bytes in B
    for _ in range(2):
        assert [work(t).n_a > 0 for t in texts] == [work._whole(t).n_a > 0 for t in texts]
    bad = [t for t in TEXTS if t and work._whole(t) == al.NOTHING]
    assert bad and all(work(t) == al.NOTHING for t in bad)


def test_tasks_hand_on_counts_when_full(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"text {k % 7} of {k % 3}") for k in range(60)], "doc_id long, text string")
    aligned = stored(al.align(docs, TOKENIZERS))
    whole = {tuple(r) for r in al.pair_counts(aligned, TOKENIZERS).collect()}
    monkeypatch.setattr(al, "MERGED", 5)
    assert {tuple(r) for r in al.pair_counts(aligned, TOKENIZERS).collect()} == whole


def test_query_equals_plain_count(spark):
    from tradewind.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op12_token_windows"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain(rows)
