"""WARC archives, token files, packed sequences, host reputation: round trips and brute force."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradewind.llm import dac, packing, reputation, tokens, warc
from tradewind.llm.reputation import Rule
from tradewind.session import settings as session_settings

BYTES, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PAGES = "page_id long, url string, html string, host string"
DOCS = "doc_id long, text string, length string"
TEXTS = ["one text", None, "", " \n ", "a  b\tc\n\nd", "the the the " * 9000, "<|endoftext|> é ̀x", "same text", "same text"]


def test_archives_hold_every_page(spark):
    same, other = "<p>same</p>", "é" * 70_000
    rows = [(5, "http://a/", same), (3, "http://b/\r\nx", same), (9, None, same), (4, "http://c/", other), (7, "u", None), (8, "v", ""), (6, "w", "z")]
    rows += [(None, "n", same), (None, "m", "alone"), (6, "w", "z")]
    pages = spark.createDataFrame([(i, u, h, "clash") for i, u, h in rows], PAGES)
    index = warc.write_archives(pages)
    read = {(r["page_id"], r["url"]): r for r in warc.read_records(index).collect()}
    assert index.count() == len(rows)
    got = sorted(map(repr, (tuple(r) for r in warc.page_records(warc.read_records(index)).collect())))
    firsts = {same: 3, "": 7}
    expected = []
    for i, _, h in rows:
        data = (h or "").encode()
        first = firsts.get(h or "")
        again = first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append(repr((i, len(data), digest, "revisit" if again else "response", first if again else None)))
    assert got == sorted(expected)
    assert read[4, "http://c/"]["block"].decode() == other
    assert (3, "http://b/%0D%0Ax") in read and (9, None) in read
    one = index.where("page_id = 4")
    assert [r["page_id"] for r in warc.read_records(one).collect()] == [4]
    assert warc.page_records(warc.read_records(warc.write_archives(pages.where("false")))).count() == 0
    large = warc.write_archives(pages, least_bytes=1000)
    assert large.where("record_type = 'revisit'").count() == 0


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(1, 40)), max_size=12), st.integers(0, 60), st.integers(40, 200))
def test_coalesced_ranges_hold_every_wanted_one(wanted, gap, most):
    wanted = sorted(wanted)
    joined = warc.coalesced(wanted, gap, most)
    assert all(any(a <= o and o + n <= a + m for a, m in joined) for o, n in wanted)
    assert all(m <= most for _, m in joined)


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_direct_codes_round_trip(ids):
    ids = np.array(ids, np.uint32)
    seg = dac.Segment(dac.pack(ids))
    assert (seg.slice(0, len(ids)) == ids).all()
    for i in range(0, len(ids), 97):
        assert seg[i] == ids[i] and (seg.slice(i, len(ids)) == ids[i:]).all()


PARTS = ["a", "Bc", " ", "  ", "\n", "é", "İ", "'s", "!", "1", " ̀", " ", "\t", "🙂", "ΟΣ", "\x1d", ".", ",", "ǅ", "ß", "İ", "|"]
PARTS += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|", "\u2581", "\x00", "<s>", "word" * 60]


def odd_texts(n):
    rng = random.Random(1)
    return [*TEXTS[2:], *("".join(rng.choices(PARTS, k=rng.randint(1, 25))) for _ in range(n))]


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("path, spaced", [(BYTES, True), (WORDS, False)])
def test_pieces_have_the_library_ids(path, spaced, as_text):
    library = Tokenizer.from_file(path)
    if as_text:
        library.encode_special_tokens = True
    own = tokens.Encoder(path, spaced, as_text)
    for text in odd_texts(1500):
        assert np.frombuffer(own.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_memory_of_pieces_is_bounded(monkeypatch):
    library = Tokenizer.from_file(BYTES)
    own = tokens.Encoder(BYTES, True)
    own.known, own.words, own.others = (tokens.Remembered(4000) for _ in range(3))
    for k in range(300):
        text = " ".join(f"w{chr(97 + j % 26) * (j % 7)}x{chr(97 + (j * k) % 26)}." for j in range(k % 40)) + " " + "y" * 3000 * (k % 3)
        assert np.frombuffer(own.encode(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
        for known in (own.known, own.words, own.others):
            assert known.held <= 4000 and max(map(len, known), default=0) <= tokens.LONGEST


def test_pieces_of_a_marking_model_have_the_library_ids(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20_000)
    own = tokens.PieceEncoder(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert own.apart
    for text in odd_texts(1500):
        assert np.frombuffer(own.encode(text), np.uint32).tolist() == library.encode(text)
    assert own.known.held <= 15_000


def test_merges_are_used_only_where_ids_grow_with_them():
    assert tokens.Merges.of(BYTES) is not None and tokens.Merges.of(WORDS) is None
    library, merges = Tokenizer.from_file(BYTES), tokens.Merges.of(BYTES)
    words = [" " + "".join(random.Random(k).choices("aeiounrstéßŁİǆɏ", k=1 + k % 20)) for k in range(800)]
    for word, ids in zip(words, merges.words(words)):
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(word, add_special_tokens=False).ids


def test_merges_of_words_with_marked_ends_are_the_library_s():
    library, merges = Tokenizer.from_file(WORDS), tokens.Merges.ending(WORDS)
    assert merges is not None and tokens.Merges.ending(BYTES) is None
    words = ["".join(random.Random(k).choices("aeiounrstéßıłǎɏ", k=1 + k % 20)) for k in range(800)]
    learned = {t.removesuffix("</w>") for t in library.get_vocab()}  # where the whole word, or what it is made of, is one entry
    words += [w for w in sorted(learned) if w.isascii() and w.isalpha() and w.islower()]
    assert len(words) > 30_000
    for word, own, ids in zip(words, merges.words(words), library.encode_batch(words, add_special_tokens=False)):
        assert np.frombuffer(own, np.uint32).tolist() == ids.ids, word


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(dac, "SEGMENT", 50)
    ids = [3, 1, 2, 9, 7, 8, 20, 11, 11]
    docs = spark.createDataFrame([*((i, t, "clash") for i, t in zip(ids, TEXTS)), (None, "no id", None)], DOCS)
    got = [tuple(r) for r in dac.checksums(dac.read_tokens(dac.with_starts(dac.write_tokens(docs, BYTES, 2)))).orderBy("start").collect()]
    library = Tokenizer.from_file(BYTES)
    expected, start = [], 0
    for i, t in sorted([*zip(ids, TEXTS), (None, "no id")], key=lambda r: (r[0] is not None, r[0] or 0)):
        data = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], np.uint32)
        expected.append((i, start, len(data), zlib.crc32(data.tobytes())))
        start += len(data)
    assert got == expected
    assert dac.read_tokens(dac.with_starts(dac.write_tokens(docs.where("false"), BYTES, 2))).count() == 0


def check_packed(rows, capacity):
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return held


def test_packing_of_odd_rows(spark):
    docs = spark.createDataFrame([(k % 7, t, "clash") for k, t in enumerate(TEXTS)] + [(None, "x", None)], DOCS)
    parts = packing.pieces(docs, WORDS, 1, capacity=512)
    packed = packing.pack(parts, capacity=512)
    rows = packed.collect()
    assert len(rows) == parts.count() and "ids_crc32" in packed.columns
    held = check_packed(rows, 512)
    total = sum(r["length"] for r in rows)
    assert len(held) == -(-total // 512)
    assert sum(r["length"] for r in rows if r["doc_id"] == 5) == 27_001 and max(r["length"] for r in rows) == 512
    assert packing.pack(parts.where("false")).count() == 0


def test_equal_rows_are_dealt_like_others(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 200)
    sizes, kept = [], packing.stored

    def counted(df):
        df = kept(df)
        if "_fill" in df.columns:
            sizes.extend(r["count"] for r in df.groupBy((F.col("sequence_id") / packing.BIN).cast("long")).count().collect())
        return df

    monkeypatch.setattr(packing, "stored", counted)
    parts = spark.createDataFrame([(7, 300, 1)] * 3000, "doc_id long, length long, _number int")
    rows = packing.pack(parts, 1000).collect()
    assert len(rows) == 3000 and len(check_packed(rows, 1000)) <= 1010 and packing.pack(parts, 1000).columns[:3] == parts.columns
    assert max(sizes) < 300


def test_equal_rows_are_written_by_many_tasks(spark):
    docs = spark.createDataFrame([(5, "same text", "")] * 900 + [(None, None, "")] * 300, DOCS).repartition(6)
    index = dac.write_tokens(docs, BYTES, 2)
    files = [r["count"] for r in index.groupBy("part").count().collect()]
    assert len(files) > 2 and max(files) < 700
    got = dac.checksums(dac.read_tokens(dac.with_starts(index))).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None] * 300 + [5] * 900
    assert [r["start"] for r in got] == [*range(300), *range(300, 300 + 900 * 3, 3)]


def test_little_text_is_written_by_many_tasks_of_any_session(spark):
    key = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    docs = spark.createDataFrame([(k, "text", "") for k in range(300)], DOCS)
    with session_settings(spark, {key: "false"}):
        index = dac.write_tokens(docs, BYTES, 2)
    assert index.select("part").distinct().count() > 2 and index.count() == 300


def test_rounds_of_groups_come_close_to_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 40)
    rng = random.Random(3)
    parts = spark.createDataFrame([(k, rng.randint(1, 900)) for k in range(600)], "doc_id long, length long")
    rows = packing.pack(parts, 1000).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(600))
    assert len(check_packed(rows, 1000)) <= 1.06 * sum(r["length"] for r in rows) / 1000  # groups of 40 are tiny


def test_search_empties_bins_and_loses_nothing():
    rng, better = np.random.default_rng(1), 0
    for _ in range(30):
        lengths = rng.integers(600, 1500, rng.integers(20, 80))
        fit = packing.best_fit(lengths, 4096)
        found = packing.local_search([list(b) for b in fit], lengths, 4096)
        assert sorted(p for b in found for p in b) == list(range(len(lengths)))
        assert all(0 < lengths[b].sum() <= 4096 for b in found) and len(found) <= len(fit)
        better += len(found) < len(fit)
    assert better > 3


def test_urls_and_rules(spark):
    cases = {
        "http://WWW.Example.com/en/x?y": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "x://b.com": ("b.com", "", None, "allow"),
        "x://b.com?q=/z": ("b.com", "", None, "allow"),
        "x://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "x://s.net/es/1#f": ("s.net", "/es/1", "net/es/", "block"),
        "x://É.net/a://b": ("É.net", "/a://b", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(k, u, None, "clash") for k, u in enumerate(cases)], PAGES)
    out = reputation.judge(pages, reputation.RULES)
    assert out.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict"]
    assert [tuple(r)[3:] for r in out.orderBy("page_id").collect()] == list(cases.values())
    assert reputation.judge(pages.where("false"), reputation.RULES).count() == 0
    clash = pages.selectExpr("*", "1 AS _judged", "2 AS _RULED", "3 AS _judged_")
    assert reputation.judge(clash, reputation.RULES).columns == [*clash.columns[:3], "_judged", "_RULED", "_judged_", "host", "path", "rule", "verdict"]
    assert [r["verdict"] for r in reputation.judge(clash, reputation.RULES).orderBy("page_id").collect()] == [v[-1] for v in cases.values()]
    with pytest.raises(ValueError):
        reputation.judge(pages, [Rule(f"h{k}", "/", "block") for k in range(reputation.MOST_RULES + 1)])


def test_a_host_is_judged_by_its_pages_and_its_parents(spark):
    urls = [f"x://bad.evil.org/es/{k}" for k in range(60)] + ["x://bad.evil.org/other", "x://new.evil.org/a", "x://fine.org/b"]
    urls += [f"x://good{k % 9}.fine.com/x" for k in range(300)]
    pages = spark.createDataFrame([(k, u, None, None) for k, u in enumerate(urls)], PAGES)
    rules = [Rule("org", "/es/", "block"), Rule("com", "/", "allow")]
    verdict = {r["url"]: r["verdict"] for r in reputation.judge(pages, rules).collect()}
    assert verdict["x://bad.evil.org/other"] == "block" and verdict["x://good1.fine.com/x"] == "allow"
    assert len(verdict) == len(set(urls))
