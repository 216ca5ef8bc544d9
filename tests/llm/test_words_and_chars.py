"""Words and n-grams against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tradewind.llm import chars, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


@settings(deadline=None, max_examples=200)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b😀Z1", max_size=40)), max_size=12))
def test_word_hashes_follow_the_words(texts):
    names = {}
    found = list(words.word_hashes(pa.array(texts, pa.string())))
    assert len(found) == len(texts)
    for text, hashes in zip(texts, found):
        expected = plain_words(text)
        assert len(expected) == len(hashes)
        for word, value in zip(expected, hashes.tolist()):
            assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


def test_texts_longer_than_a_block_and_words_longer_than_a_block():
    texts = ["long word " * 150_000, "y" * (words.BLOCK + 50_000) + " z", "", "z"]
    found = list(words.word_hashes(pa.array(texts)))
    assert [len(x) for x in found] == [300_000, 2, 0, 1]
    assert found[1][1] == found[3][0]
    assert len(np.unique(found[0])) == 2


def test_a_sliced_array_is_read_from_its_own_start():
    array = pa.array(["one two", "three", None, "two"])
    tail = list(words.word_hashes(array.slice(1)))
    assert [len(x) for x in tail] == [1, 0, 1]
    assert tail[2][0] == list(words.word_hashes(array))[0][1]


def test_shingles_are_sets_and_short_texts_are_one_run():
    one, two, none = words.word_hashes(pa.array(["a b a b a b", "a", ""]))
    assert len(words.shingles(one, 2)) == 2
    assert len(words.shingles(two, 5)) == 1
    assert len(words.shingles(none, 5)) == 0
    assert len(words.runs(one, 2)) == 5


def test_ngrams_of_a_long_text_come_once_each(monkeypatch):
    text = "".join(random.Random(1).choice("abcdé ") for _ in range(5000))
    whole = np.sort(np.concatenate(list(chars.ngram_ids(text, (1, 3, 4), 20))))
    monkeypatch.setattr(chars, "BLOCK", 700)
    assert (np.sort(np.concatenate(list(chars.ngram_ids(text, (1, 3, 4), 20)))) == whole).all()
    assert len(whole) == 5000 + 4998 + 4997
    assert list(chars.ngram_ids(None, (3,), 10)) == [] == list(chars.ngram_ids("", (3,), 10))
    assert list(chars.ngram_ids("ab", (3,), 10)) == []
