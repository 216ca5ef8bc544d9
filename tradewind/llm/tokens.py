"""Token ids of whole texts from a public tokenizer file, with each distinct piece of text encoded once."""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Callable
from functools import wraps

import numpy as np

REMEMBERED = 64 << 20  # bytes of strings and their ids in each half of what a worker remembers
LONGEST = 200  # characters of the longest string that is remembered
_OTHER_SPACE = re.compile(r"[^\S \n]")
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
_SINGLE_SPACE = re.compile("(?<=[^ ]) (?=[^ ])")
MARK = "\u2581"  # how SentencePiece writes a space
#: A word of Latin letters (without the one whose lower case is two characters) and ASCII marks behind it, but no apostrophe.
_PLAIN = re.compile("(\n?)([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:;=?@[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(rest)}


_LETTERS = _byte_letters()
_encoders: dict = {}


class Remembered(dict):
    """What was worked out for strings before, in two halves of a bounded size: a full one becomes the older half."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit, self.held, self.older = limit, 0, {}

    def recalled(self, keys) -> dict:
        """What the older half knows of ``keys``."""
        return {k: self.older[k] for k in keys if k in self.older}

    def keep(self, found: dict, size: int) -> None:
        """Remember what was worked out; ``size`` is what keys and values take in bytes."""
        size += 200 * len(found)
        if self.held + size > self.limit:
            self.older, self.held = dict(self), 0
            self.clear()
        if size <= self.limit:
            self.held += size
            self.update(found)

    def keep_ids(self, found: dict[str, bytes]) -> None:
        if max(map(len, found), default=0) > LONGEST:
            found = {text: ids for text, ids in found.items() if len(text) <= LONGEST}
        self.keep(found, 2 * sum(map(len, found)) + sum(map(len, found.values())))

    def joined(self, pieces: list[str], learned: Callable[[set[str]], dict[str, bytes]]) -> bytes:
        """Ids of the pieces one after another; ``learned`` works out those of pieces that are not known."""
        found = list(map(self.get, pieces))
        if None in found:
            missing = {p for p, ids in zip(pieces, found) if ids is None}
            new = self.recalled(missing)
            new |= learned(missing.difference(new))
            self.keep_ids(new)
            found = [new[p] if ids is None else ids for p, ids in zip(pieces, found)]
        return b"".join(found)


class Merges:
    """The merges of a byte-level tokenizer file, applied to many words by one call of tiktoken.

    A word has a space before it (``of``), or its last letter bears a mark of the end (``ending``): there a space behind the
    word stands for that mark. Marked letters have the smallest ids but for letters, so that space is merged first of all.
    """

    def __init__(self, ranks: dict[bytes, int], ends: bool = False):
        import tiktoken

        self.ends = ends
        self.encoding = tiktoken.Encoding("merges", pat_str=r"\p{L}+ " if ends else r" ?\p{L}+", mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, k in ranks.items():
            self.sizes[k] = len(token)

    @classmethod
    def _read(cls, path: str, ends: bool) -> "Merges | None":
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, byte_of = model["vocab"], {letter: byte for byte, letter in _LETTERS.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [vocabulary.get(a + b, -1) for a, b in pairs]
        mark = model.get("end_of_word_suffix") or ""
        letters = {token: k for token, k in vocabulary.items() if len(token) == 1 or (mark and token.endswith(mark) and len(token) == 1 + len(mark))}
        plain = not any(model.get(k) for k in ("continuing_subword_prefix", "byte_fallback", "ignore_merges", "dropout"))
        wanted = {*byte_of, *(letter + mark for letter in byte_of)}
        if not plain or bool(mark) != ends or set(letters) != wanted or made != sorted(set(made)) or min(made, default=0) <= max(letters.values()):
            return None

        def spelled(token: str) -> bytes:
            marked = mark and token.endswith(mark)
            return bytes(byte_of[c] for c in (token.removesuffix(mark) if marked else token)) + (b" " if marked else b"")

        ranks = {spelled(token): k for token, k in [*letters.items(), *((a + b, k) for (a, b), k in zip(pairs, made))]}
        if mark and any(b" " in token[:-1] for token, k in ranks.items() if k >= made[0]):
            return None  # a space within a word
        return cls(ranks, ends) if len(ranks) == len(letters) + len(made) else None

    @classmethod
    def of(cls, path: str) -> "Merges | None":
        """None unless ids grow in the order of the merges, so that the smallest id is always merged first."""
        return cls._read(path, ends=False)

    @classmethod
    def ending(cls, path: str) -> "Merges | None":
        """The same for words whose last letter bears the file's mark; None if it has no such mark."""
        return cls._read(path, ends=True)

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, each with a space before it, or none if their ends are marked."""
        if not words:
            return []
        text = " ".join(words) + " " if self.ends else "".join(words)
        ids = np.array(self.encoding.encode_ordinary(text), np.uint32)
        ends = np.cumsum([len(w.encode()) + self.ends for w in words])
        cuts = (4 * (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1)).tolist()
        data = ids.tobytes()
        return [data[i:j] for i, j in zip([0, *cuts], cuts)]


class Encoder:
    """Encodes a text piece by piece, as little-endian unsigned 32-bit ids: those of ``Tokenizer.from_file(path)``.

    Strings of added tokens are cut out first and have their own ids, as the library does it by default;
    with ``special_as_text`` they are ordinary text. What is left is cut before every single space or line
    feed between two other characters. No token of these tokenizers reaches over one: their patterns match
    it only as the first character of a word (``leading_space``), alone, or drop it. So a piece has the same
    ids wherever it stands, and pieces that come again are looked up; what is remembered is bounded in bytes.
    """

    def __init__(self, path: str, leading_space: bool, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = {} if special_as_text else self.tokenizer.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError(f"{path} has added tokens that depend on their surroundings")
        self.special = {t.content: np.uint32(k).tobytes() for k, t in added.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_strings = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.leading_space = leading_space
        self.merges = Merges.of(path) if leading_space else Merges.ending(path)
        self.known, self.words, self.others = Remembered(), Remembered(REMEMBERED // 2), Remembered(REMEMBERED // 8)

    def _ids(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _words(self, words: set[str]) -> dict[str, bytes]:
        """Ids of letters alone, behind a space or not: one word of the pattern, so the model's merges are all there is to do."""
        if self.merges and not self.leading_space:
            words = list(words)
            return dict(zip(words, self.merges.words(words)))
        if self.merges:
            spaced = [w for w in words if w[0] == " "]
            found = dict(zip(spaced, self.merges.words(spaced)))
            return found | {w: self._merged(w) for w in words if w[0] != " "}
        found = {w: self.words[w] for w in words if w in self.words}
        found |= self.words.recalled(words.difference(found))
        new = {word: self._merged(word) for word in words.difference(found)}
        self.words.keep_ids(new)
        return found | new

    def _merged(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _other(self, text: str) -> bytes:
        """Ids of a text as it stands, without a space before it: marks, or the start of a text."""
        if text not in self.others:
            self.others.keep_ids({text: self._ids([text])[0]})
        return self.others.get(text) or self._ids([text])[0]

    def learned(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of new pieces: plain ones as a word and marks, the others as the library gives them."""
        found, others, plain = {}, [], {}
        for piece in pieces:
            match = _PLAIN.fullmatch(piece) if len(piece) <= LONGEST else None
            if match:
                line, word, marks = match.groups()
                word = word.lower() if not self.leading_space else word if line else " " + word
                plain[piece] = (self.leading_space and line, word, marks)
            else:
                others.append(piece)
        words = self._words({word for _, word, _ in plain.values()})
        for piece, (line, word, marks) in plain.items():
            ids = words[word] + self._other(marks) if marks else words[word]
            found[piece] = self._other(line) + ids if line else ids
        lead = " " if self.leading_space else ""
        found.update(zip(others, self._ids([p if p[:1] == "\n" else lead + p for p in others])))
        return found

    def spaced(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of texts with a space put before each, all new ones together; for files with ``leading_space``."""
        parts = {p: p.replace("\n", " \n").split(" ") for p in pieces}
        odd = {p for p, own in parts.items() if "" in own or "\n" in own or _OTHER_SPACE.search(p)}
        new = self.learned({x for p, own in parts.items() if p not in odd for x in own})
        return {p: self.encode(" " + p) if p in odd else b"".join([new[x] for x in own]) for p, own in parts.items()}

    def _plain(self, text: str) -> bytes:
        """Ids of a text without strings of added tokens."""
        if not self.leading_space:  # white space is dropped
            return self.known.joined(text.replace("\n", " ").split(" "), self.learned)
        pieces = text.replace("\n", " \n").split(" ")
        first = pieces.pop(0)
        if "" in pieces or "\n" in pieces or _OTHER_SPACE.search(text):
            first, *pieces = _BOUNDARY.split(text)
        head = self._other(first) if first else b""  # no space before the first piece
        return head + self.known.joined(pieces, self.learned)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.special_strings.split(text)  # every second part is an added token
        return b"".join(self.special[p] if k % 2 else self._plain(p) if p else b"" for k, p in enumerate(parts))


def between_spaces(text: str) -> list[str]:
    """The text cut at each single space between two characters that are no white space."""
    pieces = text.split(" ")
    if "" in pieces or " \n" in text or "\n " in text or _OTHER_SPACE.search(text):
        pieces = _BOUNDARY.split(text)
    return pieces


class PieceEncoder:
    """Encodes a text with a SentencePiece model that marks a space before a word, as little-endian unsigned 32-bit ids.

    The ids are those of ``SentencePieceProcessor(model_file=path).encode(text)``. A text is cut before every
    single space between two other characters: if no piece of the model holds the mark behind another
    character, none reaches over it, and the model itself puts a mark before the text it gets. Pieces of
    text that come again are looked up; new ones are encoded together. Texts that hold the mark are encoded whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.marked = np.array([e[:1] == MARK for e in entries])
        self.apart = not any(MARK in e.lstrip(MARK) for e in entries)
        self.apart &= "".join(self.model.encode("a  b ", out_type=str)) == f"{MARK}a{MARK}{MARK}b{MARK}"
        self.known = Remembered(REMEMBERED * 3 // 4)

    def learned(self, pieces: set[str]) -> dict[str, bytes]:
        """In a text of pieces without a space, each begins with its only token that has the mark."""
        plain = [p for p in pieces if p and " " not in p]
        ids = np.array(self.model.encode(" ".join(plain), num_threads=1), np.uint32)
        data, starts = ids.tobytes(), [*(np.flatnonzero(self.marked[ids]) * 4).tolist(), 4 * len(ids)]
        found = {p: data[i:j] for p, i, j in zip(plain, starts, starts[1:])}
        return found | {p: array("I", self.model.encode(p)).tobytes() for p in pieces if p not in found}

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.apart or MARK in text:
            return array("I", self.model.encode(text)).tobytes()
        pieces = text.split(" ")
        if "" in pieces:
            pieces = _SINGLE_SPACE.split(text)
        return self.known.joined(pieces, self.learned)


def uncollected(rows: Callable) -> Callable:
    """A function of batches that runs without Python's search for cycles.

    What encoders remember are some hundred thousand small objects and no cycles: looking through them again and
    again would take up to a quarter of a task's time.
    """

    @wraps(rows)
    def run(batches):
        gc.disable()
        try:
            yield from rows(batches)
        finally:
            gc.enable()

    return run


def encoder(path: str, leading_space: bool, special_as_text: bool = False) -> Encoder:
    """The encoder of this worker process for a tokenizer file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (path, leading_space, special_as_text)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def piece_encoder(path: str) -> PieceEncoder:
    """The encoder of this worker process for a SentencePiece model."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def byte_level_entries(path: str) -> list[bytes]:
    """The bytes that each id of a byte-level tokenizer file stands for; an added token's are its string."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    byte_of = {letter: byte for byte, letter in _LETTERS.items()}
    added = {k: t.content for k, t in tokenizer.get_added_tokens_decoder().items()}
    entries = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, k in tokenizer.get_vocab(with_added_tokens=True).items():
        entries[k] = added[k].encode() if k in added else bytes(byte_of[c] for c in token)
    return entries


def piece_entries(path: str) -> list[bytes]:
    """The bytes that each id of a SentencePiece model stands for: its piece with marks as spaces, or the byte it names."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    return [bytes([int(p[3:-1], 16)]) if model.is_byte(k) else p.replace(MARK, " ").encode() for k, p in enumerate(pieces)]
