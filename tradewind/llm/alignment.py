"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, found in windows between words.

Tokenizer A is a byte-level one, tokenizer B a SentencePiece model that marks spaces. A text is read as a space
and the text, which is what B makes of it, so both sides cover the same bytes. No token of either side reaches over a
single space between two other characters, so both have an end there and their next tokens begin with the space: what
lies between such spaces is whole windows, whatever stands around it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.tokens import LONGEST, MARK, Remembered, between_spaces, byte_level_entries, encoder, piece_encoder, piece_entries, uncollected
from tradewind.session import stored

WINDOWS = 96 << 20  # bytes of window alignments in each half of what a worker remembers
BATCH_BYTES = 8 << 20  # results handed on at once
PAIRS_TO_BROADCAST = 2_000_000  # id pairs with their counts, 17 bytes each
MERGED = 4_000_000  # links counted at once, and distinct pairs that a task holds
BAD = ("", b"", -(1 << 60), 0)  # what is known of a window whose bytes differ: fewer tokens than any text has
STOP = 0xFFFFFFFF  # no id: between the ids of both sides in the name of a window
HOT = 1000  # a pair with more than this fraction of all links is counted without a shuffle: fewer than this many

_aligners: dict = {}


@dataclass(frozen=True)
class Tokenizers:
    """Files of both tokenizers."""

    byte_level: str
    pieces: str


@dataclass(frozen=True)
class Alignment:
    """``groups``: ids between neighbouring shared ends, ``a1,a2|b1;a3|b2,b3``. ``links``: a code for each pair of tokens that end together."""

    n_a: int
    n_b: int
    groups: str
    links: bytes


NOTHING = Alignment(0, 0, "", b"")


class Aligner:
    """Aligns whole texts; one per worker process, which remembers the alignment of windows by their text."""

    def __init__(self, tokenizers: Tokenizers):
        self.byte_level = encoder(tokenizers.byte_level, leading_space=True, special_as_text=True)
        self.pieces = piece_encoder(tokenizers.pieces)
        self.encode_a, self.encode_b = self.byte_level.encode, self.pieces.encode
        self.entries = byte_level_entries(tokenizers.byte_level), piece_entries(tokenizers.pieces)
        self.sizes = [np.array([len(e) for e in entries], np.int64) for entries in self.entries]
        self.marked = [np.array([e[:1] == b" " for e in entries]) for entries in self.entries]
        self.names = [f"{k}{sign}" for sign in ",|;" for k in range(max(map(len, self.entries)))]
        self.code = np.uint32 if len(self.entries[0]) * len(self.entries[1]) <= 1 << 32 else np.uint64
        self.known = Remembered(WINDOWS)

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The byte behind each token of either side."""
        return np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])

    def windows(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where windows end, as places in ``a`` and in ``b``, of ids that cover equally many bytes.

        A window ends where a token of A and one of B end at the same byte and the next token of each begins
        with a space, or where the text ends.
        """
        before_space, anchor = np.ones(len(a), bool), np.ones(len(b), bool)
        before_space[:-1], anchor[:-1] = self.marked[0][a[1:]], self.marked[1][b[1:]]
        anchors = np.flatnonzero(anchor)
        place = np.searchsorted(end_a, end_b[anchors])
        shared = (end_a[place] == end_b[anchors]) & before_space[place]
        return place[shared] + 1, anchors[shared] + 1

    def _named(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> list[bytes]:
        """The name of each window: its ids of A, ``STOP``, its ids of B."""
        count_a, count_b = ends_a.copy(), ends_b.copy()
        count_a[1:] -= ends_a[:-1]
        count_b[1:] -= ends_b[:-1]
        number = np.arange(len(ends_a))
        names = np.full(len(a) + len(b) + len(number), STOP, np.uint32)
        names[np.arange(len(a)) + np.repeat(ends_b - count_b + number, count_a)] = a
        names[np.arange(len(b)) + np.repeat(ends_a + number + 1, count_b)] = b
        data, ends = names.tobytes(), (4 * (ends_a + ends_b + number + 1)).tolist()
        return [data[i:j] for i, j in zip([0, *ends], ends)]

    def _windows(self, names: list[bytes]) -> list[tuple[str, bytes, bytes]] | None:
        """Groups, links and covered bytes of new windows, all of them at once; None if both sides' bytes differ."""
        ids = np.frombuffer(b"".join(names), np.uint32)
        sizes = np.array([len(n) for n in names]) // 4
        stops = np.flatnonzero(ids == STOP)
        first = np.cumsum(sizes) - sizes
        behind = np.arange(len(ids)) > np.repeat(stops, sizes)  # what follows the stop is of B
        is_stop = ids == STOP
        a, b = ids[~behind & ~is_stop], ids[behind]
        covered = b"".join(map(self.entries[0].__getitem__, a.tolist()))
        if covered != b"".join(map(self.entries[1].__getitem__, b.tolist())):
            return None
        end_a, end_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        place = np.searchsorted(end_a, end_b)
        shared_b, shared_a = end_a[place] == end_b, np.zeros(len(a), bool)
        shared_a[place[shared_b]] = True
        links = (a[shared_a].astype(np.uint64) * np.uint64(len(self.entries[1])) + b[shared_b]).astype(self.code).tobytes()
        # Tokens of a group of A, then of B, each with the sign that follows it.
        vocabulary = len(self.names) // 3
        signed = np.concatenate([a + vocabulary * shared_a, b + 2 * vocabulary * shared_b])
        group = np.concatenate([2 * (np.cumsum(shared_a) - shared_a), 2 * (np.cumsum(shared_b) - shared_b) + 1])
        parts = [self.names[k] for k in signed[np.argsort(group, kind="stable")].tolist()]
        last_a = np.cumsum(stops - first) - 1  # of each window, among the tokens of A
        text_ends = (np.cumsum(sizes) - np.arange(len(names)) - 1).tolist()
        link_ends = (np.cumsum(shared_a)[last_a] * np.dtype(self.code).itemsize).tolist()
        byte_ends = end_a[last_a].tolist()
        return [
            ("".join(parts[i:j])[:-1], links[m:n], covered[x:y])
            for i, j, m, n, x, y in zip([0, *text_ends], text_ends, [0, *link_ends], link_ends, [0, *byte_ends], byte_ends)
        ]

    def _learned(self, pieces: set[str]) -> dict[str, tuple[str, bytes, int, int]]:
        """Groups, links and numbers of tokens of pieces of text, each with a space before it."""
        a, b, stop = self.byte_level.spaced(pieces), self.pieces.learned(pieces), np.uint32(STOP).tobytes()
        names = [a[p] + stop + b[p] for p in pieces]
        aligned = self._windows(names)
        if aligned is None:
            aligned = [(self._windows([name]) or [BAD])[0] for name in names]
        return {
            p: (groups, links, len(a[p]) // 4, len(b[p]) // 4) if covered == (" " + p).encode() else BAD
            for p, (groups, links, covered, *_) in zip(pieces, aligned)
        }

    def _joined(self, text: str) -> Alignment | None:
        """The alignment of a text from those of its pieces; None if the bytes of one of them differ."""
        pieces = between_spaces(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            missing = {p for p, hit in zip(pieces, found) if hit is None}
            new = self.known.recalled(missing)
            rest = missing.difference(new)
            if rest:
                new |= self._learned(rest)
            kept = new if max(map(len, missing)) <= LONGEST else {p: hit for p, hit in new.items() if len(p) <= LONGEST}
            self.known.keep(kept, 150 * len(kept) + sum([2 * len(p) + len(hit[0]) + len(hit[1]) for p, hit in kept.items()]))
            found = [new[p] if hit is None else hit for p, hit in zip(pieces, found)]
        groups, links, n_a, n_b = zip(*found)
        count = sum(n_a)
        return Alignment(count, sum(n_b), ";".join(groups), b"".join(links)) if count >= 0 else None

    def _whole(self, text: str) -> Alignment:
        """The alignment of a text that is encoded in one go, from windows between the ends of its tokens."""
        spaced = " " + text
        a, b = np.frombuffer(self.encode_a(spaced), np.uint32), np.frombuffer(self.encode_b(text), np.uint32)
        whole = spaced.encode()
        end_a, end_b = self.ends(a, b)
        if not end_a[-1] == end_b[-1] == len(whole):
            return NOTHING
        names = self._named(a, b, *self.windows(a, b, end_a, end_b))
        distinct = list(dict.fromkeys(names))
        aligned = self._windows(distinct)
        if aligned is None:
            return NOTHING
        known = dict(zip(distinct, aligned))
        groups, links, covered = zip(*map(known.__getitem__, names))
        if b"".join(covered) != whole:
            return NOTHING
        return Alignment(len(a), len(b), ";".join(groups), b"".join(links))

    def __call__(self, text: str | None) -> Alignment:
        if not text:
            return NOTHING
        found = self._joined(text) if self.pieces.apart and MARK not in text else None
        return self._whole(text) if found is None else found


def aligner(tokenizers: Tokenizers) -> Aligner:
    """The aligner of this worker process."""
    if tokenizers not in _aligners:
        _aligners[tokenizers] = Aligner(tokenizers)
    return _aligners[tokenizers]


def second_size(tokenizers: Tokenizers) -> int:
    """Ids of tokenizer B: a link's code is the id of A times this, plus the id of B."""
    return len(piece_entries(tokenizers.pieces))


def _codes(tokenizers: Tokenizers) -> type:
    return np.uint32 if len(byte_level_entries(tokenizers.byte_level)) * second_size(tokenizers) <= 1 << 32 else np.uint64


def align(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, groups, links`` of every row of ``docs(doc_id, text)``, from its whole text.

    Strings of special tokens are plain text. A text is cut into windows at shared ends before space-marked tokens, and the
    tokens of each window, known by its text, are found and aligned once per worker, as long as it is remembered. If the bytes
    of either side's tokens differ from a space and the text, it has no tokens: counts of 0, an empty
    ``groups``. So do NULL and empty texts. Texts with the mark itself, and those with a window whose bytes differ, are
    encoded as a whole by both tokenizers and cut where their tokens end. A group is what lies between two
    neighbouring bytes at which tokens of both sides end; its last tokens are linked, and no others.
    ``links`` holds their codes (see ``second_size``), 4 bytes each (8 for very large vocabularies).

    Repeated rows are aligned each; rows without an id keep none. Nothing is shuffled.
    """
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"]
    width = np.dtype(_codes(tokenizers)).itemsize

    @uncollected
    def run(batches):
        work, kinds = aligner(tokenizers), [*[pa.int64()] * 4, pa.string(), pa.binary()]
        for batch in batches:
            out, held = [], 0
            for k, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), start=1):
                found = work(text)
                out.append((doc_id, found.n_a, found.n_b, len(found.links) // width, found.groups, found.links))
                held += len(found.groups) + len(found.links)
                if held > BATCH_BYTES or k == len(batch):
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=names)
                    out, held = [], 0

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, groups string, links binary")


def pair_counts(aligned: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """``code, n``: how many links of all of ``aligned`` hold each pair of ids. Tasks add up before the shuffle."""
    kind = _codes(tokenizers)

    def count(batches):
        codes, counts, held, waiting = np.zeros(0, kind), np.zeros(0, np.int64), [], 0

        def merge():
            nonlocal codes, counts, held, waiting
            new, times = np.unique(np.concatenate([np.frombuffer(x, kind) for x in held] or [codes[:0]]), return_counts=True)
            both = np.concatenate([codes, new])
            codes, place = np.unique(both, return_inverse=True)
            total = np.zeros(len(codes), np.int64)
            np.add.at(total, place, np.concatenate([counts, times]))
            counts, held, waiting = total, [], 0

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(counts)], names=["code", "n"])

        for batch in batches:
            for links in batch.column(0).to_pylist():
                held.append(links)
                waiting += len(links) // kind().itemsize
                if waiting >= MERGED:
                    merge()
                    if len(codes) >= MERGED:
                        yield rows()
                        codes, counts = codes[:0], counts[:0]
        merge()
        yield rows()

    parts = aligned.select("links").mapInArrow(count, "code long, n long")
    return parts.groupBy("code").agg(F.sum("n").alias("n"))


def _with_best(counts: DataFrame, second: int) -> DataFrame:
    """``code, n, best``: whether no other pair with the same id of B has a larger count."""
    own = counts.withColumn("b", F.col("code") % second)
    most = own.groupBy("b").agg(F.max("n").alias("most"))
    return own.join(most, "b").select("code", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def _sorted_pairs(pairs: DataFrame, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``_with_best``, of a bounded number, as arrays in order of their codes."""
    table = pairs.toArrow()
    codes = table["code"].to_numpy().astype(kind)
    order = np.argsort(codes)
    return codes[order], table["n"].to_numpy()[order], table["best"].to_numpy()[order]


def link_counts(aligned: DataFrame, tokenizers: Tokenizers, most_pairs: int = PAIRS_TO_BROADCAST) -> DataFrame:
    """``aligned`` with ``n_links, n_best, count_sum`` in place of ``links``; ``aligned`` has to be stored.

    A pair's count is how many links of all documents hold it; ``count_sum`` adds up the counts of a document's
    links, ``n_best`` tells how many of them hold a pair whose count is the highest of its id of B, ties included.

    Up to ``most_pairs`` distinct pairs are broadcast. Beyond, the links of each document are counted per pair and
    joined with the counts in Spark; pairs with more than a thousandth of all links, of which there are fewer than a
    thousand, are added up in place, so that no pair's group is large. Both ways give the same rows.
    """
    kind = _codes(tokenizers)
    counts = stored(pair_counts(aligned, tokenizers))
    pairs = _with_best(counts, second_size(tokenizers))
    size = counts.agg(F.count("*").alias("pairs"), F.sum("n").alias("links")).first()
    everything = size["pairs"] <= most_pairs
    near = pairs if everything else pairs.where(F.col("n") * HOT > size["links"])
    shared = aligned.sparkSession.sparkContext.broadcast(_sorted_pairs(near, kind))

    def looked_up(links: bytes):
        """Places in the broadcast arrays of the links found there, and the codes of the others."""
        own, codes = np.frombuffer(links, kind), shared.value[0]
        place = np.minimum(np.searchsorted(codes, own), max(0, len(codes) - 1))
        hit = codes[place] == own if len(codes) else np.zeros(len(own), bool)
        return place[hit], own[~hit]

    kept = [c for c in aligned.columns if c != "links"]
    at = aligned.columns.index("links")
    if everything:

        def add(batches):
            _, n, best = shared.value
            for batch in batches:
                sizes, tops, sums = [], [], []
                for links in batch.column(at).to_pylist():
                    place, _ = looked_up(links)
                    sizes.append(len(place)), tops.append(int(best[place].sum())), sums.append(int(n[place].sum()))
                columns = [c for k, c in enumerate(batch.columns) if k != at] + [pa.array(x, pa.int64()) for x in (sizes, tops, sums)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_links", "n_best", "count_sum"])

        added = ", n_links long, n_best long, count_sum long"
        return aligned.mapInArrow(add, ", ".join(f"`{c}` {t}" for c, t in aligned.dtypes if c != "links") + added)

    numbered = stored(aligned.withColumn("row", F.monotonically_increasing_id()))

    def spread(batches):
        """A row with what the broadcast pairs give for each document, and one for each other pair it holds."""
        _, n, best = shared.value
        for batch in batches:
            for row, links in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place, rest = looked_up(links)
                codes, times = np.unique(rest, return_counts=True)
                columns = [
                    np.full(len(codes) + 1, row), np.concatenate([[-1], codes.astype(np.int64)]), np.concatenate([[len(place)], times]),
                    np.concatenate([[best[place].sum()], 0 * times]), np.concatenate([[n[place].sum()], 0 * times]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["row", "code", "times", "tops", "total"])

    found = numbered.select("row", "links").mapInArrow(spread, "row long, code long, times long, tops long, total long")
    near, far = found.where("code < 0"), found.where("code >= 0").select("row", "code", "times")
    far = far.join(pairs, "code").select("row", "code", "times", (F.col("times") * F.col("best")).alias("tops"), (F.col("times") * F.col("n")).alias("total"))
    sums = near.unionByName(far).groupBy("row").agg(
        F.sum("times").alias("n_links"), F.sum("tops").alias("n_best"), F.sum("total").alias("count_sum")
    )
    return numbered.join(sums, "row").select(*kept, "n_links", "n_best", "count_sum")
