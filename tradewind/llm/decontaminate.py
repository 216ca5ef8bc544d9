"""Benchmark decontamination by greedy string tiling, which also finds passages in another order."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.words import mixed, runs, word_hashes

SEED = 5  # words that a document and an item must share in a row to be compared
LEAST_TILE = 3  # words of the shortest tile
FIRST_LENGTH = 20  # words of the first search
COVERAGE = 0.5  # share of an item's words in tiles from which on a document is contaminated
CHUNK_ROWS, CHUNK_BYTES = 20_000, 32 << 20  # benchmark items, and bytes of them, that one pass over the documents looks for
FILTER_BITS = 22
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``size`` words, from the running sum of weighted words."""
    n = len(words)
    if n < size:
        return np.zeros(0, np.uint64)
    up = np.concatenate(([np.uint64(1)], np.full(n - 1, _BASE))).cumprod(dtype=np.uint64)
    down = np.concatenate(([np.uint64(1)], np.full(n - size, _INVERSE))).cumprod(dtype=np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(words * up, dtype=np.uint64)))
    return mixed((sums[size:] - sums[:-size]) * down)


def _free_runs(free: np.ndarray) -> np.ndarray:
    """How many free words there are in a row from each place on."""
    stops = np.append(np.flatnonzero(~free), len(free))
    return stops[np.searchsorted(stops, np.arange(len(free)))] - np.arange(len(free))


class _Runs:
    """Hashes of any runs of words, from running sums: two runs are compared without looking at their words."""

    def __init__(self, words: np.ndarray):
        up = np.concatenate(([np.uint64(1)], np.full(max(0, len(words) - 1), _BASE))).cumprod(dtype=np.uint64)[: len(words)]
        self.down = np.concatenate(([np.uint64(1)], np.full(len(words), _INVERSE))).cumprod(dtype=np.uint64)
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(words * up, dtype=np.uint64)))

    def __call__(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return (self.sums[starts + sizes] - self.sums[starts]) * self.down[starts]


def _matches(doc: np.ndarray, item: np.ndarray, doc_free: np.ndarray, item_free: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """``(length, doc place, item place)`` of the longest match from each pair of places with equal windows of ``size`` free words.

    A match that could begin one word earlier is left out. Pairs of places are therefore made only where the
    words before them differ (or are not free): of a run of one repeated word these are its ends, not its square.
    The length of each is found by halving steps on the hashes of runs, for all pairs at once.
    """
    doc_hash, item_hash = _window_hashes(doc, size), _window_hashes(item, size)
    if not len(doc_hash) or not len(item_hash):
        return []
    doc_runs, item_runs = _free_runs(doc_free), _free_runs(item_free)
    places = np.flatnonzero(item_runs[: len(item_hash)] >= size)
    wanted = np.flatnonzero((doc_runs[: len(doc_hash)] >= size) & np.isin(doc_hash, item_hash[places]))
    if not len(places) or not len(wanted):
        return []

    def before(words, free, at):
        """The word before each place, and whether there is a free one."""
        return words[at - 1], (at > 0) & free[at - 1]

    word, known = before(item, item_free, places)
    order = np.lexsort((word, known, item_hash[places]))
    places, word, known = places[order], word[order], known[order]
    hashes = item_hash[places]
    low, high = np.searchsorted(hashes, doc_hash[wanted], "left"), np.searchsorted(hashes, doc_hash[wanted], "right")
    # Places of the item with the same window and the same free word before it lie behind one another.
    name = mixed(hashes * _BASE + word)
    names, first = np.unique(name[known], return_index=True)
    first = np.flatnonzero(known)[first]
    behind = np.append(np.flatnonzero((name[1:] != name[:-1]) | (known[1:] != known[:-1])) + 1, len(name))
    last = behind[np.searchsorted(behind, first, "right")]
    own, own_known = before(doc, doc_free, wanted)
    if len(names):
        at = np.minimum(np.searchsorted(names, mixed(doc_hash[wanted] * _BASE + own)), len(names) - 1)
        same = own_known & (names[at] == mixed(doc_hash[wanted] * _BASE + own))
        skip_from, skip_to = np.where(same, first[at], low), np.where(same, last[at], low)
    else:
        skip_from = skip_to = low
    counts = np.stack([skip_from - low, high - skip_to], axis=1)
    total = int(counts.sum())
    if not total:
        return []
    starts, flat = np.stack([low, skip_to], axis=1).ravel(), counts.ravel()
    t = places[np.repeat(starts - (np.cumsum(flat) - flat), flat) + np.arange(total)]
    d = np.repeat(wanted, counts.sum(axis=1))

    most = np.minimum(doc_runs[d], item_runs[t])
    doc_hashes, item_hashes, length = _Runs(doc), _Runs(item), np.zeros(total, np.int64)
    step = 1 << int(most.max()).bit_length()
    while step:
        fits = length + step <= most
        tried = np.flatnonzero(fits)
        longer = length[tried] + step
        equal = doc_hashes(d[tried], longer) == item_hashes(t[tried], longer)
        length[tried[equal]] = longer[equal]
        step >>= 1
    kept = length >= size
    return list(zip(length[kept].tolist(), d[kept].tolist(), t[kept].tolist()))


def tiles(doc: np.ndarray, item: np.ndarray, least: int = LEAST_TILE, first: int = FIRST_LENGTH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences: ``(doc place, item place, words)`` of each tile.

    The longest common run of unmarked words is marked first, ties in order of place; every word is in one
    tile at most, and no tile is shorter than ``least``. As in running Karp-Rabin matching, windows of one
    length are looked up by hash; the length is halved down to ``least``, or raised first if a match is
    more than twice as long.
    """
    if not len(doc) or not len(item):
        return []
    least = min(least, len(item))
    # Only words near a shared window of the least length can be in a tile.
    shared = np.isin(_window_hashes(doc, least), _window_hashes(item, least))
    near = np.zeros(len(doc) + 1, np.int64)
    starts = np.flatnonzero(shared)
    np.add.at(near, starts, 1)
    np.add.at(near, np.minimum(starts + least, len(doc)), -1)
    kept = np.flatnonzero(np.cumsum(near[:-1]) > 0)
    if not len(kept):
        return []
    breaks = np.flatnonzero(np.diff(kept) > 1) + 1
    doc_words = np.insert(doc[kept], breaks, np.uint64(0))  # a gap matches nothing: it is never free
    where = np.insert(kept, breaks, -1)
    doc_free, item_free = where >= 0, np.ones(len(item), bool)
    size, out = max(first, least), []
    while True:
        found = _matches(doc_words, item, doc_free, item_free, size)
        longest = max((f[0] for f in found), default=0)
        if longest > 2 * size:
            size = longest
            continue
        heap = sorted(found, key=lambda f: (-f[0], f[1], f[2]))
        while heap:
            again = []
            for n, d, t in heap:
                free = doc_free[d : d + n] & item_free[t : t + n]
                if free.all():
                    out.append((int(where[d]), t, n))
                    doc_free[d : d + n] = False
                    item_free[t : t + n] = False
                elif free.any():  # what an earlier tile has left of it, longest part later
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).view(np.int8)))
                    again += [(int(e - s), d + int(s), t + int(s)) for s, e in zip(edges[::2], edges[1::2]) if e - s >= size]
            heap = sorted(again, key=lambda f: (-f[0], f[1], f[2]))
        if size == least:
            return sorted(out)
        size = size // 2 if size > 2 * least else least


@dataclass(frozen=True)
class Items:
    """A bounded part of the benchmark: its words, and which items have which seed."""

    ids: list[int | None]
    words: list[np.ndarray]
    seeds: np.ndarray  # sorted
    owners: np.ndarray
    sizes: tuple[int, ...]  # seed lengths: SEED, and the lengths of shorter items
    mask: np.ndarray  # low bits of the seeds


def make_items(ids: list[int | None], texts: list[str | None]) -> Items:
    """Items without a word are left out: nothing can contain them."""
    both = [(i, w) for i, w in zip(ids, word_hashes(pa.array(texts, pa.string()))) if len(w)]
    seeds = [np.unique(runs(w, SEED)) for _, w in both]
    flat = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
    owners = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
    order = np.argsort(flat, kind="stable")
    mask = np.zeros(1 << FILTER_BITS, bool)
    mask[flat & np.uint64((1 << FILTER_BITS) - 1)] = True
    sizes = tuple(sorted({min(SEED, len(w)) for _, w in both}))
    return Items([i for i, _ in both], [w for _, w in both], flat[order], owners[order], sizes, mask)


def compared(words: np.ndarray, items: Items, coverage: float) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """``(item, covered words, tiles)`` of each item that shares a seed with a text and is covered far enough."""
    candidates: set[int] = set()
    for size in items.sizes:
        if len(words) < size:
            continue
        own = runs(words, size)
        own = own[items.mask[own & np.uint64((1 << FILTER_BITS) - 1)]]
        if len(own):
            own = np.unique(own)
            low, high = np.searchsorted(items.seeds, own, "left"), np.searchsorted(items.seeds, own, "right")
            for a, b in zip(low[high > low].tolist(), high[high > low].tolist()):
                candidates.update(items.owners[a:b].tolist())
    for k in sorted(candidates):
        found = tiles(words, items.words[k])
        covered = sum(n for _, _, n in found)
        if covered >= coverage * len(items.words[k]):
            yield k, covered, found


def _chunks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in parts of a bounded number and size of items, each of which is broadcast."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    items, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-items // CHUNK_ROWS), -(-size // CHUNK_BYTES))
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).distinct().collect()
        own.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        yield make_items([r["item_id"] for r in own], [r["text"] for r in own])


TILES = pa.list_(pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32())]))


def contaminations(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, item_id, item_words, matched_words, coverage, tiles`` of each contaminated document and item.

    Words are runs of anything but white space, with A-Z lower-cased; whole texts are compared. A document and
    an item that share a seed of five words (an item of fewer: all of them) are tiled; a tile has at least
    three words. The document is contaminated if tiles cover ``coverage`` of the item's words, in
    whatever order and place they are.

    The documents are scanned once for every 20,000 items or 32 MB of them, which are broadcast; nothing is shuffled, and
    a seed that many documents share makes no pairs but those that are reported. NULL and empty texts on either
    side match nothing. Rows without an id are reported without one; repeated rows are reported each.
    """
    kind = (
        "doc_id long, item_id long, item_words long, matched_words long, coverage double, "
        "tiles array<struct<doc_word:int,item_word:int,words:int>>"
    )
    names = ["doc_id", "item_id", "item_words", "matched_words", "coverage", "tiles"]
    rows, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for items in _chunks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def scan(batches, shared=shared):
            items = shared.value
            for batch in batches:
                found = ([], [], [], [], [], [])
                for doc_id, words in zip(batch.column(0).to_pylist(), word_hashes(batch.column(1))):
                    for k, covered, spans in compared(words, items, coverage):
                        size = len(items.words[k])
                        spans = [dict(zip(("doc_word", "item_word", "words"), s)) for s in spans]
                        for column, value in zip(found, (doc_id, items.ids[k], size, covered, covered / size, spans)):
                            column.append(value)
                kinds = [*[pa.int64()] * 4, pa.float64(), TILES]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, kinds)], names=names)

        part = rows.mapInArrow(scan, kind)
        out = part if out is None else out.unionByName(part)
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are contaminated by no item."""
    at = docs.columns.index("text")
    for items in _chunks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches, shared=shared):
            for batch in batches:
                found = [next(compared(words, shared.value, coverage), None) is None for words in word_hashes(batch.column(at))]
                yield batch.filter(pa.array(found, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
