"""Packing by Karmarkar-Karp differencing: near-equal windows of token pieces, cut only where windows would overflow."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.tokens import encoder, uncollected
from tradewind.session import stored

CAPACITY = 4096
GROUP = 2048  # pieces partitioned at once
GROUP_TOKENS = 2 << 20  # and their tokens
PADDING = 0.005  # the count of windows may rise up to this share over the tokens before pieces are cut
BATCH = 10_000  # rows handed on at once


def difference(lengths: np.ndarray, windows: int) -> list[list[int]]:
    """Places of ``lengths`` in so many windows with near-equal sums, by multiway differencing.

    Every length starts as a partition of its own: one window has it, the others are empty. Again and again the
    two partitions with the largest imbalance (largest less smallest sum) are merged, the largest window of one
    with the smallest of the other, so that their imbalances cancel. Only windows that hold something
    are stored. Ties go to the partition that was made first.
    """
    made = count()
    left, right = [], []  # a node beyond the places joins two others

    def entry(sums: np.ndarray, nodes: np.ndarray):
        low = int(sums[0]) if len(sums) == windows else 0
        return low - int(sums[-1]), next(made), sums, nodes

    heap = [entry(lengths[k : k + 1], np.array([k])) for k in range(len(lengths))]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, others, others_nodes = heap[0]
        shared = max(0, len(sums) + len(others) - windows)
        joined = np.arange(len(lengths) + len(left), len(lengths) + len(left) + shared)
        left.extend(nodes[:shared].tolist())
        right.extend(others_nodes[:shared][::-1].tolist())
        sums = np.concatenate([sums[:shared] + others[:shared][::-1], sums[shared:], others[shared:]])
        nodes = np.concatenate([joined, nodes[shared:], others_nodes[shared:]])
        order = np.argsort(sums, kind="stable")
        heapq.heapreplace(heap, entry(sums[order], nodes[order]))

    out: list[list[int]] = [[] for _ in range(windows)]
    for window, node in zip(out, heap[0][3].tolist() if heap else []):
        waiting = [node]
        while waiting:
            node = waiting.pop()
            if node < len(lengths):
                window.append(node)
            else:
                waiting += [left[node - len(lengths)], right[node - len(lengths)]]
    return out


Part = tuple[int, int, int]  # place, tokens of it before the part, tokens of the part


def levelled(windows: list[list[Part]], capacity: int) -> list[list[Part]]:
    """Cut off what sticks out of each window and fill it into those with room, most room and longest part first."""
    spare: list[Part] = []
    for window in windows:
        over = sum(n for _, _, n in window) - capacity
        while over > 0:
            place, at, n = longest = max(window, key=lambda part: (part[2], -part[0]))
            window.remove(longest)
            if n > over:
                window.append((place, at, n - over))
                spare.append((place, at + n - over, over))
            else:
                spare.append(longest)
            over -= n
    room = [(sum(n for _, _, n in window) - capacity, k) for k, window in enumerate(windows)]
    heapq.heapify(room)
    for place, at, n in sorted(spare, key=lambda part: (-part[2], part)):
        while n:
            free, k = heapq.heappop(room)
            taken = min(n, -free)
            windows[k].append((place, at, taken))
            place, at, n = place, at + taken, n - taken
            if free + taken < 0:
                heapq.heappush(room, (free + taken, k))
    return windows


def near_equal_windows(lengths: np.ndarray, capacity: int, padding: float | None = PADDING) -> list[list[Part]]:
    """Windows of at most ``capacity`` tokens that hold all lengths, none of which is longer than that.

    The lengths are differenced into the fewest windows that could hold them. Whenever a window exceeds the
    capacity, the count of windows rises and all are differenced anew, if ``padding`` (room over tokens) leaves
    enough windows to bring the largest one down to the capacity. Otherwise the windows of the fewest are
    levelled by cuts. ``None``: the count rises as far as it takes, and nothing is cut.
    """
    if not len(lengths):
        return []
    total = int(lengths.sum())
    least = windows = -(-total // capacity)
    most = len(lengths) if padding is None else max(least, int(total * (1 + padding) / capacity))
    first = None
    while True:
        found = difference(lengths, windows)
        sums = np.array([lengths[w].sum() for w in found])
        over = int(np.maximum(sums - capacity, 0).sum())
        whole = [[(place, 0, int(lengths[place])) for place in window] for window in found]
        first = first or whole
        if over == 0:
            return [window for window in whole if window]
        if padding is not None and (windows >= most or sums.max() * windows > capacity * most):
            return levelled(first, capacity)
        windows = min(most, windows + max(1, over // capacity))


KIND = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, waiting long, ids binary"
NAMES = [column.split(" ")[0] for column in KIND.split(", ")]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * (len(NAMES) - 1) + [pa.binary()]
    columns = list(zip(*rows)) or [()] * len(NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=NAMES)


Item = tuple[int | None, int, int, bytes]  # document, its tokens, those before the piece, the piece's ids


def _packed(items: list[Item], capacity: int, padding: float | None, numbers: Iterator[int], keep_ids: bool) -> list[tuple]:
    """Rows of ``KIND`` for pieces whose ids are at hand."""
    rows = []
    for window in near_equal_windows(np.array([len(i[3]) // 4 for i in items], np.int64), capacity, padding):
        number, offset = next(numbers), 0
        for place, at, n in sorted(window):
            doc_id, tokens, start, ids = items[place]
            own = ids[4 * at : 4 * (at + n)]
            rows.append((doc_id, start + at, n, zlib.crc32(own), tokens, number, offset, None, own if keep_ids else None))
            offset += n
    return rows


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    padding: float | None = PADDING,
    leading_space: bool = False,
    keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of each piece of ``docs(doc_id, text)``.

    A document is the ids of its whole text and the end id (NULL and empty texts: the end id alone). Of a
    document longer than ``capacity`` every full window is a sequence of its own. What is left of all documents is
    differenced into near-equal windows, some thousand pieces at a time; few pieces are cut (see
    ``near_equal_windows``). Every id lies in exactly one piece, and a sequence has no gap.

    Each task encodes its rows and packs them group by group with the ids at hand, so texts are not shuffled. Only
    its last, unfilled group is dealt by number with those of other tasks into groups of the same size. No
    group depends on a key: repeated rows are packed as often as they come, rows without an id keep none. An
    empty table gives no row. ``keep_ids`` adds each piece's ``ids`` as little-endian 32-bit bytes.
    """

    @uncollected
    def first_pass(batches):
        texts, end = encoder(tokenizer, leading_space), np.uint32(end_id).tobytes()
        base = TaskContext.get().partitionId() << 32
        numbers, items, tokens, rows = count(base), [], 0, []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = texts.encode(text) + end
                size = len(ids) // 4
                whole = size // capacity * capacity
                for at in range(0, whole, capacity):
                    own = ids[4 * at : 4 * (at + capacity)]
                    rows.append((doc_id, at, capacity, zlib.crc32(own), size, next(numbers), 0, None, own if keep_ids else None))
                if size > whole:
                    items.append((doc_id, size, whole, ids[4 * whole :]))
                    tokens += size - whole
                if len(items) >= GROUP or tokens >= GROUP_TOKENS:
                    rows += _packed(items, capacity, padding, numbers, keep_ids)
                    items, tokens = [], 0
                if len(rows) >= BATCH:
                    yield _table(rows)
                    rows = []
        rows += [(d, start, len(ids) // 4, None, size, None, None, base + k, ids) for k, (d, size, start, ids) in enumerate(items)]
        for at in range(0, len(rows), BATCH):
            yield _table(rows[at : at + BATCH])

    placed = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(first_pass, KIND))
    kept = [n for n in NAMES if n != "waiting" and (keep_ids or n != "ids")]
    waiting = placed.where("waiting IS NOT NULL")
    groups = max(1, -(-waiting.count() // GROUP))

    def second_pass(table: pa.Table) -> pa.Table:
        table = table.sort_by("waiting")
        items = list(zip(*(table[c].to_pylist() for c in ("doc_id", "doc_tokens", "start", "ids"))))
        numbers = count((1 << 62) + (table["group"][0].as_py() << 32))
        return pa.Table.from_batches([_table(_packed(items, capacity, padding, numbers, keep_ids))])

    rest = waiting.withColumn("group", F.pmod(F.xxhash64("waiting"), F.lit(groups))).groupBy("group").applyInArrow(second_pass, KIND)
    return placed.where("waiting IS NULL").select(*kept).unionByName(rest.select(*kept))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of what ``pack`` gave with ``keep_ids``; a sequence gathers at most one capacity of ids."""
    in_order = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(in_order, F.lit(b""), lambda whole, x: F.concat(whole, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def padding_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequences, tokens, padding``: padding up to ``capacity`` of sequences whose length is no power of two."""
    per = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(
        F.count("*").alias("sequences"),
        zero("n").alias("tokens"),
        zero(F.when(power, 0).otherwise(capacity - F.col("n"))).alias("padding"),
    )
