"""Best-fit packing of token pieces into sequences, improved by swaps that empty bins."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField

from tradewind.llm.columns import unused
from tradewind.llm.tokens import encoder, uncollected
from tradewind.session import stored

CAPACITY = 4096
GROUP = 4096  # pieces packed by one call
SOURCES = 32  # bins that the search tries to empty in turn before it stops
LOOSE = 0.97  # bins filled less than this are opened again in the next round
ROUND, BIN = 1 << 50, 1 << 20  # sequence ids: round, group, bin


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each document's ids and its end id.

    Only documents longer than ``capacity`` are cut, into full pieces and a last one. NULL and empty
    texts are the end id alone.
    """

    @uncollected
    def cut(batches):
        texts, end = encoder(tokenizer, leading_space=False), np.uint32(end_id).tobytes()
        for batch in batches:
            out = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = texts.encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    kind = "doc_id long, piece long, start long, length long, ids_crc32 long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, kind)
    return rows.withColumn("piece", F.col("piece").cast("int"))


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Places of the lengths in bins: longest first, each into the fullest bin that has room."""
    room: list[tuple[int, int]] = []  # (free, bin), ascending
    bins: list[list[int]] = []
    for place in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[place])
        at = bisect_left(room, (need, -1))
        if at < len(room):
            free, number = room.pop(at)
            bins[number].append(place)
        else:
            free, number = capacity, len(bins)
            bins.append([place])
        if free > need:
            insort(room, (free - need, number))
    return bins


def _exchange(source: list[int], targets: list[list[int]], size, capacity: int) -> bool:
    """One exchange that takes most out of ``source`` while the squared fill grows: a move, one for one, two for one."""
    filled = sum(map(size, source))
    best = None  # (tokens gained by the target, target, out of source, out of target)
    for t, target in enumerate(targets):
        fill = sum(map(size, target))
        free = capacity - fill
        if free == 0 or (best and best[0] >= free):
            continue
        back = sorted(target, key=size)
        sizes = [size(b) for b in back]
        for i, a in enumerate(source):
            for partner in (None, *source[i + 1 :]):
                out = size(a) + (size(partner) if partner is not None else 0)
                given = (a,) if partner is None else (a, partner)
                options = [((), out)] if partner is None and out <= free else []
                at = bisect_left(sizes, out - free)  # the least that has to come back
                if at < len(sizes) and sizes[at] < out:
                    options.append(((back[at],), out - sizes[at]))
                for returned, gain in options:
                    # (fill + gain)^2 + (filled - gain)^2 > fill^2 + filled^2
                    if fill + gain > filled and (best is None or gain > best[0]):
                        best = (gain, t, given, returned)
    if best is None:
        return False
    _, t, given, returned = best
    source[:] = [x for x in source if x not in given] + list(returned)
    targets[t] = [x for x in targets[t] if x not in returned] + list(given)
    return True


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Empty underfull bins by moves and swaps as long as the tokens would fit into fewer bins.

    The least filled bin is the source; each exchange fills another underfull bin further and raises the
    squared fill, so it ends. If a source cannot be emptied, the next one is tried, up to ``SOURCES``;
    once a bin is empty all may be tried again.
    """
    size = lambda place: int(lengths[place])
    total = int(lengths.sum())
    full = [b for b in bins if sum(map(size, b)) == capacity]
    under = sorted((b for b in bins if sum(map(size, b)) < capacity), key=lambda b: sum(map(size, b)))
    tried = 0
    while len(full) + len(under) > -(-total // capacity) and tried < min(SOURCES, len(under)):
        source, others = under[tried], under[:tried] + under[tried + 1 :]
        slack = sum(capacity - sum(map(size, b)) for b in others)
        if slack < sum(map(size, source)):
            break  # no fuller bin can be emptied either
        before, kept = [list(b) for b in others], list(source)
        while source and _exchange(source, others, size, capacity):
            pass
        if source:
            under, tried = sorted([*before, kept], key=lambda b: sum(map(size, b))), tried + 1
        else:
            full += [b for b in others if sum(map(size, b)) == capacity]
            under = sorted((b for b in others if sum(map(size, b)) < capacity), key=lambda b: sum(map(size, b)))
            tried = 0
    return full + under


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (with ``length``) with ``sequence_id, offset`` added: every piece in one sequence, without gaps.

    Full pieces are sequences of their own. The others are stored with a number each and dealt by a hash of it into
    groups of some thousand, equal rows like any others; each group is packed best fit, longest first, and improved by swaps. Bins that are
    left loose are opened again and packed together in fewer groups, until there is one group or the
    loose pieces get no fewer. No task sees more than its group, whatever the size of the table.
    Repeated rows are packed as often as they come. An empty table gives no row.
    """
    number = unused(parts.columns, "_number")
    added = parts.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    columns = added.schema.fields
    numbers_field = StructField(number, LongType())

    def solve(table: pa.Table) -> pa.Table:
        first = table["_base"][0].as_py()
        lengths = table["length"].to_numpy()
        table = table.drop_columns(["_group", "_base"])
        # The same rows in any order are packed alike.
        order = np.lexsort([*(table[c].to_numpy(zero_copy_only=False) for c in ("_tie",)), -lengths])
        table, lengths = table.drop_columns(["_tie"]).take(pa.array(order)), lengths[order]
        numbers, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        fill = np.zeros(len(lengths), np.int64)
        for k, places in enumerate(local_search(best_fit(lengths, capacity), lengths, capacity)):
            sizes = lengths[places]
            numbers[places], offsets[places], fill[places] = first + k, np.cumsum(sizes) - sizes, sizes.sum()
        names = table.column_names
        columns = [*table.columns, pa.array(numbers), pa.array(offsets), pa.array(fill)]
        return pa.Table.from_arrays(columns, names=[*names, "sequence_id", "offset", "_fill"])

    whole = parts.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    done = [stored(whole.withColumn("offset", F.lit(0).cast("long")))]
    numbered = parts.where(F.col("length") < capacity).withColumn(number, F.monotonically_increasing_id())
    waiting, turn, before = stored(numbered), 0, None
    while True:
        rows = waiting.count()
        if rows == 0:
            break
        groups = -(-rows // GROUP)
        tie = F.xxhash64(F.lit(turn), number)
        dealt = waiting.withColumn("_tie", tie).withColumn("_group", F.pmod("_tie", F.lit(groups)))
        dealt = dealt.withColumn("_base", F.lit((turn + 1) * ROUND) + F.col("_group") * BIN)
        fields = [*(f for f in columns if f.name not in ("sequence_id", "offset")), numbers_field, *columns[-2:]]
        kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", _fill long"
        packed = stored(dealt.groupBy("_group").applyInArrow(solve, kind))
        last = groups == 1 or (before is not None and rows > 0.9 * before)
        loose = F.col("_fill") < LOOSE * capacity
        done.append((packed if last else packed.where(~loose)).drop("_fill", number))
        if last:
            break
        waiting, turn, before = packed.where(loose).select(*parts.columns, number), turn + 1, rows
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, ids as little-endian 32-bit bytes.

    ``packed`` has to come from ``pieces`` of the same documents with one row per ``doc_id``. Each sequence
    gathers at most one capacity of ids.
    """

    def cut(batches):
        texts, end = encoder(tokenizer, leading_space=False), np.uint32(end_id).tobytes()
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))
            out = [(texts.encode(t) + end)[4 * s : 4 * (s + n)] for t, s, n in rows]
            columns = [batch.column(4), batch.column(5), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["sequence_id", "offset", "ids"])

    placed = docs.select("doc_id", "text").join(packed, "doc_id")
    placed = placed.select("doc_id", "text", "start", "length", "sequence_id", "offset")
    parts = placed.mapInArrow(cut, "sequence_id long, offset long, ids binary")
    in_order = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(in_order, F.lit(b""), lambda whole, x: F.concat(whole, x["ids"]))
    return parts.groupBy("sequence_id").agg(joined.alias("ids"))


def packing_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequences, tokens, least, fill``: how many sequences, and the fewest that could hold the tokens."""
    per = packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"))
    return per.agg(
        F.count("*").alias("sequences"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        F.ceil(F.coalesce(F.sum("tokens"), F.lit(0)) / capacity).alias("least"),
        F.avg(F.col("tokens") / capacity).alias("fill"),
    )
