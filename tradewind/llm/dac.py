"""Token ids in directly addressable codes: any token can be read without decoding its neighbours.

A file is a sequence of segments, each of whole documents. In a segment an id is split into chunks of
8 bits, the lowest first. Level 0 has the lowest chunk of every id and a bit that tells whether the id
goes on; level 1 has the next chunk of those that do, and so on. A directory of ones before every
512th bit makes the place in the next level a lookup and one popcount.

Segment: ``magic, levels, tokens`` (little-endian 32, 32, 64 bits), then per level its length (64 bits),
its chunks, its bits (least first, padded to 512) and its directory (64 bits each).
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tradewind.llm.files import create, new_folder, open_file
from tradewind.llm.tokens import encoder, uncollected
from tradewind.session import stored

MAGIC = 0x31434144
SPAN = 512  # bits between two entries of the directory
SEGMENT = 2_000_000  # tokens after which a segment ends


def pack(ids: np.ndarray) -> bytes:
    """The segment of some ids (unsigned 32 bits)."""
    out, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (SPAN // 8), np.uint8)])
        ones = np.bitwise_count(bits.reshape(-1, SPAN // 8)).sum(axis=1, dtype=np.uint64)
        before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ones, dtype=np.uint64)])
        out += [np.uint64(len(rest)).tobytes(), rest.astype(np.uint8).tobytes(), bits.tobytes(), before.tobytes()]
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    head = np.array([MAGIC, len(out) // 4], np.uint32).tobytes() + np.uint64(len(ids)).tobytes()
    return head + b"".join(out)


class Segment:
    """A packed segment; ``seg[i]`` and ``seg.slice(start, stop)`` read only what they need."""

    def __init__(self, data: bytes):
        magic, levels = np.frombuffer(data, np.uint32, 2)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.tokens, at, self.levels = int(np.frombuffer(data, np.uint64, 1, 8)[0]), 16, []
        for _ in range(levels):
            n = int(np.frombuffer(data, np.uint64, 1, at)[0])
            spans = -(-(-(-n // 8)) // (SPAN // 8))
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bits = np.frombuffer(data, np.uint8, spans * SPAN // 8, at + 8 + n)
            before = np.frombuffer(data, np.uint64, spans + 1, at + 8 + n + len(bits))
            at += 8 + n + len(bits) + before.nbytes
            self.levels.append((chunks, bits, before))

    @staticmethod
    def _rank(level, i: int) -> int:
        """Ids of this level before place ``i`` that go on."""
        _, bits, before = level
        first = i // SPAN * (SPAN // 8)
        whole = np.bitwise_count(bits[first : i // 8]).sum(dtype=np.int64)
        part = int(bits[i // 8]) & ((1 << i % 8) - 1) if i % 8 else 0
        return int(before[i // SPAN]) + int(whole) + part.bit_count()

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = 0
        for depth, level in enumerate(self.levels):
            value |= int(level[0][i]) << 8 * depth
            if not (int(level[1][i // 8]) >> i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        out, places = np.zeros(stop - start, np.uint32), None
        for depth, level in enumerate(self.levels):
            if start == stop:
                break
            part = level[0][start:stop].astype(np.uint32) << np.uint32(8 * depth)
            more = np.unpackbits(level[1][start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start].view(bool)
            if places is None:
                out, places = part, np.flatnonzero(more)
            else:
                out[places] |= part
                places = places[more]
            start, stop = self._rank(level, start), self._rank(level, start) + int(np.count_nonzero(more))
        return out


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, leading_space: bool = True) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and write it in ascending ``doc_id`` order; the index of what was written.

    ``part, file, at, size, doc_id, first, n_tokens``: the documents of file ``part`` follow those of the
    files before it, a segment is the ``size`` bytes from ``at``, and a document's ids are ``n_tokens``
    from place ``first`` of its segment. Rows without an id come first; rows with the same id are
    ordered by their text. A NULL or empty text is the end id alone. An empty table writes no file.

    Texts are dealt by ranges of ids, and then each task encodes and writes its range segment by segment. Rows with
    the same id and text, which may be a large share of the table, are dealt by a number that the scan gives them.
    """
    folder = new_folder(docs.sparkSession, "tokens")

    @uncollected
    def write(batches):
        texts, out, uri, at = encoder(tokenizer, leading_space), None, None, 0
        end, part = np.uint32(end_id).tobytes(), TaskContext.get().partitionId()
        ids, held, waiting = [], [], 0

        def segment():
            nonlocal at, ids, held, waiting
            data = pack(np.frombuffer(b"".join(held), np.uint32))
            out.write(data)
            sizes = np.array([len(x) // 4 for x in held])
            n = len(ids)
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part), pa.int64()), pa.array([uri] * n), pa.array(np.full(n, at), pa.int64()),
                    pa.array(np.full(n, len(data)), pa.int64()), pa.array(ids, pa.int64()),
                    pa.array(np.cumsum(sizes) - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                ],
                names=["part", "file", "at", "size", "doc_id", "first", "n_tokens"],
            )
            at, ids, held, waiting = at + len(data), [], [], 0
            return row

        for batch in batches:
            if out is None and len(batch):
                out, uri = create(folder, ".dac")
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                held.append(texts.encode(text) + end)
                waiting += len(held[-1]) // 4
                if waiting >= SEGMENT:
                    yield segment()
        if held:
            yield segment()
        if out is not None:
            out.close()

    # Adaptive execution may give a table of little text to one task, but leaves a number that is asked for.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("by_text"))
        .withColumn("again", F.monotonically_increasing_id())
        .repartitionByRange(parts, "doc_id", "by_text", "again")
        .sortWithinPartitions("doc_id", "by_text", "text")
        .select("doc_id", "text")
    )
    index = "part long, file string, at long, size long, doc_id long, first long, n_tokens long"
    return stored(ordered.mapInArrow(write, index))


def with_starts(index: DataFrame) -> DataFrame:
    """``index`` with ``start``: how many ids all documents before it have. One row per segment is added up."""
    segments = index.groupBy("part", "at").agg(F.sum("n_tokens").alias("n"))
    files = segments.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("files_before"))
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.select("part", "at", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("segments_before"))
    starts = segments.join(files, "part")
    start = F.col("files_before") + F.col("segments_before") + F.col("first")
    return index.join(starts, ["part", "at"]).withColumn("start", start).drop("files_before", "segments_before")


def read_tokens(index: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of each row of ``with_starts(index)``; ``ids`` as little-endian 32-bit bytes.

    Each segment is read once, by one task; of it only the asked documents are decoded.
    """

    def read(batches):
        key, file, segment = None, None, None
        for batch in batches:
            out = []
            for uri, at, size, first, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if key is None or key[0] != uri:
                    file = open_file(uri)
                if key != (uri, at):
                    file.seek(at)
                    key, segment = (uri, at), Segment(file.read(size))
                out.append(segment.slice(first, first + n).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(5), batch.column(6), pa.array(out, pa.binary())], names=["doc_id", "start", "ids"])

    rows = index.select("file", "at", "size", "first", "n_tokens", "doc_id", "start")
    rows = rows.repartition("file", "at").sortWithinPartitions("file", "at", "first")
    return rows.mapInArrow(read, "doc_id long, start long, ids binary")


def checksums(read: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what was read."""

    return read.select(
        "doc_id", "start", F.expr("cast(octet_length(ids) / 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
