"""Near-duplicate documents: HyperMinHash sketches, bands of registers, links confirmed on full sets."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tradewind.llm.columns import unused
from tradewind.llm.graph import components
from tradewind.llm.words import mixed, shingles, word_hashes
from tradewind.session import scratch, shared_folder, stored

REGISTERS, ROWS = 256, 6  # 42 bands of 6 registers; the last 4 registers only serve the estimate
BANDS = REGISTERS // ROWS
MANTISSA = 10  # bits kept below the leading zeros
IDS_TO_BROADCAST = 2_000_000
BLOCK = 2048  # rows compared with each other by one task
BLOCK_HASHES = 1 << 20  # and elements of their sets


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash of a set: per bucket the leading zeros and the next bits of the smallest hash, 16 bits.

    The low bits of a hash choose the bucket, the rest are its rank. Buckets that stay empty are filled
    by hashing the whole set again, as often as it takes, so a small set fills its sketch too and two
    registers agree with the probability of the sets' similarity. The round is mixed into the register:
    values of different rounds are different elements.
    """
    out = np.zeros(REGISTERS, np.uint16)
    empty, turn = np.ones(REGISTERS, bool), 0
    while len(hashes) and empty.any():
        drawn = mixed(hashes + np.uint64(turn * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
        bucket, rank = (drawn & np.uint64(REGISTERS - 1)).astype(np.int64), drawn >> np.uint64(8)
        least = np.full(REGISTERS, np.uint64(1 << 56))
        np.minimum.at(least, bucket, rank)
        fresh = empty & (least < np.uint64(1 << 56))
        value = least[fresh]
        zeros = 55 - np.floor(np.log2(np.maximum(value, 1).astype(np.float64))).astype(np.int64)
        below = np.maximum(55 - zeros - MANTISSA, 0)
        bits = (value >> below.astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
        packed = (np.minimum(zeros, 63) << MANTISSA).astype(np.uint64) | bits
        out[fresh] = (packed ^ np.uint64(turn * 0x9E37 & 0xFFFF)).astype(np.uint16)
        empty &= ~fresh
        turn += 1
    return out


#: Chance that two different elements leave equal registers: half the elements have the first count of
#: leading zeros, a quarter the next, and so on (sum of 4**-i = 1/3), times equal mantissas.
COLLISION = 1 / 3 / (1 << MANTISSA)


def estimated(equal: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal registers, less those that agree by accident."""
    return (equal / REGISTERS - COLLISION) / (1 - COLLISION)


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80  # links have 100 * intersection >= percent * union

    @property
    def least_estimate(self) -> float:
        """Five standard errors under the threshold: what the estimate drops is no link."""
        share = self.percent / 100
        return share - 5 * (share * (1 - share) / REGISTERS) ** 0.5


def _row_id() -> Column:
    """The id of a row, or a number made from its text; ``_nameless`` tells which."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("no id"), "text"))


def _nameless() -> Column:
    return F.col("doc_id").cast("long").isNull()


def _sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """``id, nameless, n, digest, registers`` of each row, from its whole text."""

    def sketch(batches):
        for batch in batches:
            sizes, digests, kept = [], [], []
            for words in word_hashes(batch.column(2)):
                found = shingles(words, shingle)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                kept.append(registers(found).tobytes())
            columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["id", "nameless", "n", "digest", "registers"])

    rows = docs.select(_row_id().alias("id"), _nameless().alias("nameless"), "text")
    return rows.mapInArrow(sketch, "id long, nameless boolean, n long, digest binary, registers binary")


def _sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """``node, hashes`` of the rows with these ids. The ids are broadcast while they are few, else joined."""

    def build(batches):
        kind = pa.list_(pa.int64())
        for batch in batches:
            found = [shingles(words, shingle).view(np.int64) for words in word_hashes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["node", "hashes"])

    few = ids.count() <= IDS_TO_BROADCAST
    rows = docs.select(_row_id().alias("node"), "text").join(F.broadcast(ids) if few else ids, "node")
    return rows.mapInArrow(build, "node long, hashes array<long>")


def _likely(pairs: DataFrame, sketches: DataFrame, settings: Settings) -> DataFrame:
    """``a, b`` of the pairs whose sizes and estimated similarity allow a link."""

    def estimate(batches):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
            keep = estimated((left == right).sum(axis=1)) >= settings.least_estimate
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])

    side = lambda name: sketches.select(
        F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}")
    )
    sized = 100 * F.least("n_a", "n_b") >= settings.percent * F.greatest("n_a", "n_b")
    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(sized)
    return joined.select("a", "b", "r_a", "r_b").mapInArrow(estimate, "a long, b long").distinct()


def _linked(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """``a, b`` of the pairs whose full sets are similar enough."""
    joined = pairs.join(sets.toDF("a", "h_a"), "a").join(sets.toDF("b", "h_b"), "b")
    both, total = F.size(F.array_intersect("h_a", "h_b")), F.size("h_a") + F.size("h_b")
    return joined.where(100 * both >= settings.percent * (total - both)).select("a", "b").distinct()


def _runs(batches, key: int):
    """Batches cut and joined so that each holds all neighbouring rows with the same value of column ``key``."""
    held = []
    for batch in batches:
        if not len(batch):
            continue
        value = batch.column(key).to_numpy()
        starts = [0, *(np.flatnonzero(value[1:] != value[:-1]) + 1).tolist(), len(value)]
        for start, end in zip(starts, starts[1:]):
            part = batch.slice(start, end - start)
            if held and held[-1].column(key)[0] != part.column(key)[0]:
                yield held
                held = []
            held.append(part)
    if held:
        yield held


@dataclass
class Cell:
    """One block of a bucket's rows, or two that are compared with each other."""

    side: np.ndarray  # 2 in a cell of one block, else 0 or 1
    node: np.ndarray
    label: np.ndarray
    n: np.ndarray
    band: int
    registers: np.ndarray

    @classmethod
    def of(cls, parts: list[pa.RecordBatch]) -> Cell:
        side, node, label, n, band = (np.concatenate([p.column(i).to_numpy() for p in parts]) for i in range(1, 6))
        kept = b"".join(x for p in parts for x in p.column(6).to_pylist())
        return cls(side, node, label, n, int(band[0]), np.frombuffer(kept, np.uint16).reshape(-1, REGISTERS))

    def asking(self) -> list[int]:
        """The rows without the label that most have: one of them is in every pair of different labels."""
        names, counts = np.unique(self.label, return_counts=True)
        return np.flatnonzero(self.label != names[counts.argmax()]).tolist()

    def likely(self, i: int, among: np.ndarray, settings: Settings, first_band: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places and estimates of the rows that may link with row ``i``, of other labels and the other block.

        With ``first_band`` only those that agree with it in no earlier band: these pairs are decided there.
        """
        other = np.flatnonzero(among & (self.label != self.label[i]) & ((self.side != self.side[i]) | (self.side == 2)))
        other = other[100 * np.minimum(self.n[other], self.n[i]) >= settings.percent * np.maximum(self.n[other], self.n[i])]
        equal = self.registers[other] == self.registers[i]
        share = estimated(equal.sum(axis=1))
        keep = share >= settings.least_estimate
        if first_band and keep.any():
            bands = equal[keep, : BANDS * ROWS].reshape(-1, BANDS, ROWS).all(axis=2)
            keep[keep] = bands.argmax(axis=1) == self.band
        return other[keep], share[keep]


CELL = "cell long, side long, node long, label long, n long, band long, registers binary"


def _dealt(members: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows of ``CELL``, each cell's behind one another: rows that share a bucket whose rows differ in label.

    Buckets whose rows (but for the leader) all have one label are done. Of the others, only pairs with a row
    without the bucket's main label are left to compare. Both kinds of rows are dealt into blocks of two thousand
    (fewer if their sets are large). A row of the main label goes to one cell for each block of the others, and
    these to one for each block of either kind: a few stray rows in a bucket leave all its rows at one copy.
    """
    named = members.where("node <> leader").join(labels, "node", "left")
    named = named.select("key", "band", "node", "n", F.coalesce("label", "node").alias("label"))
    per_label = named.groupBy("key", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("hashes"))
    blocks = lambda rows, hashes: F.greatest(
        F.lit(1), F.ceil(F.greatest(F.expr(rows) / BLOCK, F.expr(hashes) / BLOCK_HASHES))
    ).cast("int")
    sizes = (
        per_label.groupBy("key")
        .agg(F.max(F.struct("rows", "label", "hashes")).alias("top"), F.count("*").alias("labels"), F.sum("rows").alias("rows"), F.sum("hashes").alias("hashes"))
        .where("labels > 1")
        .select(
            "key",
            F.col("top.label").alias("main"),
            blocks("top.rows", "top.hashes").alias("held"),
            blocks("rows - top.rows", "hashes - top.hashes").alias("asking"),
        )
    )
    asks, own = F.col("label") != F.col("main"), F.col("own")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda kind, i, j, side: F.struct(F.xxhash64("key", F.lit(kind), i, j).alias("cell"), side.cast("long").alias("side"))
    # Sides 0 and 1 are compared with each other, rows of side 2 among themselves.
    held = F.transform(every("asking"), lambda x: cell(0, own, x, F.lit(0)))
    asking = F.concat(
        F.transform(every("held"), lambda x: cell(0, x, own, F.lit(1))),
        F.transform(every("asking"), lambda x: cell(1, F.least(own, x), F.greatest(own, x), F.when(own == x, 2).when(own < x, 0).otherwise(1))),
    )
    dealt = (
        named.join(sizes, "key")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.when(asks, F.col("asking")).otherwise(F.col("held"))).cast("int"))
        .withColumn("place", F.explode(F.when(asks, asking).otherwise(held)))
        .join(sketches.select("node", "registers"), "node")
        .select("place.cell", "place.side", "node", "label", "n", F.col("band").cast("long").alias("band"), "registers")
    )
    return dealt.repartition("cell").sortWithinPartitions("cell")


def _partners(dealt: DataFrame, settings: Settings) -> DataFrame:
    """``a, b``: the likeliest partner of another label, in each cell, of each row without its cell's main label."""

    def compare(batches):
        for parts in _runs(batches, 0):
            cell = Cell.of(parts)
            a, b, everyone = [], [], np.ones(len(cell.node), bool)
            for i in cell.asking():
                other, share = cell.likely(i, everyone, settings, first_band=False)
                if len(other):
                    a.append(cell.node[i]), b.append(cell.node[other[share.argmax()]])
            if a:
                pair = np.unique(np.sort(np.array([a, b]), axis=0), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], names=["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def _undecided(dealt: DataFrame, settings: Settings) -> DataFrame:
    """The rows of each cell that may link with a row of another label there: only they need their full sets."""

    def pick(batches):
        for parts in _runs(batches, 0):
            cell = Cell.of(parts)
            waiting, wanted = np.ones(len(cell.node), bool), np.zeros(len(cell.node), bool)
            for i in cell.asking():
                waiting[i] = False
                other, _ = cell.likely(i, waiting, settings, first_band=True)
                wanted[other] = True
                wanted[i] |= len(other) > 0
            if wanted.any():
                yield from pa.Table.from_batches(parts).filter(pa.array(wanted)).to_batches()

    return dealt.mapInArrow(pick, CELL)


def _joining(undecided: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """``a, b``: links, confirmed on full sets, that join all labels which links of a cell join.

    Each likely pair of rows is decided inside its cell unless links found there before have joined
    their labels. So a cell gives fewer links than it has rows, however many of its pairs are likely.
    """

    def decide(batches):
        for parts in _runs(batches, 0):
            cell = Cell.of(parts)
            sizes = np.concatenate([p.column(7).value_lengths().to_numpy() for p in parts]).astype(np.int64)
            values, codes = np.unique(np.concatenate([p.column(7).flatten().to_numpy() for p in parts]), return_inverse=True)
            own = np.split(codes, np.cumsum(sizes)[:-1])
            a, b, waiting, asked = [], [], np.ones(len(sizes), bool), np.zeros(len(values), np.int32)
            for i in cell.asking():
                waiting[i] = False
                other, _ = cell.likely(i, waiting, settings, first_band=True)
                if not len(other):
                    continue
                asked[own[i]] = 1
                starts = np.cumsum(sizes[other]) - sizes[other]
                both = np.add.reduceat(asked[np.concatenate([own[k] for k in other])], starts)
                asked[own[i]] = 0
                for k in other[100 * both >= settings.percent * (sizes[other] + sizes[i] - both)]:
                    if cell.label[k] != cell.label[i]:
                        a.append(cell.node[i]), b.append(cell.node[k])
                        cell.label[cell.label == cell.label[k]] = cell.label[i]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    whole = undecided.join(sets, "node").select(*undecided.columns, "hashes")
    return whole.repartition("cell").sortWithinPartitions("cell").mapInArrow(decide, "a long, b long").distinct()


def _components(docs: DataFrame, settings: Settings) -> DataFrame:
    """``id, nameless, n, label, component`` of every row; see ``near_duplicates``. ``label`` names each component, also
    one without any id."""
    rows = stored(_sketches(docs, settings.shingle).withColumn("digest", F.when(F.col("n") > 0, F.col("digest"))))
    copies = rows.where("n > 0").groupBy("digest").agg(F.min("id").alias("node"))
    copies = stored(copies)
    # One sketch for each set: that of the row with the smallest id.
    first = rows.join(copies, "digest").where("id = node").groupBy("node", "n", "digest").agg(F.first("registers").alias("registers"))
    sketches = stored(first.drop("digest"))

    band = f"xxhash64(b, substring(registers, b * {2 * ROWS} + 1, {2 * ROWS}))"
    keys = F.posexplode(F.expr(f"transform(sequence(0, {BANDS - 1}), b -> {band})"))
    bands = sketches.select("node", "n", keys.alias("band", "key"))
    buckets = bands.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader <> last")
    members = stored(bands.join(buckets.drop("last"), "key").select("key", "band", "node", "n", "leader"))
    ids = members.select("node").distinct()
    sets = stored(_sets(docs, ids, settings.shingle))

    star = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(_linked(_likely(star, sketches, settings), sets, settings))
    labels = components(links)
    partners = _partners(_dealt(members, labels, sketches), settings)
    links = stored(links.unionByName(_linked(partners, sets, settings)))
    labels = components(links)
    undecided = _undecided(_dealt(members, labels, sketches), settings)
    links = stored(links.unionByName(_joining(undecided, sets, settings)))
    labels = components(links)

    named = copies.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("label"))
    found = rows.select("id", "nameless", "n", "digest").join(named, "digest", "left")
    found = found.select("id", "nameless", "n", F.coalesce("label", "id").alias("label"))
    if rows.where("nameless").isEmpty():
        return found.withColumn("component", F.col("label"))
    # A component with rows without an id is named by the smallest id among the others.
    found = stored(found)
    touched = found.where("nameless").select("label").distinct()
    few = touched.count() <= IDS_TO_BROADCAST
    touched = F.broadcast(touched) if few else touched
    smallest = found.where("NOT nameless").join(touched, "label").groupBy("label").agg(F.min("id").alias("smallest"))
    smallest = touched.join(smallest, "label", "left").withColumn("renamed", F.lit(True))
    component = F.when(F.col("renamed"), F.col("smallest")).otherwise(F.col("label"))
    return found.join(F.broadcast(smallest) if few else smallest, "label", "left").select("id", "nameless", "n", "label", component.alias("component"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs(doc_id, text)``.

    Words are runs of anything but white space, with A-Z lower-cased. Two documents are linked if their
    sets of word shingles are similar enough; documents reachable over links are one component, named
    by its smallest id, whose document is kept.

    1. Every set is sketched (HyperMinHash). Rows with equal sets are one node.
    2. Rows that agree in a band of registers share a bucket. Each is compared with its bucket's
       smallest node: first by estimate, then on the full sets. A bucket of any size gives one pair a
       row, and links of exact or very near copies need no more.
    3. Rows of one bucket that are still in different components are compared in blocks: each with its
       likeliest partner, and then, inside the tasks and on full sets, with every likely row of another
       component. Every pair that shares a bucket and is likely is so decided on full sets or already
       connected, and no pair is made as a row unless it joins two components of its block. A pair at
       the threshold shares no bucket with a chance of 3 in a million.

    Texts without words (NULL, empty) have 0 shingles and are linked with nothing. Rows that share an id
    are one document. Rows without an id are linked by their text; their component has the smallest id
    among the others, or NULL, and then all of them are kept. An empty table gives no row.
    """
    doc_id, component = F.when(~F.col("nameless"), F.col("id")), F.col("component")
    return _components(docs, settings).select(
        doc_id.alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        doc_id.eqNullSafe(component).alias("kept"),
    )


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document per component: the one with the smallest id.

    Of rows with the same id and text one stays. Of a component without any id one row's text stays. The
    ids that go are broadcast while they are few, else joined; texts are not shuffled but for repeated ids.
    Only each row's component stays stored; sketches, sets and links are removed.
    """
    folder = shared_folder(docs.sparkSession)
    with scratch(docs.sparkSession):
        rows = stored(_components(docs, settings), folder)
    # Of a component without any id the row that names it stays.
    stays = F.when(F.col("component").isNull(), F.col("id") == F.col("label")).otherwise(~F.col("nameless") & (F.col("id") == F.col("component")))
    repeated = rows.groupBy("id").agg(F.count("*").alias("rows"), F.min(stays).alias("stays"))
    row, name = (unused(docs.columns, c) for c in ("_row", "_id"))
    gone = repeated.where("NOT stays OR rows > 1").select(F.col("id").alias(name))
    twice = repeated.where("stays AND rows > 1").select(F.col("id").alias(name))
    few = lambda ids: F.broadcast(ids) if ids.count() <= IDS_TO_BROADCAST else ids
    out = docs.join(few(gone), _row_id() == F.col(name), "left_anti")
    if twice.isEmpty():
        return out
    again = docs.join(few(twice), _row_id() == F.col(name), "left_semi").withColumn(row, _row_id())
    return out.unionByName(again.dropDuplicates([row, "text"]).drop(row))
