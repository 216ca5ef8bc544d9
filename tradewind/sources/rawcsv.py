"""The wide order export as text columns."""

from __future__ import annotations

import csv
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tradewind.session import settings, stored
from tradewind.sources.layers import publish

SPLIT_BYTES = 128 << 20
FILES_TO_BROADCAST = 1_000_000  # 8 bytes each


def read_wide_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """Read the export with every column as text. A file whose header differs from the first one's stops the job.

    Quoted fields may hold newlines, so one file is one task; ``read_split_csv`` reads large files in
    parallel. For an export without such newlines, ``multi_line=False`` lets Spark split each file.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)  # columns go by position: each file's header is checked
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def _record_key(file: Column, block: Column) -> Column:
    return F.xxhash64(file, block)


def _assembled(batches):
    """Records of the lines of each block, which come in order: ``file, block, kind, closes, first, record``.

    ``kind`` 0 is a whole record; 1 is the start of a block that lies inside quotes, up to the line that
    closes them (``closes`` 1) or the block's end; 2 is what a block leaves open. ``first`` marks what
    begins a file. Lines that are a record are handed on together; only the others are joined.
    """
    names = ["file", "block", "kind", "closes", "first", "record"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
    file = block = None
    inside, head, pending, first = False, False, [], False

    def left_open() -> list[tuple]:
        return [(file, block, 1 if head else 2, 0, first, "\n".join(pending))] if pending else []

    for batch in batches:
        files, blocks, quotes = (batch.column(i).to_numpy() for i in (0, 1, 2))
        opened, values = batch.column(3).to_numpy(zero_copy_only=False), batch.column(4)
        if not len(batch):
            continue
        cuts = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            rows = []
            if (file, block) != (files[start], blocks[start]):
                rows += left_open()
                file, block = int(files[start]), int(blocks[start])
                inside = head = bool(opened[start])
                pending, first = [], block == 0
            odd = (np.cumsum(quotes[start:end]) + inside) % 2 == 1
            before = np.concatenate(([inside], odd[:-1]))
            alone = ~before & ~odd
            header = None
            if first and not pending:  # handed on by itself, to be marked; empty lines before it are no records
                lines = (k for k in range(end - start) if values[start + k].as_py() not in ("", "\r"))
                header = next(lines, None)
            if header is not None and alone[header]:
                rows.append((file, block, 0, 0, True, values[start + header].as_py()))
                alone[header], first = False, False
            else:
                header = None
            for i in np.flatnonzero(~alone).tolist():
                if i == header:
                    continue
                pending.append(values[start + i].as_py())
                if not odd[i]:
                    rows.append((file, block, 1 if head else 0, int(head), first, "\n".join(pending)))
                    pending, head, first = [], False, False
            inside = bool(odd[-1])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
            whole = values.slice(start, end - start).filter(pa.array(alone))
            if len(whole):
                fixed = [np.full(len(whole), x) for x in (file, block, 0, 0, False)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(fixed, kinds)), whole.cast(pa.string())], names=names)
    rows = left_open()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def split_records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``first, record``: every record of the CSV files under ``path`` as text, read in blocks of ``split_bytes``.

    Spark cuts each file at byte offsets and reads physical lines. Whether a block begins inside quotes is the
    parity of the quotes in all blocks of its file before it: one small row per block is added up first.
    Then each task joins the lines of its own blocks to records. What a block leaves open is joined
    with the starts of the next ones, by the number of the record in its file; these are two pieces per block.
    ``first`` marks the first record of each file.

    Escaped quotes come in twos and do not count. A quote inside a field that does not begin with one
    is not CSV and would be taken for an opening one. Lines end with LF, or with CRLF, which then also stands for
    LF inside quotes. Empty lines are no records.
    """
    # Both passes have to see the same blocks, whatever executors come and go in between.
    with settings(spark, {"spark.sql.files.maxPartitionBytes": split_bytes, "spark.sql.files.minPartitionNum": 1}):
        lines = spark.read.option("lineSep", "\n").text(path).select(
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
            "value",
        )
        blocks = stored(lines.groupBy("file", "block").agg((F.sum("quotes") % 2).alias("odd"), F.first(F.endswith("value", F.lit("\r"))).alias("crlf")))
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        inside = blocks.withColumn("inside", F.coalesce(F.sum("odd").over(before) % 2 == 1, F.lit(False))).where("inside")
        # A number for each block that begins inside quotes: under a ten millionth of the text. A join by
        # shuffle would lose the order of lines.
        inside = inside.select(_record_key(F.col("file"), F.col("block")).alias("key"), F.lit(True).alias("opened"))
        known = lines.withColumn("key", _record_key(F.col("file"), F.col("block"))).join(F.broadcast(inside), "key", "left")
        ordered = known.select("file", "block", F.col("quotes").cast("long"), F.coalesce("opened", F.lit(False)).alias("opened"), "value")
        kind = "file long, block long, kind int, closes int, first boolean, record string"
        pieces = stored(ordered.mapInArrow(_assembled, kind))

    whole, torn = pieces.where("kind = 0").select("file", "first", "record"), pieces.where("kind > 0")
    by_place = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum("closes").over(by_place), F.lit(0))
    numbered = torn.select("file", "block", "kind", number.alias("number"))
    in_order = F.sort_array(F.collect_list(F.struct("block", "kind", "record")))
    joined = (
        torn.join(numbered, ["file", "block", "kind"])
        .groupBy("file", "number")
        .agg(F.max("first").alias("first"), F.array_join(F.transform(in_order, lambda p: p["record"]), "\n").alias("record"))
    )
    both = whole.unionByName(joined.select("file", "first", "record"))
    # In a file whose first line ends with CRLF every line does, also inside quotes; a number for each such file.
    windows = blocks.where("block = 0 AND crlf").select("file", F.lit(True).alias("crlf"))
    if not windows.isEmpty():
        few = windows.count() <= FILES_TO_BROADCAST
        both = both.join(F.broadcast(windows) if few else windows, "file", "left")
        bare = F.replace(F.regexp_replace("record", "\\r\\z", ""), F.lit("\r\n"), F.lit("\n"))
        both = both.withColumn("record", F.when(F.col("crlf"), bare).otherwise(F.col("record")))
    return both.where("record <> ''").select("first", "record")


def read_split_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """The rows of ``read_wide_csv`` with files of any size read by many tasks; see ``split_records``.

    Without ``schema`` the columns are those of the first file's header. A file whose header differs from
    them stops the job. The assembled records are stored once, so no line is joined twice.
    """
    if schema is None:
        schema = read_wide_csv(spark, path).schema
    records = split_records(spark, path, split_bytes)
    for row in records.where("first").select("record").distinct().limit(100).collect():
        header = next(csv.reader(io.StringIO(row["record"].lstrip("﻿"), newline="")), [])
        if [h.lower() for h in header] != [f.name.lower() for f in schema.fields]:
            raise ValueError(f"a file under {path} has the header {header}, not {schema.fieldNames()}")
    escaped = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("record", F.lit(escaped), {"escape": '"', "multiLine": "true"})
    return records.where("NOT first").select(parsed.alias("row")).select("row.*")


def stage_wide_csv(
    spark: SparkSession, path: str, base: str, schema: StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """Parse the text once into Parquet, so that nine column selections do not parse it nine times.

    Fields with newlines are read in parallel too; ``multi_line=False`` saves the look at the quotes.
    """
    wide = read_split_csv(spark, path, schema) if multi_line else read_wide_csv(spark, path, schema, False)
    return spark.read.parquet(publish(wide, base, "wide"))
