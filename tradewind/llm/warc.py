"""WARC archives with an index written first: records are found by offset and read in coalesced ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tradewind.llm.files import create, new_folder, open_file
from tradewind.session import stored

FILE_BYTES = 64 << 20  # a file ends after so many bytes
GAP = 64 << 10  # bytes between two wanted records that are read rather than skipped
RANGE = 8 << 20  # bytes of one read, unless one record is longer
DATE = "2024-01-01T00:00:00Z"

INDEX = (
    "part long, file string, offset long, length long, url string, digest string, "
    "page_id long, record_type string, refers_to long, payload_bytes long"
)


def _header(version: str, fields: list[tuple[str, str]]) -> bytes:
    lines = [version, *(f"{name}: {value}" for name, value in fields)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def one_line(text: str) -> str:
    """A header value on one line: what would end it is percent-encoded."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in text or "\n" in text else text


def record(url: str | None, payload: bytes, digest: str, refers_to: str | None, name: str, headers: list[tuple[str, str]]) -> bytes:
    """One WARC/1.1 record as a gzip member of its own. A revisit names the record it repeats and has no payload."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", DATE),
        ("Content-Length", str(len(block))),
        ("Content-Type", "text/html; charset=utf-8"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *headers,
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", one_line(url)))
    if revisit:
        fields.append(("WARC-Refers-To", f"<{refers_to}>"))
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(_header("WARC/1.1", fields) + block + b"\r\n\r\n") + packer.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one gzip member."""
    whole = zlib.decompress(data, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    return fields, block


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}"


def plan_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: which pages repeat the payload of one with a smaller id.

    Payloads are compared by SHA-1 and length. The page with the smallest id of those with the same
    payload of at least ``least_bytes`` bytes is the response; all others revisit it. Only digests are
    grouped, and reduced in each task first; the pages join their group's first id, so a payload that a
    third of all pages have is the skewed side of a plain join.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("_sha", F.sha1("payload")).withColumn("_bytes", F.octet_length("payload").cast("long"))
    firsts = (
        rows.where(F.col("_bytes") >= least_bytes)
        .groupBy("_sha", "_bytes")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_rows"))
        .where("_rows > 1")
        .drop("_rows")
    )
    again = ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(firsts, ["_sha", "_bytes"], "left").select(
        "page_id", "url", "payload", F.when(F.col("_first").isNotNull() & again, F.col("_first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as gzipped WARC files; the index of what was written.

    One index row per record: ``file, offset, length`` of its bytes, url, digest (bare base 32 SHA-1 of the
    full payload), and what kind of record it is. Each task writes files of its own and hands on
    index rows only for what is in them, so the index of the finished tasks is what exists: files of lost
    or repeated attempts are named nowhere.

    A NULL html is an empty payload; a NULL url is left out of the record. Rows with the smallest id of
    their payload are all responses if the id repeats. Rows without an id are revisits if a page with an
    id has their payload, otherwise responses. An empty table writes no file.
    """
    folder = new_folder(pages.sparkSession, "warc")

    def write(batches):
        part, out, uri, at = TaskContext.get().partitionId(), None, None, 0
        for batch in batches:
            rows = []
            for page_id, url, payload, refers in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    (out, uri), at = create(folder, ".warc.gz"), 0
                digest = base32(hashlib.sha1(payload).digest())
                extra = [("X-Page-Id", "" if page_id is None else str(page_id)), ("X-Payload-Length", str(len(payload)))]
                if refers is not None:
                    extra.append(("X-Refers-To-Page", str(refers)))
                data = record(url, payload, digest, None if refers is None else record_id(refers), record_id(page_id), extra)
                out.write(data)
                kind = "response" if refers is None else "revisit"
                rows.append((part, uri, at, len(data), url, digest, page_id, kind, refers, len(payload)))
                at += len(data)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 10, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in INDEX.split(", ")])
        if out is not None:
            out.close()

    return stored(plan_records(pages, least_bytes).mapInArrow(write, INDEX))


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP, most: int = RANGE) -> list[tuple[int, int]]:
    """Ranges ``(offset, length)`` in order of offset joined where less than ``gap`` lies between, up to ``most`` bytes."""
    out: list[tuple[int, int]] = []
    for offset, length in ranges:
        end = offset + length
        if out and offset <= sum(out[-1]) + gap and end - out[-1][0] <= most:
            out[-1] = (out[-1][0], max(sum(out[-1]), end) - out[-1][0])
        else:
            out.append((offset, length))
    return out


def read_records(index: DataFrame) -> DataFrame:
    """The records that the rows of ``index(file, offset, length)`` name, read from the archives.

    ``page_id, url, record_type, refers_to, digest, payload_bytes, block``, all from the record itself.
    Select index rows first: nothing else is read. The rows of a file go to one task, by offset,
    and neighbouring records are read with one request.
    """

    def read(batches):
        uri, file = None, None
        for batch in batches:
            files, offsets, lengths = (batch.column(i).to_pylist() for i in range(3))
            rows, first = [], 0
            while first < len(files):
                last = first
                while last < len(files) and files[last] == files[first]:
                    last += 1
                if files[first] != uri:
                    uri, file = files[first], open_file(files[first])
                wanted = list(zip(offsets[first:last], lengths[first:last]))
                place = 0
                for start, size in coalesced(wanted):
                    data = file.read_at(size, start)
                    while place < len(wanted) and sum(wanted[place]) <= start + size:
                        at = wanted[place][0] - start
                        fields, block = parse(data[at : at + wanted[place][1]])
                        refers, page = fields.get("X-Refers-To-Page"), fields["X-Page-Id"]
                        rows.append((
                            int(page) if page else None, fields.get("WARC-Target-URI"), fields["WARC-Type"],
                            None if refers is None else int(refers), fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                            int(fields["X-Payload-Length"]), block,
                        ))
                        place += 1
                first = last
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
            names = ["page_id", "url", "record_type", "refers_to", "digest", "payload_bytes", "block"]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    wanted = index.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    return wanted.mapInArrow(
        read, "page_id long, url string, record_type string, refers_to long, digest string, payload_bytes long, block binary"
    )


def page_records(read: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the records read.

    A response's length and digest are checked against its block; a record that does not fit fails the job.
    """
    def check(batches):
        for batch in batches:
            for kind, digest, size, block in zip(*(batch.column(i).to_pylist() for i in (2, 4, 5, 6))):
                if kind == "response" and (len(block) != size or base32(hashlib.sha1(block).digest()) != digest):
                    raise ValueError("payload does not have the digest of its record")
            yield batch.select([0, 5, 4, 2, 3])

    named = read.mapInArrow(check, "page_id long, payload_bytes long, digest string, record_type string, refers_to long")
    return named.withColumnRenamed("digest", "payload_digest")
