"""WARC archives compressed record by record with a Zstandard dictionary of their own.

Each archive (``.warc.zst``) starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary,
itself compressed; every record follows as a frame of its own. The dictionary is trained on records drawn
from the whole archive, ``SAMPLE_BYTES`` of them (a documented bound), of a long one a piece from anywhere in
it; until the last record is there all wait, compressed, in a scratch file of the task.
Records with equal payloads of ``REVISIT_BYTES`` or more are written once: the row of the smallest
page_id as a response, the others as revisits that name it. Archives go to the shared folder and the
reader takes them from there; a lost task writes its archive anew under another name, and only archives
named in the manifest are read.

Defined results: null html is an empty payload; of rows with the same smallest page_id and payload, the
first by url is the response; a null page_id sorts last and is read back as null; where all ids of a group are null,
revisits refer to null; a null url is written as an empty target; control characters in urls are
percent-encoded; payloads of any length are kept whole; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import struct
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeworks.runtime import ensure_checkpoint_dir, materialize, read_table, sized

REVISIT_BYTES = 100
SKIPPABLE = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
DICTIONARY_BYTES, SAMPLE_BYTES, PIECE_BYTES = 32 << 10, 1 << 20, 128 << 10
#: Waiting bytes at which an archive is closed.
ARCHIVE_BYTES = 1 << 30
CHUNK = 256 << 10
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI such as ``file:/shared`` or ``hdfs://host/shared``."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def record_id(page_id: int | None, row: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}' if page_id is not None else row)}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers: int | None, row: str) -> bytes:
    http = HTTP.format(len(payload)).encode()
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, row)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
        *([f"X-Page-ID: {page_id}"] if page_id is not None else []),
        *([f"WARC-Profile: {PROFILE}", *([f"WARC-Refers-To: {record_id(refers, row)}", f"X-Refers-To-Page-ID: {refers}"] if refers is not None else [])] if revisit else []),
        "Content-Type: application/http; msgtype=response",
    ]
    block = http if revisit else http + payload
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8)
    except zstandard.ZstdError:  # too few or too small for statistics: the text itself serves as dictionary
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Sample:
    """Records with the least priorities, as far as ``SAMPLE_BYTES``; priorities and pieces are pseudo-random, but the same in a rerun."""

    def __init__(self):
        self.random, self.heap, self.held = random.Random(0), [], 0

    def add(self, data: bytes) -> None:
        priority, place = self.random.random(), self.random.random()
        if self.heap and self.held >= SAMPLE_BYTES and -priority <= self.heap[0][0]:
            return
        piece = data[int(place * max(0, len(data) - PIECE_BYTES + 1)) :][:PIECE_BYTES]
        heapq.heappush(self.heap, (-priority, piece))
        self.held += len(piece)
        while self.held - len(self.heap[0][1]) >= SAMPLE_BYTES:
            self.held -= len(heapq.heappop(self.heap)[1])

    def pieces(self) -> list[bytes]:
        return [piece for _, piece in self.heap]


class ArchiveWriter:
    """One archive; its records wait in a scratch file until the dictionary is trained on a sample of all."""

    def __init__(self, folder: str, name: str):
        self.fs, root = open_folder(folder)
        self.path, self.uri = f"{root}/{name}", f"{folder}/{name}"
        self.scratch, self.sample = tempfile.TemporaryFile(), Sample()  # noqa: SIM115
        self.fast = zstandard.ZstdCompressor(level=1)
        self.size = self.records = 0

    def add(self, data: bytes) -> None:
        self.records += 1
        self.sample.add(data)
        packed = self.fast.compress(data)
        self.scratch.write(struct.pack("<Q", len(packed)) + packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int, int]:
        dictionary = train_dictionary(self.sample.pieces())
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        body = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes())
        squeeze, expand = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary), zstandard.ZstdDecompressor()
        self.scratch.seek(0)
        with self.scratch, self.fs.open_output_stream(self.path, compression=None) as out:
            out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
            self.size = 8 + len(body)
            while head := self.scratch.read(8):
                data = squeeze.compress(expand.decompress(self.scratch.read(struct.unpack("<Q", head)[0])))
                out.write(data)
                self.size += len(data)
        return self.uri, self.records, self.size


def read_archive(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and HTTP payload of each record, one at a time."""
    fs, path = open_folder(uri)
    with fs.open_input_stream(path, compression=None) as stream:
        magic, size = struct.unpack("<II", stream.read(8))
        if magic != SKIPPABLE:
            raise ValueError(f"{uri} does not start with a dictionary")
        body = stream.read(size)
        if body[:4] == struct.pack("<I", FRAME_MAGIC):
            body = zstandard.ZstdDecompressor().decompress(body)
        expand = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
        rest = b""
        while True:
            rest = rest or stream.read(CHUNK)
            if not rest:
                return
            frame, parts = expand.decompressobj(), []
            while True:
                parts.append(frame.decompress(rest))
                if frame.eof:
                    rest = frame.unused_data
                    break
                rest = stream.read(CHUNK)
                if not rest:
                    raise ValueError(f"{uri} ends within a record")
            yield parse(b"".join(parts))


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, block = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    return headers, block[: int(headers["Content-Length"])].partition(b"\r\n\r\n")[2]


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    part, writer, done, n = TaskContext.get().partitionId(), None, [], 0
    for batch in batches:
        for page, url, payload, digest, revisit, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            writer = writer or ArchiveWriter(folder, f"part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.warc.zst")
            writer.add(record(page, url, payload, digest, revisit, refers, f"{part}:{n}"))
            n += 1
            if writer.size >= ARCHIVE_BYTES:
                done.append(writer.close())
                writer = None
    if writer:
        done.append(writer.close())
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["archive", "records", "bytes"])


def _first_pages(pages: DataFrame) -> DataFrame:
    """Per payload that is there more than once: the id of its response, and whether that id is there more than once."""
    long_ones = pages.where(F.col("_wa_bytes") >= REVISIT_BYTES)
    by_page = long_ones.groupBy("_wa_digest", "_wa_page").agg(F.count("*").alias("n"))
    by_text = by_page.groupBy("_wa_digest").agg(F.min("_wa_page").alias("_wa_first"), F.min_by("n", F.coalesce("_wa_page", F.lit(2**63 - 1))).alias("_wa_equal"), F.sum("n").alias("n"))
    return materialize(by_text.where("n > 1").select("_wa_digest", "_wa_first", "_wa_equal"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all rows; the manifest ``(archive, records, bytes)`` is the result."""
    rows = pages.select(F.col(id_col).cast("long").alias("_wa_page"), F.col(url_col).alias("_wa_url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("_wa_payload"))
    rows = rows.withColumns({"_wa_digest": F.sha2("_wa_payload", 256), "_wa_bytes": F.octet_length("_wa_payload")})
    firsts = _first_pages(rows.select("_wa_page", "_wa_digest", "_wa_bytes"))
    repeated = firsts.where("_wa_equal > 1").limit(1).count() > 0
    joined = rows.join(sized(firsts), "_wa_digest", "left")
    is_first = F.col("_wa_page").eqNullSafe(F.col("_wa_first"))
    if repeated:  # rows of one page and payload: the first by url is the response
        nth = F.row_number().over(Window.partitionBy("_wa_digest", "_wa_page").orderBy("_wa_url"))
        joined = joined.withColumn("_wa_nth", nth)
        is_first = is_first & (F.col("_wa_nth") == 1)
    revisit = F.col("_wa_equal").isNotNull() & ~is_first
    out = joined.select("_wa_page", "_wa_url", "_wa_payload", "_wa_digest", revisit.alias("_wa_revisit"), F.when(revisit, F.col("_wa_first")).alias("_wa_refers"))
    return materialize(out.mapInArrow(lambda it: _write(it, folder), "archive string, records long, bytes long"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    number = lambda x: None if x is None else int(x)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for uri in batch.column(0).to_pylist():
            rows = []
            for head, payload in read_archive(uri):
                size, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha256:")
                if head["WARC-Type"] == "response":
                    size, told = len(payload), digest
                    if (digest := hashlib.sha256(payload).hexdigest()) != told:
                        raise ValueError(f"{uri}: payload of {head['WARC-Record-ID']} is damaged")
                rows.append((number(head.get("X-Page-ID")), size, digest, head["WARC-Type"], number(head.get("X-Refers-To-Page-ID")), head["WARC-Target-URI"]))
                if len(rows) == 4096:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row a record of the archives in ``manifest``; payloads of responses are checked against their digests."""
    names = manifest.select("archive")
    return names.repartition(max(1, min(10_000, manifest.count())), "archive").mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def op4_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(read_table(spark, sf_dir, "pages"), folder)).drop("url")


#: What the archives give back, from the pages themselves.
SQL = f"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, url, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, url NULLS FIRST) AS nth, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN nth > 1 AND payload_bytes >= {REVISIT_BYTES} THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN nth > 1 AND payload_bytes >= {REVISIT_BYTES} THEN least END AS refers_to
FROM r
"""
