"""WARC (9): a chunked record table, written as archives and read back.

A payload is cut into chunks of bounded size; each is a row (record id, chunk
number, bytes) and carries the digest of the payload so far, so the last chunk's
digest is the payload's.  This table is written once; sizes, digests and archives
all come from its rows.  On disk a chunk is one WARC record: the first is the
``response``, the further ones are ``continuation`` records as the format's
segmentation defines them.  Payloads are shuffled as chunks only; no task holds more than a few
chunks beside the input row, and the reader streams archives line by line, so it holds no record at all.

Records with equal payloads of at least ``min_revisit`` bytes: the one with the
smallest id is the ``response``, the others are ``revisit`` records without a
payload that refer to it.  The digest decides, in a narrow shuffle without
payloads.

Archives are written and read by Spark's text source with gzip (a gzip file is
never split, so one task sees a file's records in order), below the folder that
driver and executors share.

Defined cases: a null payload is an empty one.  Rows without an id are left out.
Repeated rows of one id and payload are all ``response``.  An empty table gives
no records.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartwright.plans.session import discard, materialize, scratch_path

CHUNK = 1 << 20
MIN_REVISIT = 100
EOL = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunks(payload: memoryview | bytes, size: int) -> Iterator[bytes]:
    """The payload in pieces of at most ``size`` bytes that end between characters; one empty piece of nothing."""
    at, n = 0, len(payload)
    while True:
        to = min(n, at + size)
        while to < n and payload[to] & 0xC0 == 0x80:
            to -= 1
        yield bytes(payload[at:to])
        at = to
        if at >= n:
            return


_CHUNK = pa.schema([("row", pa.int64()), ("record_id", pa.int64()), ("chunk_no", pa.int32()), ("url", pa.string()), ("chunk", pa.binary()),
                    ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_())])
CHUNK_TABLE = "row long, record_id long, chunk_no int, url string, chunk binary, bytes_so_far long, digest_so_far string, last boolean"


def _payload(value: pa.Scalar) -> memoryview:
    """The value's bytes in place, null as empty."""
    return memoryview(value.as_buffer() or b"")


def chunk_table(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", size: int = CHUNK) -> DataFrame:
    """Rows (row, record_id, chunk_no, url, chunk, bytes_so_far, digest_so_far, last); ``row`` tells equal ids apart,
    the first chunk carries the url."""
    source = pages.select(
        F.col(id_col).cast("long").alias("record_id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("payload"),
        F.monotonically_increasing_id().alias("row")).filter("record_id is not null")

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        ids, urls, numbers = (batch.column(c).to_pylist() for c in (0, 1, 3))
        for record_id, url, value, row in zip(ids, urls, batch.column(2), numbers, strict=True):
            payload, digest, done = _payload(value), hashlib.sha256(), 0
            for number, chunk in enumerate(chunks(payload, size)):
                digest.update(chunk)
                done += len(chunk)
                yield row, record_id, number, url if number == 0 else None, chunk, done, digest.hexdigest(), done == len(payload)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, n = [], 0
            for made in rows(batch):
                held.append(made)
                n += len(made[4])
                if n >= 4 * CHUNK:
                    yield _columns(held)
                    held, n = [], 0
            if held:
                yield _columns(held)

    return source.mapInArrow(task, CHUNK_TABLE)


def _columns(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CHUNK, strict=True)], schema=_CHUNK)


def _record(fields: list[tuple[str, object]], block: str) -> str:
    """One WARC record without the two line ends that close it."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block.encode())}"]
    return EOL.join(lines) + EOL + EOL + block


def _uri(record_id: int, segment: int = 1) -> str:
    return f"<urn:page:{record_id}>" if segment == 1 else f"<urn:page:{record_id}:{segment}>"


def record(chunk: dict, whole: dict, *, date: str) -> str:
    """The WARC record of one chunk; ``whole``: what is known of its payload (bytes, digest, refers_to)."""
    record_id, number = chunk["record_id"], chunk["chunk_no"] + 1
    target = "".join(c for c in whole["url"] or "" if c not in "\r\n")
    common = [("WARC-Date", date), *([("WARC-Target-URI", target)] if target else [])]
    told = [("WARC-Payload-Digest", f"sha256:{whole['digest']}")]
    if whole["refers_to"] is not None:
        return _record([("WARC-Type", "revisit"), ("WARC-Record-ID", _uri(record_id)), *common, *told, ("WARC-Profile", _PROFILE), ("WARC-Refers-To", _uri(whole["refers_to"]))], "")
    http = f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: {whole['bytes']}{EOL}{EOL}"
    text = chunk["chunk"].decode()
    if number == 1:
        fields = [("WARC-Type", "response"), ("WARC-Record-ID", _uri(record_id)), *common, *told, ("Content-Type", "application/http;msgtype=response")]
        return _record(fields + [("WARC-Segment-Number", 1)] * (not chunk["last"]), http + text)
    fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", _uri(record_id, number)), *common,
              ("WARC-Segment-Origin-ID", _uri(record_id)), ("WARC-Segment-Number", number)]
    return _record(fields + [("WARC-Segment-Total-Length", len(http) + whole["bytes"])] * chunk["last"], text)


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit: int = MIN_REVISIT, date: str = "2024-01-01T00:00:00Z", size: int = CHUNK) -> str:
    """Write every row as WARC records below ``path``.

    The chunk table is written first.  Its last chunks tell sizes and digests, which decide the
    revisits; the archives are made of its rows, which meet what is known of
    their payload by row number and lie in order (row, chunk_no).
    """
    table = materialize(chunk_table(pages, id_col=id_col, url_col=url_col, payload_col=payload_col, size=size), "chunks", compression="zstd")
    known = table.filter("last").select("row", "record_id", F.col("bytes_so_far").alias("bytes"), F.col("digest_so_far").alias("digest"))
    first = known.filter(F.col("bytes") >= min_revisit).groupBy("digest").agg(F.min("record_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    urls = table.filter("chunk_no = 0").select("row", "url")
    later = (F.col("bytes") >= min_revisit) & (F.col("record_id") != F.col("first"))
    whole = materialize(
        known.join(first, "digest", "left").join(urls, "row")
        .select("row", "bytes", "digest", F.when(later, F.col("first")).alias("refers_to"), F.col("url").alias("target")), "payloads")
    met = table.select("row", "record_id", "chunk_no", "chunk", "last").join(whole, "row").filter("refers_to is null or chunk_no = 0")
    met = met.withColumn("chunk", F.when(F.col("refers_to").isNull(), F.col("chunk")))
    columns = ["record_id", "chunk_no", "chunk", "last", "bytes", "digest", "refers_to", "target"]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ready, held = [], 0
            for record_id, number, chunk, last, n, digest, to, url in zip(*(batch.column(c).to_pylist() for c in range(8)), strict=True):
                made = record({"record_id": record_id, "chunk_no": number, "chunk": chunk, "last": last},
                              {"bytes": n, "digest": digest, "refers_to": to, "url": url}, date=date)
                ready.append(made)
                held += len(made)
                if held >= 4 * CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array(ready, pa.string())], ["value"])
                    ready, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(ready, pa.string())], ["value"])

    rows = met.repartition("row").sortWithinPartitions("row", "chunk_no").select(*columns)
    rows.mapInArrow(task, "value string").write.option("lineSep", EOL + EOL).option("compression", "gzip").text(path)
    discard(table)
    discard(whole)
    return path


class Reader:
    """Streaming parser of one archive, fed with its lines."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.head: dict[bytes, bytes] | None = None
        self.left = -1  # bytes of the block still to come; -1: in the header
        self.skip = False  # inside the HTTP header of a response
        self.open: tuple[int, bytes] | None = None
        self.closing = 0

    def feed(self, line: bytes) -> None:
        """A line without its line feed."""
        if self.closing:
            self.closing -= 1
            return
        if self.left < 0:
            line = line.rstrip(b"\r")
            if line.startswith(b"WARC/"):
                self.head = {}
            elif line and self.head is not None:
                name, _, value = line.partition(b":")
                self.head[name.lower()] = value.strip()
            elif self.head is not None:
                self._begin()
            return
        if len(line) < self.left:
            self._data(line, True)
            self.left -= len(line) + 1
        else:
            self._data(line[: self.left], False)
            if line[self.left :] != b"\r":
                raise ValueError("a record does not end where its length says")
            self.closing, self.left = 1, -1
            self._end()

    def _begin(self) -> None:
        self.left = int(self.head[b"content-length"])
        self.kind = self.head[b"warc-type"].decode()
        if self.kind != "continuation":
            self.digest, self.bytes = hashlib.sha256(), 0
        self.skip = self.kind == "response"

    def _data(self, line: bytes, ended: bool) -> None:
        if self.skip:
            self.skip = bool(line.rstrip(b"\r"))
            return
        self.digest.update(line)
        self.bytes += len(line)
        if ended:
            self.digest.update(b"\n")
            self.bytes += 1

    def _end(self) -> None:
        head, self.head = self.head, None
        segment = int(head.get(b"warc-segment-number", b"0"))
        if self.kind == "continuation":
            if b"warc-segment-total-length" not in head:
                return
            record_id, declared = self.open
        else:
            record_id, declared = _number(head[b"warc-record-id"]), head[b"warc-payload-digest"].removeprefix(b"sha256:")
            if segment:
                self.open = record_id, declared
                return
        digest = declared.decode() if self.kind == "revisit" else self.digest.hexdigest()
        if digest != declared.decode():
            raise ValueError(f"record {record_id}: the payload does not have the digest that its header states")
        kind = "revisit" if self.kind == "revisit" else "response"
        to = _number(head[b"warc-refers-to"]) if kind == "revisit" else None
        self.rows.append((record_id, None if to is not None else self.bytes, digest, kind, to))


def _number(uri: bytes) -> int:
    return int(uri.strip(b"<>").split(b":")[2])


def read_archives(spark: SparkSession, path: str, *, id_col: str = "page_id") -> DataFrame:
    """Per record: id, payload bytes and digest (of what was read), type and the record it refers to."""
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["record_id", "bytes", "payload_digest", "record_type", "refers_to"]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, at = Reader(), None
        for batch in batches:
            files = batch.column(1).dictionary_encode() if not pa.types.is_dictionary(batch.column(1).type) else batch.column(1)
            values = batch.column(0).cast(pa.binary()).to_pylist()
            of = files.indices.to_pylist()
            names_of = files.dictionary.to_pylist()
            for line, code in zip(values, of, strict=True):
                if names_of[code] != at:
                    rows, reader, at = reader.rows, Reader(), names_of[code]
                    reader.rows = rows
                reader.feed(line)
            rows, reader.rows = reader.rows, []
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], names)

    read = materialize(lines.mapInArrow(task, "record_id long, bytes long, payload_digest string, record_type string, refers_to long"), "records")
    sizes = read.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("bytes").alias("size")).distinct()
    revisits = read.filter("record_type = 'revisit'").join(sizes, "refers_to", "left").withColumn("bytes", F.col("size")).select(*names)
    return (
        read.filter("record_type = 'response'").unionByName(revisits)
        .select(F.col("record_id").alias(id_col), F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    )


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write archives into the shared folder and read them back."""
    spark = pages.sparkSession
    return read_archives(spark, write_archives(pages, scratch_path(spark, "warc"), **options))
