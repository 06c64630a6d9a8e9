"""WARC archives with a Zstandard dictionary.

Of records with equal payloads the one with the largest page_id is a
``response`` with its payload; the others are ``revisit`` records that refer to
it and carry none. An archive begins with a skippable frame that holds the
dictionary, built from archived records; each record is a frame of its own,
compressed with it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.session import discard, shared_path, written
from rasterloom.sources import storage

#: The skippable frame that holds the dictionary.
SKIPPABLE = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Bounds of the dictionary and of the records it is built from.
DICTIONARY_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 64 << 10, 256, 16 << 10
LEVEL = 3


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def safe_uri(url: str) -> str:
    """The URL with white space, control and non-ASCII characters as percent escapes, so that it fits a header line."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url)


def _record_id(page_id: int | None, row: int) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def _page_of(record_id: str) -> int | None:
    page = record_id.strip("<>").split(":")[2]
    return int(page) if page else None


def response_record(page_id: int | None, row: int, url: str | None, payload: bytes) -> bytes:
    head = {"WARC-Type": "response", "WARC-Record-ID": _record_id(page_id, row), "Content-Type": "application/http; msgtype=response"}
    return _record(head, url, digest_of(payload), len(payload), HTTP_HEAD + payload)


def revisit_record(page_id: int | None, row: int, url: str | None, digest: str, size: int, refers_to: str) -> bytes:
    head = {"WARC-Type": "revisit", "WARC-Record-ID": _record_id(page_id, row), "WARC-Profile": PROFILE, "WARC-Refers-To": refers_to}
    return _record(head, url, digest, size, b"")


def _record(head: dict[str, str], url: str | None, digest: str, size: int, block: bytes) -> bytes:
    lines = {"WARC-Date": DATE, "WARC-Payload-Digest": f"sha1:{digest}", "X-Payload-Length": str(size), "Content-Length": str(len(block))}
    if url:
        lines["WARC-Target-URI"] = safe_uri(url)
    text = "".join(f"{k}: {v}\r\n" for k, v in {**head, **lines}.items())
    return b"WARC/1.1\r\n" + text.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[: int(fields["Content-Length"])]


class ArchiveWriter:
    def __init__(self, out: BinaryIO, dictionary: bytes):
        import zstandard

        self._out = out
        parts = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self._compress = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **parts).compress
        out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)

    def write(self, record: bytes) -> None:
        self._out.write(self._compress(record))


def read_archive(src: BinaryIO, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records, one frame at a time."""
    import zstandard

    magic, size = struct.unpack("<II", src.read(8))
    if magic != SKIPPABLE:
        raise ValueError("archive has no dictionary frame")
    dictionary = src.read(size)
    parts = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    inflater = zstandard.ZstdDecompressor(**parts)
    rest = b""
    while True:
        frame, out = inflater.decompressobj(), io.BytesIO()
        rest = rest or src.read(chunk)
        if not rest:
            return
        while not frame.eof:
            if not rest:
                rest = src.read(chunk)
                if not rest:
                    raise EOFError("archive is cut short")
            out.write(frame.decompress(rest))
            rest = frame.unused_data if frame.eof else b""
        yield out.getvalue()


def train_dictionary(records: list[bytes]) -> bytes:
    """A dictionary of the sampled records; none if they are too few for one."""
    import zstandard

    if len(records) < 8:
        return b""
    try:
        size = min(DICTIONARY_BYTES, max(1 << 10, sum(map(len, records)) // 8))
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:  # too few or too uniform records
        return b""


def write_archives(pages: DataFrame, path: str | None = None, min_payload: int = 0) -> list[str]:
    """Archive every row of ``pages`` (page_id, url, html); the paths of the archives.

    Payloads under ``min_payload`` bytes are never deduplicated. The response of
    each digest is found by one map-side aggregation that carries the largest
    page_id's payload, so copies are not shuffled; revisits move without
    payload, and Spark may split a frequent digest's rows in their join.

    A null html is an empty payload, a null url leaves the target out, a null
    page_id is smaller than any other and comes back as null. Of rows that
    repeat with one page_id one is the response and the others refer to it. An
    empty table gives no archive. Other columns are not read.
    """
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    alone = F.when(F.col("size") < min_payload, F.col("row"))
    rows = rows.withColumn("alone", F.coalesce(alone, F.lit(-1)))
    # Read twice, so that row numbers and digests are those of one reading.
    rows = written(rows, "warc-rows")
    key = ["digest", "alone"]
    best = F.max_by(F.struct("page_id", "row", "url", "payload"), F.struct("page_id", "row")).alias("best")
    responses = rows.groupBy(*key).agg(best).select(*key, "best.*")
    latest = rows.groupBy(*key).agg(F.max(F.struct("page_id", "row")).alias("of"))
    slim = rows.select(*key, "page_id", "row", "url", "size")
    revisits = slim.join(latest, key).where(F.col("row") != F.col("of.row"))
    dictionary = train_dictionary([response_record(*r) for r in _sampled(rows)])
    shared = spark.sparkContext.broadcast(dictionary)

    def archive(batches: Iterator[pa.RecordBatch], record) -> Iterator[pa.RecordBatch]:
        entries = (r for b in batches for r in _rows(b))
        first = next(entries, None)
        if first is None:
            return
        uri, count = f"{path}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst", 1
        with storage.create(uri) as out:
            writer = ArchiveWriter(out, shared.value)
            writer.write(record(first))
            for entry in entries:
                writer.write(record(entry))
                count += 1
        yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([count])], names=["path", "records"])

    def write_responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return archive(batches, lambda r: response_record(*r))

    def write_revisits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def record(r: tuple) -> bytes:
            page_id, row, url, digest, size, of_page, of_row = r
            return revisit_record(page_id, row, url, base64.b32encode(bytes.fromhex(digest)).decode(), size, _record_id(of_page, of_row))

        return archive(batches, record)

    made = responses.select("page_id", "row", "url", "payload").mapInArrow(write_responses, "path string, records long")
    again = revisits.select("page_id", "row", "url", "digest", "size", "of.page_id", "of.row").toDF("page_id", "row", "url", "digest", "size", "of_page", "of_row")
    # One row per archive.
    paths = sorted(r.path for r in made.unionByName(again.mapInArrow(write_revisits, "path string, records long")).collect())
    discard(rows)
    return paths


def _sampled(rows: DataFrame) -> list[tuple]:
    """The SAMPLE_RECORDS rows that come first by a hash, of each SAMPLE_BYTES of payload.

    Keys are chosen first, below a bound under which about twice as many rows
    are expected, so partitions send a number of keys that does not grow with
    the table; payloads are cut on the executors and fetched for the chosen rows alone.
    """
    count = rows.count()
    if count == 0:
        return []
    place = F.pmod(F.xxhash64("digest", "row"), F.lit(1 << 53))
    bound = (1 << 53) if count <= 4 * SAMPLE_RECORDS else (1 << 53) // count * 2 * SAMPLE_RECORDS
    keys = rows.select("row", place.alias("place")).where(F.col("place") < bound)
    chosen = [r.row for r in sorted(keys.collect(), key=lambda r: (r.place, r.row))[:SAMPLE_RECORDS]]
    cut = rows.where(F.col("row").isin(chosen)).select("page_id", "row", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"))
    return [(r.page_id, r.row, r.url, bytes(r.payload)) for r in sorted(cut.collect(), key=lambda r: r.row)]




def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    columns = batch.columns
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


def read_archives(spark, paths: list[str]) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, uri`` per record, from the archives alone.

    A response's length and digest are computed from its payload; a digest that
    differs from its header is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with storage.reopen(uri) as src:
                    rows = []
                    for raw in read_archive(src):
                        rows.append(_entry(raw))
                        if len(rows) == 5_000:
                            yield _batch(rows, names, kinds)
                            rows = []
                    if rows:
                        yield _batch(rows, names, kinds)

    listing = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string"
    return listing.mapInArrow(read, schema)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _entry(raw: bytes) -> tuple:
    fields, block = parse_record(raw)
    digest, size, refers_to = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"]), None
    if fields["WARC-Type"] == "response":
        payload = block[len(HTTP_HEAD) :]
        if digest_of(payload) != digest or len(payload) != size:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    else:
        refers_to = _page_of(fields["WARC-Refers-To"])
    return _page_of(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], refers_to, fields.get("WARC-Target-URI")
