"""Token-id files: frequency-ranked ids, byte-aligned, control bytes apart.

Ids are replaced by their frequency rank over the whole corpus, so that the
common ones take one byte. Four ranks share a control byte of four 2-bit
lengths (1 to 4 bytes); control bytes and data bytes are kept in separate runs,
so a reader finds all lengths with one table lookup per control byte and
gathers the data bytes with numpy.

A file holds blocks. Little-endian throughout::

    magic "RLTK0001"
    block: u32 documents, u32 control bytes, u64 data bytes,
           i64 doc ids, u8 doc-id-is-null, u64 ids per document,
           control bytes (the block's ids in order), data bytes
    a block with 0 documents ends the file

The rank table is a file of its own, ``ranks.bin``: the ids as u32 by rank.

``manifest.json`` is written last and makes the folder readable on its own: it
lists the files in doc-id order with their documents, ids and bytes. Files that
it does not list are left over from failed tasks and are not read.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.encoding import crc_of, encode_batches, worker_encoder
from rasterloom.session import discard, shared_path, written
from rasterloom.sources import storage

MAGIC = b"RLTK0001"
MANIFEST, RANKS = "manifest.json", "ranks.bin"
_HEAD = "<IIQ"
#: Ids in a block, unless one document has more.
BLOCK_IDS = 1 << 19
#: Byte lengths of the four integers under each control byte.
LENGTHS = np.array([[(c >> s & 3) + 1 for s in (0, 2, 4, 6)] for c in range(256)], dtype=np.uint8)


def compress(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit integers."""
    values = np.ascontiguousarray(values, dtype="<u4")
    n = len(values)
    codes = np.zeros(-(-n // 4) * 4, dtype=np.uint8)
    codes[:n] = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    keep = np.arange(4, dtype=np.uint8)[None, :] <= codes[:n, None]
    return control.tobytes(), values.view(np.uint8).reshape(n, 4)[keep].tobytes()


def expand(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The first ``n`` integers of a block."""
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    raw = np.frombuffer(data, dtype=np.uint8)
    out = raw[starts].astype(np.uint32)
    for b in (1, 2, 3):
        longer = np.flatnonzero(lengths > b)
        if len(longer) == 0:
            break
        out[longer] |= raw[starts[longer] + b].astype(np.uint32) << np.uint32(8 * b)
    return out


def write_block(out: BinaryIO, doc_ids: list[int | None], ranks: list[np.ndarray]) -> None:
    control, data = compress(np.concatenate(ranks) if ranks else np.empty(0, np.uint32))
    out.write(struct.pack(_HEAD, len(doc_ids), len(control), len(data)))
    out.write(np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes())
    out.write(bytes(d is None for d in doc_ids))
    out.write(np.array([len(r) for r in ranks], dtype="<u8").tobytes())
    out.write(control)
    out.write(data)


def read_blocks(src: BinaryIO) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray, int]]:
    """(doc ids, ids per document, ranks, stored bytes) of each block."""
    if src.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    while True:
        docs, n_control, n_data = struct.unpack(_HEAD, _exactly(src, struct.calcsize(_HEAD)))
        if docs == 0:
            return
        ids = np.frombuffer(_exactly(src, 8 * docs), dtype="<i8").tolist()
        null = _exactly(src, docs)
        counts = np.frombuffer(_exactly(src, 8 * docs), dtype="<u8").astype(np.int64)
        ranks = expand(_exactly(src, n_control), _exactly(src, n_data), int(counts.sum()))
        yield [None if z else d for d, z in zip(ids, null, strict=True)], counts, ranks, n_control + n_data


def _exactly(src: BinaryIO, n: int) -> bytes:
    got = src.read(n)
    if len(got) != n:
        raise EOFError("token file is cut short")
    return got


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int | None = 1, path: str | None = None) -> str:
    """Encode every whole text and write files in ascending doc-id order; the folder they are in.

    1. Encode once; ids go to a table in the shared folder, and after a task's
       documents a row for each id that it met, with its count.
    2. Sum the counts over all documents (one row per id of the vocabulary
       reaches the driver) and rank by count, then id.
    3. Deal the table out by doc-id range, sort, and write one file a task.
    4. List the files that the job has committed in the manifest (one row per
       file reaches the driver).

    Null texts count as empty, null doc ids come first, rows that repeat are
    kept each on its own in any order between equals. An empty table gives a
    manifest without files. Other columns are not read.
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "token-files")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path, end_id)
        row, total = TaskContext.get().partitionId() << 33, np.zeros(0, np.int64)
        for doc_ids, encoded in encode_batches(batches, encoder):
            flat = np.frombuffer(b"".join(encoded), dtype="<u4")
            if len(flat):
                seen = np.bincount(flat, minlength=len(total))
                seen[: len(total)] += total
                total = seen
            # Two planes of bytes where they suffice: half the volume, and they compress well.
            planes = [_planes(np.frombuffer(e, dtype="<u4")) for e in encoded]
            yield _tokens(len(planes), doc_id=doc_ids, tie=range(row, row + len(planes)), ids=planes)
            row += len(planes)
        used = np.flatnonzero(total)
        yield _tokens(len(used), id=used, n=total[used])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = written(slim.mapInArrow(encode, "doc_id long, tie long, ids binary, id long, n long"), "token-ids")
    tokens = rows.where("id is null").select("doc_id", "tie", "ids")
    counted = rows.where("id is not null").groupBy("id").agg(F.sum("n").alias("n")).collect()
    ranked = np.array([r.id for r in sorted(counted, key=lambda r: (-r.n, r.id))], dtype="<u4")
    with storage.create(f"{path}/{RANKS}") as out:
        out.write(ranked.tobytes())
    rank_of = np.zeros(int(ranked.max()) + 1 if len(ranked) else 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)  # one entry per id of the vocabulary

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rank = TaskContext.get().partitionId(), shared.value
        rows = ((d, r) for b in batches for d, r in zip(b.column(0).to_pylist(), b.column(1), strict=True))
        first = next(rows, None)
        if first is None:
            return
        name, total, docs = f"part-{part:06d}-{uuid.uuid4().hex}.rltk", 0, 0
        with storage.create(f"{path}/{name}") as out:
            out.write(MAGIC)
            doc_ids, held, size = [first[0]], [rank[_ids(first[1].as_py())]], 0
            total = size = len(held[0])
            for doc_id, planes in rows:
                if size >= BLOCK_IDS:
                    write_block(out, doc_ids, held)
                    docs += len(doc_ids)
                    doc_ids, held, size = [], [], 0
                ranks = rank[_ids(planes.as_py())]
                doc_ids.append(doc_id)
                held.append(ranks)
                size, total = size + len(ranks), total + len(ranks)
            write_block(out, doc_ids, held)
            docs += len(doc_ids)
            out.write(struct.pack(_HEAD, 0, 0, 0))
            stored = out.tell()
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, name, docs, total, stored)], names=["part", "file", "documents", "ids", "bytes"])

    ordered = tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    made = ordered.mapInArrow(write, "part long, file string, documents long, ids long, bytes long").collect()
    listed = [{k: r[k] for k in ("file", "documents", "ids", "bytes")} for r in sorted(made, key=lambda r: r.part)]
    with storage.create(f"{path}/{MANIFEST}") as out:
        out.write(json.dumps({"format": MAGIC.decode(), "ranks": RANKS, "files": listed}, indent=1).encode())
    discard(rows)
    return path


_TOKENS = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("ids", pa.binary()), ("id", pa.int64()), ("n", pa.int64())])


def _tokens(rows: int, **columns) -> pa.RecordBatch:
    """A batch of the token table; columns not given are null."""
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _TOKENS]
    return pa.RecordBatch.from_arrays(arrays, schema=_TOKENS)


def _planes(ids: np.ndarray) -> bytes:
    """1 and all low bytes, then all high bytes, if ids fit in 16 bits; else 0 and the ids."""
    if len(ids) == 0 or ids.max() > 0xFFFF:
        return b"\0" + ids.tobytes()
    pairs = ids.astype("<u2").view(np.uint8).reshape(-1, 2)
    return b"\1" + pairs.T.tobytes()


def _ids(planes: bytes) -> np.ndarray:
    if planes[0] == 0:
        return np.frombuffer(planes, dtype="<u4", offset=1)
    both = np.frombuffer(planes, dtype=np.uint8, offset=1).reshape(2, -1)
    return both[0] | both[1].astype(np.uint16) << np.uint16(8)


def read_token_files(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian u32) per document, from the folder alone."""
    return _read(spark, path, "ids binary", lambda ids: ids.tobytes(), pa.binary())


def read_digests(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the folder alone."""
    return _read(spark, path, "ids_crc32 long", crc_of, pa.int64())


def read_manifest(path: str) -> dict:
    with storage.reopen(f"{path}/{MANIFEST}") as src:
        return json.loads(src.read())


def _read(spark, path: str, column: str, of, kind: pa.DataType) -> DataFrame:
    manifest = read_manifest(path)
    ranks_path, name = f"{path}/{manifest['ranks']}", column.split()[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of = None
        for batch in batches:
            for uri, start, listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if id_of is None:
                    with storage.reopen(ranks_path) as src:
                        id_of = np.frombuffer(src.read(), dtype="<u4")
                found = 0
                with storage.reopen(uri) as src:
                    for doc_ids, counts, ranks, _ in read_blocks(src):
                        ids, ends = id_of[ranks], np.cumsum(counts)
                        digests = [of(ids[e - n : e]) for e, n in zip(ends, counts, strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc_ids, pa.int64()), pa.array(start + found + ends - counts), pa.array(counts), pa.array(digests, kind)],
                            names=["doc_id", "start", "n_tokens", name],
                        )
                        found += int(counts.sum())
                if found != listed:
                    raise ValueError(f"{uri} does not hold the ids that the manifest lists")

    before, files = 0, []
    for f in manifest["files"]:
        files.append((f"{path}/{f['file']}", before, f["ids"]))
        before += f["ids"]
    listing = spark.createDataFrame(files, "path string, start long, ids long")
    dealt = listing.repartition(max(1, len(files)), "path")
    return dealt.mapInArrow(read, f"doc_id long, start long, n_tokens long, {column}")
