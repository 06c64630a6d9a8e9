"""Packing by power-of-two decomposition.

A document of n ids is cut into pieces whose lengths are the powers of two of
n's binary form; pieces above ``max_length`` do not arise because whole
multiples of it come first. Every piece is a training sequence of its own, in
the bucket of its length, so no sequence crosses documents and none needs
padding. Batches are drawn per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasterloom.llm.encoding import encode_batches, worker_encoder

#: Ids in a batch of pieces.
BATCH_IDS = 1 << 18
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("bucket", pa.int32()),
    ]
)


def piece_lengths(n: int, max_length: int) -> list[int]:
    """Longest first: ``n // max_length`` whole sequences, then the binary digits of the rest."""
    whole, rest = divmod(n, max_length)
    return [max_length] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, max_length: int = 2048, end_id: int | None = 1) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian unsigned
    32-bit), ``doc_tokens, sequence_id, offset, bucket`` (log2 of the length).

    ``max_length`` must be a power of two. There is no shuffle: a task cuts the
    documents it reads and numbers its sequences from ``partition << 33``.

    Null and empty texts give the end id alone (no piece if ``end_id`` is
    None). Rows that repeat, also with the same doc_id, are packed each on its
    own. A null doc_id stays null. An empty table gives no rows. Other columns
    are not read. Pieces leave a task in batches of about BATCH_IDS
    ids, so a long document does not make a large batch; its text and ids are held whole.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path, end_id)
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        held = 0
        for doc_ids, encoded in encode_batches(batches, encoder):
            for doc_id, ids in zip(doc_ids, encoded, strict=True):
                total, start = len(ids) // 4, 0
                for length in piece_lengths(total, max_length):
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, piece, total, number, 0, length.bit_length() - 1))
                    start, number, held = start + length, number + 1, held + length
                    if held >= BATCH_IDS:
                        yield _pieces(rows)
                        rows, held = [], 0
        if rows:
            yield _pieces(rows)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(cut, SCHEMA)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def write_buckets(sequences: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length, for length-bucketed batches."""
    sequences.write.partitionBy("bucket").option("compression", "zstd").parquet(path)


def decode(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, dtype="<u4")
