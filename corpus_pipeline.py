"""Corpus pipeline: language ID, near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and is written as Parquet and read again before the next one. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm import decontaminate, language, near_dedup, packing
from rasterloom.llm.registry import WORD_BPE
from rasterloom.session import discard, scratch, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a learned language, with ``lang`` set to the predicted one; the others go.

    Learned from the stage's own input. Null, empty and letterless texts go,
    all rows if no row has both a text and a language. Repeated rows stay or go
    together; ties go to the language first by name; an empty table stays empty.
    """
    return language.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: that with the smallest doc_id.

    Null doc_ids come last, of repeated rows one stays; null and empty texts are
    one group; an empty table stays empty.
    """
    return near_dedup.deduplicate(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Null and empty texts contain none, null and wordless items are in no text;
    repeated rows stay or go together; empty tables drop nothing.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length with their token ids and the ids' checksum.

    Null and empty texts are the end id alone, repeated rows are packed each on
    its own, a null doc_id stays null, an empty table gives no piece.
    """
    pieces = packing.pack(docs, WORD_BPE, max_length=2048, end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_duplicates),
    ("decontaminate", benchmark_leaks),
    ("packing", pack),
]

#: Cross-parsing, XXH64 fingerprints and token ids have no SQL form; the tests
#: hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's table is deleted when the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark) as keep:
            after = keep(written(stage(spark, docs, sf_dir), f"stage-{name}"))
        discard(docs)
        docs = after
    return docs
