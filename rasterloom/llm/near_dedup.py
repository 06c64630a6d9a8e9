"""SimHash near-duplicates over a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in
at most ``max_bits`` = 4 bits share at least 8 - 4 = 4 of them: the guaranteed
minimum. The index posts each distinct fingerprint under sets of three
(position, byte) entries; the sets are Turan's, so that any four positions
contain one of them and no pair with four shared bytes is missed. Inside a
posting list the shared positional bytes are tallied per pair, pairs below the
minimum are dropped, and the rest are verified by their differing bits.

A list yields at most one edge per member (to the least member it is connected
to inside the list), never its pairs, so groups of thousands stay linear.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.encoding import pieces
from rasterloom.operators.components import connected_components
from rasterloom.session import shared_path, written
from rasterloom.sources import storage

#: Runs up to this long compare neighbours at every distance at once; longer ones are searched breadth-first.
SHORT_RUN = 32
#: Posting lists longer than this are searched by sublists that share a fourth byte.
SPLIT_RUN = 4096
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def position_sets(min_shared: int = 4) -> list[tuple[int, int, int]]:
    """Turan's 20 triples of 8 positions: every four positions contain one.

    With the positions in rings of groups (3, 3, 2), a triple lies in one group
    or has two members in a group and one in the next.
    """
    if min_shared != 4:
        raise ValueError("the sets cover four shared bytes, that is at most 4 differing bits")
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    sets = []
    for triple in combinations(range(8), 3):
        g = sorted(group[p] for p in triple)
        inside = g[0] == g[2]
        two_and_next = any(g.count(k) == 2 and g.count((k + 1) % 3) == 1 for k in range(3))
        if inside or two_and_next:
            sets.append(triple)
    return sets


def simhash(text: str | None, width: int = 4, seed: int = 42) -> int:
    """Unsigned fingerprint of a whole text; 0 if it has no word."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones, count = np.zeros(64, np.int64), 0
    held: list[bytes] = []  # the last words, whose shingles are not complete yet
    for piece in pieces(text or ""):
        held += piece.encode("utf-8", "surrogatepass").lower().split()
        if len(held) < width:
            continue
        joined = b" ".join(held)
        sizes = np.fromiter(map(len, held), np.int64, len(held))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(held) - width + 1].tolist()
        spans = zip(starts, ends[width - 1 :].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[s:e], seed) for s, e in spans), np.uint64, len(starts))
        ones, count = ones + _set_bits(hashes), count + len(hashes)
        held = held[len(held) - width + 1 :]
    if count == 0:
        if not held:
            return 0
        ones, count = _set_bits(np.array([digest(b" ".join(held), seed)], dtype=np.uint64)), 1
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[i : i + CHUNK].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return ones


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_column(text, width: int = 4, seed: int = 42):
    """The fingerprint as a signed long column."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([_signed(simhash(t.as_py(), width, seed)) for t in texts], pa.int64())

    return of(text)


def _shared_and_close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Tally of shared positional bytes, then the differing bits of those that reach the minimum."""
    differing = np.bitwise_xor(a, b).view(np.uint64)  # numpy counts the bits of a signed number's magnitude
    tally = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    found = np.flatnonzero(tally >= 8 - max_bits)
    return found[np.bitwise_count(differing[found]) <= max_bits]


def _long_run(members: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Star edges of the connected parts of one posting list, by breadth-first search
    over those not reached yet."""
    edges, left = [], np.sort(members)
    while len(left) > 1:
        root, part, left = left[0], [], left[1:]
        frontier = [root]
        while frontier and len(left):
            at = frontier.pop()
            near = _shared_and_close(left, np.broadcast_to(at, left.shape), max_bits)
            if len(near):
                reached = left[near]
                part.append(reached)
                frontier.extend(reached)
                left = np.delete(left, near)
        if part:
            reached = np.concatenate(part)
            edges.append((reached, np.full(len(reached), root)))
    return edges


def _by_fourth_byte(key: int, members: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges of one posting list, from its sublists of equal bytes at each position that its triple lacks.

    No link is lost: who shares the guaranteed four bytes shares one beyond the triple.
    """
    triple = position_sets(8 - max_bits)[key >> 24]
    edges = []
    for p in set(range(8)) - set(triple):
        byte = (members >> (8 * p)) & 255
        order = np.argsort(byte, kind="stable")
        edges.append(run_edges(byte[order], members[order], max_bits, split=False))
    return edges


def run_edges(keys: np.ndarray, fps: np.ndarray, max_bits: int, split: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Edges inside runs of equal keys; with ``split`` the keys are those of posting lists."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(bounds)
    for k in np.flatnonzero(sizes > SHORT_RUN):
        members = fps[bounds[k] : bounds[k + 1]]
        out += _by_fourth_byte(int(keys[bounds[k]]), members, max_bits) if split and len(members) > SPLIT_RUN else _long_run(members, max_bits)
    short = np.repeat((sizes > 1) & (sizes <= SHORT_RUN), sizes)
    keys, fps = keys[short], fps[short]
    for step in range(1, SHORT_RUN):
        at = np.flatnonzero(keys[step:] == keys[:-step]) if len(keys) > step else ()
        if len(at) == 0:
            break
        a, b = fps[at], fps[at + step]
        near = _shared_and_close(a, b, max_bits)
        out.append((b[near], a[near]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def fingerprint_links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges ``a, b`` that connect the same fingerprints as all links of at most ``max_bits`` bits.

    ``distinct`` holds each fingerprint (signed long ``fp``) once.
    """
    sets = position_sets(8 - max_bits)
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    entries = []
    for n, (i, j, k) in enumerate(sets):
        entries.append(F.lit(n << 24) + F.shiftleft(byte[i], 16) + F.shiftleft(byte[j], 8) + byte[k])
    posted = distinct.select(F.explode(F.array(*entries)).alias("key"), "fp")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # ends with the last run, which may go on in the next batch

        def edges() -> pa.RecordBatch:
            keys, fps = (np.concatenate(c) for c in zip(*held, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in run_edges(keys, fps, max_bits)], names=["a", "b"])

        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if len(keys) == 0:
                continue
            last = int(np.searchsorted(keys, keys[-1], side="left"))
            if held and (last > 0 or held[-1][0][-1] != keys[-1]):
                held.append((keys[:last], fps[:last]))
                yield edges()
                held = []
            elif last > 0:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in run_edges(keys[:last], fps[:last], max_bits)], names=["a", "b"])
            held.append((keys[last:], fps[last:]))
        if held:
            yield edges()

    dealt = posted.repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(scan, "a long, b long")


def _roots(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fp, root`` of every fingerprint that links to another. ``fps`` is a written table, whose rows cost nothing to count."""
    edges = fingerprint_links(fps.select("fp").distinct(), max_bits)
    about = fps.count() * len(position_sets(8 - max_bits))  # an edge per member and list
    return connected_components(edges, "a", "b", about).select(F.col("node").alias("fp"), "root")


def components(docs: DataFrame, max_bits: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, fingerprint`` (16 lowercase hex digits), ``component_id`` per row.

    The component is the smallest doc_id among all documents reached over
    links. Null, empty and blank texts have fingerprint zero and link like any
    other. Rows that repeat come out each on its own. A null doc_id is never a
    component unless the whole component has none. An empty table gives no
    rows; other columns are not read. Texts are hashed whole.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), fingerprint_column(F.col("text").cast("string"), width, seed).alias("fp")
    )
    fps = written(slim, "fingerprints")
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = written(_roots(fps, max_bits), "roots")
    linked = first.join(roots, "fp")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = roots.join(least, "root").select("fp", "least")
    labels = first.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    hex16 = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(labels, "fp").select("doc_id", hex16.alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, max_bits: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest
    doc_id (nulls last, then the smallest fingerprint); of rows that repeat
    both, one. All columns are kept as they are, whatever their names. Texts are not shuffled.

    Null, empty and blank texts have fingerprint zero and are one component
    with whatever links to it. An empty table gives no rows.
    """
    fp, row = unused_name(docs, "fp"), unused_name(docs, "row")
    # The row numbers are those of the written table, so they stay what they are.
    hashed = docs.withColumn(fp, fingerprint_column(F.col("text").cast("string"), width, seed))
    marked = written(hashed.withColumn(row, F.monotonically_increasing_id()), "fingerprinted")
    fps = marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "fp", "row")
    first = fps.groupBy("fp").agg(F.min(order).alias("best"))
    with_root = first.join(_roots(fps, max_bits), "fp", "left")
    best = with_root.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
    return marked.where(_kept_rows(fps.select("row"), best.select("best.row"))(F.col(row))).drop(fp, row)


def unused_name(table: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of the table has."""
    taken = {c.lower() for c in table.columns}
    while name in taken:
        name = f"_{name}"
    return name


#: A row number is its partition's number shifted by this, and its place there.
_PLACE_BITS = 33


def _kept_rows(every: DataFrame, rows: DataFrame):
    """A predicate on the row numbers ``every``: whether ``rows`` has the number.

    The numbers kept of a partition are a bitmap in the shared folder, which the
    tasks that read that partition's rows open. Only row numbers are shuffled,
    never the rows, and no bitmap is larger than its partition has rows. Each
    partition that has rows gets a bitmap, if only an empty one, and a missing one is an error.
    """
    folder = shared_path(rows.sparkSession, "kept-rows")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        part = None
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            parts = numbers >> _PLACE_BITS
            cuts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(parts)], strict=True):
                if part is not None and parts[lo] != part:
                    yield _write_bitmap(folder, part, held)
                    held = []
                part = int(parts[lo])
                held.append(numbers[lo:hi] & ((1 << _PLACE_BITS) - 1))
        if part is not None:
            yield _write_bitmap(folder, part, held)

    part = F.shiftright("row", _PLACE_BITS)
    # One mark a partition, a place that no row has, so that all partitions come up.
    marks = every.select(F.shiftright("row", _PLACE_BITS).alias("part")).distinct()
    marks = marks.select((F.shiftleft("part", _PLACE_BITS) + F.lit(_NO_PLACE)).alias("row"))
    dealt = rows.unionByName(marks).repartition(part).sortWithinPartitions("row").mapInArrow(write, "part long, kept long")
    dealt.agg(F.sum("kept")).collect()

    @F.arrow_udf("boolean")
    def kept(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at, bitmap = None, np.zeros(0, bool)
        for numbers in batches:
            numbers = numbers.to_numpy()
            out = np.zeros(len(numbers), bool)
            parts = numbers >> _PLACE_BITS
            for p in np.unique(parts):
                if p != at:
                    at, bitmap = p, _read_bitmap(folder, int(p))
                here = np.flatnonzero(parts == p)
                places = numbers[here] & ((1 << _PLACE_BITS) - 1)
                inside = places < len(bitmap)
                out[here[inside]] = bitmap[places[inside]]
            yield pa.array(out)

    return kept


_NO_PLACE = (1 << _PLACE_BITS) - 1


def _write_bitmap(folder: str, part: int, places: list[np.ndarray]) -> pa.RecordBatch:
    places = np.concatenate(places)
    places = places[places != _NO_PLACE]
    bits = np.zeros(int(places.max()) + 1 if len(places) else 0, bool)
    bits[places] = True
    with storage.create(f"{folder}/{part}.bits") as out:
        out.write(np.packbits(bits).tobytes())
    return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([int(bits.sum())])], names=["part", "kept"])


def _read_bitmap(folder: str, part: int) -> np.ndarray:
    with storage.reopen(f"{folder}/{part}.bits") as src:
        return np.unpackbits(np.frombuffer(src.read(), np.uint8)).astype(bool)
