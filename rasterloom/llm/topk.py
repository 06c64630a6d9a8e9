"""Exact top-k by inner product: no-random-access aggregation over sorted lists.

The candidates are dealt into blocks. A block holds, for every component, its
list: the rows' numbers and values from the largest value to the smallest. For a
query each list is read from its best end, all to the same depth: from the top
where the query's component is positive, from the bottom where it is negative.

A candidate's score then lies between two bounds: components read count as
they are; one not read counts as at most the last value read in its list (the
upper bound) or at least the value at the list's far end (the lower bound).
Candidates whose upper bound falls below the k-th best lower bound are out. When
no more than k are left, no outsider can qualify, and the lists are read on only
until the missing components of those that are left have come up, which resolves
their scores. Nothing is ever looked up by row.

Lists and queries are written once. The work is a grid of query blocks and runs
of candidate blocks in one job; a task keeps, for every query, the best k of the
blocks it has read, whose k-th score bounds the next ones.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rasterloom.session import delete, shared_path, written
from rasterloom.sources import storage

#: Components of a block of candidates and of a block of queries, and rows of it at most.
BLOCK_VALUES, BLOCK_ROWS, BLOCK_QUERIES = 1 << 19, 8192, 1024
#: Candidate blocks that a task reads for a query block at most.
RUN_BLOCKS = 64
#: Share of each list read at first; then the depth is doubled.
FIRST_DEPTH = 1 / 8
#: Queries that are read side by side.
SIDE_BY_SIDE = 128


class Best:
    """The k best (score, id) of each query so far; equal scores go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores: list[np.ndarray] = [np.empty(0, np.int64)] * queries
        self.ids: list[np.ndarray] = [np.empty(0, np.int64)] * queries
        self.least: list[float] = [-np.inf] * queries

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[q], scores]), np.concatenate([self.ids[q], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[q], self.ids[q] = scores[order], ids[order]
        if len(order) == self.k:
            self.least[q] = float(self.scores[q][-1])


@dataclass
class Lists:
    """A block: ``order[j]`` are row numbers and ``values[j]`` their component j, from the largest down."""

    ids: np.ndarray
    order: np.ndarray
    values: np.ndarray

    def largest(self) -> int:
        return max((abs(int(v)) for v in (self.values.min(), self.values.max())), default=0) if self.values.size else 0


def sorted_lists(ids: np.ndarray, rows: np.ndarray) -> Lists:
    order = np.argsort(-rows, axis=0, kind="stable").T
    values = np.take_along_axis(rows.T, order, axis=1)
    return Lists(ids, np.ascontiguousarray(order), values)


def search_lists(lists: Lists, queries: np.ndarray, query_ids: np.ndarray, best: Best, first: int = 0) -> np.ndarray:
    """Adds a block's rows to the best of the queries, which are numbers ``first``.. of ``best``; the list entries read for each.

    The queries of a call are read side by side, as they share the lists.
    Values are integers in float64 whose sums are exact.
    """
    n, k = len(lists.ids), best.k
    rising, falling = np.minimum(queries, 0), np.maximum(queries, 0)  # weights of lists read from the bottom, from the top
    far = falling @ lists.values[:, -1] + rising @ lists.values[:, 0]
    entries = np.zeros(len(queries), np.int64)
    # Components known, by row; and whether a row has come up in a list read from the top, from the bottom.
    known = np.zeros((n, len(queries)))
    top, bottom = np.zeros((n, lists.order.shape[0])), np.zeros((n, lists.order.shape[0]))
    going, depth = np.arange(len(queries)), 0
    while len(going):
        to = min(n, max(k + 1, int(n * FIRST_DEPTH)) if depth == 0 else 2 * depth)
        for j, (rows, values) in enumerate(zip(lists.order, lists.values, strict=True)):
            for weights, seen, part in ((falling, top, slice(depth, to)), (rising, bottom, slice(n - to, n - depth))):
                if weights[going, j].any():
                    known[rows[part]] += values[part, None] * weights[going, j]
                seen[rows[part], j] = 1
        depth = to
        entries[going] = depth * np.count_nonzero(queries[going], axis=1)
        left, lower = _bounds(lists, falling[going], rising[going], far[going], known, top, bottom, depth)
        own = lists.ids[:, None] == query_ids[None, going]
        left[own] = lower[own] = -np.inf
        bar = np.array([best.least[first + q] for q in going])
        if n >= k:
            bar = np.maximum(bar, np.partition(lower, n - k, axis=0)[n - k])
        left = (left >= bar) & ~own
        done = (left.sum(axis=0) <= k) | (depth == n)
        for at in np.flatnonzero(done):
            q, rows = going[at], np.flatnonzero(left[:, at])
            scores = known[rows, at]
            if depth < n and len(rows):
                entries[q] += _read_on(lists, queries[q], depth, rows, scores, np.where(queries[q] > 0, top[rows], bottom[rows]) == 0)
            best.add(first + int(q), scores.astype(np.int64), lists.ids[rows])
        if depth == n:
            break
        if done.any():
            going, known = going[~done], np.ascontiguousarray(known[:, ~done])
    return entries


def _bounds(lists: Lists, falling: np.ndarray, rising: np.ndarray, far: np.ndarray, known: np.ndarray, top: np.ndarray, bottom: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """[row, query] upper and lower bounds: a component that has not come up is at most the last value read, at least the far end's."""
    n = len(known)
    if depth == n:
        return known.copy(), known.copy()
    last_top, last_bottom = lists.values[:, depth - 1], lists.values[:, n - depth]
    most = falling @ last_top + rising @ last_bottom
    upper = known + most - (top @ (falling * last_top).T + bottom @ (rising * last_bottom).T)
    lower = known + far - (top @ (falling * lists.values[:, -1]).T + bottom @ (rising * lists.values[:, 0]).T)
    return upper, lower


def _read_on(lists: Lists, query: np.ndarray, depth: int, found: np.ndarray, scores: np.ndarray, missing: np.ndarray) -> int:
    """Reads each list on until all rows found have come up in it; adds their products to ``scores``. The entries read."""
    entries, n = 0, len(lists.ids)
    place = np.full(n, -1)
    for j in np.flatnonzero((query != 0) & missing.any(axis=0)):
        rows, values = lists.order[j], lists.values[j]
        if query[j] < 0:
            rows, values = rows[::-1], values[::-1]
        place[found] = np.where(missing[:, j], np.arange(len(found)), -1)
        hits = depth + np.flatnonzero(place[rows[depth:]] >= 0)
        scores[place[rows[hits]]] += query[j] * values[hits]
        entries += int(hits[-1]) + 1 - depth
    return entries


def _exact_in_floats(largest: int, width: int) -> bool:
    """Whether every inner product and the sums on the way to it fit the 53 bits of float64."""
    return 2 * largest * max(1, width) < 2**53


def _add_large(lists: Lists, query: np.ndarray, query_id: int, best: Best, q: int) -> None:
    """Sums products of any size from the whole lists; a score outside 64 bits is an error."""
    scores = np.zeros(len(lists.ids), object)
    for j, factor in enumerate(query.tolist()):
        scores[lists.order[j]] += factor * lists.values[j].astype(object)
    other = lists.ids != query_id
    best.add(q, scores[other].astype(np.int64), lists.ids[other])


# Files of blocks: counts, the size of a value, then ids and arrays.
_HEAD = "<QQB"


def _write_lists(folder: str, ids: np.ndarray, rows: np.ndarray) -> str:
    lists = sorted_lists(ids, rows)
    small = np.int32 if lists.largest() < 2**31 else np.int64
    uri = f"{folder}/lists-{uuid.uuid4().hex}"
    with storage.create(uri) as out:
        out.write(struct.pack(_HEAD, *rows.shape, np.dtype(small).itemsize))
        for array in (ids.astype("<i8"), lists.order.astype("<u2"), lists.values.astype(small)):
            out.write(np.ascontiguousarray(array).tobytes())
    return uri


def _read_lists(uri: str) -> Lists:
    with storage.reopen(uri) as src:
        n, width, size = struct.unpack(_HEAD, src.read(struct.calcsize(_HEAD)))
        ids = np.frombuffer(src.read(8 * n), "<i8")
        order = np.frombuffer(src.read(2 * n * width), "<u2").reshape(width, n).astype(np.intp)
        values = np.frombuffer(src.read(size * n * width), f"<i{size}").reshape(width, n).astype(np.int64)
    return Lists(ids, order, values)


def _write_queries(folder: str, ids: np.ndarray, rows: np.ndarray) -> str:
    uri = f"{folder}/queries-{uuid.uuid4().hex}"
    with storage.create(uri) as out:
        out.write(struct.pack(_HEAD, *rows.shape, 8) + ids.astype("<i8").tobytes() + np.ascontiguousarray(rows, "<i8").tobytes())
    return uri


def _read_queries(uri: str) -> tuple[np.ndarray, np.ndarray]:
    with storage.reopen(uri) as src:
        n, width, _ = struct.unpack(_HEAD, src.read(struct.calcsize(_HEAD)))
        return np.frombuffer(src.read(8 * n), "<i8"), np.frombuffer(src.read(8 * n * width), "<i8").reshape(n, width)


def _blocks(vectors: DataFrame, folder: str, most: int, write) -> DataFrame:
    """``path, width, rows`` of block files of vectors of one length each, as a written table: what the job has committed."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def flush(width: int) -> pa.RecordBatch:
            ids, rows = (np.concatenate(c) for c in zip(*held.pop(width), strict=True))
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (write(folder, ids, rows), width, len(ids))], names=["path", "width", "rows"])

        for batch in batches:
            ids, found = batch.column(0).to_numpy(), batch.column(1)
            lengths = pa.compute.list_value_length(found).to_numpy()
            for width in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == width)
                rows = found.take(pa.array(at)).flatten().to_numpy().reshape(len(at), width)
                room = max(1, min(most, BLOCK_VALUES // max(1, width)))
                done = 0
                while done < len(at):
                    free = room - sum(len(i) for i, _ in held.get(width, ()))
                    held.setdefault(width, []).append((ids[at[done : done + free]], rows[done : done + free]))
                    done += free
                    if sum(len(i) for i, _ in held[width]) >= room:
                        yield flush(width)
        for width in list(held):
            yield flush(width)

    return written(vectors.select("vec_id", "vector").mapInArrow(make, "path string, width long, rows long"), "blocks")


def _search(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, paths in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids, queries = _read_queries(uri)
            best = Best(len(ids), k)
            largest = int(np.abs(queries).max()) if queries.size else 0
            exact = queries.astype(np.float64)
            for path in sorted(paths):
                lists = _read_lists(path)
                if _exact_in_floats(largest * lists.largest(), queries.shape[1]):
                    lists = Lists(lists.ids, lists.order, lists.values.astype(np.float64))
                    for first in range(0, len(ids), SIDE_BY_SIDE):
                        some = slice(first, first + SIDE_BY_SIDE)
                        search_lists(lists, exact[some], ids[some], best, first)
                else:
                    for q, vector in enumerate(queries):
                        _add_large(lists, vector, ids[q], best, q)
            for q, (scores, found) in enumerate(zip(best.scores, best.ids, strict=True)):
                if len(found):
                    columns = [pa.array([uri] * len(found)), pa.array(np.full(len(found), q)), pa.array(np.full(len(found), ids[q])), pa.array(found), pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(columns, names=["block", "q", "query_id", "vec_id", "score"])


def integer_vectors(table: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, vector``: floor(scale * x) of each component as double, x as long.

    Vectors that are null or hold a null or non-finite component, and rows with
    a null vec_id, take no part. A component outside 64 bits after scaling is an error.
    """
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)

    def scaled(x):
        at = F.floor(x * F.lit(float(scale)))
        return F.when(F.abs(x * F.lit(float(scale))) < F.lit(float(2**63)), at).otherwise(F.raise_error(F.lit("a component is outside 64 bits")))

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(vector, scaled).alias("vector"))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query row.

    Both are tables of ``vec_id, vector`` (array of long). A query's own vec_id
    is no candidate. Scores that tie go to the smaller vec_id; candidates that
    repeat are ranked each on its own; query rows that share an id, with equal
    or different vectors, are each searched and ranked on their own. A query only
    meets vectors of its own length. A query without any candidate has no row;
    empty tables give none. A score outside 64 bits is an error.

    Candidates are sorted into lists once and queries written once; each query
    block meets each run of candidate blocks in one task, which sends k rows per
    query to the final ranking.
    """
    spark = candidates.sparkSession
    folder = shared_path(spark, "top-k")
    lists = _blocks(candidates, folder, BLOCK_ROWS, _write_lists)
    count = queries.count()
    if count > 0:
        queries = queries.repartition(-(-count // BLOCK_QUERIES))
    asked = _blocks(queries, folder, BLOCK_QUERIES, _write_queries)
    n_lists, n_asked = lists.count(), asked.count()
    parallel = 2 * spark.sparkContext.defaultParallelism
    runs = max(1, -(-n_lists // RUN_BLOCKS), min(n_lists, -(-parallel // max(1, n_asked))))
    # Block files, not rows, are paired: each query block with each run of candidate blocks.
    dealt = lists.select("width", F.col("path").alias("lists"), (F.row_number().over(Window.partitionBy("width").orderBy("path")) % runs).alias("run"))
    every = asked.select("width", F.col("path").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run"))
    units = every.join(dealt, ["width", "run"]).groupBy("queries", "run").agg(F.collect_list("lists").alias("lists"))
    units = units.select("queries", "lists").repartition(max(1, min(10_000, n_asked * runs)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(k, batches)

    found = written(units.mapInArrow(search, "block string, q long, query_id long, vec_id long, score long"), "top-k-found")
    delete(spark, folder)
    order = Window.partitionBy("block", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
