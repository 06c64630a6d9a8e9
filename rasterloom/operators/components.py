"""Connected components by alternating large-star and small-star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.session import discard, written

#: Edges a file of a table holds, where there are more than a file for each core.
FILE_EDGES = 1 << 20


def _in_files(edges: DataFrame, n: int) -> DataFrame:
    """``edges``, about ``n`` of them, in no more partitions than they need."""
    return edges.coalesce(max(edges.sparkSession.sparkContext.defaultParallelism, n // FILE_EDGES + 1))


def connected_components(edges: DataFrame, a: str, b: str, about: int | None = None) -> DataFrame:
    """``node, root`` for every node of an edge; the root is the least node reached.

    Rounds grow with the logarithm of the longest path. Minima are aggregated
    map-side and joined back, so the centre of a large star is no hot window.
    Each round is written to the shared folder, which bounds the lineage; its
    files follow the number of edges, whatever the number of shuffle partitions.
    The first table's do so if ``about`` says how many edges to expect; it sets
    nothing but files.
    Edges with a null end and loops carry no link; an empty edge table gives no rows.
    """
    kind = edges.schema[a].dataType
    cur = edges.select(F.col(a).alias("u"), F.col(b).cast(kind).alias("v")).where("u <> v").distinct()
    cur = written(cur if about is None else _in_files(cur, about), "edges")
    n = cur.count()  # no round adds edges
    while not _stars(cur):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u")
        hooked = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = hooked.unionByName(floor.withColumnRenamed("m", "v")).distinct()
        after = written(_in_files(after, n), "edges")
        discard(cur)
        cur = after
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every edge goes from a node to a lesser one that has no edge of its own, each node's only one."""
    if not edges.where("u < v").isEmpty() or not edges.groupBy("u").count().where("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").isEmpty()
