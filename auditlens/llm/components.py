"""Connected components by alternating large-star and small-star steps on an edge table.

Each step is a grouped minimum and a join, so a node of very high degree is combined before
it is shuffled and its joined rows can be split. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.packed import stored


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long); root is the smallest node.

    No edges give no rows; loops and repeated or reversed edges change nothing; edges with a
    null end are ignored.
    """
    a, b = F.col("a"), F.col("b")
    edges = edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges, before = stored(edges, "edges"), None
    while (now := _signature(edges)) != before:
        before = now
        if not now[0]:
            break
        both = edges.union(edges.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.least(a, F.min("b")).alias("m"))
        large = both.filter(b > a).join(low, "a").select(b.alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.inline(F.array(F.struct(b.alias("a"), F.col("m").alias("b")), F.struct(a, F.col("m").alias("b")))))
        edges = stored(small.filter(a != b).distinct(), "edges")
    roots = edges.select(b.alias("node"), b.alias("root")).distinct()
    return edges.select(a.alias("node"), b.alias("root")).union(roots)
