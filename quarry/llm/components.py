"""Distributed connected components over an edge table.

Alternates the large-star and small-star steps (every node points its larger,
then its smaller neighbours at the smallest node it knows) until the edge set
stops changing, which takes a number of rounds logarithmic in the longest
chain.  Every round is written to the shared folder, so lineage stays short
and a lost executor costs one round's tasks at most.  A star's centre may
hold a third of all edges: its minimum is a partial aggregate, and joins back
are plain equi-joins, which adaptive execution splits.

Defined results: edges with a null end and loops are ignored; repeated edges
count once; an empty table has no components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import store


#: Edges that one file of a round holds, at most.
EDGES_PER_FILE = 200_000


def _print(edges: DataFrame) -> tuple:
    """Size and order-free checksum of an edge table."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has
    an edge."""
    edges = store(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") > F.col("v")))
        .distinct(), "edges")
    last = _print(edges)
    while last[0]:
        # a round never has more edges, or nodes with edges, than twice those of the one before
        files = -(-last[0] // EDGES_PER_FILE)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that adaptive execution can split the join of a star's centre; in the
        # small-star step the centre, being the smallest, is nobody's larger end
        low = store(both.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
                    .coalesce(files), "minima")
        large = (both.where("v > u").join(low, F.col("u") == F.col("n"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        small = (large.join(low, F.col("u") == F.col("n"))
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u > v").distinct())
        edges = store(small.coalesce(files), "edges")
        now = _print(edges)
        if now == last:
            break
        last = now
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
