"""Connected components of an edge table by alternating star contractions
(large-star and small-star rounds), as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction over edges ``(a, b)``. Large: every vertex sends its
    larger neighbours to its smallest one; small: its smaller ones."""
    flipped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    near = edges.unionByName(flipped) if large else \
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = near.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: columns ``a, b`` (long), either way round, self-loops and
    repeats allowed, nulls dropped. Returns ``(vertex, root)`` for every
    vertex but the roots, which are the least vertices of their components;
    an empty table gives an empty result.

    Each round is written to the shared folder, so lineage stays short. A
    vertex with very many edges is reduced by partial aggregation; the join
    back is left to Spark's skew handling. Rounds end when the edge set no
    longer changes (its count, sums and hash sum are compared).
    """
    now = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        now = written(_star(_star(now, True), False), "edges")
        state = now.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)")),
                        F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        seen = state
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
