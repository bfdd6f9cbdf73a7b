"""Connected components of a graph given by its edges, by alternating large and small stars.

Every step is a partial minimum per vertex, a join and a distinct, each written before the next. The minima are settled
first, so that the join's two sides are plain shuffles and the rows of a vertex with very many neighbours can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import settle


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    met = both.join(least, "u")
    if larger:
        out = met.where("v > u")
    else:
        out = met.where("v < u").unionByName(least.select("u", F.col("u").alias("v"), "m"))
    out = out.where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
    return settle(out, "edges")


def components(edges: DataFrame) -> DataFrame:
    """Columns v and label: the smallest vertex that v reaches, for every v that is not the smallest itself.

    ``edges`` has long columns a and b; the direction and repeats don't matter.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges, state = settle(edges, "edges"), None
    while True:
        edges = _star(_star(edges, larger=True), larger=False)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("b").alias("v"), F.col("a").alias("label"))
        state = now
