"""Connected components of an edge table, by alternating large-star and small-star joins.

Edges and labels stay in tables; each round is written to the shared folder. A hub's neighbours are
never collected: the smallest neighbour is an aggregate, and the join that hands it out is split by
adaptive execution where a hub is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.scratch import stored


def _stars(pairs: DataFrame) -> DataFrame:
    """``(a, b)`` with a's smallest neighbour, itself included, as ``low``.

    The aggregate is written first: were it planned into the join, both would share one exchange, and
    Spark could not split a hub's rows.
    """
    low = pairs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("low"))
    low = stored(low, "stars")
    return pairs.join(low, pairs["a"] == low["k"]).select("a", "b", "low")


def labels(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; root is the least node it is linked to."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _stars(both).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        # A node now points below itself only; its larger neighbours have been handed on.
        star = _stars(large)
        small = star.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(star.select("a", F.col("low").alias("b")))
        nxt = stored(small.where("a <> b").distinct(), "edges")
        # Done when every node has one edge and no root has a parent: all are stars.
        more = nxt.join(nxt.select(F.col("a").alias("c")), F.col("b") == F.col("c"), "left_semi").limit(1).count()
        twice = 0 if more else nxt.groupBy("a").count().where("count > 1").limit(1).count()
        now = nxt
        if not more and not twice:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
