"""Exact distribution figures of many groups without holding a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.session import written

FIGURES = ["total_count", "mean", "min", "max", "zeros", "negatives", "std"]


def value_counts(values: DataFrame, groups: list[str], value: str = "value") -> DataFrame:
    """(groups, value, n): repeats collapse map-side, so a hot value costs one row per task."""
    return values.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("n"))


def in_ranges(counts: DataFrame, groups: list[str], value: str) -> DataFrame:
    """The counts range-partitioned by group and value, with the number of the range as ``_bucket``.

    The number of ranges follows the data. They are written once: ranges come from a sample, and
    several readers need the same ones.
    """
    placed = counts.repartitionByRange(*groups, value).withColumn("_bucket", F.spark_partition_id())
    return written(placed, "values")


def distribution(counts: DataFrame, groups: list[str], probs: dict[str, float], value: str = "value") -> DataFrame:
    """One row per group: count, min, max, mean, std, zeros, negatives and the quantiles.

    ``counts`` holds (groups, value, n). Quantiles are exact and linearly interpolated. The values
    lie in ranges; counting the rows per range tells which ranges hold the wanted ranks, and only
    those are numbered row by row. The spread is taken around the mean, which keeps large values
    with a small spread exact.

    Groups must be few (measured columns, whose number the schema bounds). The facts that are
    broadcast are one row per group and range.
    """
    v, n = F.col(value), F.col("n")
    stored = in_ranges(counts, groups, value)
    per_range = stored.groupBy(*groups, "_bucket").agg(
        F.sum(n).alias("_rows"),
        F.sum(v * n).alias("_sum"),
        F.min(v).alias("_low"),
        F.max(v).alias("_high"),
        F.sum(F.when(v == 0, n).otherwise(0)).alias("_zeros"),
        F.sum(F.when(v < 0, n).otherwise(0)).alias("_negatives"),
    )

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("total_count") - 1)

    def holds(rank: Column, begin: Column, rows: Column) -> Column:
        return (rank >= begin) & (rank < begin + rows)

    in_order = Window.partitionBy(*groups).orderBy("_bucket")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    ranks = F.array(*[f(position(p)) for p in probs.values() for f in (F.floor, F.ceil)])
    facts = per_range.withColumns(
        {
            "_start": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "total_count": F.sum("_rows").over(whole),
            "_near": F.sum("_sum").over(whole) / F.sum("_rows").over(whole),
            "min": F.min("_low").over(whole),
            "max": F.max("_high").over(whole),
            "zeros": F.sum("_zeros").over(whole),
            "negatives": F.sum("_negatives").over(whole),
        }
    ).withColumn("_wanted", F.exists(ranks, lambda r: holds(r, F.col("_start"), F.col("_rows"))))
    facts = facts.drop("_rows", "_sum", "_low", "_high", "_zeros", "_negatives")
    known = stored.join(F.broadcast(facts), [*groups, "_bucket"])

    # Both figures are corrected by what the first mean was off, so they keep their precision however
    # large the values are against their spread, and whatever the order of partial sums.
    count = F.max("total_count")
    off = F.sum(n * (v - F.col("_near"))) / count
    squares = F.greatest(F.sum(n * F.pow(v - F.col("_near"), 2)) - count * off * off, F.lit(0.0))
    figures = known.groupBy(*groups).agg(
        *[F.max(c).alias(c) for c in ("total_count", "min", "max", "zeros", "negatives")],
        (F.max("_near") + off).alias("mean"),
        F.sqrt(F.try_divide(squares, count - 1)).alias("std"),
    )

    running = Window.partitionBy(*groups, "_bucket").orderBy(value)
    at = known.filter("_wanted").withColumn("_begin", F.col("_start") + F.sum("n").over(running) - n)

    def at_rank(rank: Column) -> Column:
        return F.max(F.when(holds(rank, F.col("_begin"), n), v))

    bounds = []
    for name, p in probs.items():
        bounds += [
            at_rank(F.floor(position(p))).alias(f"_lo_{name}"),
            at_rank(F.ceil(position(p))).alias(f"_hi_{name}"),
        ]
    found = figures.join(at.groupBy(*groups).agg(*bounds), groups)

    def interpolate(name: str, p: float) -> Column:
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (low + (high - low) * (position(p) - F.floor(position(p)))).alias(name)

    return found.select(*groups, *FIGURES, *[interpolate(name, p) for name, p in probs.items()])
