"""Outlier detection on many numeric columns, of one table or several, in one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.functions.numeric import rounded
from tiersmith.operators.profiling import long_numbers
from tiersmith.operators.quantiles import distribution, value_counts

# Fixed values.
Z_THRESHOLD = 3.0
IQR_MULTIPLIER = 1.5
MIN_SAMPLE_SIZE = 10
STATS = {
    "z_score": ["mean", "std", "max_z_score"],
    "iqr": ["q1", "q3", "iqr", "lower_fence", "upper_fence"],
}


def column_stats(counts: DataFrame, groups: list[str], iqr_multiplier: float, min_sample_size: int) -> DataFrame:
    """Mean, spread, quartiles and fences; one row per measured column.

    Columns with too few values are kept and marked: nothing in them counts as an outlier.
    """
    iqr = F.col("q3") - F.col("q1")
    farthest = F.greatest(F.col("max") - F.col("mean"), F.col("mean") - F.col("min"))
    return (
        distribution(counts, groups, {"q1": 0.25, "q3": 0.75})
        .withColumns(
            {
                "enough": F.col("total_count") >= min_sample_size,
                "iqr": iqr,
                "lower_fence": F.col("q1") - iqr_multiplier * iqr,
                "upper_fence": F.col("q3") + iqr_multiplier * iqr,
                "max_z_score": F.try_divide(farthest, F.col("std")),
            }
        )
    )


def is_z_outlier(threshold: float) -> Column:
    """A column without spread has no outliers."""
    z = F.try_divide(F.abs(F.col("value") - F.col("mean")), F.col("std"))
    return F.col("enough") & F.coalesce(z > threshold, F.lit(False))


def is_iqr_outlier() -> Column:
    outside = (F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))
    return F.col("enough") & (F.col("iqr") != 0) & outside


def _detect(
    long: DataFrame, groups: list[str], z_threshold: float, iqr_multiplier: float, min_sample_size: int
) -> DataFrame:
    counts = value_counts(long, groups)
    stats = column_stats(counts, groups, iqr_multiplier, min_sample_size)
    carried = [*STATS["z_score"], *STATS["iqr"], "total_count", "enough"]
    flagged = (
        counts.join(F.broadcast(stats.select(*groups, *carried)), groups)
        .groupBy(*groups)
        .agg(
            F.sum(F.when(is_z_outlier(z_threshold), F.col("n")).otherwise(0)).alias("z_score"),
            F.sum(F.when(is_iqr_outlier(), F.col("n")).otherwise(0)).alias("iqr_outliers"),
            *[F.max(c).alias(c) for c in carried],
        )
    )

    def result(method: str, count: str, threshold: float) -> Column:
        stat_map = F.create_map(*[x for c in STATS[method] for x in (F.lit(c), rounded(c, 4))])
        return F.struct(
            F.lit(method).alias("method"),
            F.col(count).alias("anomaly_count"),
            F.lit(float(threshold)).alias("threshold"),
            stat_map.alias("stats"),
        )

    rows = F.array(result("z_score", "z_score", z_threshold), result("iqr", "iqr_outliers", iqr_multiplier))
    share = rounded(100 * F.col("_r.anomaly_count") / F.col("total_count"), 2)
    status = F.when(F.col("enough"), "checked").otherwise("too few values")
    return flagged.select(*groups, "total_count", "enough", F.explode(rows).alias("_r")).select(
        *groups, "_r.method", F.when(F.col("enough"), F.col("_r.anomaly_count")).alias("anomaly_count"), "total_count",
        F.when(F.col("enough"), share).alias("anomaly_pct"), "_r.threshold", "_r.stats", status.alias("status"),
    )


def detect(
    df: DataFrame, cols: list[str] | None = None, z_threshold: float = Z_THRESHOLD,
    iqr_multiplier: float = IQR_MULTIPLIER, min_sample_size: int = MIN_SAMPLE_SIZE,
) -> DataFrame:
    """Two result rows per column (z_score and iqr). Columns with too few values have no count, and a status."""
    return _detect(long_numbers(df, cols), ["column"], z_threshold, iqr_multiplier, min_sample_size)


def detect_tables(
    tables: dict[str, tuple[DataFrame, list[str]]], z_threshold: float = Z_THRESHOLD,
    iqr_multiplier: float = IQR_MULTIPLIER, min_sample_size: int = MIN_SAMPLE_SIZE,
) -> DataFrame:
    """The same for the given columns of several tables, all in one job."""
    long = [long_numbers(df, cols).withColumn("table_name", F.lit(t)) for t, (df, cols) in tables.items()]
    values = reduce(DataFrame.unionByName, long)
    return _detect(values, ["table_name", "column"], z_threshold, iqr_multiplier, min_sample_size)


def flagged_rows(
    df: DataFrame, ids: list[str], cols: list[str] | None = None, z_threshold: float = Z_THRESHOLD,
    iqr_multiplier: float = IQR_MULTIPLIER, min_sample_size: int = MIN_SAMPLE_SIZE,
) -> DataFrame:
    """(ids, column, value, methods) of every outlying cell.

    The join side is one row per numeric column, so its size is bounded by the schema.
    """
    long = long_numbers(df, cols, ids).filter(F.col("value").isNotNull())
    counts = value_counts(long, ["column"])
    stats = column_stats(counts, ["column"], iqr_multiplier, min_sample_size).select(
        "column", "mean", "std", "iqr", "lower_fence", "upper_fence", "enough"
    )
    return (
        long.join(F.broadcast(stats), "column")
        .withColumns({"is_z_score": is_z_outlier(z_threshold), "is_iqr": is_iqr_outlier()})
        .filter(F.col("is_z_score") | F.col("is_iqr"))
        .select(*ids, "column", "value", "is_z_score", "is_iqr")
    )
