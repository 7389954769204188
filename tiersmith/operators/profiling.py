"""Table and column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.functions.numeric import ratio, rounded
from tiersmith.operators.cleaning import columns_of, quoted
from tiersmith.operators.quantiles import distribution, value_counts

MISSING = "∅"


def as_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    c = quoted(name)
    return F.to_json(c) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")


def row_digest(df: DataFrame, cols: list[str] | None = None, bits: int = 256) -> Column:
    """Digest of the row values. Nulls are spelled out since ``concat_ws`` would skip them."""
    parts = [F.coalesce(as_text(df, c), F.lit(MISSING)) for c in cols or df.columns]
    joined = F.concat_ws("|", *parts)
    return F.md5(joined) if bits == 128 else F.sha2(joined, bits)


def table_profile(df: DataFrame, table_name: str) -> DataFrame:
    """One row of table statistics: one wide scan plus one shuffle of row digests."""
    cols = df.columns
    nulls = df.agg(
        F.count("*").alias("row_count"),
        *[(F.count("*") - F.count(quoted(c))).alias(f"_n{i}") for i, c in enumerate(cols)],
    )
    missing = F.array(*[F.col(f"_n{i}") for i in range(len(cols))])
    cells = F.aggregate(missing, F.lit(0).cast("bigint"), lambda a, x: a + x)
    summary = nulls.select(
        "row_count",
        F.size(F.filter(missing, lambda x: (x == F.col("row_count")) & (x > 0))).alias("empty_columns"),
        F.size(F.filter(missing, lambda x: x > 0)).alias("columns_with_nulls"),
        cells.alias("null_cells"),
    )
    repeats = (
        df.select(row_digest(df).alias("_digest"))
        .groupBy("_digest")
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
    )
    # Two one-row frames become one row: a union and an aggregate instead of a join.
    both = summary.unionByName(repeats, allowMissingColumns=True)
    merged = both.agg(*[F.max(c).alias(c) for c in both.columns])
    pct = rounded(100 * ratio("null_cells", F.col("row_count") * len(cols)), 2)
    return merged.select(
        F.lit(table_name).alias("table_name"),
        "row_count",
        F.lit(len(cols)).alias("column_count"),
        "duplicate_rows",
        "empty_columns",
        "columns_with_nulls",
        "null_cells",
        F.coalesce(pct, F.lit(0.0)).alias("null_pct"),
    )


def null_share(df: DataFrame, by: list[str], cols: list[str] | None = None) -> DataFrame:
    """Row count and share of null cells per partition: one aggregate, no row is moved twice."""
    cols = cols or [c for c in df.columns if c not in by]
    known = sum((F.count(quoted(c)) for c in cols[1:]), F.count(quoted(cols[0])))
    cells = F.count("*") * len(cols)
    return df.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        F.coalesce(rounded(100 * ratio(cells - known, cells), 2), F.lit(0.0)).alias("null_pct"),
    )


def long_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, value) with every value as text: one scan for all columns."""
    cols = cols or df.columns
    texts = df.select(*[as_text(df, c).alias(c) for c in cols])
    return texts.unpivot([], [quoted(c) for c in cols], "column", "value")


def long_numbers(df: DataFrame, cols: list[str] | None = None, ids: list[str] | None = None) -> DataFrame:
    cols = cols or columns_of(df, T.NumericType)
    ids = ids or []
    # Key columns may be measured too, so they travel under their own names.
    held = df.select(
        *[quoted(c).alias(f"_id_{c}") for c in ids], *[quoted(c).try_cast("double").alias(c) for c in cols]
    )
    long = held.unpivot([f"_id_{c}" for c in ids], [quoted(c) for c in cols], "column", "value")
    return long.withColumnsRenamed({f"_id_{c}": c for c in ids})


def text_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, value, n), null included as a value."""
    return long_text(df, cols).groupBy("column", "value").agg(F.count("*").alias("n"))


def identity(c: Column) -> Column:
    """The value's digest: long texts need not travel to be counted."""
    return F.sha2(c, 256)


def column_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null and distinct counts and shares of every column from one table of value counts."""
    wanted = cols or df.columns
    types = F.create_map(*[F.lit(x) for c in wanted for x in (c, df.schema[c].dataType.simpleString())])
    rows = F.sum("n")
    nulls = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    counts = (
        long_text(df, wanted)
        .groupBy("column", identity(F.col("value")).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    return (
        counts.groupBy("column")
        .agg(
            rows.alias("total_rows"),
            nulls.alias("null_count"),
            rounded(100 * ratio(nulls, rows), 2).alias("null_pct"),
            F.count("value").alias("unique_count"),
            rounded(100 * ratio(F.count("value"), rows), 2).alias("unique_pct"),
        )
        .withColumn("dtype", types[F.col("column")])
    )


def numeric_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Moments, quartiles, zeros and negatives of the numeric columns."""
    counts = value_counts(long_numbers(df, cols), ["column"])
    found = distribution(counts, ["column"], {"q25": 0.25, "median": 0.5, "q75": 0.75})
    found = found.withColumn("std", F.coalesce("std", F.lit(0.0)))
    figures = {c: rounded(c, 4) for c in ("mean", "std", "q25", "median", "q75")}
    return found.withColumns(figures).drop("total_count")


def string_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    size = F.length("value")
    return (
        long_text(df, cols or columns_of(df, T.StringType))
        .filter(F.col("value").isNotNull())
        .groupBy("column")
        .agg(
            F.min(size).alias("min_length"),
            F.max(size).alias("max_length"),
            rounded(ratio(F.sum(size), F.count("*")), 1).alias("avg_length"),
            F.count_if(F.col("value") == "").alias("empty_strings"),
        )
    )


def top_values(df: DataFrame, cols: list[str] | None = None, k: int = 5) -> DataFrame:
    """The k most frequent values per column. Ties go to the smaller value.

    Spark cuts each map task to its k best rows per column before the window's shuffle.
    """
    best = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return (
        text_counts(df, cols or columns_of(df, T.StringType))
        .filter(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
    )


def date_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or columns_of(df, T.DateType, T.TimestampType, T.TimestampNTZType)
    long = df.select(*[quoted(c).cast("timestamp").alias(c) for c in cols]).unpivot(
        [], [quoted(c) for c in cols], "column", "value"
    )
    seconds = F.unix_timestamp(F.max("value")) - F.unix_timestamp(F.min("value"))
    return long.groupBy("column").agg(
        F.min("value").alias("min_date"),
        F.max("value").alias("max_date"),
        F.floor(seconds / 86400).alias("range_days"),
    )


def boolean_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or columns_of(df, T.BooleanType)
    long = df.select(*map(quoted, cols)).unpivot([], [quoted(c) for c in cols], "column", "value")
    return long.groupBy("column").agg(
        F.count_if("value").alias("true_count"),
        F.count_if(~F.col("value")).alias("false_count"),
        rounded(100 * ratio(F.count_if("value"), F.count("value")), 2).alias("true_pct"),
    )


def profile_warnings(profile: DataFrame) -> DataFrame:
    """Warnings from a column profile: empty, mostly null, constant, likely an id column."""
    pct, uniques = F.col("null_pct"), F.col("unique_count")

    def warn(condition: Column, severity: str, text: Column) -> Column:
        return F.when(condition, F.struct(F.lit(severity).alias("severity"), text.alias("warning")))

    found = F.array(
        warn(pct == 100, "CRITICAL", F.lit("Column is completely empty")),
        warn((pct > 50) & (pct < 100), "WARNING", F.concat(F.lit("High null percentage: "), pct, F.lit("%"))),
        warn((uniques == 1) & (pct < 100), "INFO", F.lit("Column has only one unique value")),
        warn(
            (F.col("unique_pct") > 95) & (F.col("dtype") == "string"),
            "INFO",
            F.concat(F.lit("Very high cardinality: "), F.col("unique_pct"), F.lit("%")),
        ),
    )
    return profile.select("column", F.explode(F.filter(found, lambda w: w.isNotNull())).alias("_w")).select(
        "column", "_w.severity", "_w.warning"
    )
