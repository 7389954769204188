"""Profiles that add up: sketches per batch, merged over batches, with a stated error.

Of each column a batch stores counts, a HyperLogLog sketch of its values and, if it is a number, a KLL sketch of
their distribution: some kilobytes, however many rows there are. The exact profiles stay the default; these
answer for all batches without reading their rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.operators.cleaning import columns_of, quoted
from tiersmith.operators.profiling import as_text
from tiersmith.sources import paths, store

# 4096 registers: a relative standard error of 1.6 %. KLL with k = 200: a rank is off by 1.7 % at most
# with 99 % probability.
LOG_REGISTERS, KLL_K = 12, 200
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / (1 << LOG_REGISTERS) ** 0.5, 0.0167
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def sketches(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per column: ``column, rows, nulls, distinct, quantiles``, in one aggregate over one scan."""
    cols = cols or df.columns
    numbers = set(columns_of(df, T.NumericType))
    aggregates = [F.count("*").alias("_rows")]
    for i, c in enumerate(cols):
        aggregates += [F.count(quoted(c)).alias(f"_have_{i}"), F.hll_sketch_agg(as_text(df, c), F.lit(LOG_REGISTERS)).alias(f"_hll_{i}")]
        if c in numbers:
            aggregates.append(F.kll_sketch_agg_double(quoted(c).cast("double"), F.lit(KLL_K)).alias(f"_kll_{i}"))
    none = F.lit(None).cast("binary")
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col("_rows").alias("rows"), (F.col("_rows") - F.col(f"_have_{i}")).alias("nulls"),
            F.col(f"_hll_{i}").alias("distinct"), (F.col(f"_kll_{i}") if c in numbers else none).alias("quantiles"),
        )
        for i, c in enumerate(cols)
    ]
    return df.agg(*aggregates).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def keep(df: DataFrame, root: str, batch: str, cols: list[str] | None = None) -> DataFrame:
    """Store the sketches of a batch; the same batch again replaces itself."""
    return store.appended(sketches(df, cols), root, batch)


def merged(spark: SparkSession, root: str) -> DataFrame:
    """The sketches of all batches as one per column."""
    folders = [f"{root}/{n}" for n in paths.names(spark, root) if paths.exists(spark, f"{root}/{n}/_SUCCESS")]
    return merge(spark.read.parquet(*folders))


def merge(rows: DataFrame) -> DataFrame:
    return rows.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def estimates(rows: DataFrame) -> DataFrame:
    """``column, rows, nulls, unique_count`` and quartiles; of text columns the quartiles are null."""
    quantile = lambda at: F.when(
        F.kll_sketch_get_n_double("quantiles") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(at))
    )
    return rows.select(
        "column", "rows", "nulls", F.hll_sketch_estimate("distinct").alias("unique_count"),
        *(quantile(at).alias(name) for name, at in QUARTILES.items()),
    )
