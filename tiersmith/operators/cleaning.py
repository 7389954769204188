"""Schema-generic cleaning steps, each DataFrame -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.functions.text import snake_case, unique_names
from tiersmith.session import written

TYPE_NAMES = {
    "string": "string", "str": "string",
    "integer": "bigint", "int": "bigint",
    "float": "double", "numeric": "double", "decimal": "double",
    "date": "date", "datetime": "timestamp",
    "boolean": "boolean", "bool": "boolean",
}


def standardize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names([snake_case(c) for c in df.columns]))


def columns_of(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def tick(name: str) -> str:
    """A name as SQL takes it literally."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str):
    return F.col(tick(name))


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip white space from string columns. Arrays, structs and nulls stay as they are."""
    return df.withColumns(
        {c: F.regexp_replace(quoted(c), r"^\s+|\s+$", "") for c in columns_of(df, T.StringType)}
    )


def fill_nulls(df: DataFrame, numeric_fill: float | None = None, string_fill: str | None = None) -> DataFrame:
    if numeric_fill is not None and (cols := columns_of(df, T.NumericType)):
        df = df.fillna(numeric_fill, subset=cols)
    if string_fill is not None and (cols := columns_of(df, T.StringType)):
        df = df.fillna(string_fill, subset=cols)
    return df


def cast_types(df: DataFrame, type_map: dict[str, str] | None) -> DataFrame:
    """Coercing casts by column name. A bad value becomes null, a missing column is skipped."""
    casts = {}
    for name, kind in (type_map or {}).items():
        if name not in df.columns:
            continue
        if kind not in TYPE_NAMES:
            raise ValueError(f"unknown type '{kind}' for column '{name}'")
        source, target = quoted(name), TYPE_NAMES[kind]
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        if target == "bigint" and is_text:
            # "12.0" is a number, so read it as one before dropping the fraction.
            casts[name] = source.try_cast("double").try_cast("bigint")
        elif target == "date" and is_text:
            casts[name] = source.try_cast("timestamp").cast("date")
        else:
            casts[name] = source.try_cast(target)
    return df.withColumns(casts) if casts else df


def deduplicate(
    df: DataFrame,
    subset: list[str] | None = None,
    keep: str | bool = "last",
    order_by: list[str] | None = None,
) -> DataFrame:
    """Drop duplicate rows; ``keep`` is "first", "last" or False (drop every row that repeats).

    Without ``subset`` all columns count but those starting with ``_``. "First" and "last" follow
    ``order_by``, or the values of all columns where none is given, so the answer never depends on
    the layout of the files. Everything is one aggregate with map-side combine: a key that holds
    a large share of the rows collapses before the shuffle.
    """
    keys = subset or [c for c in df.columns if not c.startswith("_")]
    rest = [c for c in df.columns if c not in keys]
    if keep is False:
        picked = [F.min(F.struct(*map(quoted, rest or keys))).alias("_row"), F.count("*").alias("_n")]
        once = df.groupBy(*map(quoted, keys)).agg(*picked).filter(F.col("_n") == 1)
    else:
        if not rest:
            return df.dropDuplicates(keys)
        row = F.struct(*map(quoted, rest))
        if order_by:
            picked = (F.max_by if keep == "last" else F.min_by)(row, F.struct(*map(quoted, order_by)))
        else:
            # A row is its own order, so it is shuffled once.
            picked = (F.max if keep == "last" else F.min)(row)
        once = df.groupBy(*map(quoted, keys)).agg(picked.alias("_row"))
    return once.select(*[F.col("_row")[c].alias(c) if c in rest else quoted(c) for c in df.columns])


def _has_number(kind: T.DataType) -> bool:
    """Whether equal values of a type have equal hashes: maps and variants have none."""
    if isinstance(kind, T.ArrayType):
        return _has_number(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_has_number(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


# Repeated keys that may be sent to every task: 8 MB of numbers.
FEW_REPEATS = 1_000_000


def deduplicate_stored(
    df: DataFrame,
    subset: list[str] | None = None,
    keep: str | bool = "last",
    order_by: list[str] | None = None,
) -> DataFrame:
    """The rows of ``deduplicate``, for stored rows few of which repeat: only those that may repeat are shuffled whole.

    All rows are asked for a hash of their key first. Rows whose hash is there once stay where they are; the others go
    through ``deduplicate``, and all rows do where too many hashes repeat. ``df`` is read twice or three times.
    """
    keys = subset or [c for c in df.columns if not c.startswith("_")]
    if not keys or not all(_has_number(df.schema[c].dataType) for c in keys):
        return deduplicate(df, subset, keep, order_by)
    # Groups know one zero only, and so do rows that are in none.
    floats = {c: (quoted(c) + F.lit(0).cast(df.schema[c].dataType)).alias(c) for c in keys if isinstance(df.schema[c].dataType, T.FractionalType)}
    df = df.select(*(floats.get(c, quoted(c)) for c in df.columns))
    number = F.xxhash64(*map(quoted, keys))
    repeats = written(df.select(number.alias("_number")).groupBy("_number").agg(F.count("*").alias("_n")).filter("_n > 1").select("_number"), "repeats")
    found = repeats.count()
    if not found:
        return df
    if found > FEW_REPEATS:
        return deduplicate(df, subset, keep, order_by)
    marked = df.withColumn("_number", number)
    alone, again = (marked.join(F.broadcast(repeats), "_number", how).select(*map(quoted, df.columns)) for how in ("left_anti", "left_semi"))
    return alone.unionByName(deduplicate(again, subset, keep, order_by))


def prepare(
    df: DataFrame,
    type_map: dict[str, str] | None = None,
    numeric_fill: float | None = None,
    string_fill: str | None = None,
) -> DataFrame:
    """All steps of ``clean`` that work row by row."""
    return (
        df.transform(standardize_columns)
        .transform(trim_strings)
        .transform(fill_nulls, numeric_fill, string_fill)
        .transform(cast_types, type_map)
    )


def clean(
    df: DataFrame,
    type_map: dict[str, str] | None = None,
    dedup_columns: list[str] | None = None,
    order_by: list[str] | None = None,
    numeric_fill: float | None = None,
    string_fill: str | None = None,
) -> DataFrame:
    return deduplicate(prepare(df, type_map, numeric_fill, string_fill), dedup_columns, "last", order_by)
