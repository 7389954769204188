"""Aggregates kept up to date from changes: sums, counts and distinct counts that can take rows back.

A batch of changes gives signed rows: what it replaces or deletes counts -1, what it brings +1. Only their
sums per group are stored, in a folder per batch, so keeping an aggregate costs what the batch holds,
and a repeated batch replaces itself. Readers add the folders up. A distinct count is kept as a count of rows per
group and value: a value is there as long as its count is not 0. ``fold`` adds the folders so far into a base
whose list says which ones it holds, so an interrupted fold counts nothing twice.

Sums go through decimals with six places, which makes taking back exact; a value with more places
counts rounded to them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.operators.cleaning import deduplicate
from tiersmith.sources import paths, store

DELETE = "DELETE"
PLACE = "_place"
NUMBER = "decimal(38,6)"
# Rows whose sums one task holds while a fold writes the folders of an aggregate.
RANGE_ROWS = 500_000


def before_and_after(
    known: DataFrame | None, batch: DataFrame, keys: list[str], order: list[str], op: str, path: str | None = None
) -> tuple[DataFrame | None, DataFrame]:
    """The rows a batch of changes takes away and those it brings.

    ``known`` has the last change of each key, deletes included. Of a key's changes in the batch the last by ``order``
    counts, and only if it is later than the known one. With a ``path`` both sides are stored there, so that several readers do not
    work them out again; the batch must have one change of each key then.
    """
    latest = batch if path else deduplicate(batch, keys, "last", order)
    if known is None:
        return None, latest.filter(F.col(op) != DELETE)
    new = latest.select(*keys, F.struct(*latest.columns).alias("_new"))
    old = known.select(*keys, F.struct(*known.columns).alias("_old"))
    both = new.join(old, keys, "left")
    at = lambda side: F.struct(*(F.col(f"{side}.{c}") for c in order))
    takes = both.filter(F.col("_old").isNull() | (at("_new") > at("_old")))
    if path:
        takes.write.parquet(path)
        takes = batch.sparkSession.read.schema(takes.schema).parquet(path)
    before = takes.filter(F.col("_old").isNotNull()).select("_old.*")
    return before.filter(F.col(op) != DELETE), takes.select("_new.*").filter(F.col(op) != DELETE)


@dataclass(frozen=True)
class Kept:
    """An aggregate below ``root``: expressions over a row for its groups, sums and distinct values.

    ``folders`` names a group with few values that becomes a folder level, so that a filter on it rules out files. ``number`` is the type of
    the sums: whole numbers that stay below 2^63 need no decimals.
    """

    root: str
    groups: dict[str, Column]
    sums: dict[str, Column] = field(default_factory=dict)
    distinct: tuple[str, Column] | None = None
    folders: str | None = None
    number: str = NUMBER

    def _by(self) -> list[str]:
        return [*self.groups, *(["_value"] if self.distinct else [])]

    def _added(self, rows: DataFrame) -> DataFrame:
        numbers = [c for c in rows.columns if c == "_rows" or c.startswith(("_sum_", "_have_"))]
        # Where rows are dealt by a number made of their group, it says that a group is in one task.
        place = [c for c in rows.columns if c == PLACE]
        return rows.groupBy(*place, *self._by()).agg(*(F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in numbers)).drop(PLACE)

    def _signed(self, before: DataFrame | None, after: DataFrame) -> DataFrame:
        """The rows a batch takes away and those it brings, each with its sign."""
        values = {f"_sum_{n}": c.cast(self.number) for n, c in self.sums.items()}

        def signed(rows: DataFrame, sign: int) -> DataFrame:
            cells = [c.alias(n) for n, c in self.groups.items()]
            cells += [self.distinct[1].alias("_value")] if self.distinct else []
            own = rows.select(*cells, F.lit(sign).cast("bigint").alias("_rows"), *(v.alias(n) for n, v in values.items()))
            have = {n.replace("_sum_", "_have_", 1): F.when(F.col(n).isNotNull(), F.lit(sign)).otherwise(0).cast("bigint") for n in values}
            own = own.withColumns(have) if have else own
            return own.withColumns({n: (F.coalesce(F.col(n), F.lit(0)) * sign).cast(self.number) for n in values}) if values else own

        rows = signed(after, 1)
        return rows if before is None else signed(before, -1).unionByName(rows)

    def _moved(self, signed: DataFrame) -> DataFrame:
        """Sums of signed rows, of the groups where they are not 0."""
        found = self._added(signed)
        moved = F.lit(False)
        for c in (c for c in found.columns if c not in self._by()):
            moved |= F.col(c) != 0
        return found.filter(moved)

    def deltas(self, before: DataFrame | None, after: DataFrame) -> DataFrame:
        """Signed sums per group (and distinct value); groups where nothing changes have none."""
        return self._moved(self._signed(before, after))

    def apply(
        self, before: DataFrame | None, after: DataFrame, batch: str | int, place: tuple[int, Column] | None = None
    ) -> None:
        """Take a batch in; the same batch again replaces itself.

        ``place`` deals the rows of an aggregate in folders to so many tasks by a number made of their group, for a caller that knows
        how many rows a batch has: to find ranges, the rows would be worked out twice.
        """
        if self.folders:
            rows = self._signed(before, after)
            rows = rows.withColumn(PLACE, place[1]).repartitionById(place[0], PLACE) if place else self._placed(rows, None)
            self._write(self._moved(rows), f"{self.root}/log/batch={batch}")
        else:
            store.appended(self.deltas(before, after), f"{self.root}/log", str(batch))

    def _order(self) -> list[str]:
        return [self.folders, *(g for g in self._by() if g != self.folders)]

    def _placed(self, rows: DataFrame, ranges: int | None) -> DataFrame:
        """Rows in ranges of their groups, ahead of the sums: a task then holds the groups of its range, not those of its input."""
        return rows.repartitionByRange(*([ranges] if ranges else []), *self._order())

    def _write(self, rows: DataFrame, path: str) -> None:
        """Store sums; those of an aggregate in folders are dealt to tasks already."""
        if not self.folders:
            rows.write.mode("overwrite").parquet(path)
            return
        rows.sortWithinPartitions(*self._order()).write.mode("overwrite").partitionBy(self.folders).parquet(path)

    def _folded(self, spark: SparkSession) -> tuple[int, list[str]]:
        versions = sorted(int(n[2:-5]) for n in paths.names(spark, f"{self.root}/folded") if n.startswith("v="))
        if not versions:
            return 0, []
        return versions[-1], json.loads(paths.read_text(spark, f"{self.root}/folded/v={versions[-1]}.json"))

    def _state(self, spark: SparkSession) -> tuple[DataFrame | None, list[str], int]:
        version, done = self._folded(spark)
        names = [n for n in paths.names(spark, f"{self.root}/log") if n.startswith("batch=") and paths.exists(spark, f"{self.root}/log/{n}/_SUCCESS")]
        since = [f"{self.root}/log/{n}" for n in names if n not in done]
        parts = ([f"{self.root}/base/v={version}"] if version else []) + since
        if self.folders:
            # A batch that changed nothing has no file and so no schema.
            parts = [p for p in parts if any(n.startswith(f"{self.folders}=") for n in paths.names(spark, p))]
        rows = [spark.read.parquet(p) for p in parts]
        whole = None
        for r in rows:
            whole = r if whole is None else whole.unionByName(r)
        return whole, [*done, *(n for n in names if n not in done)], version

    def current(self, spark: SparkSession) -> DataFrame | None:
        """The aggregate: groups, ``rows``, sums (null where no row has a value) and the distinct count."""
        whole, _, _ = self._state(spark)
        if whole is None:
            return None
        there = self._added(whole)
        if self.distinct:
            # A null value is no value, but its rows count.
            there = there.withColumn("_there", ((F.col("_rows") > 0) & F.col("_value").isNotNull()).cast("bigint"))
        out = [F.sum("_rows").alias("rows")]
        out += [F.when(F.sum(f"_have_{n}") > 0, F.sum(f"_sum_{n}")).cast("double").alias(n) for n in self.sums]
        out += [F.sum("_there").alias(self.distinct[0])] if self.distinct else []
        return there.groupBy(*self.groups).agg(*out).filter("rows > 0")

    def fold(self, spark: SparkSession) -> None:
        """Add all batches so far into a new base; their folders are removed once its list is written."""
        whole, held, version = self._state(spark)
        if whole is None:
            return
        if self.folders:
            # Stored rows are counted from the footers of their files.
            whole = self._placed(whole, 1 + whole.count() // RANGE_ROWS)
        self._write(self._added(whole), f"{self.root}/base/v={version + 1}")
        paths.write_text(spark, f"{self.root}/folded/v={version + 1}.json", json.dumps(held))
        for name in held:
            paths.delete(spark, f"{self.root}/log/{name}")
