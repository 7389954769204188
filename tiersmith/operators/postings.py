"""A search index that follows changes: postings per term, kept as sums that can take rows back.

A text gives one posting per term: how often the term stands in it and how many words the text has, each word
counted with the weight of its column. Postings are a kept aggregate, so a batch of new, changed and deleted
texts writes only what it changes. They lie in folders by hash of the term, so a question reads the folders of its
terms and a frequent term covers several files; a fold puts them in ranges of term and key inside.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.functions.numeric import rounded
from tiersmith.functions.text import query_terms, tokens
from tiersmith.operators.incremental import Kept

PART = "_part"
# Bytes of text whose postings one task holds: some 500,000 of them.
PIECE = 4 << 20


@dataclass(frozen=True)
class SearchIndex:
    """An index below ``root`` over the texts of ``weights`` (column: weight, a whole number), by ``key``.

    Null and empty texts have no postings, but count as rows; rows with a null key are left out. ``parts`` is the number of folders and may not
    change once the index has rows.
    """

    root: str
    key: str
    weights: dict[str, int]
    parts: int = 64

    def _part(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.parts)).cast("int")

    def _postings(self) -> Kept:
        groups = {PART: self._part(F.col("term")), "term": F.col("term"), self.key: F.col(self.key)}
        sums = {"frequency": F.col("frequency"), "words": F.col("words")}
        return Kept(f"{self.root}/postings", groups, sums, folders=PART, number="bigint")

    def _rows(self) -> Kept:
        return Kept(f"{self.root}/rows", {"all": F.lit(0)})

    def postings_of(self, df: DataFrame, tasks: int | None = None) -> DataFrame:
        """(term, key, frequency, words) of the texts in ``df``, which has a row per key.

        Words are counted inside the row of their text, so a task holds one text at a time and not all postings
        of its texts. ``tasks`` says into how many tasks the texts are dealt.
        """
        have = [c for c in self.weights if c in df.columns]
        if not have:
            raise ValueError(f"none of the columns {sorted(self.weights)} is there")

        def weighed(c: str) -> Column:
            n = F.lit(self.weights[c]).cast("bigint").alias("n")
            return F.transform(tokens(F.col(c).cast("string")), lambda x: F.struct(x.alias("term"), n))

        texts = df.filter(F.col(self.key).isNotNull()).select(self.key, *have)
        texts = texts.repartition(tasks, self.key) if tasks else texts
        cut = texts.select(self.key, F.concat(*map(weighed, have)).alias("_cut"))
        # Rows of the same key are one text.
        whole = cut.groupBy(self.key).agg(F.sort_array(F.flatten(F.collect_list("_cut"))).alias("_all"))
        every, at = F.col("_all"), F.col("_at")
        first = lambda x, i: (i == 0) | (x["term"] != F.get(every, i - 1)["term"])
        places = F.transform(every, lambda x, i: F.when(first(x, i), i))
        found = whole.select(
            self.key, "_all", F.filter(places, lambda i: i.isNotNull()).alias("_at"),
            F.aggregate(every, F.lit(0).cast("bigint"), lambda n, x: n + x["n"]).alias("words"),
        )

        def posting(start: Column, k: Column) -> Column:
            own = F.slice(every, start + 1, F.coalesce(F.get(at, k + 1), F.size(every)) - start)
            frequency = F.aggregate(own, F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
            return F.struct(F.get(every, start)["term"].alias("term"), frequency.alias("frequency"))

        postings = found.select(self.key, "words", F.explode(F.transform(at, posting)).alias("_p"))
        return postings.select(F.col("_p.term").alias("term"), self.key, F.col("_p.frequency").alias("frequency"), "words")

    def _tasks(self, before: DataFrame | None, after: DataFrame) -> int:
        """How many tasks hold the postings of a batch: one for each ``PIECE`` of its texts."""
        have = [c for c in self.weights if c in after.columns]
        length = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in have), F.lit(0).cast("bigint"))
        sides = [df.agg(F.sum(length).alias("n")) for df in (before, after) if df is not None]
        size = reduce(DataFrame.unionByName, sides).agg(F.sum("n").alias("n")).first()["n"]
        return 1 + (size or 0) // PIECE

    def apply(self, before: DataFrame | None, after: DataFrame, batch: str | int) -> None:
        """Take a batch in: the rows it takes away and those it brings. The same batch again replaces itself."""
        known = lambda df: df.filter(F.col(self.key).isNotNull())
        self._rows().apply(before and known(before), known(after), batch)
        tasks = self._tasks(before, after)
        self._postings().apply(before and self.postings_of(before, tasks), self.postings_of(after, tasks), batch, self._place(tasks))

    def _place(self, tasks: int) -> tuple[int, Column]:
        """Which task gets a posting: one has some folders, or a share of the postings of one folder."""
        if tasks < self.parts:
            return tasks, F.floor(F.col(PART) * tasks / self.parts).cast("int")
        share = -(-tasks // self.parts)
        return self.parts * share, F.col(PART) * share + F.pmod(F.xxhash64("term", self.key), F.lit(share)).cast("int")

    def fold(self, spark: SparkSession) -> None:
        """Merge all batches so far, so that a question reads one set of files again."""
        self._rows().fold(spark)
        self._postings().fold(spark)

    def found(self, spark: SparkSession, query: str) -> DataFrame | None:
        """Postings of the query's terms, from the folders of these terms; none if nothing is indexed yet."""
        terms = query_terms(query)
        current = self._postings().current(spark)
        if current is None:
            return None
        # The hash of a constant is folded, so the folders are known when files are listed.
        folders = reduce(lambda a, b: a | b, [F.col(PART) == self._part(F.lit(t)) for t in terms], F.lit(False))
        return current.filter(folders & F.col("term").isin(terms)).select("term", self.key, "frequency", "words")

    def search(self, spark: SparkSession, query: str) -> DataFrame | None:
        """Keys of the texts that hold every term, with ``hits``, ``words`` and ``rank``; none if nothing is indexed yet.

        The rank adds, for each term, its share of the text's words times ``ln(1 + rows / rows with the term)``, rounded to nine
        places: a rare term counts more than a frequent one. Sorting is left to the caller.
        """
        postings, terms = self.found(spark, query), query_terms(query)
        if postings is None:
            return None
        rows = self._rows().current(spark).select(F.col("rows").alias("_rows"))
        # At most one row per term of the query, and one row.
        spread = postings.groupBy(F.col("term").alias("_term")).agg(F.count("*").alias("_with"))
        weight = spread.join(F.broadcast(rows)).select("_term", F.log1p(F.col("_rows") / F.col("_with")).alias("_weight"))
        weighed = postings.join(F.broadcast(weight), F.col("term") == F.col("_term"))
        share = F.col("frequency") / F.col("words") * F.col("_weight")
        return (
            weighed.groupBy(self.key)
            .agg(
                F.sum("frequency").cast("bigint").alias("hits"), F.max("words").cast("bigint").alias("words"),
                rounded(F.sum(share.cast("decimal(38,15)")).cast("double"), 9).alias("rank"), F.count("*").alias("_found"),
            )
            .filter(F.col("_found") == len(terms))
            .drop("_found")
        )
