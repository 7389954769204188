"""Queries over what is kept up to date: aggregates with retraction, sketches per batch, checked arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.catalog.registry import query
from tiersmith.catalog.sqltext import dsum, rnd
from tiersmith.functions.numeric import rounded
from tiersmith.catalog.views import tokens_sql
from tiersmith.operators import sketches
from tiersmith.operators.incremental import Kept
from tiersmith.operators.postings import SearchIndex
from tiersmith.session import scratch_dir, table
from tiersmith.sources import quarantine
from tiersmith.sources.landing_table import LandingTable
from tiersmith.streaming import aggregates, arrivals


@query(
    "G3_kept_daily_totals",
    f"""WITH now AS (
         SELECT user_id, CAST(ts AS DATE) AS day, event_type, value + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS value
         FROM events WHERE event_id % 7 <> 0
       )
       SELECT user_id, day, COUNT(*) AS meals, {rnd(dsum('value'), 2)} AS calories, COUNT(DISTINCT event_type) AS kinds
       FROM now GROUP BY user_id, day""",
)
def kept_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per user and day after a first load and batches of inserts, updates, deletes and late changes."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"), "event_type", "value")
    change = lambda df, seq, op="UPSERT": df.withColumns({"seq": F.lit(seq), "op": F.lit(op)})
    old, new = rows.filter("event_id % 3 <> 0"), rows.filter("event_id % 3 = 0")
    moved = rows.filter("event_id % 5 = 0").withColumn("value", F.col("value") + 1)
    late = rows.withColumns({"value": F.col("value") + 100, "event_type": F.lit("late")}).filter("event_id % 10 = 0")
    batches = [
        change(old.withColumn("value", F.col("value") * 2), 1), change(new, 2).unionByName(change(old, 2)),
        change(moved, 3).unionByName(change(rows.filter("event_id % 7 = 0"), 4, "DELETE")), change(late, 0),
    ]
    root, log = scratch_dir(spark, "kept"), scratch_dir(spark, "changes")
    kept = Kept(root, {"user_id": F.col("user_id"), "day": F.col("day")}, {"calories": F.col("value")}, ("kinds", F.col("event_type")))
    for number, batch in enumerate(batches):
        aggregates.take(batch, number, [kept], log, ["event_id"], ["seq"], "op")
        if number == 1:
            kept.fold(spark)
    return kept.current(spark).select("user_id", "day", F.col("rows").alias("meals"), rounded("calories", 2).alias("calories"), "kinds")


RANKED_SQL = f"""WITH texts AS (
      SELECT doc_id, {tokens_sql("CASE WHEN doc_id % 5 = 0 THEN text || ' anat singing' ELSE text END")} AS w, {tokens_sql("source")} AS s
      FROM documents WHERE doc_id % 7 <> 0
    ),
    counted AS (SELECT doc_id, CAST(len(w) + 2 * len(s) AS BIGINT) AS words, u.term,
        len(list_filter(w, lambda x: x = u.term)) + 2 * len(list_filter(s, lambda x: x = u.term)) AS frequency
      FROM texts CROSS JOIN (VALUES ('anat'), ('sing')) u(term)),
    there AS (SELECT *, COUNT(*) OVER (PARTITION BY term) AS with_term FROM counted WHERE frequency > 0)
    SELECT doc_id, CAST(SUM(frequency) AS BIGINT) AS hits, MAX(words) AS words,
      {rnd("CAST(SUM(CAST(CAST(frequency AS DOUBLE) / words * ln(1 + CAST((SELECT COUNT(*) FROM texts) AS DOUBLE) / with_term) AS DECIMAL(38,15))) AS DOUBLE)", 9)} AS rank
    FROM there GROUP BY doc_id HAVING COUNT(*) = 2"""


@query("G10_kept_search", RANKED_SQL)
def kept_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked matches from an index after a first load, changed texts, late and deleting changes, and a merge between."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    change = lambda df, seq, op="UPSERT": df.withColumns({"seq": F.lit(seq), "op": F.lit(op)})
    longer = docs.filter("doc_id % 5 = 0").withColumn("text", F.concat("text", F.lit(" anat singing")))
    batches = [
        change(docs, 1), change(longer, 2).unionByName(change(docs.filter("doc_id % 7 = 0"), 3, "DELETE")),
        change(docs.filter("doc_id % 10 = 0"), 0),
    ]
    index, log = SearchIndex(scratch_dir(spark, "index"), "doc_id", {"text": 1, "source": 2}), scratch_dir(spark, "changes")
    for number, batch in enumerate(batches):
        aggregates.take(batch, number, [index], log, ["doc_id"], ["seq"], "op")
        if number == 1:
            index.fold(spark)
    return index.search(spark, "singing anat")


PROFILED = ["event_id", "user_id", "value", "event_type"]


@query(
    "F2_F3_sketch_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT(*) - COUNT({c}) AS null_count, TRUE AS distinct_within, TRUE AS quartiles_within FROM events"
        for c in PROFILED
    ),
)
def sketch_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of three batches, merged, and whether they lie within the stated error of the exact profile."""
    events, root = table(spark, sf_dir, "events").select(*PROFILED), scratch_dir(spark, "sketches")
    for n in range(3):
        sketches.keep(events.filter(F.col("event_id") % 3 == n), root, str(n))
    found = sketches.estimates(sketches.merged(spark, root))
    numbers = [c for c in PROFILED if c != "event_type"]
    # One row of estimates per column, next to one aggregate over the rows.
    wide = found.agg(*(F.max(F.when(F.col("column") == c, F.col(q))).alias(f"{c}_{q}") for c in numbers for q in sketches.QUARTILES))
    share = lambda c, q: F.avg((F.col(c) <= F.col(f"{c}_{q}")).cast("double"))
    below = lambda c, q: F.avg((F.col(c) < F.col(f"{c}_{q}")).cast("double"))
    exact = events.join(F.broadcast(wide)).agg(
        *(F.count_distinct(c).alias(f"{c}_distinct") for c in PROFILED),
        *(x.alias(f"{c}_{q}_{n}") for c in numbers for q in sketches.QUARTILES for n, x in (("upto", share(c, q)), ("below", below(c, q)))),
    )
    near = {
        c: F.lit(True) if c not in numbers else
        F.array_min(F.array(*((F.col(f"{c}_{q}_below") <= at + sketches.RANK_ERROR) & (F.col(f"{c}_{q}_upto") >= at - sketches.RANK_ERROR) for q, at in sketches.QUARTILES.items())))
        for c in PROFILED
    }
    checks = exact.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"{c}_distinct").alias("exact"), near[c].alias("quartiles_within")) for c in PROFILED))).alias("r")).select("r.*")
    off = F.abs(F.col("unique_count") / F.col("exact") - 1)
    return found.join(checks, "column").select(
        F.col("column").alias("column_name"), F.col("rows").alias("total_rows"), F.col("nulls").alias("null_count"),
        (off <= sketches.DISTINCT_ERROR).alias("distinct_within"), "quartiles_within",
    )


LINE_SQL = """'{"event_id":' || event_id || ',"event_type":"' || event_type || '"}'"""


@query(
    "J1_checked_arrivals",
    f"""WITH lines AS (SELECT event_id, event_type, {LINE_SQL} AS line FROM events)
    SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
           CASE WHEN event_type = 'error' THEN left(line, length(line) - 3) END AS raw_text FROM lines""",
)
def checked_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over files with broken lines, then over the same rows in other files: each is landed or set aside once."""
    folder, root = scratch_dir(spark, "arrivals"), scratch_dir(spark, "checked")
    line = F.to_json(F.struct("event_id", "event_type"))
    cut = F.when(F.col("event_type") == "error", F.left(line, F.length(line) - 3)).otherwise(line)
    lines = table(spark, sf_dir, "events").select(cut.alias("value"))
    schema, state = T.StructType.fromDDL("event_id bigint, event_type string"), scratch_dir(spark, "state")
    for again in (False, True):
        (lines.filter(F.col("value").endswith("}")) if again else lines).write.mode("append").text(folder)
        arrivals.land_checked(spark, folder, schema, "events", "drop", root, state, "json", drain=True).awaitTermination()
    landing = LandingTable(spark, root, "events")
    batches = landing.batches()
    landing.open(batches)
    landed = landing.rows([b.batch_id for b in batches if b.landed]).select("event_id")
    return landed.unionByName(quarantine.items_of(spark, root).select("raw_text"), allowMissingColumns=True)
