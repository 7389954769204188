"""Queries over sources, sinks and landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.catalog.registry import query
from tiersmith.session import scratch_dir, table
from tiersmith.sources import bronze, files, ledger, pages, quarantine, store
from tiersmith.sources.landing_table import LandingTable

AT = "2024-02-01 00:00:00"
PAGE = 100


@query("A1_csv_scan", "SELECT * FROM customer")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    folder = scratch_dir(spark, "csv")
    customers.write.option("header", True).csv(folder)
    return files.read_csv(spark, folder, customers.schema)


@query("A2_json_scan", "SELECT * FROM supplier")
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that wrap at most 1000 records each, one document per file."""
    suppliers = table(spark, sf_dir, "supplier")
    record = F.struct(*suppliers.columns)
    docs = suppliers.groupBy(F.floor(F.col("s_suppkey") / 1000).alias("doc")).agg(
        F.collect_list(record).alias("records")
    )
    folder = scratch_dir(spark, "json")
    docs.select(F.to_json(F.struct("doc", "records")).alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).text(folder)
    schema = T.StructType(
        [T.StructField("doc", T.LongType()), T.StructField("records", T.ArrayType(suppliers.schema))]
    )
    return files.read_json(spark, folder, schema)


@query("A2_mixed_json", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def mixed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of arrays, objects that wrap records under each known key, files of lines, and single records."""
    suppliers = table(spark, sf_dir, "supplier").withColumn("kind", F.col("s_suppkey") % 6)
    record = F.to_json(F.struct("s_suppkey", "s_name", "s_nationkey", "s_acctbal"))
    listed = F.concat_ws(", ", F.collect_list(record))
    # A document holds the records of some 6000 keys, however many there are; single records are one in 60.
    alone = F.col("s_suppkey") % 60 == 5
    docs = suppliers.filter(~alone).groupBy("kind", F.floor(F.col("s_suppkey") / 6000).alias("doc")).agg(listed.alias("rows"), F.concat_ws("\n", F.collect_list(record)).alias("lines"))
    kind = F.col("kind")
    text = F.when(kind == 4, F.concat(F.lit("["), "rows", F.lit("]"))).when(kind == 5, F.col("lines"))
    for k, key in enumerate(files.WRAPPER_KEYS):
        text = text.when(kind == k, F.concat(F.lit('{"n": 1, "%s": [' % key), "rows", F.lit("]}")))
    folder = scratch_dir(spark, "mixed")
    singles = suppliers.filter(alone).select(record.alias("value"))
    docs.select(text.alias("value")).union(singles).write.option("maxRecordsPerFile", 1).text(folder)
    return files.read_json(spark, folder).withColumn("s_nationkey", F.col("s_nationkey").cast("int"))


@query(
    "A3_nested_flatten",
    """SELECT event_id, event_type AS event_kind_name, user_id AS event_kind_user,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS props_k FROM events""",
)
def nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "events").select(
        F.struct(
            F.col("event_id").alias("id"),
            F.struct(F.col("event_type").alias("name"), F.col("user_id").alias("user")).alias("kind"),
        ).alias("event"),
        F.from_json("props", "k int").alias("props"),
    )
    return files.flatten(nested)


@query("A4_file_discovery")
def file_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = files.discover(spark, sf_dir, "*.parquet", formats=(".parquet",))
    return found.select("file_name", "length", "accepted", "reason")


@query(
    "A5_union_with_lineage",
    """SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS BIGINT) AS s_suppkey, NULL AS s_name,
         'customer.parquet' AS _source_file FROM customer
       UNION ALL BY NAME SELECT s_suppkey, s_name, 'supplier.parquet' AS _source_file FROM supplier""",
)
def union_with_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.union_all(
        [
            files.with_source_file(table(spark, sf_dir, "customer")).drop("c_nationkey", "c_mktsegment"),
            files.with_source_file(table(spark, sf_dir, "supplier")).drop("s_nationkey", "s_acctbal"),
        ]
    )


@query(
    "A5_mixed_csv",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 2 THEN c_acctbal END AS c_acctbal, c_name,
         CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS segment FROM customer""",
)
def mixed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder with their columns in other orders, one missing, one more: they meet by name."""
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "segment")
    folder = scratch_dir(spark, "shapes")
    for k, columns in enumerate((["c_custkey", "c_acctbal", "c_name"], ["segment", "c_name", "c_acctbal", "c_custkey"], ["c_name", "c_custkey"])):
        rows = customers.filter(F.col("c_custkey") % 3 == k).select(*columns)
        rows.write.mode("append").option("header", True).csv(folder)
    good, bad = files.read_csv_checked(spark, folder)
    # A record is landed or set aside: one set aside here would be a row too many.
    return good.drop("_source_file").unionByName(bad.select(F.lit(-1).cast("long").alias("c_custkey")), allowMissingColumns=True)


LINE_SQL = """'{"event_id":' || event_id || ',"event_type":"' || event_type || '"}'"""


@query(
    "A6_bad_input_quarantine",
    f"""WITH lines AS (SELECT event_id, event_type, {LINE_SQL} AS line FROM events)
    SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
           CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
           CASE WHEN event_type = 'error' THEN left(line, length(line) - 3) END AS raw_text,
           CASE WHEN event_type = 'error' THEN 'unreadable record' END AS reason FROM lines""",
)
def bad_input_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.to_json(F.struct("event_id", "event_type"))
    cut = F.when(F.col("event_type") == "error", F.left(line, F.length(line) - 3)).otherwise(line)
    folder = scratch_dir(spark, "lines")
    table(spark, sf_dir, "events").select(cut.alias("value")).write.text(folder)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    good, bad = files.split_corrupt(files.read_json_lines(spark, folder, schema))
    return good.unionByName(bad, allowMissingColumns=True).drop("_source_file")


@query("A6_quarantine_replay", "SELECT event_id, event_type, event_type = 'error' AS replayed FROM events")
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that lost their end are set aside once, mended by a rule and read."""
    line = F.to_json(F.struct("event_id", "event_type"))
    cut = F.when(F.col("event_type") == "error", F.left(line, F.length(line) - 2)).otherwise(line)
    folder, root = scratch_dir(spark, "lines"), scratch_dir(spark, "set-aside")
    table(spark, sf_dir, "events").select(cut.alias("value")).write.text(folder)
    good, bad = files.read_json_checked(spark, folder)
    for run in ("first", "again"):
        quarantine.set_aside(bad.withColumn("dataset", F.lit("events")), root, run)
    items = quarantine.open_items(spark, root).filter("error_class = 'syntax'")
    frames, released = quarantine.repaired(items, lambda c: F.concat(c, F.lit('"}')))
    quarantine.release(released, root)
    mended = files.stacked(frames)
    return good.withColumn("replayed", F.lit(False)).unionByName(mended.withColumn("replayed", F.lit(True))).drop("_source_file")


RECORD = "event_id bigint, event_type string, value double"
PAGE_SCHEMA = f"totalHits bigint, currentPage bigint, results array<struct<{RECORD.replace(' ', ':').replace(',:', ',')}>>"


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed pages of a paged API: page documents of at most 100 records."""
    events = table(spark, sf_dir, "events")
    hits = events.agg(F.count("*")).scalar()
    docs = events.groupBy(F.floor(F.col("event_id") / PAGE).alias("currentPage")).agg(
        F.collect_list(F.struct("event_id", "event_type", "value")).alias("results")
    )
    folder = scratch_dir(spark, "pages")
    page = F.struct(hits.alias("totalHits"), "currentPage", "results")
    docs.select(F.to_json(page).alias("value")).write.text(folder)
    return pages.read_pages(spark, folder, PAGE_SCHEMA)


@query("A7_page_records", "SELECT event_id, event_type, value FROM events")
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_records(landed_pages(spark, sf_dir))


@query(
    "A7_page_completeness",
    f"""SELECT COUNT(DISTINCT event_id // {PAGE}) AS pages, COUNT(*) AS records, COUNT(*) AS announced,
        TRUE AS complete FROM events""",
)
def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.completeness(landed_pages(spark, sf_dir))


HASH_SQL = "md5(" + " || '|' || ".join(
    f"coalesce(CAST({c} AS VARCHAR), '∅')" for c in ("event_id", "user_id", "event_type", "value", "props")
) + ")"


def hashed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props", "ts")
    return bronze.with_source_hash(rows.withColumnRenamed("ts", "_ts"))


@query(
    "A8_ingest_metadata",
    f"""SELECT event_id, value, 'event_api' AS _source_name, 'batch-1' AS _batch_id,
        TIMESTAMP '{AT}' AS _ingested_at FROM events""",
)
def ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    at = F.lit(AT).cast("timestamp")
    return bronze.add_metadata(rows, "event_api", "batch-1", at).drop("_source_hash")


@query("A9_row_hash", f"SELECT event_id, {HASH_SQL} AS _source_hash FROM events")
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashed_events(spark, sf_dir).select("event_id", "_source_hash")


@query(
    "A10_bronze_append",
    """SELECT event_id, value, 'event_api' AS _source_name,
       CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'batch-1' ELSE 'batch-2' END AS _batch_id FROM events""",
)
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    root = scratch_dir(spark, "bronze")
    for batch, rows in (("batch-1", events.filter(early)), ("batch-2", events.filter(~early))):
        tagged = bronze.add_metadata(rows.select("event_id", "value"), "event_api", batch)
        bronze.append_bronze(tagged, root, "events")
    return spark.read.parquet(f"{root}/events").select("event_id", "value", "_source_name", "_batch_id")


@query("A11_idempotent_ingest", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-16'")
def idempotent_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hashed_events(spark, sf_dir)
    landed = rows.filter(F.col("_ts") < F.lit("2024-01-16").cast("timestamp"))
    return bronze.unseen_rows(rows, landed).select("event_id")


@query(
    "A11_resumed_load",
    """SELECT event_id, value, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'early' ELSE 'all' END AS load FROM events""",
)
def resumed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, one that ended half-way, and one of everything: each row is there once, by the load that finished."""
    events = table(spark, sf_dir, "events")
    landing = LandingTable(spark, scratch_dir(spark, "ledger"), "events", buckets=16)
    at = F.lit(AT).cast("timestamp")
    early = landing.land(events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp")), "api", at)
    landing.land(events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp")), "api", at, batch_id="lost")
    ledger.note(spark, landing.root, "events", "lost", ledger.LANDED, ledger.STARTED)
    rest = landing.land(events.withColumn("note", F.lit(None).cast("string")), "api", at)
    rows = landing.rows([early.batch_id, rest.batch_id])
    load = F.when(F.col("_batch_id") == early.batch_id, "early").otherwise("all")
    return rows.select("event_id", "value", load.alias("load"))


@query(
    "A12_clustered_month",
    """SELECT user_id, COUNT(*) AS events, MAX(value) AS best FROM events
       WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY user_id""",
)
def clustered_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a table laid out by month and user, only the partitions of one month are read."""
    root = scratch_dir(spark, "clustered")
    store.write_clustered(table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value"), root, "ts", ["user_id"], ["event_id"])
    rows = store.read_current(spark, root)
    month = rows.filter(store.in_months(rows, "2024-01-01", "2024-01-31"))
    return month.groupBy("user_id").agg(F.count("*").alias("events"), F.max("value").alias("best"))


@query("A12_silver_store", "SELECT event_id, value * 2 AS doubled FROM events")
def silver_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "silver")
    store.write_silver(table(spark, sf_dir, "events").select("event_id", "value"), root, "api", "events")
    current = store.read_current(spark, f"{root}/api/events")
    # The second version is computed from the first, which stays readable meanwhile.
    store.write_silver(current.select("event_id", (F.col("value") * 2).alias("doubled")), root, "api", "events")
    return store.read_current(spark, f"{root}/api/events")


@query("A13_gold_replace_append", "SELECT * FROM customer")
def gold_replace_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    in_debt = F.col("c_acctbal") < 0
    path = scratch_dir(spark, "gold")
    name = "gold_" + path.rsplit("-", 1)[-1]
    store.load_table(customers, name, "replace", path)
    store.load_table(customers.filter(in_debt), name, "replace", path)
    store.load_table(customers.filter(~in_debt), name, "append", path)
    return spark.table(name)


@query("A14_table_parquet_round_trip", "SELECT * FROM supplier")
def table_parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "table")
    name = "loaded_" + path.rsplit("-", 1)[-1]
    store.load_parquet(spark, name, f"{sf_dir}/supplier.parquet", path=path)
    target = scratch_dir(spark, "export")
    store.export_parquet(spark, name, target)
    return spark.read.parquet(target)


@query(
    "A15_parameterised_query",
    "SELECT event_type, COUNT(*) AS n FROM events WHERE value >= 100 GROUP BY event_type",
)
def parameterised_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT event_type, count(*) AS n FROM {events} WHERE value >= :low GROUP BY event_type"
    return store.query(spark, text, {"low": 100}, events=table(spark, sf_dir, "events"))


@query(
    "A17_split_and_drop_empty",
    "SELECT s_suppkey, s_name, 'supplier.parquet' AS _source_file FROM supplier",
)
def split_and_drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = union_with_lineage(spark, sf_dir)
    return bronze.drop_empty_columns(bronze.split_by_file(landed, "supplier.parquet"))
