import json
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tiersmith.plans import landing
from tiersmith.session import scratch_dir
from tiersmith.sources import bronze, files, pages, store
from tiersmith.streaming import arrivals, changes


def test_csv_falls_back_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("name,n\nJosé,1\n".encode())
    (tmp_path / "b.csv").write_bytes("name,n\nZoë,2\n".encode("latin-1"))
    out = files.read_csv(spark, str(tmp_path), "name string, n int")
    assert rows(out) == [("José", 1), ("Zoë", 2)]


@pytest.mark.parametrize("wrapper", [None, "data", "records", "results", "items"])
def test_json_shapes(spark, tmp_path, wrapper):
    records = [{"id": 1, "who": {"name": "x", "at": {"city": "y"}}, "tags": [1]}, {"id": 2, "who": None, "tags": []}]
    (tmp_path / "x.json").write_text(json.dumps({wrapper: records} if wrapper else records))
    out = files.read_json(spark, str(tmp_path))
    assert sorted(out.columns) == ["id", "tags", "who_at_city", "who_name"]
    assert rows(out, "id", "who_at_city") == [(1, "y"), (2, None)]


def test_single_json_record(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"id": 5, "tags": [1, 2]}')
    assert rows(files.read_json(spark, str(tmp_path)), "id") == [(5,)]


def test_discovery(spark, tmp_path):
    (tmp_path / "small.csv").write_text("a\n1\n")
    (tmp_path / "big.csv").write_text("a\n" + "1\n" * 100)
    (tmp_path / "x.xlsx").write_text("?")
    found = files.discover(spark, str(tmp_path), max_bytes=50)
    assert rows(found, "file_name", "reason") == sorted([("big.csv", "too large"), ("small.csv", None), ("x.xlsx", "unsupported format")], key=repr)


def test_quarantine_keeps_the_text(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"id": 1}\n{"id": \n{"id": 3}\n')
    schema = T.StructType([T.StructField("id", T.LongType())])
    good, bad = files.split_corrupt(files.read_json_lines(spark, str(tmp_path), schema))
    assert rows(good, "id") == [(1,), (3,)]
    assert rows(bad) == [("l.json", '{"id": ', "unreadable record")]


def test_pages(spark, tmp_path):
    for i, ids in enumerate([[1, 2], [3]]):
        page = {"totalHits": 3, "results": [{"id": x, "cat": {"name": "n"}} for x in ids]}
        (tmp_path / f"p{i}.json").write_text(json.dumps(page))
    got = pages.read_pages(spark, str(tmp_path), "totalHits long, results array<struct<id:int,cat:struct<name:string>>>")
    assert rows(pages.page_records(got)) == [(1, "n"), (2, "n"), (3, "n")]
    assert tuple(pages.completeness(got).first()) == (2, 3, 3, True)
    assert not pages.completeness(got.limit(1).withColumn("totalHits", F.lit(9))).first().complete


def test_hash_ignores_metadata_and_sees_nulls(spark):
    df = spark.createDataFrame([(1, None, "b1"), (1, None, "b2"), (None, 1, "b1")], "a int, b int, _batch string")
    hashes = [r._source_hash for r in bronze.with_source_hash(df).collect()]
    assert hashes[0] == hashes[1] != hashes[2]


def test_ingest_append_and_idempotence(spark):
    root = scratch_dir(spark, "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    first = bronze.ingest(df, "src", "ds", root)
    assert (first["status"], first["rows_ingested"]) == ("success", 2)
    landed = spark.read.parquet(f"{root}/ds")
    again = bronze.add_metadata(df.union(spark.createDataFrame([(3, "c"), (3, "c")], df.schema)), "src", "b2")
    fresh = bronze.unseen_rows(again, landed)
    assert rows(fresh, "id") == [(3,)]
    bronze.append_bronze(fresh, root, "ds")
    assert spark.read.parquet(f"{root}/ds").count() == 3
    broken = bronze.ingest(df.withColumn("v", F.raise_error(F.lit("no"))), "src", "ds", root)
    assert broken["status"] == "error" and broken["error"]


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b int, c string")
    assert bronze.drop_empty_columns(df).columns == ["a", "c"]


def test_store_versions_and_tables(spark):
    root = scratch_dir(spark, "t")
    assert store.read_current(spark, root) is None
    store.write_current(spark.range(3).toDF("id"), root)
    current = store.read_current(spark, root)
    store.write_current(current.filter("id > 0"), root)
    assert rows(store.read_current(spark, root)) == [(1,), (2,)]
    assert store.load_table(spark.range(4).toDF("id"), "t_gold") == 4
    assert store.load_table(spark.range(2).toDF("id"), "t_gold", "append") == 2
    assert store.load_table(spark.range(1).toDF("id"), "t_new", "append") == 1
    assert store.row_count(spark, "t_gold") == 6 and store.table_exists(spark, "t_new") and not store.table_exists(spark, "t_x")
    assert {"t_gold", "t_new"} <= set(store.list_tables(spark))
    with pytest.raises(ValueError):
        store.load_table(spark.range(1), "t_gold", "merge")


def test_arrivals_read_each_file_once(spark, tmp_path):
    drop, target, state = tmp_path / "in", scratch_dir(spark, "t"), scratch_dir(spark, "s")
    drop.mkdir()
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    for n, ids in enumerate([(1, 2), (3,)]):
        (drop / f"f{n}.csv").write_text("id\n" + "".join(f"{i}\n" for i in ids))
        stream = arrivals.arrivals(spark, str(drop), schema)
        arrivals.land(stream, "drop", target, state, drain=True).awaitTermination()
    landed = spark.read.parquet(target)
    assert rows(landed, "id", "_source_file") == [(1, "f0.csv"), (2, "f0.csv"), (3, "f1.csv")]


def test_change_feed(spark, tmp_path):
    drop, log, state, base = tmp_path / "in", scratch_dir(spark, "l"), scratch_dir(spark, "s"), scratch_dir(spark, "b")
    drop.mkdir()
    schema = T.StructType.fromDDL("k string, seq int, v int, op string")
    batches = ["a,1,10,UPSERT\na,2,20,UPSERT\nb,1,1,UPSERT\n", "b,2,0,DELETE\nc,1,5,UPSERT\na,1,99,UPSERT\n"]
    for n, text in enumerate(batches):
        (drop / f"f{n}.csv").write_text("k,seq,v,op\n" + text)
        stream = arrivals.arrivals(spark, str(drop), schema).drop("_source_file")
        changes.upsert_batches(stream, ["k"], ["seq"], log, state, drain=True).awaitTermination()
    now = changes.current_rows(changes.read_log(spark, log), ["k"], ["seq"], "op")
    assert rows(now, "k", "v") == [("a", 20), ("c", 5)]
    # The base takes the place of the folded batches; later ones are read on top of it.
    changes.compact(spark, log, base, ["k"], ["seq"])
    assert not list(pathlib.Path(log).glob("batch=*"))
    (drop / "f2.csv").write_text("k,seq,v,op\nb,1,7,UPSERT\nd,1,8,UPSERT\nc,2,6,UPSERT\n")
    stream = arrivals.arrivals(spark, str(drop), schema).drop("_source_file")
    changes.upsert_batches(stream, ["k"], ["seq"], log, state, drain=True).awaitTermination()
    after = changes.current_rows(changes.read_log(spark, log, base), ["k"], ["seq"], "op")
    assert rows(after, "k", "v") == [("a", 20), ("c", 6), ("d", 8)]
    changes.compact(spark, log, base, ["k"], ["seq"])
    assert rows(changes.current_rows(changes.read_log(spark, log, base), ["k"], ["seq"], "op"), "k", "v") == [("a", 20), ("c", 6), ("d", 8)]


def test_a_drop_zone_is_read_per_format_and_bad_records_are_set_aside(spark, tmp_path):
    body = tmp_path / "zone" / "body_metrics"
    meals = tmp_path / "zone" / "nutrition_logs"
    body.mkdir(parents=True)
    meals.mkdir()
    (body / "a.csv").write_text("date,weight_kg\n2024-01-01,80.5\n2024-01-02,81\n")
    (body / "b.csv").write_text("date,weight_kg\n2024-01-03,82,extra,more\n")
    (body / "notes.txt").write_text("nothing to read")
    (meals / "c.json").write_text('{"records": [{"log_date": "2024-01-01", "calories": 500}, {"log_date": "2024-01-02", "calories": 600}]}')
    (meals / "d.json").write_text('{"records": [{"log_date": ')
    frames, aside = landing.read_zone(spark, str(tmp_path / "zone"))
    assert rows(frames["body_metrics"], "weight_kg", "_source_file") == [(80.5, "a.csv"), (81.0, "a.csv")]
    assert rows(frames["nutrition_logs"], "calories", "_source_file") == [(500, "c.json"), (600, "c.json")]
    assert rows(aside, "dataset", "_source_file", "reason") == [
        ("body_metrics", "b.csv", "unreadable record"), ("body_metrics", "notes.txt", "unsupported format"),
        ("nutrition_logs", "d.json", "unreadable record"),
    ]


def test_a_zone_with_a_latin_1_file(spark, tmp_path):
    folder = tmp_path / "zone" / "body_metrics"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_bytes("größe,name,n\n1,José,1\n2,Ann,2\n".encode())
    # A longer file, with signs in its name that a path or pattern reads otherwise, a type of its own and a row that does not fit.
    (folder / "b [1]%20.csv").write_bytes(("größe,name,n\n3,Zoë,x\n4,Jürgen,\n5,Ann,7,8\n" + "6,Ann,6\n" * 50).encode("latin-1"))
    frames, aside = landing.read_zone(spark, str(tmp_path / "zone"))
    got = frames["body_metrics"]
    assert sorted(got.columns) == ["_source_file", "größe", "n", "name"]
    assert rows(got.where("`größe` < 6"), "größe", "name", "n") == [(1, "José", "1"), (2, "Ann", "2"), (3, "Zoë", "x"), (4, "Jürgen", None)]
    assert got.count() == 54
    assert rows(aside, "dataset", "raw_text", "reason") == [("body_metrics", "5,Ann,7,8", "unreadable record")]
    # Without any UTF-8 file, and with only such.
    (folder / "a.csv").write_bytes("größe,name,n\n1,José,1\n".encode("latin-1"))
    got = landing.read_zone(spark, str(tmp_path / "zone"))[0]["body_metrics"]
    assert got.count() == 53 and rows(got.where("`größe` = 1"), "name") == [("José",)]
    plain, broken = files.read_csv_checked(spark, str(tmp_path / "zone" / "body_metrics" / "a.csv"))
    assert (rows(plain, "größe", "name"), broken.count()) == ([(1, "José")], 0)
