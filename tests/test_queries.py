"""Registered queries next to their SQL on the smallest tables."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"
CHECKED = [
    "A5_union_with_lineage", "A6_bad_input_quarantine", "A7_page_records", "A9_row_hash", "A11_idempotent_ingest",
    "A13_gold_replace_append", "B5_coercing_cast", "B7_clean_chain", "C2_tail_code_labels", "C7_nutrient_pivot",
    "D10_weight_change", "D13_macro_percentages", "E1_dim_date", "E9_scd2_merge", "E10_star_join",
    "F1_table_profile", "F3_numeric_profile", "F9_F10_F18_rule_set", "F21_monitored_columns",
    "F26_overall_score_and_grade", "F28_row_contracts", "G2_exercise_progression", "G5_muscle_volume_distribution",
    "G7_workout_detail", "G8_training_stats", "G9_e1rm_history", "G10_search_documents", "G11_log_sets_with_pr_flag",
    "G12_process_staged_exercises", "G14_detect_new_prs", "G16_update_session_totals", "G23_audit_trail",
    "H2_weekly_volume", "H7_weight_trend", "H14_overview", "H21_best_streak", "H25_athlete_cards", "I7_score_delta",
    "I12_run_totals", "J1_file_arrival_ingest", "J2_change_feed_upsert", "P_pipeline", "A2_mixed_json", "A5_mixed_csv",
    "A6_quarantine_replay", "A11_resumed_load", "A12_clustered_month", "E9_history_timeline", "G3_kept_daily_totals",
    "F2_F3_sketch_profile", "J1_checked_arrivals", "G10_kept_search",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = {n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)}
    without = own - set(entry.oracle_sql())
    assert without == {"A4_file_discovery", "F30_contract_on_sample"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert sorted(got[1], key=repr) == sorted(want[1], key=repr)


def test_plans_stay_in_the_jvm(spark):
    for name in ("G2_exercise_progression", "F28_row_contracts", "G14_detect_new_prs", "H7_weight_trend"):
        plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    own = plan_of(entry.queries()["G25_rows_through_parent"](spark, SF_DIR))
    assert "EqualTo(o_custkey,1)" in own
    volume = plan_of(entry.queries()["D5_set_volume_and_e1rm"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>" in volume


def test_sql_functions(spark):
    from tiersmith.plans import roles, sql_surface

    names = ("workouts", "workout_sets", "exercises", "body_metrics", "nutrition_logs")
    sql_surface.register(spark, {n: getattr(roles, n)(spark, SF_DIR) for n in names})
    one, many = spark.sql("SELECT calculate_e1rm(100D, 1), calculate_e1rm(100D, 8)").first()
    assert (one, many) == (100.0, 126.7)
    some = spark.sql("SELECT athlete_id, slug, count(*) AS n FROM e1rm_histories GROUP BY ALL ORDER BY n DESC, 1, 2").first()
    rows = spark.sql(f"SELECT * FROM get_e1rm_history({some.athlete_id}, '{some.slug}')").collect()
    assert len(rows) == some.n and all(r.estimated_1rm >= r.best_weight_kg for r in rows)
    hit = spark.sql("SELECT athlete_id, workout_id, count(*) AS n FROM new_records GROUP BY ALL ORDER BY n DESC, 1, 2").first()
    assert spark.sql(f"SELECT * FROM detect_new_prs({hit.athlete_id}, {hit.workout_id})").count() == hit.n


def test_records_of_one_athlete_read_only_their_rows(spark):
    from tiersmith.operators import records
    from tiersmith.plans import roles

    candidates = records.candidate_sets(roles.workout_sets(spark, SF_DIR), roles.workouts(spark, SF_DIR))
    found = records.new_records(candidates, ["workout_date", "workout_id", "set_number", "weight_kg", "reps"])
    plan = plan_of(found.filter("athlete_id = 1"))
    scans = [line for line in plan.splitlines() if "o_custkey" in line and "PushedFilters" in line]
    assert scans and all("EqualTo(o_custkey,1)" in line for line in scans)


def test_a_contract_on_a_sample_finds_some_of_the_violations(spark):
    from tiersmith.operators import contracts
    from tiersmith.plans import roles

    metrics = roles.body_metrics(spark, "/root/testdata/sf0.01")
    every = {tuple(r) for r in contracts.violations(metrics, "body_metrics", ["id"]).collect()}
    sample = [tuple(r) for r in contracts.violations(metrics, "body_metrics", ["id"], sample_size=100).collect()]
    whole = [tuple(r) for r in contracts.violations(metrics, "body_metrics", ["id"], sample_size=10**6).collect()]
    assert set(sample) <= every and len({r[0] for r in sample}) <= 100
    assert set(whole) == every


def test_discovery_lists_what_is_there(spark):
    import pathlib

    found = {(r.file_name, r.length) for r in entry.queries()["A4_file_discovery"](spark, SF_DIR).collect()}
    assert found == {(p.name, p.stat().st_size) for p in pathlib.Path(SF_DIR).iterdir()}
