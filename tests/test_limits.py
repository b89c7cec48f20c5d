"""Legal input off the beaten path: both sides of every size switch, times off the grid, long rows, double keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rotorlake.operators import cleaning, joins, lookup, mapping, series
from rotorlake.plans import minute, per_second, ten_minute
from rotorlake.sources import files, tables

LIMITS = pytest.mark.parametrize("max_bytes", [0, joins.MAX_BROADCAST_BYTES])


def at(day, hour=0, minute=0, second=0, micro=0):
    return dt.datetime(2024, 1, day, hour, minute, second, micro)


@pytest.fixture(scope="module")
def points(spark):
    rows = [("a", 1.0, 1.0), ("a", 1.0, 3.0), ("a", 2.0, 2.0), ("a", 2.0, 3.0), ("a", 4.0, 9.0), ("a", None, 7.0), (None, 1.0, 5.0), ("b", None, 1.0)]
    return spark.createDataFrame(rows, "k string, rank double, power double")


@pytest.fixture(scope="module")
def facts(spark):
    rows = [(1, "a", 0.5), (2, "a", 1.0), (3, "a", 2.0), (4, "a", 3.0), (5, "a", 9.0), (6, "a", None), (7, None, 1.0), (8, "b", 1.0), (9, "c", 1.0)]
    return spark.createDataFrame(rows, "i int, k string, x double")


@LIMITS
def test_asof_takes_one_point_whatever_the_size(facts, points, max_bytes):
    found = lookup.asof_lookup(facts, points, "k", "x", "rank", "lo", above="hi", known="has", max_bytes=max_bytes)
    got = {r["i"]: (r["lo"] and r["lo"]["power"], r["hi"] and r["hi"]["power"], r["has"]) for r in found.collect()}
    none = (None, None, False)
    assert got[1] == (None, 3.0, True) and got[2] == (3.0, 3.0, True) and got[3] == (3.0, 9.0, True)
    assert got[4] == (3.0, 9.0, True) and got[5] == (9.0, None, True) and got[6][0] is None
    assert got[7] == got[8] == got[9] == none


@LIMITS
def test_brackets_take_one_point_whatever_the_size(facts, points, max_bytes):
    sets = {"low": F.col("power") < 3, "all": F.lit(True)}
    found = lookup.bracket_sets(facts, points, "k", "x", "rank", sets, max_bytes)
    got = {r["i"]: tuple(r[c] and r[c]["power"] for c in ("low_lo", "low_hi", "all_lo", "all_hi")) for r in found.collect()}
    assert got[2] == (1.0, 2.0, 3.0, 3.0) and got[4] == (2.0, None, 3.0, 9.0)
    assert got[7] == got[8] == got[9] == (None, None, None, None)


@LIMITS
def test_predicted_power_of_double_points(spark, max_bytes):
    curves = [("t", k, r, p) for k in (1, 3) for r, p in ((0.0, 1.0), (0.0, 2.0), (1.0, 3.0), (None, 5.0), (1.0, 1.0))]
    curves = spark.createDataFrame(curves, "wtg_id string, pc_type int, wind_speed_rank double, power double")
    rows = spark.createDataFrame([("t", 0.25)], "wtg_id string, ntf_wind_speed_standard double")
    assert ten_minute.predicted_power(rows, curves, max_bytes).first()["theory_power_10m"] == 2.25


@LIMITS
def test_ideal_power_with_rows_without_speed(spark, max_bytes):
    curve = [("t", None, 5.0, "2"), ("t", 1.0, 10.0, "1"), ("t", 1.5, 20.0, "1"), (None, 1.0, 1.0, "1"), ("u", None, 1.0, "1")]
    curve = spark.createDataFrame(curve, "wtg_id string, wind_speed_rank double, active_power double, created_time string")
    fact = spark.createDataFrame([("t", 1.25), ("t", None), ("t", 7.0), ("u", 1.0), (None, 1.0)], "wtg_id string, read_wind_speed double")
    got = minute.ideal_power(fact, curve, max_bytes=max_bytes).collect()
    assert sorted((r[0], r[1] or 0, r[2]) for r in got) == [("t", 0, -1.0), ("t", 1.25, 15.0), ("t", 7.0, -1.0)]


def test_large_curves_shuffle_the_fact_once(spark):
    curve = spark.createDataFrame([("t", 1.0, 10.0, "1")], "wtg_id string, wind_speed_rank double, active_power double, created_time string")
    fact = spark.createDataFrame([("t", 1.25)], "wtg_id string, read_wind_speed double")
    plan = minute.ideal_power(fact, curve, max_bytes=0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1


def test_lookup_join_refuses_other_kinds(facts, points):
    with pytest.raises(ValueError):
        joins.lookup_join(facts, points, "k", "full")


def test_marks_off_the_grid_are_left_out(spark):
    rows = [("t", at(1, 0, 10), 1.0), ("t", at(1, 0, 13), 2.0), ("t", at(1, 0, 20), 3.0), ("t", at(1, 0, 20, 0, 1), 4.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    grid = series.fill_grid(df, "k", "ts").orderBy("ts").collect()
    assert len(grid) == 144 and [r["v"] for r in grid[:3]] == [1.0, 3.0, None]
    assert all(r["ts"].minute % 10 == 0 and r["ts"].second == 0 for r in grid)
    assert df.where(series.off_grid(F.col("ts"))).count() == 2


@pytest.mark.parametrize("midnight", [True, False])
def test_silent_days_are_filled(spark, midnight):
    rows = [("t", at(1, 12), 1.0), ("t", at(3, 12), 3.0)] + [("t", at(2), 2.0)] * midnight + [("u", at(5), 5.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    grid = series.fill_grid(df, "k", "ts").collect()
    days = {}
    for r in grid:
        days.setdefault((r["k"], r["day"].day), []).append(r)
    # The midnight row is handed to the silent day; without one the day has no opening row.
    assert {k: len(v) for k, v in days.items()} == {("t", 1): 144, ("t", 2): 144 + midnight, ("t", 3): 144, ("u", 4): 144}
    assert sum(not r["is_filled"] for r in days["t", 2]) == midnight
    more = series.fill_grid(df, "k", "ts", last_day="2024-01-06")
    assert more.select("k", "day").distinct().count() == 6 + 3


def test_states_within_a_second(spark):
    rows = [("t", at(1, 0, 0, 3, 500_000), 1, 7), ("t", at(1, 0, 0, 4, 200_000), 0, 8), ("t", at(1, 0, 0, 4, 100_000), 900, 9)]
    log = spark.createDataFrame(rows, "wtg_id string, starttime timestamp_ntz, msec int, state_id int")
    roster = spark.createDataFrame([("t", dt.date(2024, 1, 1))], "wtg_id string, day date")
    got = series.pad_states({"s": log}, roster).orderBy("ts").collect()
    assert len(got) == 86_400 and all(r["ts"].microsecond == 0 for r in got)
    assert [r["s"] for r in got[:5]] == [None, None, 7, 8, 8]
    second = series.last_event_per_second(log, ["wtg_id"], "starttime", "msec", "state_id").orderBy("starttime").collect()
    assert [(r["starttime"].second, r["state_id"]) for r in second] == [(3, 7), (4, 8)]


def test_logs_get_the_turbines_ids(spark):
    log = spark.createDataFrame([("x1", 1), ("x9", 2)], "wtg_id string, state_id int")
    aliases = spark.createDataFrame([("x1", "t1"), ("x1", "t0"), (None, "t5")], "idx string, mdm_id string")
    assert [tuple(r) for r in per_second.remap_logs({"s": log}, aliases)["s"].collect()] == [("t1", 1)]


def test_double_master_ids_double_no_row(spark):
    rows = spark.createDataFrame([("W1", 1), ("W2", 2)], "k string, v int")
    master = spark.createDataFrame([("W1", "M1"), ("W1", "M2"), (None, "M3")], "s string, m string")
    got = cleaning.remap_ids(rows, master, "k", "s", "m", keep_unmapped=True)
    assert sorted(tuple(r) for r in got.collect()) == [("M2", 1), ("W2", 2)]


def test_fields_without_alias_are_reserved(spark):
    fields = [("1", 0, "speed", "WNAC.WindSpeed"), ("1", 1, "b", None), ("1", 2, "c", "X.Other")]
    fields = spark.createDataFrame(fields, "protocol_id string, pos int, field_desc string, field_alias string")
    master = spark.createDataFrame([], "wtg_id string, master_id string")
    rows = spark.createDataFrame([("k\t1,W1,t,1,5,6,7",)], "line string")
    assert mapping.standard_mapping(rows, fields, master).first()["COMMON_Reserved"] == "b=6;c=7"


def test_very_long_key_value_rows(spark):
    pairs = ",".join(f"k{i}:v{i}" for i in range(50_000)) + ",wtg_id:W1,temout:4"
    rows = spark.createDataFrame([(1, pairs), (2, pairs + ",broken"), (3, "wtg_id:W2,a:1:2"), (4, ""), (5, None)], "i int, all_key_value string")
    assert [(r["i"], r["wtg_id"], r["temp_out_door"]) for r in cleaning.parse_kv(rows).collect()] == [(1, "W1", 4.0)]
    assert sorted(r["i"] for r in cleaning.kv_rejects(rows).collect()) == [2, 3, 4, 5]


def test_staging_reads_one_day_of_a_partitioned_table(spark, tmp_path):
    rows = [("t", f"2024010{d}", float(d)) for d in range(1, 6)]
    tables.overwrite_partitions(spark.createDataFrame(rows, "wtg_id string, date string, v double"), str(tmp_path / "t"), ["date"])
    fact = spark.read.schema("wtg_id string, v double, date string").parquet(str(tmp_path / "t"))
    turbines = spark.createDataFrame([("t", "y", 1)], "wtg_id string, wtg_type_id string, site_type int")
    types = spark.createDataFrame([("y", "name", 2.0)], "wtg_type_id string, wtg_type_name string, rated_power double")
    staged = minute.staging(fact, turbines, types, ["wtg_id", "v", "rated_power"], day="20240103")
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert [tuple(r) for r in staged.collect()] == [("t", 3.0, 2.0)]


@LIMITS
def test_assigned_curves_are_read_by_curve(spark, max_bytes):
    points = [(7, 0.0, 1.0), (7, 0.0, 2.0), (7, 1.0, 3.0), (8, 0.0, 6.0), (8, 1.0, 12.0), (None, 0.0, 9.0), (9, None, 1.0)]
    points = spark.createDataFrame(points, "pc_id int, wind_speed_rank double, power double")
    assignment = [("t", 1, 7), ("t", 1, 6), ("t", 3, 8), ("u", 1, 9), (None, 1, 7)]
    assignment = spark.createDataFrame(assignment, "wtg_id string, pc_type int, pc_id int")
    rows = spark.createDataFrame([("t", 0.25), ("u", 0.5), ("x", 0.5), ("t", None)], "wtg_id string, ntf_wind_speed_standard double")
    got = ten_minute.assigned_power(rows, assignment, points, max_bytes)
    assert got.columns == [*rows.columns, "theory_power_10m", "theory_approduction_10m", "active_power_10m", "active_approduction_10m"]
    found = {(r[0], r[1]): (r["theory_power_10m"], r["active_power_10m"]) for r in got.collect()}
    assert found == {("t", 0.25): (2.25, 7.5), ("u", 0.5): (None, None), ("x", 0.5): (None, None), ("t", None): (None, None)}


def test_lines_of_unknown_folders_are_listed(spark, tmp_path):
    for place in ("s/t/d/m", "s/u/d/m"):
        folder = tmp_path / place
        folder.mkdir(parents=True)
        (folder / "a.csv").write_text("x,y\n1,2\n3\n")
    ids = spark.createDataFrame([("s/t/d/m", "t", "s")], "folder string, wtg_id string, site_id string")
    kept, rejects = files.read_header_csv(spark, str(tmp_path / "*/*/*/*/*.csv"), ids)
    assert kept.count() == 1 and {r["value"] for r in rejects.collect()} == {"3"}
    unowned = files.unowned_lines(spark, str(tmp_path / "*/*/*/*/*.csv"), ids).collect()
    assert sorted(r["value"] for r in unowned) == ["1,2", "3", "x,y"] and all("/u/" in r["file"] for r in unowned)


def loop_brackets(points, facts, sets):
    """For each row the greatest knot at or below its value and the least above it, per set."""
    out = {}
    for i, k, x in facts:
        found = []
        for chosen in sets:
            knots = {}
            for key, rank, power in points:
                if key == k and key is not None and rank is not None and chosen(power):
                    knots[rank] = max(knots.get(rank, power), power)
            low = max((r for r in knots if x is not None and r <= x), default=None)
            high = min((r for r in knots if x is not None and r > x), default=None)
            found += [knots.get(low), knots.get(high)]
        out[i] = tuple(found)
    return out


@pytest.mark.parametrize("rows, cuts", [(50, 1000), (20, 7), (10**6, 1000)])
def test_merged_brackets_with_hot_keys_and_hot_values(spark, monkeypatch, rows, cuts):
    import random

    monkeypatch.setattr(lookup, "BUCKET_ROWS", rows)
    monkeypatch.setattr(lookup, "CUTS", cuts)
    rng = random.Random(11)
    points = [("hot", float(rng.randint(0, 300)), float(rng.randint(0, 99))) for _ in range(400)]
    points += [(k, rng.random() * 9, rng.random()) for k in ("a", "b", None) for _ in range(20)]
    facts = [(i, "hot", rng.choice([7.0, 7.0, rng.uniform(-20, 330), float(rng.randint(0, 300))])) for i in range(1500)]
    facts += [(2000 + i, rng.choice(["a", "b", "none", None]), rng.choice([None, rng.random() * 10])) for i in range(200)]
    df = spark.createDataFrame(facts, "i int, k string, x double").repartition(5)
    table = spark.createDataFrame(points, "k string, rank double, power double")
    sets = {"even": F.col("power") % 2 == 0, "all": F.lit(True)}
    found = lookup.bracket_sets(df, table, "k", "x", "rank", sets, max_bytes=0)
    got = {r["i"]: tuple(r[c] and r[c]["power"] for c in ("even_lo", "even_hi", "all_lo", "all_hi")) for r in found.collect()}
    assert got == loop_brackets(points, facts, [lambda p: p % 2 == 0, lambda p: True])


def test_a_hot_value_is_spread(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BUCKET_ROWS", 100)
    df = spark.range(4000).selectExpr("cast(id as int) as i", "'t' as k", "if(id % 4 = 0, 7.0D, id / 10) as x")
    table = spark.range(50).selectExpr("'t' as k", "cast(id as double) as rank", "cast(id as double) as power")
    unique = lookup.unique_points(table, "k", "rank", {"": F.lit(True)})
    merged = lookup.merge_sets(df, unique, "k", "x", "rank", [""])
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert merged.count() == 4000 and plan.count("_row#") > 0
    # Windows are by bucket: with forty buckets none holds the thousand equal rows.
    physical = merged._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Window [") >= 2 and "k#" in physical
    wide = [x for x in physical.splitlines() if "Exchange hashpartitioning(k#" in x and "_b#" in x]
    assert len(wide) >= 1
    assert merged.where("x = 7 and _lo.rank <> 7").count() == 0 and merged.where("x = 7 and _hi.rank = 8").count() == 1001


def test_one_shuffle_of_the_fact_for_both_curves(spark):
    marks = spark.range(300).selectExpr("cast(id % 7 as string) as wtg_id", "id / 20 as ntf_wind_speed_standard", "id as mark")
    assignment = spark.range(7).selectExpr("cast(id as string) as wtg_id", "explode(array(1, 3)) as pc_type", "id % 3 as pc_id")
    points = spark.range(3).selectExpr("id as pc_id", "explode(sequence(0, 14)) as r").selectExpr("pc_id", "cast(r as double) as wind_speed_rank", "r * (1.0D + pc_id) as power")
    few, many = (ten_minute.assigned_power(marks, assignment, points, m) for m in (joins.MAX_BROADCAST_BYTES, 0))
    assert few.columns == many.columns and few.exceptAll(many).count() == 0 == many.exceptAll(few).count()
    plan = many._jdf.queryExecution().executedPlan().toString()
    # The marks are the only rows with this column; they pass one exchange, besides the one of the bucket counts.
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(_pcs" in x and "_b#" in x]) <= 2
