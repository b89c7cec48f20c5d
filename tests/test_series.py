"""Grids, deltas, padded states and energy against plain Python loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rotorlake.operators import joins, lookup, series
from rotorlake.plans import per_second, ten_minute

DAY = dt.datetime(2024, 1, 1)
STEP = dt.timedelta(minutes=10)
SECOND = dt.timedelta(seconds=1)


def test_grid_has_every_mark(spark):
    rng = random.Random(1)
    marks = sorted(rng.sample(range(1, 289), 60)) + [144]
    rows = [("a", DAY + STEP * m, float(m)) for m in set(marks)] + [("b", DAY + STEP * 100, 1.0)]
    df = spark.createDataFrame(rows, "wtg_id string, datatime timestamp_ntz, x double")
    out = series.fill_grid(df, "wtg_id", "datatime").collect()
    per_day = {}
    for r in out:
        per_day.setdefault((r["wtg_id"], r["day"]), {})[r["datatime"]] = r
    first, second = DAY.date(), (DAY + dt.timedelta(days=1)).date()
    # The midnight row of the first day opens the second.
    assert {k: len(v) for k, v in per_day.items()} == {("a", first): 144, ("a", second): 145, ("b", first): 144}
    real = {(k, t): x for k, t, x in rows}
    for (turbine, _), grid in per_day.items():
        for t, r in grid.items():
            assert r["x"] == real.get((turbine, t)) and r["is_filled"] == ((turbine, t) not in real)
    again = series.fill_grid(df.orderBy(F.desc("datatime")), "wtg_id", "datatime").collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_carried_row_alone_gives_a_day_up_to_the_run_day(spark):
    df = spark.createDataFrame([("a", DAY + dt.timedelta(days=1), 1.0)], "wtg_id string, datatime timestamp_ntz, x double")
    assert series.fill_grid(df, "wtg_id", "datatime").count() == 144
    assert series.fill_grid(df, "wtg_id", "datatime", last_day="2024-01-02").count() == 144 + 145
    assert series.fill_grid(df, "wtg_id", "datatime", last_day="2024-01-02", keep_carry=False).count() == 288


def test_delta_across_midnight_and_gaps(spark):
    rows = [("a", DAY + STEP * m, float(m * m)) for m in (1, 2, 4, 143, 144, 145)]
    df = spark.createDataFrame(rows, "wtg_id string, datatime timestamp_ntz, x double")
    deltas = ten_minute.without_carry(series.counter_delta(series.fill_grid(df, "wtg_id", "datatime"), "wtg_id", "datatime", ["x"]))
    found = {r["datatime"]: r["x_delta"] for r in deltas.collect() if r["x_delta"] is not None}
    assert found == {DAY + STEP * 2: 3.0, DAY + STEP * 144: 287.0, DAY + STEP * 145: 289.0}


def test_duplicate_marks_keep_the_last_load(spark):
    rows = [("a", DAY, i, float(i)) for i in (3, 1, 2)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, n int, x double")
    assert series.last_per(df, ["k", "ts"], "n", ["x"]).collect() == [("a", DAY, 3.0)]


def make_logs(spark, rng, days=3):
    rows = []
    for kind in ("nc_id", "ss_id", "sc_id"):
        for turbine in ("a", "b", "c"):
            for _ in range(0 if (kind, turbine) == ("sc_id", "a") else 25):
                second = rng.choice([rng.randrange(0, days * 86400), 86400, 86401, 43200])
                if turbine == "c":
                    second = rng.randrange(0, 3600)  # silent on later days
                rows.append((turbine, kind, DAY + SECOND * second, rng.randrange(10**6), rng.choice([None, 1, 2, 3])))
    df = spark.createDataFrame(rows, "wtg_id string, kind string, starttime timestamp_ntz, msec int, state_id int")
    return rows, {k: df.where(F.col("kind") == k).drop("kind") for k in ("nc_id", "ss_id", "sc_id")}


def brute_states(rows, roster):
    """Walk all seconds with the last event of each log at or before them."""
    out = {}
    for turbine, day in roster:
        start = dt.datetime.combine(day, dt.time())
        mine = sorted((r for r in rows if r[0] == turbine), key=lambda r: (r[2], r[3]))
        if not any(r[2] <= start + dt.timedelta(days=1) for r in mine):
            continue
        held, at = {}, 0
        for s in range(1, 86401):
            now = start + SECOND * s
            while at < len(mine) and mine[at][2] <= now:
                held[mine[at][1]] = mine[at][4]
                at += 1
            out[turbine, now] = tuple(held.get(k) for k in ("nc_id", "ss_id", "sc_id"))
    return out


def test_padded_states(spark):
    rng = random.Random(7)
    rows, logs = make_logs(spark, rng)
    days = [(DAY + dt.timedelta(days=d)).date() for d in range(3)]
    roster = [("a", days[0]), ("a", days[2]), ("b", days[1]), ("c", days[2]), ("nobody", days[0])]
    roster_df = spark.createDataFrame(roster, "wtg_id string, day date")
    seconds = series.pad_states(logs, roster_df)
    found = {(r["wtg_id"], r["ts"]): (r["nc_id"], r["ss_id"], r["sc_id"]) for r in seconds.toLocalIterator()}
    assert found == brute_states(rows, roster)


def test_golden_states(spark):
    rows = [("a", DAY + SECOND * 3, 0, 7), ("a", DAY + SECOND * 10, 0, None)]
    log = spark.createDataFrame(rows, "wtg_id string, starttime timestamp_ntz, msec int, state_id int")
    roster = spark.createDataFrame([("a", DAY.date())], "wtg_id string, day date")
    intervals = series.state_intervals({"s": log}, roster).orderBy("start_time").collect()
    assert [(r["start_time"] - DAY, r["end_time"] - DAY, r["s"]) for r in intervals] == [
        (SECOND, 3 * SECOND, None),
        (3 * SECOND, 10 * SECOND, 7),
        (10 * SECOND, 86401 * SECOND, None),
    ]


def test_production_base_is_the_outer_join(spark):
    """Interval merge equals the full outer join of both per-second tables; one turbine has energy only."""
    rng = random.Random(3)
    rows, logs = make_logs(spark, rng, 1)
    marks = [
        (t, DAY.date(), DAY + STEP * m, 288.15, *[rng.choice([None, rng.random() * 300]) for _ in range(3)])
        for t in ("a", "d")
        for m in range(1, 145)
    ]
    schema = "wtg_id string, day date, datatime timestamp_ntz, temoutave double, " + ", ".join(f"{c} double" for c in per_second.ENERGIES)
    calculated = spark.createDataFrame(marks, schema)
    base = per_second.production_base(calculated, logs)
    spread = series.spread_energy(calculated, "datatime", per_second.ENERGIES).withColumnRenamed("datatime", "ts")
    spread = spread.withColumn("temoutave", F.col("temoutave") - 273.15)
    states = series.pad_states(logs, calculated.select("wtg_id", "day").distinct())
    expected = spread.join(states, ["wtg_id", "day", "ts"], "full_outer").select(*base.columns)
    assert base.count() == 2 * 86400
    assert base.exceptAll(expected).count() == 0 and expected.exceptAll(base).count() == 0
    total = base.where("wtg_id = 'd'").agg(F.sum("production_per_second")).first()[0]
    assert total == pytest.approx(sum(m[4] for m in marks if m[0] == "d" and m[4] is not None))


def test_seconds_of_the_day_are_counted(spark):
    rows = [("a", DAY.date(), DAY + SECOND, DAY + 601 * SECOND), ("a", DAY.date(), DAY + 86399 * SECOND, DAY + 86401 * SECOND), ("b", None, DAY, DAY + SECOND)]
    intervals = spark.createDataFrame(rows, "wtg_id string, day date, start_time timestamp_ntz, end_time timestamp_ntz")
    found = series.expand_seconds(intervals, second="second")
    assert found.columns == ["wtg_id", "day", "ts", "second"]
    assert sorted((r.ts - DAY) // SECOND for r in found.where("day is not null").collect()) == [*range(1, 601), 86399, 86400]
    assert all(r.second == (None if r.day is None else (r.ts - DAY) // SECOND) for r in found.collect())


def test_what_a_run_shares_is_computed_once(spark, sf_dir):
    """Codes of columns and times of day lie below the expansion, where a run is one row."""
    from workload import queries

    for name in ("production_base", "energy_seconds", "state_seconds"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        spread = next(k for k, x in enumerate(plan) if "Generate posexplode" in x)
        assert not [x for x in plan[:spread] if "rint(" in x.lower() or "unix_seconds(" in x or "hour(" in x.replace("AS hour", "")]


def lookup_case(spark):
    """A third of the rows and of the points belong to one key, many rows repeat one value."""
    rng = random.Random(5)
    points = {("hot", float(r)): r * 1.5 for r in rng.sample(range(2000), 400)}
    points |= {(f"k{k}", float(r)): r * 2.0 for k in range(40) for r in rng.sample(range(2000), 20)}
    rows = [("hot", rng.choice([5.5, 1999.5, -3.0, None, 777.0])) for _ in range(600)]
    rows += [(f"k{rng.randrange(45)}", rng.choice([None, float(rng.randrange(-5, 2005)), rng.random() * 2000])) for _ in range(1200)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "i int, key string, v double")
    table = spark.createDataFrame([(k, r, p) for (k, r), p in points.items()], "key string, rank double, p double")
    below, above = {}, {}
    for i, key, v in rows:
        own = sorted(r for k, r in points if k == key)
        low = [r for r in own if v is not None and r <= v]
        high = [r for r in own if v is not None and r > v]
        below[i] = (low[-1], points[key, low[-1]]) if low else None
        above[i] = (high[0], points[key, high[0]]) if high else None
    return df, table, below, above


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_ordered_lookup(spark, max_bytes):
    df, table, below, above = lookup_case(spark)
    found = lookup.asof_lookup(df, table, "key", "v", "rank", "lo", "hi", known="known", max_bytes=max_bytes).collect()
    assert len(found) == len(below)
    assert {r["i"]: r["lo"] and tuple(r["lo"]) for r in found} == below
    assert {r["i"]: r["hi"] and tuple(r["hi"]) for r in found} == above
    assert all(r["known"] == (r["key"] not in {f"k{k}" for k in range(40, 45)}) for r in found)


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_bracket_sets(spark, max_bytes):
    df, table, below, above = lookup_case(spark)
    both = table.withColumn("kind", F.lit(1)).union(table.withColumn("kind", F.lit(2)).where("p > 100"))
    sets = {"one": F.col("kind") == 1, "two": (F.col("kind") == 2) & (F.col("p") > 1e9)}
    found = lookup.bracket_sets(df, both, "key", "v", "rank", sets, max_bytes).collect()
    assert {r["i"]: r["one_lo"] and tuple(r["one_lo"])[:2] for r in found} == below
    assert {r["i"]: r["one_hi"] and tuple(r["one_hi"])[:2] for r in found} == above
    assert all(r["two_lo"] is None and r["two_hi"] is None for r in found) and len(found) == len(below)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, how):
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 70).alias("k"), F.col("id").alias("n"))
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    plain = fact.join(dim, "k", how)
    small = joins.lookup_join(fact, dim, "k", how)
    large = joins.lookup_join(fact, dim, "k", how, max_bytes=0)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert sorted(large.collect(), key=str) == sorted(plain.collect(), key=str) == sorted(small.collect(), key=str)


def test_measured_bytes_counts_texts(spark):
    df = spark.range(10).select("id", F.lit("x" * 100).alias("t"), F.array(F.lit("y" * 50)).alias("a"))
    assert joins.measured_bytes(df) > 10 * (8 + 100 + 50)


def test_expansion_keeps_its_partitions(spark):
    """A day per turbine is a tiny shuffle and a large expansion; it must not end up in one task."""
    days = [(str(t), DAY + dt.timedelta(days=d)) for t in range(20) for d in range(3)]
    log = spark.createDataFrame([(t, d + SECOND, 0, 1) for t, d in days], "wtg_id string, starttime timestamp_ntz, msec int, state_id int")
    roster = spark.createDataFrame([(t, d.date()) for t, d in days], "wtg_id string, day date")
    per_task = series.pad_states({"s": log}, roster).groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 4 and sum(r["count"] for r in per_task) == 60 * 86400
