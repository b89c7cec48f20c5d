"""Stage tables: days are replaced, buckets carry the next job's windows, and nothing of a row is lost on the way."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rotorlake.plans import daily, per_second, ten_minute
from rotorlake.session import shared_folder
from rotorlake.sources.stages import write_stage
from workload import queries
from workload.views import view


@pytest.fixture(scope="module")
def chain(spark, sf_dir):
    path = shared_folder(spark, "stage-test")
    stages = daily.Stages("stage_test", path, buckets=4)
    dims = [view(spark, sf_dir, n) for n in ("wtg_dim", "site_dim", "ntf_data", "wtg_pc", "pc_data")]
    daily.run_clean(stages, view(spark, sf_dir, "telemetry_10m"), dims[0])
    daily.run_calculation(stages, dims)
    daily.run_states(stages, queries._logs(spark, sf_dir))
    yield stages, dims
    for name in ("clean", "calculated", "states"):
        spark.sql(f"DROP TABLE IF EXISTS stage_test_{name}")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def below_windows(plan):
    """Lines of the plan below its lowest window on the way down to a stage."""
    lines = plan.splitlines()
    return lines[max(k for k, x in enumerate(lines) if "Window [" in x) :]


def test_no_exchange_below_the_windows(spark, chain):
    stages, dims = chain
    day = F.col("day") == F.lit("2024-01-04").cast("date")
    for days in (None, day):
        plan = final_plan(daily.production(stages, spark, days))
        assert "Window [" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert (days is None) or "PartitionFilters: [isnotnull(day" in plan
    plan = final_plan(ten_minute.calculate(stages.read(spark, "clean"), *dims))
    assert "Window [" in plan and "hashpartitioning(wtg_id" not in "\n".join(x for x in below_windows(plan) if "stage_test_clean" in x)
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(wtg_id" in x and "day" in x]


def test_stages_give_the_same_seconds(spark, sf_dir, chain):
    stages, _ = chain
    direct = per_second.production_base(queries._calculated(spark, sf_dir), queries._logs(spark, sf_dir), queries._roster(spark, sf_dir))
    staged = daily.production(stages, spark)
    few = F.col("wtg_id").isin("0", "3") & (F.minute("ts") < 2)
    assert staged.columns == direct.columns
    assert staged.where(few).exceptAll(direct.where(few)).count() == 0 == direct.where(few).exceptAll(staged.where(few)).count()


def test_every_column_of_the_seconds_is_reported(spark, sf_dir):
    rows = per_second.production_base(queries._calculated(spark, sf_dir), queries._logs(spark, sf_dir), queries._roster(spark, sf_dir))
    assert set(rows.columns) == {"wtg_id", "day", "ts", *queries.KINDS, *queries.PRODUCTION_DIGITS}


def test_a_day_is_replaced_alone_and_lies_in_one_file_a_bucket(spark, tmp_path):
    def rows(first, last, value):
        days = spark.range(first, last).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
        return days.crossJoin(spark.range(50).selectExpr("cast(id as string) as wtg_id")).withColumn("t", F.lit(1)).withColumn("v", F.lit(value))

    path = str(tmp_path / "s")
    for _ in range(2):
        write_stage(rows(0, 4, 1), "stage_days", path, "t", buckets=3)
        table = write_stage(rows(2, 3, 2), "stage_days", path, "t", buckets=3)
    got = {(r.day, r.v): r["count"] for r in table.groupBy("day", "v").count().collect()}
    assert got == {(dt.date(2024, 1, k), 2 if k == 3 else 1): 50 for k in range(1, 5)}
    assert all(len(list((tmp_path / "s" / f"day=2024-01-0{k}").glob("*.parquet"))) == 3 for k in range(1, 5))
    spark.sql("DROP TABLE stage_days")


def test_logs_are_read_once(spark, sf_dir):
    plan = final_plan(per_second.states(queries._logs(spark, sf_dir), queries._roster(spark, sf_dir)).where(F.minute("ts") == 0))
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x and "event_type" in x]
    assert len(scans) == len(queries.KINDS)


def test_tasks_follow_the_expanded_rows(spark, monkeypatch):
    from rotorlake.operators import series

    marks = spark.range(1000).selectExpr("cast(id % 3 as string) as wtg_id", "date'2024-01-01' as day", "timestamp_ntz'2024-01-01 00:10:00' + make_interval(0,0,0,0,0,10*id) as ts", "cast(id as double) as e")
    before = series.spread_energy(marks, "ts", {"e": "p"}).rdd.getNumPartitions()
    monkeypatch.setattr(series, "ROWS_PER_TASK", 20_000)
    after = series.spread_energy(marks, "ts", {"e": "p"})
    assert before == 4 and after.rdd.getNumPartitions() == 30 and after.count() == 600_000


def test_equally_late_rows_give_the_same_one(spark):
    from rotorlake.operators import series

    rows = [("a", 1, 5, "x"), ("a", 1, 7, None), ("a", 1, 7, "b"), ("b", None, 1, "z"), ("b", 2, 0, "y")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, t int, v int, s string").repartition(3)
        assert sorted(series.last_record(df, "k", "t").collect()) == [("a", 1, 7, "b"), ("b", 2, 0, "y")]
