"""Streams driven to the end of what is there."""

import datetime as dt

from pyspark.sql import functions as F

from rotorlake.operators.series import avg_windows
from rotorlake.sources.tables import overwrite_partitions
from rotorlake.streaming import jobs, stateful

START = dt.datetime(2024, 1, 1, 23, 30)


def lines(first, last, step=7):
    times = (START + dt.timedelta(seconds=s) for s in range(first, last, step))
    return "".join(f"{t:%Y-%m-%d %H:%M:%S},{t.second}.5,{t.minute}\n" for t in times)


def run_means(spark, tmp_path):
    stream = jobs.follow_seconds(spark, str(tmp_path / "in"), ["a", "b"], files_per_batch=1)
    out = str(tmp_path / "out")
    jobs.write_by_day(jobs.ten_minute_means(stream, ["a", "b"]), out, str(tmp_path / "cp")).awaitTermination()
    return spark.read.parquet(out)


def test_means_follow_a_growing_folder(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text(lines(0, 2500))
    run_means(spark, tmp_path)
    (folder / "2.csv").write_text(lines(2504, 5400))
    # A row far in the future closes all windows before it.
    (folder / "3.csv").write_text("2024-01-03 00:00:00,0,0\n")
    out = run_means(spark, tmp_path)
    batch = spark.read.schema("ts timestamp, a double, b double").csv(str(folder))
    closed = avg_windows(batch, "ts", ["a", "b"]).where("ts < '2024-01-03'")
    assert out.select("ts", "a", "b").exceptAll(closed).count() == 0 and out.count() == closed.count() == 9
    assert {p.name for p in (tmp_path / "out").glob("date=*")} == {"date=2024-01-01", "date=2024-01-02"}


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text(lines(0, 5400))
    before = run_means(spark, tmp_path).collect()
    (folder / "2.csv").write_text("2024-01-01 23:30:01,1000,1000\n")
    (folder / "3.csv").write_text("2024-01-03 00:00:00,0,0\n")
    after = run_means(spark, tmp_path).where("ts = '2024-01-01 23:30:00'").collect()
    assert after == [r for r in before if r["ts"] == START]


def test_latest_row_per_key(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "k string, t int, s string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    latest = jobs.latest_per_key(stream, "k", "t")
    latest.writeStream.format("memory").queryName("latest_rows").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted(spark.table("latest_rows").collect()) == [("a", 3, "y"), ("b", 2, "z")]


def test_late_files_rewrite_every_day_they_touch(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "t")

    def rows(first, last, value):
        spread = spark.range(first, last).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"), F.lit(value).alias("v"))
        spread.write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema("d date, v int").parquet(source)
        jobs.reload_each_batch(stream, table, lambda: spark.read.parquet(source), "d", ["d"], str(tmp_path / "cp")).awaitTermination()

    rows(0, 10, 1)
    overwrite_partitions(spark.read.parquet(source), table, ["d"])
    run()
    rows(1, 9, 2)
    run()
    run()
    counts = spark.read.parquet(table).groupBy("d").count().orderBy("d").collect()
    assert [r["count"] for r in counts] == [1, *[2] * 8, 1]


def run_day_ends(spark, tmp_path):
    stream = jobs.follow_seconds(spark, str(tmp_path / "in"), ["a", "b"], mark="mark")
    out = str(tmp_path / "out")
    with stateful.state_store(spark):
        jobs.append_files(stateful.day_end_means(stream, "ts", ["a", "b"]), out, str(tmp_path / "cp")).awaitTermination()
    return sorted((r.ts, r.a, r.b) for r in spark.read.schema("ts timestamp, a double, b double").parquet(out).collect())


def test_the_last_window_of_a_day_needs_no_later_row(spark, tmp_path):
    setting = spark.conf.get(stateful.STATE_CONF)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text("2024-01-01 23:40:00,1,2\n2024-01-01 23:50:00,4,\n2024-01-01 23:59:58,6,\n")
    first = dt.datetime(2024, 1, 1, 23, 40)
    assert run_day_ends(spark, tmp_path) == [(first, 1.0, 2.0)]
    # The row of the day's last second closes its window, which goes on from the state of the run before.
    (folder / "2.csv").write_text("2024-01-01 23:59:59,8,\n")
    last = dt.datetime(2024, 1, 1, 23, 50)
    assert run_day_ends(spark, tmp_path) == [(first, 1.0, 2.0), (last, 6.0, None)]
    # A late row is dropped; the next day is closed by a mark, which is no row of a window.
    (folder / "3.csv").write_text("2024-01-01 23:59:59,100,100\n2024-01-02 12:00:01,1,1\n2024-01-02 23:51:00,3,\n")
    jobs.close_day(spark, str(folder), "2024-01-02", ["a", "b"])
    noon, night = dt.datetime(2024, 1, 2, 12), dt.datetime(2024, 1, 2, 23, 50)
    assert run_day_ends(spark, tmp_path) == [(first, 1.0, 2.0), (last, 6.0, None), (noon, 1.0, 1.0), (night, 3.0, None)]
    assert spark.conf.get(stateful.STATE_CONF) == setting


def test_the_last_row_is_carried_from_run_to_run(spark, tmp_path):
    schema = "k string, t timestamp_ntz, v double, n long"
    at = lambda day, h=0, m=0: dt.datetime(2024, 1, day, h, m)

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        with stateful.state_store(spark):
            jobs.append_files(stateful.carried_rows(stream, "k", "t"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return sorted((r.k, r.t, r.v, r.n) for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect())

    assert run([("a", at(2), 1.25, None), ("a", at(1, 5), 2.0, 1), ("b", at(1, 23, 50), 0.1, 2), ("c", at(2), None, 3)]) == []
    # b's last row is no midnight; c has no row of the day; a null time or key is no row.
    a = ("a", at(2), 1.25, None)
    assert run([("a", at(2, 0, 10), 9.0, 4), ("b", at(2, 0, 10), 9.0, 5), ("a", None, 1.0, 6), (None, at(2, 1), 1.0, 7)]) == [a]
    # Midnights inside a run open their days too; the same state is not handed out twice.
    b = ("b", at(3), 4.5, 8)
    assert run([("a", at(2, 0, 20), 9.0, 9), ("b", at(3), 4.5, 8), ("b", at(3, 1), 0.0, 8)]) == [a, b]
