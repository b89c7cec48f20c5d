"""Readers and writers on small files."""

import datetime as dt
import functools
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorlake.functions.text import partition_spec
from rotorlake.operators import joins
from rotorlake.schemas import create_table
from rotorlake.session import shared_folder
from rotorlake.sources import files, relational, tables
from workload import queries


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.mark.parametrize("stop", [False, True])
def test_header_files(spark, tmp_path, stop):
    put(tmp_path / "f1/t1/20240102/minute/minute_20240102.csv", "a,b\n1,2\n3\n5,6\n")
    put(tmp_path / "f1/t2/20240102/minute/minute_20240102.csv", "b,c,a\n1,2,3\n")
    put(tmp_path / "f1/t3/20240102/minute/minute_20240102.csv", "a\n1\n")
    master = spark.createDataFrame([("W1", "f1.x.t1", "S"), ("W2", "f1.x.t2", "S"), ("W3", "NULL", "S")], "wtg_id string, alias string, site_id string")
    ids = files.alias_paths(master, "20240102")
    assert {r["file_name"] for r in ids.collect()} == {"minute_20240102.csv"}
    kept, rejects = files.read_header_csv(spark, f"{tmp_path}/*/*/*/*/*.csv", ids, stop_at_bad=stop)
    rows = sorted(r["all_key_value"] for r in kept.collect())
    later = [] if stop else ["a:5,b:6,site_id:S,wtg_id:W1"]
    assert rows == sorted(["a:1,b:2,site_id:S,wtg_id:W1", "b:1,c:2,a:3,site_id:S,wtg_id:W2", *later])
    assert [r["value"] for r in rejects.collect()] == ["3"]


def test_large_header_file_is_split(spark, tmp_path):
    lines = ["n,x"] + [f"{i},{'y' * 50}" if i != 15000 else "bad" for i in range(20000)]
    put(tmp_path / "a/c/20240102/minute/minute_20240102.csv", "\n".join(lines))
    ids = spark.createDataFrame([("a/c/20240102/minute", "W", "S")], "folder string, wtg_id string, site_id string")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        for stop, expected in [(False, 19999), (True, 15000)]:
            kept, _ = files.read_header_csv(spark, f"{tmp_path}/*/*/*/*/*.csv", ids, stop_at_bad=stop)
            assert kept.rdd.getNumPartitions() > 5
            assert kept.count() == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_line_numbers_run_over_splits_and_text_is_read_once(spark, tmp_path):
    good = [f"{i},{'y' * (i % 40)}" for i in range(3000)]
    put(tmp_path / "a/c/20240102/minute/m.csv", "\n".join(["n,x", *good[:2000], "bad", *good[2000:], "worse,1,2"]))
    put(tmp_path / "a/d/20240102/minute/m.csv", "n\n1\n2,3\n")
    put(tmp_path / "a/e/20240102/minute/m.csv", "only,a,header")
    put(tmp_path / "a/f/20240102/minute/m.csv", "")
    ids = spark.createDataFrame([(f"a/{t}/20240102/minute", t, "S") for t in "cdef"], "folder string, wtg_id string, site_id string")
    glob = f"{tmp_path}/*/*/*/*/*.csv"
    lines = files.numbered_lines(spark, glob, split_bytes=1000)
    assert lines.select("file", "block").distinct().count() > 40
    found = {r.line: r.value for r in lines.where("file like '%/c/%'").collect()}
    assert [found[k] for k in range(3003)] == ["n,x", *good[:2000], "bad", *good[2000:], "worse,1,2"]
    setting = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for stop, n in ((False, 3001), (True, 2001)):
        kept, rejects = files.read_header_csv(spark, glob, ids, stop, split_bytes=1000)
        assert kept.count() == n
        assert sorted((r.line, r.value) for r in rejects.collect()) == [(2, "2,3"), (2001, "bad"), (3002, "worse,1,2")]
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and "FileScan parquet" in plan
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == setting


def put_turbines(tmp_path, turbines, rows):
    """Turbine files with a bad row in some; (rejects by file and line, rows up to the first bad one)."""
    rejects, kept = [], []
    for t in range(turbines):
        bad = {k for k in range(rows) if (k * 7 + t * 13) % 60 == 17 and t % 5}
        lines = [f"{k},x" if k in bad else f"{k},x,{t * k}" for k in range(rows)]
        put(tmp_path / f"a/t{t}/20240102/minute/m.csv", "\n".join(["n,note,v", *lines]) + "\n")
        rejects += [(f"t{t}", k + 1, f"{k},x") for k in sorted(bad)]
        kept += [f"n:{k},note:x,v:{t * k},site_id:S,wtg_id:W{t}" for k in range(min(bad, default=rows))]
    return sorted(rejects), sorted(kept)


def turbine_ids(spark, turbines):
    ids = [(f"a/t{t}/20240102/minute", f"W{t}", "S") for t in range(turbines)]
    return spark.createDataFrame(ids, "folder string, wtg_id string, site_id string")


def test_small_splits_make_no_task_and_file_each(spark, tmp_path):
    rejects, _ = put_turbines(tmp_path, 20, 150)
    lines = files.numbered_lines(spark, f"{tmp_path}/*/*/*/*/*.csv", split_bytes=100)
    assert lines.select("file", "block").distinct().count() > 200
    assert len(lines.inputFiles()) < 60
    _, found = files.read_header_csv(spark, f"{tmp_path}/*/*/*/*/*.csv", turbine_ids(spark, 20), split_bytes=100)
    assert sorted((r.file.split("/")[-4], r.line, r.value) for r in found.collect()) == rejects
    assert len(found.inputFiles()) < 60


@pytest.mark.parametrize("max_bytes", [joins.MAX_BROADCAST_BYTES, 0])
def test_rows_up_to_the_first_bad_one_of_packed_splits(spark, tmp_path, monkeypatch, max_bytes):
    monkeypatch.setattr(files, "lookup_join", functools.partial(joins.lookup_join, max_bytes=max_bytes))
    _, kept = put_turbines(tmp_path, 20, 150)
    found, _ = files.read_header_csv(spark, f"{tmp_path}/*/*/*/*/*.csv", turbine_ids(spark, 20), True, split_bytes=100)
    assert sorted(r.all_key_value for r in found.collect()) == kept
    assert len(found.inputFiles()) < 60
    # Of a file's splits each is joined by itself: none is copied for the sake of others.
    assert "_salt" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_one_scan_of_several_folders(spark, tmp_path):
    put(tmp_path / "t/ds=1/x.txt", "a\n")
    put(tmp_path / "t/ds=2/x.txt", "b\nc\n")
    put(tmp_path / "t_more/ds=1/x.txt", "d\n")
    put(tmp_path / "t/inner/ds=1/x.txt", "e\n")
    roots = {"one": f"{tmp_path}/t", "two": f"file://{tmp_path}/t_more/", "deep": f"{tmp_path}/t/inner"}
    lines = files.read_tagged(spark, roots, "/ds=*/*.txt")
    assert lines._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert sorted((r.tag, r.value) for r in lines.collect()) == [("deep", "e"), ("one", "a"), ("one", "b"), ("one", "c"), ("two", "d")]


def test_delimited_table_keeps_values_and_cuts_files(spark, tmp_path):
    schema = T.StructType.fromDDL("a string, b double, t timestamp_ntz, d string")
    rows = [("x", 1.5, dt.datetime(2024, 1, 1, 2, 3, 4, 5), "p"), (None, None, None, "p"), ("", 2.0, None, "q"), ("\\y", -0.25, None, "q")]
    for sep in ("\x01", ",", "\t"):
        name = f"text_table_{ord(sep)}"
        create_table(spark, name, schema, ["d"], str(tmp_path / name), sep, rows_per_file=1)
        tables.write_by_name(spark.createDataFrame(rows, schema), name, ["d"])
        assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, spark.createDataFrame(rows, schema).collect()))
        assert all(len(list((tmp_path / name / d).glob("*.csv"))) == 2 for d in ("d=p", "d=q"))
        spark.sql(f"DROP TABLE {name}")


def test_every_partition_has_a_task(spark, tmp_path):
    """More partitions than shuffle partitions, of few bytes: none waits for another."""
    schema = T.StructType.fromDDL("a long, d string")
    create_table(spark, "dealt_table", schema, ["d"], str(tmp_path / "dealt"), ",", rows_per_file=10)
    rows = spark.range(1205).select(F.col("id").alias("a"), F.when(F.col("id") < 1200, F.concat(F.lit("d"), F.col("id") % 12)).alias("d"))
    tables.write_by_name(rows, "dealt_table", ["d"])
    tasks = {p.name: {f.name.split("-")[1] for f in p.glob("*.csv")} for p in (tmp_path / "dealt").glob("d=*")}
    files = {p.name: len(list(p.glob("*.csv"))) for p in (tmp_path / "dealt").glob("d=*")}
    assert len(tasks) == 13 and all(len(t) == 1 for t in tasks.values())
    assert len({t for own in tasks.values() for t in own}) >= 12
    assert files == {p: 1 if "HIVE" in p else 10 for p in tasks}
    assert spark.table("dealt_table").count() == 1205
    spark.sql("DROP TABLE dealt_table")


def test_days_to_run(spark):
    at = lambda day, hour: int(dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc).timestamp())
    runs = spark.createDataFrame([(at(5, 3),), (at(5, 12),), (at(5, 12),)], "epoch long")
    present = {"daily": spark.createDataFrame([("20240104",)], "day string"), "reload": spark.createDataFrame([("20240103",)], "day string")}
    got = tables.days_to_run(runs, present, {"daily": (24, 0), "reload": (9, 2)})
    assert sorted(tuple(r) for r in got.collect()) == [("reload", "20240102"), ("reload", "20240104"), ("reload", "20240105")]


def test_delimited_rejects(spark, tmp_path):
    put(tmp_path / "t.csv", "id,ts,x\n1,2016-03-10 00:10:00,2.5\n2,nonsense,1\n3,2016-03-10 00:20:00,\\N\n")
    schema = T.StructType.fromDDL("id long, ts timestamp_ntz, x double")
    df = files.read_delimited(spark, str(tmp_path), schema, header=True, timestamp_format="yyyy-MM-dd HH:mm:ss", reject_column="bad")
    rows = df.cache().collect()
    assert [(r["id"], r["ts"], r["x"]) for r in rows if r["bad"] is None] == [
        (1, dt.datetime(2016, 3, 10, 0, 10), 2.5),
        (3, dt.datetime(2016, 3, 10, 0, 20), None),
    ]
    assert [r["bad"] for r in rows if r["bad"]] == ["2,nonsense,1"]


def test_rules(spark, tmp_path):
    put(tmp_path / "rules", "T:[213.15,333.15]\n\n# note: [1,2]\nW:(0,50]\nnacelle, -1080, +1080\n")
    parsed = files.parse_rules(spark.read.text(str(tmp_path)))
    rules = files.rules_dict(parsed, ["T", "W", "nacelle", "unruled"])
    assert rules == {"T": (213.15, 333.15), "W": (0.0, 50.0), "nacelle": (-1080.0, 1080.0)}
    assert files.rules_dict(parsed.union(parsed), ["W"]) == {"W": (0.0, 50.0)}


def test_log_file_names(spark, tmp_path):
    put(tmp_path / "loga.12.20240102.07", "x\ny\n")
    rows = files.read_logs(spark, str(tmp_path)).collect()
    assert {(r["log_type"], r["site"], r["yyyymmdd"], r["hour"], r["folder"]) for r in rows} == {
        ("loga", "12", "20240102", "07", "loga/site=12/yyyymmdd=20240102")
    }
    assert len(rows) == 2


def days(spark, n, value):
    return spark.range(n).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"), F.lit(value).alias("v"))


def test_day_rewrite_is_idempotent_and_local(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_partitions(days(spark, 6, 1), path, ["d"])
    for _ in range(2):
        tables.reload_days(days(spark, 6, 2), path, "d", "2024-01-05", ["d"])
    assert [r["v"] for r in tables.read_partitions(spark, path).orderBy("d").collect()] == [1, 1, 2, 2, 2, 1]


def test_files_are_cut_at_the_row_limit(spark, tmp_path):
    tables.overwrite_partitions(spark.range(0, 1000, 1, 1).withColumn("d", F.lit("x")), str(tmp_path / "t"), ["d"], rows_per_file=300)
    assert len(list((tmp_path / "t" / "d=x").glob("*.parquet"))) == 4


def test_two_level_partitions(spark, tmp_path):
    df = days(spark, 4, 1).withColumn("hp_ds", (F.dayofmonth("d") % 2).cast("string"))
    tables.overwrite_partitions(df, str(tmp_path / "t"), ["d", "hp_ds"], spread=["v"])
    assert len(list((tmp_path / "t").glob("d=*/hp_ds=*"))) == 4


def test_ring_replaces_its_slot(spark, tmp_path):
    path = str(tmp_path / "ring")
    first = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 1)], "d date, v int")
    later = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(days=100), 2)], "d date, v int")
    tables.ring_export(first, path, "d")
    tables.ring_export(later, path, "d")
    assert sorted((r["d"], r["v"]) for r in spark.read.parquet(path).collect()) == [(dt.date(2024, 1, 2), 1), (dt.date(2024, 4, 10), 2)]


def test_partition_spec_of_paths(spark):
    df = spark.createDataFrame([("/x/log/site=1/yyyymmdd=20240102/",)], "p string")
    assert df.select(partition_spec(F.col("p"))).first()[0] == 'site="1", yyyymmdd="20240102"'


def test_jdbc_options_only():
    """The options alone: a database is not started for a test."""
    plain = relational.reader_options("jdbc:x", "facts")
    assert "partitionColumn" not in plain
    split = relational.reader_options("jdbc:x", "facts", "id", ("0", "9"), 4)
    assert (split["partitionColumn"], split["numPartitions"], split["dbtable"]) == ("id", "4", "facts")
    with pytest.raises(ValueError):
        relational.reader_options("jdbc:x", "facts", "id")


def test_shared_folder_follows_the_setting(spark):
    first, second = shared_folder(spark, "a"), shared_folder(spark, "a")
    base = spark.conf.get("spark.checkpoint.dir")
    assert first != second and first.startswith(base) and second.startswith(base)


def test_turbine_files_in_the_order_of_events(spark, tmp_path):
    columns = ["id as event_id", "timestamp_ntz '2024-01-01 00:00:00' + interval '1' minute * id as ts", "id % 230 as user_id", "'view' as event_type", "id / 10 as value", "'' as props"]
    spark.range(6000).selectExpr(*columns).repartition(7, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    roots, ids = queries._turbine_files(spark, str(tmp_path), f"{tmp_path}/made")
    made = [p for root in roots for p in Path(root).rglob("part-*.csv")]
    assert len(made) == ids.count() == 230
    folders = {f.parent.relative_to(tmp_path / "made").as_posix().split("/", 1)[1] for f in made}
    assert folders == {r.folder for r in ids.collect()}
    for file in made:
        head, *rows = file.read_text().replace("\0", "").splitlines()
        place = head.split(",").index("event_id")
        events = [int(r.split(",")[place]) for r in rows]
        assert events == sorted(events) and len(events) > 20
    # All cores make files, however few bytes they hold, and each file takes one folder of its own.
    tasks = {f.name.split("-")[1] for f in made if "/site0/" not in str(f)}
    assert len(tasks) >= 2 * spark.sparkContext.defaultParallelism
    assert len([p for root in roots for p in Path(root).rglob("*") if p.is_dir()]) < 230 + 20


def test_small_files_are_read_by_few_tasks(spark, tmp_path, monkeypatch):
    put_turbines(tmp_path, 60, 20)
    setting = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(files, "SPLITS_A_TASK", 50)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        lines = files.stored_lines(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", setting)
    assert lines.count() == 60 * 21 and len(lines.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism


def test_folders_are_read_with_all_below_them(spark, tmp_path):
    rejects, kept = put_turbines(tmp_path / "x", 6, 40)
    put(tmp_path / "x/_hidden/b/c/m.csv", "no\n1,2\n")
    ids = turbine_ids(spark, 6)
    found = [files.read_header_csv(spark, p, ids, True) for p in (str(tmp_path / "x"), f"{tmp_path}/x/a/*/*/*/*.csv")]
    for rows, left in found:
        assert sorted(r.all_key_value for r in rows.collect()) == kept
        assert sorted((r.file.split("/")[-4], r.line, r.value) for r in left.collect()) == rejects
    for setting in ("spark.sql.files.maxPartitionNum", "spark.sql.files.openCostInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism"):
        assert spark.conf.get(setting, None) is None
