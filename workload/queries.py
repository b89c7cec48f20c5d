"""One query per operator of the work list; each reads whole tables below ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorlake.functions import bits, calendar
from rotorlake.functions.text import partition_spec
from rotorlake.operators import cleaning, mapping, quality, series
from rotorlake.plans import daily, minute, per_second, station, ten_minute
from rotorlake.schemas import COUNTERS, STATION_MEASURES, TEN_MINUTE_MEASURES, column_name, create_table
from rotorlake.session import shared_folder
from rotorlake.sources import files, relational, tables
from rotorlake.streaming import jobs, stateful
from workload.views import view

DAY = "2024-01-04"
#: Where the runs of streams over all days are cut.
MIDDLE = "2024-01-15"
KINDS = ["nc_id", "ss_id", "sc_id"]
#: Tasks for each core that make turbine files.
WRITERS = 4

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn``. Days leave as text: engines hand a date to pandas in different types."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        days = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
        return df.withColumns({d: F.date_format(d, "yyyy-MM-dd") for d in days}) if days else df

    QUERIES[fn.__name__] = run
    return fn


def _rounded(df: DataFrame, cols: list[str], digits: int = 8) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _joined_text(df: DataFrame, col: str, array) -> DataFrame:
    return df.withColumn(col, F.array_join(array, "; "))


def _epoch(ts):
    return F.unix_seconds(ts.cast("timestamp"))


def _e5(col: str):
    """Energy with five decimals as a whole number, so that sums are exact."""
    return F.rint(F.col(col) * 100000).cast("long")


#: Decimals that count of each column of the production base; 8 for small numbers, 3 for measured ones.
PRODUCTION_DIGITS = {
    **dict.fromkeys(TEN_MINUTE_MEASURES, 3),
    "clean_flag": 0,
    **dict.fromkeys(["air_density", "ntf_wind_speed", "ntf_wind_speed_site", "ntf_wind_speed_standard"], 8),
    **{f"real_{c}_10m": 3 for c in COUNTERS},
    "real_approduction_10m_errors": 0,
    **dict.fromkeys(["theory_power_10m", "theory_approduction_10m", "active_power_10m", "active_approduction_10m"], 6),
    **dict.fromkeys(per_second.ENERGIES.values(), 5),
}
#: A null's code, the modulus of codes, and the weights of seconds.
NULL_CODE, CODES, WEIGHTS = 999_979, 1_000_003, 97
#: Columns of one digest.
DIGEST_COLUMNS = 6


def _row_codes(digits):
    """A code of every ``DIGEST_COLUMNS`` columns of a run.

    Columns are whole numbers after scaling, so both engines sum the same; another value in any column of any second,
    or a row in another second, changes a sum. The parts of a code are added as doubles, which hold them exactly: a
    checked cast for each column would make the method too large to be compiled.
    """
    codes = []
    for k, (name, n) in enumerate(digits.items(), 1):
        whole = F.col(name).cast("long") % CODES if n == 0 else F.rint(F.col(name) * 10**n) % float(CODES)
        codes.append(F.coalesce(whole.cast("double"), F.lit(float(NULL_CODE))) * float(k))
    parts = [codes[at : at + DIGEST_COLUMNS] for at in range(0, len(codes), DIGEST_COLUMNS)]
    return {f"row_digest_{k * DIGEST_COLUMNS}": reduce(Column.__add__, part).cast("long") % CODES for k, part in enumerate(parts)}


# --- shared steps -------------------------------------------------------------------------------


def _clean(spark, sf, keep_carry=True):
    return ten_minute.clean(view(spark, sf, "telemetry_10m"), view(spark, sf, "wtg_dim"), keep_carry=keep_carry)


def _speeds(spark, sf):
    sited = ten_minute.with_site(_clean(spark, sf), view(spark, sf, "wtg_dim"), view(spark, sf, "site_dim"))
    return ten_minute.corrected_speeds(ten_minute.transfer_speeds(sited, view(spark, sf, "ntf_data")))


def _calculated(spark, sf):
    dims = [view(spark, sf, n) for n in ("wtg_dim", "site_dim", "ntf_data", "wtg_pc", "pc_data")]
    return ten_minute.calculate(_clean(spark, sf), *dims)


def _roster(spark, sf):
    """Days of the turbines, from the marks alone."""
    raw = view(spark, sf, "telemetry_10m").select("wtg_id", "datatime")
    days = series.days_of(raw.where(~series.off_grid(F.col("datatime"))), "wtg_id", "datatime")
    return ten_minute.lookup_join(days, view(spark, sf, "wtg_dim").select("wtg_id"), "wtg_id")


def _logs(spark, sf):
    log = view(spark, sf, "state_log")
    return {k: log.where(F.col("kind") == k).drop("kind") for k in KINDS}


# --- sources and sinks --------------------------------------------------------------------------


@query
def kv_parse(spark, sf):
    return cleaning.parse_kv(view(spark, sf, "kv_raw"), tz="UTC")


@query
def delimited_scan(spark, sf):
    cols = ["event_id", "wtg_id", "data_time", "temp_out_door", "read_wind_speed"]
    path = shared_folder(spark, "delimited")
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    writer = view(spark, sf, "telemetry").select(*cols).write.option("sep", "\x01").option("nullValue", "\\N")
    writer.option("timestampNTZFormat", stamp).csv(path)
    schema = "event_id long, wtg_id string, data_time timestamp_ntz, temp_out_door double, read_wind_speed double"
    return files.read_delimited(spark, path, T.StructType.fromDDL(schema), sep="\x01", timestamp_format=stamp)


def _turbine_files(spark, sf, base):
    """Turbine files of two kinds of header, rows by event, some with one field too many; (roots, ids of the folders).

    The folder of the turbine comes last: every folder takes as long to make as a file, and those above are shared. The
    files are dealt to given tasks, since the adaptive planner would join partitions of few bytes, however many files
    they hold. With the constant ``minute`` among the sort columns the writer would sort anew, without the events.
    """
    tasks = max(WRITERS * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    note = F.when(F.col("event_id") % 50 == 0, F.lit("a,b")).otherwise(F.lit("ok"))
    rows = view(spark, sf, "telemetry").select(
        F.col("site_id").alias("a"),
        F.col("wtg_id").alias("c"),
        F.date_format("data_time", "yyyyMMdd").substr(1, 6).alias("day"),
        F.lit("x").alias("minute"),
        "event_id",
        note.alias("note"),
        F.col("temp_out_door").cast("long").alias("temout"),
    )
    keys = ["a", "day", "minute", "c"]
    heads = {"site0": ["event_id", "note", "temout"], "other": ["temout", "event_id", "note"]}
    for kind, cols in heads.items():
        chosen = F.col("a") == "site0" if kind == "site0" else F.col("a") != "site0"
        spread = rows.where(chosen).select(*keys, *cols).repartition(tasks, "a", "day", "c").sortWithinPartitions("a", "day", "c", "event_id")
        writer = spread.write.option("header", True).option("quote", "\u0000").option("emptyValue", "").option("nullValue", "N/A")
        writer.partitionBy(*keys).csv(f"{base}/{kind}")
    ids = rows.select(*keys).distinct().select(
        F.concat_ws("/", *[F.concat(F.lit(k + "="), F.col(k)) for k in keys]).alias("folder"),
        F.col("c").alias("wtg_id"),
        F.col("a").alias("site_id"),
    )
    return [f"{base}/{k}" for k in heads], ids


@query
def header_csv_ingest(spark, sf):
    """Turbine files with rows that are left out."""
    roots, ids = _turbine_files(spark, sf, shared_folder(spark, "turbine-files"))
    return files.read_header_csv(spark, roots, ids)[0]


@query
def header_csv_stop(spark, sf):
    """The same files, each read in several splits up to its first bad row."""
    roots, ids = _turbine_files(spark, sf, shared_folder(spark, "turbine-files"))
    return files.read_header_csv(spark, roots, ids, stop_at_bad=True, split_bytes=600)[0]


@query
def header_csv_rejects(spark, sf):
    """The rows left out, with their true line numbers."""
    roots, ids = _turbine_files(spark, sf, shared_folder(spark, "turbine-files"))
    rejects = files.read_header_csv(spark, roots, ids, split_bytes=600)[1]
    place = F.split("file", "/")
    return rejects.select(F.substring_index(F.element_at(place, -2), "=", -1).alias("wtg_id"), "line", F.translate("value", "\u0000", "").alias("value"))


@query
def tagged_scan(spark, sf):
    """Curve points and staged rows, partitions of two levels, in one scan; rows told apart by their folder."""
    base = shared_folder(spark, "tagged")
    curve = view(spark, sf, "power_curve")
    ds = F.substring("created_time", 1, 4).alias("hp_ds")
    curve.select(F.concat_ws("\x01", "wtg_id", "wind_speed_rank", "created_time").alias("value"), ds).write.partitionBy("hp_ds").text(f"{base}/curve")
    fact = view(spark, sf, "telemetry")
    line = F.concat_ws("\x01", "wtg_id", F.col("event_id").cast("string")).alias("value")
    fact.select(line, F.date_format("data_time", "yyyyMMdd").alias("hp_date")).write.partitionBy("hp_date").text(f"{base}/curve_fact")
    lines = files.read_tagged(spark, {"curve": f"{base}/curve", "fact": f"{base}/curve_fact"}, "/hp_*=*")
    return lines.select("tag", "value", F.regexp_extract("file", "/hp_[a-z]+=([^/]+)/", 1).alias("part"))


@query
def delimited_tables(spark, sf):
    """Rows through a catalog table of \\001 text into one of comma text, by name; files are cut at 100 rows."""
    base = shared_folder(spark, "delimited-tables")
    schema = T.StructType.fromDDL("event_id long, wtg_id string, data_time timestamp_ntz, temp_out_door double, hp_date string")
    day = F.date_format("data_time", "yyyy-MM-dd").alias("hp_date")
    rows = view(spark, sf, "telemetry").select("event_id", "wtg_id", "data_time", "temp_out_door", day)
    for kind, sep in (("ods", "\x01"), ("dw", ",")):
        name = f"{kind}_{base.rsplit('-', 1)[1]}"
        create_table(spark, name, schema, ["hp_date"], f"{base}/{kind}", sep, rows_per_file=100)
        tables.write_by_name(rows, name, ["hp_date"])
        rows = spark.table(name)
    per_file = rows.groupBy("hp_date", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("event_id").alias("ids"),
        F.sum(F.col("wtg_id").cast("long")).alias("turbines"),
        F.sum(_epoch(F.col("data_time"))).alias("times"),
        F.count("temp_out_door").alias("known"),
        F.sum("temp_out_door").alias("temperatures"),
    )
    sums = [F.sum(c).alias(c) for c in ("ids", "turbines", "times", "known", "temperatures")]
    return per_file.groupBy("hp_date").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_files"), F.max("n").alias("most_rows"), *sums)


@query
def days_to_run(spark, sf):
    """Days that daily, hourly and reloading jobs should have made, one run each hour with rows, and have not."""
    base = shared_folder(spark, "runs")
    rows = view(spark, sf, "telemetry").select("event_id", "data_time", F.date_format("data_time", "yyyyMMdd").alias("hp_date"))
    jobs_of = {"daily": (24, 0), "hourly": (9, 0), "reload": (9, 2)}
    present = {}
    for k, job in enumerate(jobs_of):
        tables.overwrite_partitions(rows.where(F.dayofmonth("data_time") % (3 + k) != 0), f"{base}/{job}", ["hp_date"])
        present[job] = tables.days_present(spark, f"{base}/{job}", "hp_date")
    runs = rows.select(F.unix_seconds(F.date_trunc("hour", "data_time").cast("timestamp")).alias("epoch"))
    return tables.days_to_run(runs, present, jobs_of)


@query
def alias_path_map(spark, sf):
    return files.alias_paths(view(spark, sf, "master_list"), "20240102")


@query
def rules_scan(spark, sf):
    return files.parse_rules(view(spark, sf, "rule_lines"))


@query
def time_range_scan(spark, sf):
    return relational.time_range(view(spark, sf, "events"), "ts", DAY, ["event_id", "ts", "value"])


@query
def export_clean(spark, sf):
    return _clean(spark, sf).select(*ten_minute.CLEAN_COLUMNS)


@query
def export_files(spark, sf):
    """Raw marks as one folder of files for each kind of day, read together, cleaned and written as the export."""
    base = shared_folder(spark, "raw-marks")
    raw = view(spark, sf, "telemetry_10m").withColumn("part", F.pmod(F.dayofmonth("datatime"), F.lit(3)))
    raw.write.partitionBy("part").parquet(base)
    read = spark.read.schema(raw.drop("part").schema).parquet(*[f"{base}/part={k}" for k in range(3)])
    clean = ten_minute.clean(read, view(spark, sf, "wtg_dim")).select("day", *ten_minute.CLEAN_COLUMNS)
    path = shared_folder(spark, "export")
    tables.overwrite_partitions(clean.withColumn("month", F.date_format("day", "yyyyMM")), path, ["month"])
    return spark.read.parquet(path).select(*ten_minute.CLEAN_COLUMNS)


@query
def station_partitions(spark, sf):
    """The station extract of two days, written to their partitions; the second day is written twice."""
    path = shared_folder(spark, "station")
    for day in (DAY, "2024-01-05", "2024-01-05"):
        tables.overwrite_partitions(station.weather_station(view(spark, sf, "fact_10m"), day), path, ["hp_date", "hp_ds"])
    back = spark.read.parquet(path)
    return back.withColumns({c: F.col(c).cast("string") for c in ("hp_date", "hp_ds")}).select(
        "site_id", "wtg_id", "date_time", "p_date", *STATION_MEASURES, "hp_date", "hp_ds"
    )


@query
def ring_export(spark, sf):
    """Days in their slots of the ring."""
    path = shared_folder(spark, "ring")
    rows = view(spark, sf, "telemetry").select("event_id", F.to_date("data_time").alias("day"))
    tables.ring_export(rows, path, "day")
    return spark.read.parquet(path).select("event_id", F.col("ring").cast("int").alias("ring"))


@query
def arity_check(spark, sf):
    """Comma text of the 1-minute table; rows with a field too many are left out."""
    return cleaning.parse_warehouse_text(view(spark, sf, "warehouse_text"))


@query
def partition_overwrite(spark, sf):
    """All days are written, then the days after the 10th once more with other values."""
    path = shared_folder(spark, "by-day")
    rows = view(spark, sf, "telemetry").select("event_id", "data_time", F.date_format("data_time", "yyyy-MM-dd").alias("hp_date"))
    tables.overwrite_partitions(rows, path, ["hp_date"])
    again = rows.where(F.col("hp_date") > "2024-01-10").withColumn("event_id", -F.col("event_id"))
    tables.overwrite_partitions(again, path, ["hp_date"])
    return tables.read_partitions(spark, path).select("event_id", "data_time", F.col("hp_date").cast("string").alias("hp_date"))


@query
def partition_register(spark, sf):
    path = shared_folder(spark, "registered")
    rows = view(spark, sf, "telemetry").select("event_id", "site_id", F.date_format("data_time", "yyyyMM").alias("month"))
    rows.withColumnRenamed("site_id", "site").write.partitionBy("site", "month").parquet(path)
    name = "logs_" + path.rsplit("-", 1)[1]
    schema = T.StructType.fromDDL("event_id long, site string, month string")
    create_table(spark, name, schema, ["site", "month"], path)
    folders = rows.select(F.concat(F.lit(path + "/site="), "site_id", F.lit("/month="), "month").alias("location")).distinct()
    tables.register_partitions(spark, name, folders.withColumn("spec", partition_spec(F.col("location"))))
    return spark.table(name).select("event_id", "site", "month")


@query
def rolling_reload(spark, sf):
    rows = view(spark, sf, "telemetry").withColumn("hp_date", F.to_date("data_time"))
    return tables.reload_window(rows, "hp_date", "2024-01-10").select("event_id", "wtg_id", "hp_date")


@query
def path_columns(spark, sf):
    return files.with_path_columns(view(spark, sf, "log_files"))


@query
def ring_partition(spark, sf):
    day = F.to_date("data_time")
    return view(spark, sf, "telemetry").select("event_id", calendar.ring_number(day).alias("ring"))


@query
def weather_station(spark, sf):
    return station.weather_station(view(spark, sf, "fact_10m"), DAY)


# --- 1-minute chain -----------------------------------------------------------------------------


@query
def range_clean(spark, sf):
    return cleaning.clean_ranges(view(spark, sf, "telemetry"))


def _staged(spark, sf):
    fact = cleaning.clean_ranges(view(spark, sf, "telemetry"))
    cols = ["event_id", "wtg_id", "data_time", "temp_out_door", "wind_direction", "wind_vane", "pitch_angle"]
    cols += ["read_wind_speed", "rotor_speed", "gen_speed", "active_power", "wtg_type_id", "wtg_type_name", "rated_power"]
    return minute.staging(fact, view(spark, sf, "wtg_dim").drop("rated_power"), view(spark, sf, "wtg_type"), cols)


@query
def feature_staging(spark, sf):
    return _staged(spark, sf)


@query
def ideal_power(spark, sf):
    return _rounded(minute.ideal_power(_staged(spark, sf), view(spark, sf, "power_curve")), ["ideal_active_power"], 6)


@query
def minute_chain(spark, sf):
    """One day from text to feature in one plan."""
    dims = [view(spark, sf, "wtg_dim").drop("rated_power"), view(spark, sf, "wtg_type"), view(spark, sf, "power_curve")]
    chain = minute.minute_chain(view(spark, sf, "kv_raw"), *dims, day=DAY.replace("-", ""), tz="UTC")
    cols = ["wtg_id", "data_time", "temp_out_door", "read_wind_speed", "wtg_type_name", "rated_power", "ideal_active_power"]
    return _rounded(chain.select(*cols), ["ideal_active_power"], 6)


# --- ids and sets -------------------------------------------------------------------------------


@query
def id_remap(spark, sf):
    rows = view(spark, sf, "telemetry").select("event_id", F.concat(F.lit("S"), "wtg_id").alias("wtg_id"))
    aliases = view(spark, sf, "wtg_dim").select("idx", F.col("wtg_id").alias("mdm_id"))
    return cleaning.remap_ids(rows, aliases, "wtg_id", "idx", "mdm_id")


@query
def id_remap_fallback(spark, sf):
    rows = view(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("W"), F.col("l_suppkey").cast("string")).alias("wtg_id")
    )
    return cleaning.remap_ids(rows, view(spark, sf, "wtg_master"), "wtg_id", "wtg_id", "master_id", keep_unmapped=True)


@query
def state_remap(spark, sf):
    """State logs that name turbines by their own ids."""
    logs = {k: log.withColumn("wtg_id", F.concat(F.lit("S"), "wtg_id")) for k, log in _logs(spark, sf).items()}
    aliases = view(spark, sf, "wtg_dim").select("idx", F.col("wtg_id").alias("mdm_id"))
    named = [log.withColumn("kind", F.lit(k)) for k, log in per_second.remap_logs(logs, aliases).items()]
    return named[0].unionByName(named[1]).unionByName(named[2]).select("wtg_id", "kind", "starttime", "msec", "state_id")


@query
def turbine_sets(spark, sf):
    return per_second.turbine_sets(_logs(spark, sf), _roster(spark, sf))


# --- time series --------------------------------------------------------------------------------


@query
def last_record(spark, sf):
    return series.last_record(view(spark, sf, "telemetry"), "wtg_id", "data_time")


@query
def carry_union(spark, sf):
    """Rows of one measuring day below the last earlier row of each turbine, if that is on the opening midnight."""
    marks = ten_minute.unique_marks(view(spark, sf, "telemetry_10m"))
    start = F.lit(DAY).cast("date").cast("timestamp_ntz")
    before = series.last_record(marks.where(F.col("datatime") <= start), "wtg_id", "datatime")
    carried = before.where(F.col("datatime") == start).withColumn("carried", F.lit(True))
    union = series.carry_union(carried, relational.time_range(marks, "datatime", DAY))
    return union.withColumn("carried", F.coalesce("carried", F.lit(False)))


@query
def grid_fill(spark, sf):
    return series.fill_grid(ten_minute.unique_marks(view(spark, sf, "telemetry_10m")), "wtg_id", "datatime")


@query
def counter_delta(spark, sf):
    marks = ten_minute.unique_marks(view(spark, sf, "telemetry_10m")).select("wtg_id", "datatime", *COUNTERS)
    grid = series.fill_grid(marks, "wtg_id", "datatime")
    return ten_minute.without_carry(series.counter_delta(grid, "wtg_id", "datatime", COUNTERS)).drop("is_filled")


@query
def state_dedupe(spark, sf):
    return series.last_event_per_second(view(spark, sf, "state_log"), ["wtg_id", "kind"], "starttime", "msec", "state_id")


@query
def state_seconds(spark, sf):
    """Every second of every turbine-day, reported per combination of states."""
    seconds = per_second.states(_logs(spark, sf), _roster(spark, sf), second="second")
    return seconds.groupBy("wtg_id", "day", *KINDS).agg(
        F.count(F.lit(1)).alias("seconds"),
        F.min("ts").alias("first_second"),
        F.max("ts").alias("last_second"),
        F.sum("second").alias("second_sum"),
        F.sum(F.col("second") * 7919 % 10007).alias("second_digest"),
    )


@query
def energy_seconds(spark, sf):
    """Every second of every turbine-day, reported per hour."""
    cols = per_second.ENERGIES
    energy = _calculated(spark, sf).select("wtg_id", "day", "datatime", *cols)
    seconds = series.DAY * _roster(spark, sf).count()
    whole = {f"{name}_e5": _e5(name) for name in cols.values()}
    spread = series.spread_energy(energy, "datatime", cols, rows=seconds, on_runs=lambda runs: runs.withColumns(whole), second="second")
    reports = []
    for k, name in enumerate(whole):
        reports += [
            F.count(name).alias(f"p{k}_seconds"),
            F.sum(name).alias(f"p{k}_e5"),
            F.min(name).alias(f"p{k}_least_e5"),
            F.max(name).alias(f"p{k}_most_e5"),
        ]
    hour = F.floor(F.col("second") / 3600).cast("int") % 24
    return spread.groupBy("wtg_id", "day", hour.alias("hour")).agg(F.count(F.lit(1)).alias("seconds"), *reports)


def _coded(runs):
    """Runs with the numbers that the report sums, of every column but the time."""
    energies = {n + "_e5": _e5(n) for n in per_second.ENERGIES.values()}
    return runs.withColumns({"temperature": F.rint("temoutave").cast("long"), **energies, **_row_codes(PRODUCTION_DIGITS)})


#: How the report takes the production base: codes once a run, the second of the day in every row.
REPORTED = {"on_runs": _coded, "second": "second"}


def _production_report(seconds):
    """Seconds per combination of states, with a digest of all columns of every row."""
    weight = F.col("second") % WEIGHTS + 1
    return seconds.groupBy("wtg_id", "day", *KINDS).agg(
        F.count(F.lit(1)).alias("seconds"),
        F.sum("second").alias("second_sum"),
        F.count("temperature").alias("temperature_seconds"),
        F.sum("temperature").alias("temperature_sum"),
        *[F.sum(n + "_e5").alias(n + "_e5") for n in per_second.ENERGIES.values()],
        *[F.sum(F.col(c) * weight).alias(c) for c in _row_codes(PRODUCTION_DIGITS)],
    )


@query
def production_base(spark, sf):
    """Every second with energy and states, reported per combination of states; no column is left out."""
    return _production_report(per_second.production_base(_calculated(spark, sf), _logs(spark, sf), _roster(spark, sf), **REPORTED))


@query
def stage_tables(spark, sf):
    """The production base by way of the stage tables of the daily jobs; the later days are run twice."""
    path = shared_folder(spark, "stages")
    chain = daily.Stages("stage_" + path.rsplit("-", 1)[1], path, buckets=8)
    names = ("wtg_dim", "site_dim", "ntf_data", "wtg_pc", "pc_data")
    dims = [view(spark, sf, n) for n in names]
    daily.run_clean(chain, view(spark, sf, "telemetry_10m"), dims[0])
    for days in (None, F.col("day") > F.lit(DAY).cast("date")):
        daily.run_calculation(chain, dims, days)
        daily.run_states(chain, _logs(spark, sf), days)
    return _production_report(daily.production(chain, spark, **REPORTED))


@query
def avg_10m(spark, sf):
    means = series.avg_windows(view(spark, sf, "telemetry"), "data_time", ["read_wind_speed", "active_power", "temp_out_door"])
    return _rounded(means, ["read_wind_speed", "active_power", "temp_out_door"], 6)


@query
def stream_means(spark, sf):
    """The means by streams that run twice; the second run brings late rows of the first run's days, which are dropped."""
    values = ["read_wind_speed", "active_power", "temp_out_door"]
    base = shared_folder(spark, "seconds")
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    rows = view(spark, sf, "telemetry").select(F.date_format("data_time", stamp).alias("ts"), *values, F.lit(None).cast("string").alias("mark"), "event_id")
    first = F.col("ts") < MIDDLE
    days = rows.agg(F.max(F.when(first, F.col("ts"))).substr(1, 10), F.max("ts").substr(1, 10)).first()
    for run, (chosen, last) in enumerate([(first, days[0]), (~first | (F.col("event_id") % 7 == 0), days[1])]):
        rows.where(chosen).drop("event_id").write.mode("append").csv(f"{base}/in/{run}")
        if last:
            jobs.close_day(spark, f"{base}/in/{run}", last, values, stamp)
        # One batch a run: files of one run come in no order.
        stream = jobs.follow_seconds(spark, f"{base}/in/*", values, 1_000_000, stamp, "mark")
        with stateful.state_store(spark):
            means = stateful.day_end_means(stream, "ts", values).withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
            jobs.write_by_day(means, f"{base}/out", f"{base}/cp").awaitTermination()
    found = spark.read.schema("ts timestamp, " + ", ".join(f"{v} double" for v in values)).parquet(f"{base}/out")
    return _rounded(found.select(F.col("ts").cast("timestamp_ntz").alias("data_time"), *values), values, 6)


@query
def carry_stream(spark, sf):
    """``carry_union`` by a stream: one run brings the rows before the day, the next one the day's."""
    base = shared_folder(spark, "marks")
    marks = ten_minute.unique_marks(view(spark, sf, "telemetry_10m"))
    start = F.lit(DAY).cast("date").cast("timestamp_ntz")
    today = relational.time_range(marks, "datatime", DAY)
    for rows in (marks.where(F.col("datatime") <= start), today):
        rows.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(marks.schema).parquet(f"{base}/in")
        with stateful.state_store(spark):
            jobs.append_files(stateful.carried_rows(stream, "wtg_id", "datatime"), f"{base}/out", f"{base}/cp").awaitTermination()
    # Earlier midnights were handed out in the first run, where their days came.
    carried = spark.read.schema(marks.schema).parquet(f"{base}/out").where(F.col("datatime") == start)
    union = series.carry_union(carried.withColumn("carried", F.lit(True)), today)
    return union.withColumn("carried", F.coalesce("carried", F.lit(False)))


@query
def late_files(spark, sf):
    """Every tenth row comes late; the days it touches are written anew from all files."""
    base = shared_folder(spark, "late")
    rows = view(spark, sf, "telemetry").select("event_id", "wtg_id", F.to_date("data_time").alias("hp_date"))
    schema = "event_id long, wtg_id string, hp_date date"
    for late in (False, True):
        rows.where((F.col("event_id") % 10 == 0) == F.lit(late)).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(f"{base}/in")
        source = lambda: spark.read.schema(schema).parquet(f"{base}/in")
        jobs.reload_each_batch(stream, f"{base}/table", source, "hp_date", ["hp_date"], f"{base}/cp").awaitTermination()
    return tables.read_partitions(spark, f"{base}/table").select("event_id", "wtg_id", "hp_date")


@query
def date_spine(spark, sf):
    """Every day between the first and the last order, with the orders of that day: what a backfill has to run."""
    orders = view(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    span = orders.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    spine = span.select(F.explode(series.date_spine(F.col("first"), F.col("last"), "day")).alias("day"))
    counts = orders.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query
def grouped_map(spark, sf):
    def gaps(frame: pd.DataFrame) -> pd.DataFrame:
        times = frame["datatime"].sort_values()
        widest = times.diff().max()
        return pd.DataFrame(
            {
                "wtg_id": [frame["wtg_id"].iloc[0]],
                "day": [frame["day"].iloc[0]],
                "marks": [len(frame)],
                "widest_gap": [None if pd.isna(widest) else int(widest.total_seconds())],
            }
        )

    marks = ten_minute.unique_marks(view(spark, sf, "telemetry_10m")).select("wtg_id", "datatime")
    return series.grouped_map(marks, "wtg_id", "datatime", gaps, "wtg_id string, day date, marks long, widest_gap long")


@query
def ten_minute_marks(spark, sf):
    """The rows that lie on a ten-minute mark."""
    rows = view(spark, sf, "telemetry_10m").select("loaded_at", "wtg_id", "datatime")
    return rows.where(calendar.is_ten_minute_mark(F.col("datatime")))


# --- quality, density, energy, predicted power --------------------------------------------------


@query
def unit_convert(spark, sf):
    return cleaning.convert_units(view(spark, sf, "telemetry_10m")).select("loaded_at", "wtg_id", "datatime", "temoutave", "nacellepositionave")


@query
def im_flags(spark, sf):
    return _clean(spark, sf).select("wtg_id", "day", "datatime", "clean_flag")


@query
def missing_flags(spark, sf):
    """Missing rows with the one code for them."""
    raw, dim = view(spark, sf, "telemetry_10m"), view(spark, sf, "wtg_dim")
    return ten_minute.clean(raw, dim, missing_rows="flag").select("wtg_id", "day", "datatime", "clean_flag")


@query
def rated_flags(spark, sf):
    marks = ten_minute.unique_marks(view(spark, sf, "telemetry_10m"))
    ratings = view(spark, sf, "wtg_dim").select("wtg_id", *ten_minute.RATINGS)
    rated = ten_minute.lookup_join(marks, ratings, "wtg_id")
    return rated.select("wtg_id", "datatime", bits.build_flag(quality.rated_terms()).alias("rated_flag"))


@query
def flag_decode(spark, sf):
    flagged = _clean(spark, sf, keep_carry=False)
    decoded = _joined_text(flagged, "reasons", bits.flag_labels(F.col("clean_flag")))
    speed = bits.field_code(F.col("clean_flag"), "windspeedave").alias("wind_speed_code")
    return decoded.select("wtg_id", "datatime", speed, "reasons")


@query
def air_density(spark, sf):
    cols = ["air_density", "ntf_wind_speed_site", "ntf_wind_speed_standard"]
    return _rounded(_speeds(spark, sf).select("wtg_id", "day", "datatime", *cols), cols)


@query
def ntf_asof(spark, sf):
    sited = ten_minute.with_site(_clean(spark, sf, keep_carry=False), view(spark, sf, "wtg_dim"), view(spark, sf, "site_dim"))
    speeds = ten_minute.transfer_speeds(sited, view(spark, sf, "ntf_data"))
    return _rounded(speeds.select("wtg_id", "datatime", "scada_ntf_id", "ntf_wind_speed"), ["ntf_wind_speed"])


@query
def real_energy(spark, sf):
    energy = ten_minute.without_carry(quality.real_energy(_speeds(spark, sf)))
    return energy.select("wtg_id", "datatime", *[f"real_{c}_10m" for c in COUNTERS], "real_approduction_10m_errors")


@query
def error_bits(spark, sf):
    energy = ten_minute.without_carry(quality.real_energy(_speeds(spark, sf)))
    labels = bits.error_labels(F.col("real_approduction_10m_errors"))
    return _joined_text(energy, "errors", labels).select("wtg_id", "datatime", "errors")


PREDICTED = ["theory_power_10m", "theory_approduction_10m", "active_power_10m", "active_approduction_10m"]


@query
def curve_power(spark, sf):
    return _rounded(_calculated(spark, sf).select("wtg_id", "datatime", *PREDICTED), PREDICTED, 6)


@query
def im_calc(spark, sf):
    speeds = ["air_density", "ntf_wind_speed", "ntf_wind_speed_site", "ntf_wind_speed_standard"]
    return _rounded(_rounded(_calculated(spark, sf).drop("day"), speeds), PREDICTED, 6)


# --- standard table -----------------------------------------------------------------------------


@query
def standard_mapping(spark, sf):
    rows = view(spark, sf, "protocol_row")
    return mapping.standard_mapping(rows, view(spark, sf, "protocol_alias"), view(spark, sf, "wtg_master"))


__all__ = ["QUERIES", "PREDICTED", "KINDS", "DAY", "TEN_MINUTE_MEASURES", "column_name"]
