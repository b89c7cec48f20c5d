"""Hand-worked cases."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rotorlake.functions import bits, calendar, physics, text
from rotorlake.operators import cleaning, mapping, quality, series
from rotorlake.plans import minute
from rotorlake.schemas import (
    FEATURE,
    MINUTE_WAREHOUSE,
    RATED_RULES,
    SECOND_STANDARD,
    STANDARD_POINTS,
    TEN_MINUTE_MEASURES,
    TEN_MINUTE_RULES,
    create_table,
)


def one(spark, **columns):
    """The values of column expressions on a single row."""
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def long(value):
    return F.lit(value).cast("long")


def test_flag_decoding(spark):
    row = one(
        spark,
        counter=bits.flag_labels(long(8796093022208)),
        missing=bits.set_code("missing", bits.NULL, F.lit(True)),
        errors=bits.error_labels(F.lit(112)),
        both=bits.flag_labels(long(24576)),
    )
    assert row["counter"] == ["approduction: pre null"]
    assert row["missing"] == 17592186044416
    assert row["errors"] == ["NO_NTF_WIND_SPEED", "NO_NTF_SITE_WIND_SPEED", "NO_NTF_STANDARD_WIND_SPEED"]
    assert row["both"] == ["windspeedave: out of range", "windspeedave: wind speed freeze"]


@pytest.mark.parametrize("field", ["temoutave", "windspeedave", "approduction", "missing"])
@pytest.mark.parametrize("code", [0, 1, 6, 15])
def test_set_then_get_is_identity(spark, field, code):
    flag = bits.build_flag([bits.set_code(field, code, F.lit(True)), bits.set_code("torqueave", 3, F.lit(True))])
    row = one(spark, code=bits.field_code(flag, field), other=bits.field_code(flag, "torqueave"))
    assert (row["code"], row["other"]) == (code, 3)


def flags_of(spark, rules, **values):
    names = dict.fromkeys([*TEN_MINUTE_MEASURES, *{r for r, _, _ in RATED_RULES.values()}, "previous_approduction"])
    row = spark.range(1).select(*[F.lit({**names, **values}[n]).cast("double").alias(n) for n in names])
    return row.select(bits.build_flag(rules()).alias("f")).first()["f"]


def code(flag, position):
    return flag >> (4 * position) & 15


def test_wind_speed_codes(spark):
    def wind(**v):
        return code(flags_of(spark, quality.range_terms, **v), 3)

    assert wind(windspeedave=-1.0, windspeedstd=0.1) == 6
    assert wind(windspeedave=0.0, windspeedstd=0.1) == 2
    assert wind(windspeedave=10.0, windspeedstd=0.05) == 4
    assert wind(windspeedave=10.0, windspeedstd=0.2) == 0
    assert wind(windspeedave=50.1, windspeedstd=5.0) == 2
    assert wind() == 1


def test_fixed_bounds_are_inclusive(spark):
    for position, field in enumerate(["temoutave", "winddirectionave", "bladepitchave"]):
        low, high = TEN_MINUTE_RULES[field]
        for value, expected in [(low, 0), (high, 0), (low - 0.1, 2), (high + 0.1, 2), (None, 1)]:
            assert code(flags_of(spark, quality.range_terms, **{field: value}), position) == expected


def test_rated_bounds(spark):
    for power, expected in [(3000.0, 0), (3000.1, 2), (-750.0, 0), (-750.1, 2), (None, 1)]:
        assert code(flags_of(spark, quality.rated_terms, activepwave=power, rated_power=1500.0), 8) == expected
    for torque, expected in [(0.0, 0), (-0.1, 2), (16200.0, 0), (16200.1, 2)]:
        flag = flags_of(spark, quality.rated_terms, torqueave=torque, torquesetpointave=torque, rated_torque=8100.0)
        assert (code(flag, 6), code(flag, 7)) == (expected, expected)
    for speed, expected in [(-900.0, 0), (3600.0, 0), (3600.1, 2)]:
        assert code(flags_of(spark, quality.rated_terms, genspdave=speed, on_grid_generator_speed=1800.0), 5) == expected
    # Without a rating there is no range code; a torque below zero needs none.
    assert code(flags_of(spark, quality.rated_terms, activepwave=9e9), 8) == 0
    assert code(flags_of(spark, quality.rated_terms, torqueave=-1.0), 7) == 2


def test_counter_codes(spark):
    def counter(now, before):
        return code(flags_of(spark, quality.counter_terms, approduction=now, previous_approduction=before, rated_power=1500.0), 10)

    assert counter(350.0, 100.0) == 0
    assert counter(350.1, 100.0) == 2
    assert counter(99.0, 100.0) == 1
    assert counter(None, 100.0) == 4
    assert counter(100.0, None) == 8


def test_density_and_corrected_speed(spark):
    args = [F.lit(float(v)) for v in (288.15, 1000, 70)]
    density = physics.air_density(*args)
    row = one(
        spark,
        pressure=physics.air_pressure(args[1], args[2], args[0]),
        density=density,
        site=physics.density_corrected_speed(F.lit(8.0), density, F.lit(1.1)),
        standard=physics.density_corrected_speed(F.lit(8.0), density, F.lit(physics.STANDARD_AIR_DENSITY)),
        kelvin=physics.air_pressure(args[1], args[2], args[0], kelvin_input=True),
        negative=physics.density_corrected_speed(F.lit(8.0), F.lit(-1.0), F.lit(1.1)),
        circle=physics.full_circle(F.lit(-30.0)),
    )
    assert row["pressure"] == pytest.approx(94.9406269343, abs=1e-9)
    assert row["density"] == pytest.approx(1.1455743231, abs=1e-9)
    assert row["site"] == pytest.approx(8.1089915688, abs=1e-9)
    assert row["standard"] == pytest.approx(7.8232230796, abs=1e-9)
    assert row["kelvin"] == pytest.approx(101.325 * math.exp(-1070 * 9.8 / (287.05 * 288.15)))
    assert row["negative"] is None
    assert row["circle"] == 330.0


CURVE = [("a", 5.0, 1.0, "1"), ("a", 5.0, 100.0, "2"), ("a", 5.5, 120.0, "1"), ("a", 0.0, 0.0, "1"), ("a", 0.5, 10.0, "1")]
SPEEDS = [(5.2, 108.0), (5.5, 120.0), (7.0, -1.0), (5.7, -1.0), (None, -1.0), (-0.3, -6.0), (-1.5, -1.0)]


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_ideal_power(spark, max_bytes):
    """Small curves go out as maps; with no bytes allowed the equal joins give the same."""
    fact = spark.createDataFrame([("a", i, s) for i, (s, _) in enumerate(SPEEDS)] + [("b", 99, 5.0)], "wtg_id string, i int, read_wind_speed double")
    curve = spark.createDataFrame(CURVE, "wtg_id string, wind_speed_rank double, active_power double, created_time string")
    rows = minute.ideal_power(fact, curve, max_bytes=max_bytes).orderBy("i").collect()
    assert [r["ideal_active_power"] for r in rows] == pytest.approx([p for _, p in SPEEDS])


def test_energy_split(spark):
    mark = dt.datetime(2024, 1, 2)
    df = spark.createDataFrame([(mark, 100.0, None)], "ts timestamp_ntz, e double, f double")
    rows = series.spread_energy(df, "ts", {"e": "p", "f": "q"}).orderBy("ts").collect()
    assert len(rows) == 600 and rows[0]["ts"] == dt.datetime(2024, 1, 1, 23, 50, 1) and rows[-1]["ts"] == mark
    assert {r["p"] for r in rows[:-1]} == {0.16667} and rows[-1]["p"] == 0.16467
    assert round(sum(r["p"] for r in rows), 5) == 100 and all(r["q"] is None for r in rows)


def test_half_even(spark):
    row = one(spark, a=series.half_even(F.lit(2.5e-5), 5), b=series.half_even(F.lit(3.5e-5), 5))
    assert (row["a"], row["b"]) == (2e-5, 4e-5)


def test_key_value_rows(spark):
    lines = [
        "wtg_id:W1,SITE_ID:S1,occur_time:2016-03-10 00:01:00,readwindspeed:1984,temout:1,TEMOUT:2,approduction:7",
        "wtg_id:W2,readwindspeed:N/A,genactivepw:NULL,torque:NaN,occur_time:nonsense",
        "wtg_id:W3,broken",
        "wtg_id:W4,x:1:2",
        "wtg_id:W5,x:1:2:3,site_id:",
    ]
    raw = spark.createDataFrame([(x,) for x in lines], "all_key_value string")
    parsed = cleaning.parse_kv(raw)
    assert parsed.schema.simpleString() == MINUTE_WAREHOUSE.simpleString()
    rows = {r["wtg_id"]: r for r in parsed.collect()}
    assert sorted(rows) == ["W1", "W2", "W5"]
    first = rows["W1"]
    assert (first["site_id"], first["data_time"], first["date"]) == ("S1", 1457568060, "20160310")
    assert (first["read_wind_speed"], first["temp_out_door"], first["production_active_accum"]) == (8.0, 2.0, 7)
    assert set(rows["W2"].asDict().values()) == {"W2", None}
    assert rows["W5"]["site_id"] is None
    assert [r[0] for r in cleaning.kv_rejects(raw).collect()] == lines[2:4]


def test_local_time_of_another_zone(spark):
    raw = spark.createDataFrame([("wtg_id:W,occur_time:2016-03-10 08:01:00",)], "all_key_value string")
    row = cleaning.parse_kv(raw, tz="Asia/Shanghai").first()
    assert (row["data_time"], row["date"]) == (1457568060, "20160310")


def test_row_map(spark):
    doubled = series.row_map(spark.range(5), lambda frames: (f.assign(id=f["id"] * 2) for f in frames), "id long")
    assert sorted(r["id"] for r in doubled.collect()) == [0, 2, 4, 6, 8]


def test_warehouse_text_round_trip(spark):
    line = ",".join(["W1", "S1", "1457568060", "20160310", "7", "N/A", "NULL", "", "12.5"] + ["\\N"] * 13)
    df = spark.createDataFrame([(line,), ("W2,too,short",)], "value string")
    rows = cleaning.parse_warehouse_text(df).collect()
    assert len(rows) == 1 and rows[0]["temp_out_door"] == 12.5 and rows[0]["production_reactive_accum"] is None
    assert cleaning.split_arity(df, "value", 22)[1].count() == 1


def test_range_rules_double_the_upper_bound(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0.4, 0.5, 100.0, 100.1, None])], "i int, read_wind_speed double")
    assert [r[1] for r in cleaning.clean_ranges(df).orderBy("i").collect()] == [None, 0.5, 100.0, None, None]
    strict = cleaning.clean_ranges(df, {"read_wind_speed": (0.5, 50.0)}, upper_factor=1.0)
    assert [r[1] for r in strict.orderBy("i").collect()] == [None, 0.5, None, None, None]


def test_ids(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    pairs = spark.createDataFrame([("a", "A")], "src string, dst string")
    assert cleaning.remap_ids(df, pairs, "id", "src", "dst").collect() == [("A", 1)]
    assert sorted(cleaning.remap_ids(df, pairs, "id", "src", "dst", keep_unmapped=True).collect()) == [("A", 1), ("b", 2)]


def test_standard_mapping(spark):
    fields = spark.createDataFrame(
        [("1", 0, "speed", "WNAC.WindSpeed"), ("1", 1, "odd", "X.Odd"), ("1", 2, "speed again", "WNAC.WindSpeed"), ("1", 3, "other", "Y")],
        "protocol_id string, pos int, field_desc string, field_alias string",
    )
    master = spark.createDataFrame([("W1", "M1")], "wtg_id string, master_id string")
    lines = ["k\t1,W1,now,2,5.5,a,6.5,", "no tab", "k\tx,W1,now,2,1,2,3,4", "k\t1,W1,now,2,1,2", "k\t9,W1,now,2,1,2,3,4"]
    rows = spark.createDataFrame([(x,) for x in lines], "line string")
    mapped = mapping.standard_mapping(rows, fields, master)
    assert mapped.schema.simpleString() == SECOND_STANDARD.simpleString()
    out = mapped.collect()
    assert len(out) == 1
    assert out[0][:5] == ("odd=a;other=", "1", "M1", "now", "2") and out[0]["WNAC_WindSpeed"] == 6.5
    assert sum(v is not None for v in out[0][5:]) == 1
    assert mapping.mapping_rejects(rows, fields).count() == 4
    with pytest.raises(Exception, match="field count differs"):
        mapping.standard_mapping(rows, fields, master, fail_fast=True).collect()


def test_text_and_calendar(spark):
    path = F.lit("/root/x/log_a/site=12/yyyymmdd=20240102")
    row = one(
        spark,
        floor=text.ten_minute_text(F.lit("2024-01-02 03:47:59")),
        spec=text.partition_spec(path),
        run=calendar.run_day(F.lit(1457654400)),
        hourly=calendar.run_day(F.lit(1457654400), 9),
        ring=calendar.ring_number(F.lit("2016-03-11").cast("date")),
        mark=calendar.is_ten_minute_mark(F.lit("2024-01-02 03:40:00").cast("timestamp_ntz")),
        off=calendar.is_ten_minute_mark(F.lit("2024-01-02 03:40:01").cast("timestamp_ntz")),
    )
    assert row["floor"] == "2024-01-02 03:40:00" and row["spec"] == 'site="12", yyyymmdd="20240102"'
    assert (row["run"], row["hourly"]) == ("20160310", "20160310")
    assert row["ring"] == (dt.date(2016, 3, 11).toordinal() + 365) % 100
    assert row["mark"] and not row["off"]


def test_tables_have_the_fixed_schemas(spark, tmp_path):
    assert len(STANDARD_POINTS) == len(set(STANDARD_POINTS)) == 158 and len(SECOND_STANDARD) == 163
    assert len(MINUTE_WAREHOUSE) == 22 and len(FEATURE) == 14
    partitioned = StructType([*FEATURE.fields, StructField("hp_date", StringType())])
    create_table(spark, "feature_schema_test", partitioned, ["hp_date"], str(tmp_path / "t"))
    assert spark.table("feature_schema_test").schema.names == [*FEATURE.names, "hp_date"] and len(FEATURE) == 14
