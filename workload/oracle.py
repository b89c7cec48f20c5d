"""The same results in DuckDB SQL. Names in braces are views; the steps below add to them."""

from __future__ import annotations

from rotorlake.schemas import FLAG_FIELDS, MINUTE_WAREHOUSE, STANDARD_POINTS, TEN_MINUTE_MEASURES, column_name
from workload import views

M = ", ".join(TEN_MINUTE_MEASURES)
DAY = "2024-01-04"

RULES = {
    "nacelle_position": (-1080, 2160),
    "pitch_angle": (-5, 180),
    "read_wind_speed": (0.5, 100),
    "temp_out_door": (-40, 90),
    "gen_speed": (0, 6000),
    "active_power": (-100, 10000),
}
_TELEMETRY = "event_id wtg_id site_id data_time temp_out_door wind_direction nacelle_position wind_vane pitch_angle read_wind_speed rotor_speed gen_speed active_power".split()
_CLEANED = ", ".join(
    f"case when {c} between {RULES[c][0]} and {RULES[c][1]} then {c} end as {c}" if c in RULES else c for c in _TELEMETRY
)


def _bits(field: int, code: int, condition: str) -> str:
    return f"case when {condition} then {code << (4 * field)} else 0 end"


def _bounds(field: int, name: str, low: str, high: str) -> str:
    return _bits(field, 1, f"{name} is null") + " + " + _bits(field, 2, f"{name} < {low} or {name} > {high}")


_RATED = " + ".join(
    [
        _bounds(4, "rotorspdave", "-0.5 * on_grid_rotor_speed", "2 * on_grid_rotor_speed"),
        _bounds(5, "genspdave", "-0.5 * on_grid_generator_speed", "2 * on_grid_generator_speed"),
        _bounds(6, "torquesetpointave", "0", "2 * rated_torque"),
        _bounds(7, "torqueave", "0", "2 * rated_torque"),
        _bounds(8, "activepwave", "-0.5 * rated_power", "2 * rated_power"),
    ]
)
_FLAG = " + ".join(
    [
        _bounds(0, "temoutave", "213.15", "333.15"),
        _bounds(1, "winddirectionave", "0", "360"),
        _bounds(2, "bladepitchave", "-20", "100"),
        _bits(3, 1, "windspeedave is null"),
        _bits(3, 2, "windspeedave <= 0 or windspeedave > 50"),
        _bits(3, 4, "windspeedstd / nullif(windspeedave, 0) < 0.01"),
        _RATED,
        _bounds(9, "pcurvestsave", "0", "100"),
        _bits(10, 4, "approduction is null"),
        _bits(10, 8, "approduction is not null and prev is null"),
        _bits(10, 1, "approduction - prev < 0"),
        _bits(10, 2, "approduction - prev > rated_power / 6"),
    ]
)


def _code(field: int) -> str:
    return f"((clean_flag >> {4 * field}) & 15)"


STEPS = {
    "marks": f"select wtg_id, datatime, {M} from {{telemetry_10m}} where date_part('minute', datatime) % 10 = 0 "
    "qualify row_number() over (partition by wtg_id, datatime order by loaded_at desc) = 1",
    "days": "select wtg_id, cast(unnest(generate_series(cast(min(datatime) - interval 1 microsecond as date)::timestamp, "
    "cast(max(datatime) - interval 1 microsecond as date)::timestamp, interval 1 day)) as date) as day from {marks} group by 1",
    "grid": f"""
select s.wtg_id, s.day, s.datatime, {M}, m.wtg_id is null as is_filled from (
  select wtg_id, day, unnest(generate_series(day::timestamp + interval 10 minute, day::timestamp + interval 1 day, interval 10 minute)) as datatime from {{days}}
  union all
  select d.wtg_id, d.day, m.datatime from {{days}} d join {{marks}} m on m.wtg_id = d.wtg_id and m.datatime = d.day::timestamp) s
left join {{marks}} m on m.wtg_id = s.wtg_id and m.datatime = s.datatime""",
    "clean": f"""
select *, cast({_FLAG} as bigint) as clean_flag from (
  select g.* replace (temoutave + 273.15 as temoutave, ((nacellepositionave % 360) + 360) % 360 as nacellepositionave),
    rated_power, rated_torque, on_grid_rotor_speed, on_grid_generator_speed,
    lag(approduction) over (partition by g.wtg_id, day order by datatime) as prev
  from {{grid}} g join {{wtg_dim}} d on d.wtg_id = g.wtg_id) c""",
    "sited": """
select c.*, d.altitude, d.hub_height, d.scada_ntf_id, s.air_density as site_air_density
from {clean} c left join {wtg_dim} d on d.wtg_id = c.wtg_id left join {site_dim} s on s.site_id = d.site_id""",
    "transfer": f"""
select s.*, k.ntf_id is not null as has_ntf,
  case when {_code(4)} = 0 and {_code(3)} = 0 then n.a * windspeedave * windspeedave + n.b * windspeedave + n.c end as ntf_wind_speed
from {{sited}} s asof left join {{ntf_data}} n on s.scada_ntf_id = n.ntf_id and s.rotorspdave >= n.rotor_speed
left join (select distinct ntf_id from {{ntf_data}}) k on k.ntf_id = s.scada_ntf_id""",
    "speeds": f"""
select *, ntf_wind_speed * pow(air_density / site_air_density, 1.0 / 3) as ntf_wind_speed_site,
  ntf_wind_speed * pow(air_density / 1.225, 1.0 / 3) as ntf_wind_speed_standard
from (select *, case when has_ntf and {_code(0)} = 0 then 1 / temoutave * (
    101.325 * exp(-1 * (altitude + hub_height) * 9.8 / (287.05 * (273.15 + temoutave))) * 1000 / 287.05
    - 0.5 * 0.0000205 * exp(0.0613846 * temoutave) * (1 / 287.05 - 1 / 461.5)) end as air_density
  from {{transfer}}) t""",
    "energy": f"""
select * exclude (delta), case when errors = 0 then delta end as real_approduction_10m from (
  select *, cast({_code(10)} + case when ntf_wind_speed is null then 16 else 0 end
      + case when ntf_wind_speed_site is null then 32 else 0 end + case when ntf_wind_speed_standard is null then 64 else 0 end
      + case when {_code(0)} <> 0 then 128 else 0 end as integer) as errors,
    approduction - lag(approduction) over w as delta,
    rpproduction - lag(rpproduction) over w as real_rpproduction_10m,
    apconsumed - lag(apconsumed) over w as real_apconsumed_10m,
    rpconsumed - lag(rpconsumed) over w as real_rpconsumed_10m
  from {{speeds}} window w as (partition by wtg_id, day order by datatime)) e
where datatime > day::timestamp""",
    "curve1": "select a.wtg_id, p.wind_speed_rank, p.power from {wtg_pc} a join {pc_data} p on p.pc_id = a.pc_id where a.pc_type = 1",
    "curve3": "select a.wtg_id, p.wind_speed_rank, p.power from {wtg_pc} a join {pc_data} p on p.pc_id = a.pc_id where a.pc_type = 3",
    "calc": """
select e.*, errors as real_approduction_10m_errors,
  (b1.power - a1.power) / (b1.wind_speed_rank - a1.wind_speed_rank) * (ntf_wind_speed_standard - a1.wind_speed_rank) + a1.power as theory_power_10m,
  theory_power_10m / 6 as theory_approduction_10m,
  (b3.power - a3.power) / (b3.wind_speed_rank - a3.wind_speed_rank) * (ntf_wind_speed_standard - a3.wind_speed_rank) + a3.power as active_power_10m,
  active_power_10m / 6 as active_approduction_10m
from {energy} e
asof left join {curve1} a1 on a1.wtg_id = e.wtg_id and e.ntf_wind_speed_standard >= a1.wind_speed_rank
asof left join {curve1} b1 on b1.wtg_id = e.wtg_id and e.ntf_wind_speed_standard < b1.wind_speed_rank
asof left join {curve3} a3 on a3.wtg_id = e.wtg_id and e.ntf_wind_speed_standard >= a3.wind_speed_rank
asof left join {curve3} b3 on b3.wtg_id = e.wtg_id and e.ntf_wind_speed_standard < b3.wind_speed_rank""",
    "changes": "select wtg_id, kind, date_trunc('second', starttime) as starttime, state_id from {state_log} "
    "qualify row_number() over (partition by wtg_id, kind, date_trunc('second', state_log.starttime) order by state_log.starttime desc, msec desc) = 1",
    "masters": "select wtg_id, max(master_id) as master_id from {wtg_master} group by 1",
    "seconds": """
select d.wtg_id, d.day, unnest(generate_series(d.day::timestamp + interval 1 second, d.day::timestamp + interval 1 day, interval 1 second)) as ts
from {days} d join (select wtg_id, min(starttime) as first from {changes} group by 1) f
  on f.wtg_id = d.wtg_id and f.first <= d.day::timestamp + interval 1 day""",
    # Seconds and events in one time line; every second takes the last event of each log, null states included.
    "timeline": """
select wtg_id, day, ts, true as is_second, null::struct(v integer) as nc, null::struct(v integer) as ss, null::struct(v integer) as sc from {seconds}
union all
select wtg_id, null, starttime, false, any_value({'v': state_id}) filter (kind = 'nc_id'), any_value({'v': state_id}) filter (kind = 'ss_id'),
  any_value({'v': state_id}) filter (kind = 'sc_id')
from {changes} group by wtg_id, starttime""",
    "states": """
select wtg_id, day, ts, nc.v as nc_id, ss.v as ss_id, sc.v as sc_id, date_diff('second', day::timestamp, ts) as sod
from (select wtg_id, day, ts, is_second, last_value(nc ignore nulls) over w as nc, last_value(ss ignore nulls) over w as ss,
        last_value(sc ignore nulls) over w as sc
      from {timeline} window w as (partition by wtg_id order by ts, is_second rows between unbounded preceding and current row)) t
where is_second""",
}


def _spread(source: str, energies: dict[str, str], extra: str = "", keep: bool = False) -> str:
    shares = ", ".join(f"round_even({c} / 600, 5) as {n}" for c, n in energies.items())
    picked = ", ".join(
        f"case when i = 0 then round_even({c} - 599 * {n}, 5) else {n} end as {n}" for c, n in energies.items()
    )
    columns = ", ".join(energies)
    kept = f", {columns}" if keep else ""
    return f"""
select wtg_id, day, datatime - to_seconds(i) as ts, date_diff('second', day::timestamp, datatime) - i as sod{extra}{kept}, {picked}
from (select *, {shares} from (select wtg_id, day, datatime{extra}, {columns} from {{{source}}}) c) c, (select unnest(range(600)) as i) r"""


ENERGIES = {"real_approduction_10m": "p0", "theory_approduction_10m": "p1", "active_approduction_10m": "p2"}
STEPS["calc_spread"] = _spread("calc", ENERGIES)

# Columns of the production base in their order, with the decimals that count.
_DIGITS = [(c, 3) for c in TEN_MINUTE_MEASURES] + [("clean_flag", 0)]
_DIGITS += [(c, 8) for c in ("air_density", "ntf_wind_speed", "ntf_wind_speed_site", "ntf_wind_speed_standard")]
_DIGITS += [(f"real_{c}_10m", 3) for c in ("approduction", "rpproduction", "apconsumed", "rpconsumed")]
_DIGITS += [("real_approduction_10m_errors", 0)]
_DIGITS += [(f"{n}_{m}_10m", 6) for n in ("theory", "active") for m in ("power", "approduction")]
_DIGITS += [("p0", 5), ("p1", 5), ("p2", 5)]
STEPS["calc_all"] = _spread("calc", ENERGIES, "".join(f", {c}" for c, n in _DIGITS if c not in ENERGIES and n != 5), keep=True)


def _whole(name: str, digits: int) -> str:
    value = "temoutave - 273.15" if name == "temoutave" else name
    return f"cast({name} as bigint)" if digits == 0 else f"cast(round_even(({value}) * {10**digits}, 0) as bigint)"


_ROW_CODES = [f"{k} * coalesce({_whole(c, n)} % 1000003, 999979)" for k, (c, n) in enumerate(_DIGITS, 1)]
_ROW_DIGESTS = ",".join(
    f"\n  cast(sum(({' + '.join(_ROW_CODES[at : at + 6])}) % 1000003 * (coalesce(c.sod, s.sod) % 97 + 1)) as bigint) as row_digest_{at}"
    for at in range(0, len(_ROW_CODES), 6)
)


def _e5(name: str) -> str:
    return f"cast(round({name} * 100000) as bigint)"


_KV = "{kv_raw}"
_KV_FIELD = "([p for p in pairs if lower(split_part(p, ':', 1)) = '{}'])[-1]"


def _kv(name: str) -> str:
    field = _KV_FIELD.format(name)
    return f"nullif(substring({field}, strpos({field}, ':') + 1), 'N/A')"


_KV_COLUMNS = {
    "production_reactive_accum": "bigint",
    "consumption_active_accum": "bigint",
    "consumption_reactive_accum": "bigint",
    **{
        c: "double"
        for c in "wind_direction nacelle_position wind_vane pitch_angle wind_speed rotor_speed gen_speed torque_setpoint torque active_power_calc power_curve_state".split()
    },
}

_GRID_COLUMNS = f"wtg_id, datatime, {M}"
_IDEAL_CURVE = """
curve as (select wtg_id, wind_speed_rank, active_power as power from {power_curve}
  qualify row_number() over (partition by wtg_id, wind_speed_rank order by created_time desc, active_power desc) = 1)"""
_STAGED = """
select t.event_id, t.wtg_id, data_time, temp_out_door, wind_direction, wind_vane, pitch_angle, read_wind_speed, rotor_speed,
  gen_speed, active_power, d.wtg_type_id, wtg_type_name, y.rated_power
from (select $CLEANED from {telemetry}) t join {wtg_dim} d on d.wtg_id = t.wtg_id join {wtg_type} y on y.wtg_type_id = d.wtg_type_id
where d.site_type in (1, 2)""".replace("$CLEANED", _CLEANED)

_FLAG_TEXTS = [
    (0, "temoutave"), (1, "winddirectionave"), (2, "bladepitchave"), (3, "windspeedave"), (4, "rotorspdave"), (5, "genspdave"),
    (6, "torquesetpointave"), (7, "torqueave"), (8, "activepwave"), (9, "pcurvestsave"),
]


def _reasons() -> str:
    cases = []
    for i, name in _FLAG_TEXTS:
        labels = [(1, "null"), (2, "out of range")] + ([(4, "wind speed freeze")] if i == 3 else [])
        cases += [f"case when {_code(i)} & {bit} <> 0 then '{name}: {text}' end" for bit, text in labels]
    for bit, text in [(4, "null"), (8, "pre null"), (1, "decrease"), (2, "too large")]:
        cases.append(f"case when {_code(10)} & {bit} <> 0 then 'approduction: {text}' end")
    return "concat_ws('; ', " + ", ".join(cases) + ")"


_ERROR_TEXTS = "DECREASE OUT_OF_MAX_RANGE NAN NAN_PRE NO_NTF_WIND_SPEED NO_NTF_SITE_WIND_SPEED NO_NTF_STANDARD_WIND_SPEED NO_TEMP_OUT".split()
_ERRORS = "concat_ws('; ', " + ", ".join(f"case when errors & {1 << i} <> 0 then '{t}' end" for i, t in enumerate(_ERROR_TEXTS)) + ")"
_MAPPED = {"WNAC.WindSpeed": 0, "WGEN.GenActivePW": 1, "WROT.TemHub": 2}
_STANDARD = ", ".join(
    (f"try_cast(v[{5 + _MAPPED[a]}] as double)" if a in _MAPPED else "cast(null as double)") + f" as {column_name(a)}"
    for a in STANDARD_POINTS
)
_PREDICTED = ["theory_power_10m", "theory_approduction_10m", "active_power_10m", "active_approduction_10m"]
_ROUNDED_PREDICTED = ", ".join(f"round({c}, 6) as {c}" for c in _PREDICTED)
_ROUNDED_SPEEDS = ", ".join(f"round({c}, 8) as {c}" for c in ["air_density", "ntf_wind_speed_site", "ntf_wind_speed_standard"])
_REAL = "real_approduction_10m, real_rpproduction_10m, real_apconsumed_10m, real_rpconsumed_10m"

BODIES = {
    "kv_parse": f"""
select event_id, {_kv('wtg_id')} as wtg_id, {_kv('site_id')} as site_id,
  cast(epoch(try_strptime({_kv('occur_time')}, '%Y-%m-%d %H:%M:%S')) as bigint) as data_time,
  replace(substring({_kv('occur_time')}, 1, 10), '-', '') as date,
  try_cast({_kv('approduction')} as bigint) as production_active_accum,
  try_cast({_kv('temout')} as double) as temp_out_door, try_cast({_kv('readwindspeed')} as double) / 248 as read_wind_speed,
  try_cast({_kv('genactivepw')} as double) as active_power,
  {', '.join(f'cast(null as {k}) as {c}' for c, k in _KV_COLUMNS.items())}
from (select event_id, all_key_value, string_split(all_key_value, ',') as pairs from {_KV}) r
where len([p for p in pairs if len(string_split(p, ':')) not in (2, 4)]) = 0""",
    "delimited_scan": "select event_id, wtg_id, data_time, temp_out_door, read_wind_speed from {telemetry}",
    "header_csv_ingest": """
select wtg_id, site_id, case when site_id = 'site0'
    then concat('event_id:', cast(event_id as string), ',note:ok,temout:', t)
    else concat('temout:', t, ',event_id:', cast(event_id as string), ',note:ok') end || concat(',site_id:', site_id, ',wtg_id:', wtg_id) as all_key_value
from (select *, coalesce(cast(cast(temp_out_door as bigint) as string), 'N/A') as t from {telemetry}) x where event_id % 50 <> 0""",
    "header_csv_stop": """
select wtg_id, site_id, case when site_id = 'site0'
    then concat('event_id:', cast(event_id as string), ',note:ok,temout:', t)
    else concat('temout:', t, ',event_id:', cast(event_id as string), ',note:ok') end || concat(',site_id:', site_id, ',wtg_id:', wtg_id) as all_key_value
from (select *, coalesce(cast(cast(temp_out_door as bigint) as string), 'N/A') as t,
    min(case when event_id % 50 = 0 then event_id end) over (partition by site_id, wtg_id, strftime(data_time, '%Y%m')) as bad
  from {telemetry}) x
where bad is null or event_id < bad""",
    "header_csv_rejects": """
select wtg_id, line, case when site_id = 'site0' then concat(cast(event_id as string), ',a,b,', t)
  else concat(t, ',', cast(event_id as string), ',a,b') end as value
from (select *, coalesce(cast(cast(temp_out_door as bigint) as string), 'N/A') as t,
    row_number() over (partition by site_id, wtg_id, strftime(data_time, '%Y%m') order by event_id) as line
  from {telemetry}) x
where event_id % 50 = 0""",
    "tagged_scan": """
select 'curve' as tag, concat_ws(chr(1), wtg_id, cast(wind_speed_rank as string), created_time) as value, substring(created_time, 1, 4) as part
from {power_curve}
union all
select 'fact', concat_ws(chr(1), wtg_id, cast(event_id as string)), strftime(data_time, '%Y%m%d') from {telemetry}""",
    "delimited_tables": """
select strftime(data_time, '%Y-%m-%d') as hp_date, count(*) as n_rows, cast(ceil(count(*) / 100) as bigint) as n_files,
  least(count(*), 100) as most_rows, cast(sum(event_id) as bigint) as ids, cast(sum(cast(wtg_id as bigint)) as bigint) as turbines,
  cast(sum(epoch_us(date_trunc('second', data_time)) // 1000000) as bigint) as times, count(temp_out_door) as known, sum(temp_out_door) as temperatures
from {telemetry} group by 1""",
    "days_to_run": """
with runs as (select distinct date_trunc('hour', data_time) as run from {telemetry}),
wanted as (
  select 'daily' as job, cast(run - interval 24 hour as date) as day from runs
  union select 'hourly', cast(run - interval 9 hour as date) from runs
  union select 'reload', cast(run - interval 9 hour as date) - cast(i as integer) from runs, range(3) t(i)),
had as (
  select distinct job, cast(data_time as date) as day
  from {telemetry}, (values ('daily', 3), ('hourly', 4), ('reload', 5)) j(job, every) where day(data_time) % every <> 0)
select job, strftime(day, '%Y%m%d') as day from wanted where (job, day) not in (select (job, day) from had)""",
    "alias_path_map": """
select wtg_id, site_id, concat(split_part(alias, '.', 1), '/', split_part(alias, '.', 3), '/20240102/minute') as folder,
  'minute_20240102.csv' as file_name
from {master_list} where alias <> 'NULL'""",
    "rules_scan": """
select concat('P', cast(p_partkey as string)) as field, cast(case when p_size % 2 = 0 then p_size else -p_size end as double) as low,
  cast(floor(p_retailprice) as double) as high
from {part} where p_size not in (1, 2)""",
    "time_range_scan": f"""
select event_id, ts, value from {{events}} where ts > timestamp '{DAY} 00:00:00' and ts <= timestamp '{DAY} 00:00:00' + interval 1 day""",
    "export_clean": f"select {_GRID_COLUMNS}, clean_flag from {{clean}}",
    "partition_overwrite": """
select case when cast(data_time as date) > date '2024-01-10' then -event_id else event_id end as event_id, data_time,
  strftime(data_time, '%Y-%m-%d') as hp_date
from {telemetry}""",
    "partition_register": "select event_id, site_id as site, strftime(data_time, '%Y%m') as month from {telemetry}",
    "rolling_reload": """
select event_id, wtg_id, cast(data_time as date) as hp_date from {telemetry}
where cast(data_time as date) between date '2024-01-08' and date '2024-01-10'""",
    "path_columns": """
select event_id, file_name, split_part(file_name, '.', 1) as log_type, split_part(file_name, '.', 2) as site,
  split_part(file_name, '.', 3) as yyyymmdd, split_part(file_name, '.', 4) as hour,
  concat(log_type, '/site=', site, '/yyyymmdd=', yyyymmdd) as folder
from {log_files}""",
    "ring_partition": "select event_id, cast((date_diff('day', date '1970-01-01', cast(data_time as date)) + 719528) % 100 as integer) as ring from {telemetry}",
    "weather_station": f"""
select hp_site as site_id, wtg_id, data_time as date_time, '{DAY}' as p_date,
  {', '.join(f'{m}_{s}' for m in ('read_wind_speed', 'wind_direction', 'active_power') for s in ('avg', 'max', 'min', 'std'))},
  '{DAY}' as hp_date, hp_ds
from {{fact_10m}} where hp_yyyymm = '202401' and cast(data_time as date) = date '{DAY}'""",
    "range_clean": f"select {_CLEANED} from {{telemetry}}",
    "feature_staging": _STAGED,
    "ideal_power": f"""
with {_IDEAL_CURVE.strip()},
spots as (select s.*, floor(read_wind_speed * 2) / 2 as low, ceil(read_wind_speed * 2) / 2 as high from ({_STAGED}) s
  where wtg_id in (select wtg_id from curve))
select s.* exclude (low, high), round(coalesce(case when low = high then l.power
  else (h.power - l.power) / (high - low) * (read_wind_speed - low) + l.power end, -1), 6) as ideal_active_power
from spots s left join curve l on l.wtg_id = s.wtg_id and l.wind_speed_rank = low
left join curve h on h.wtg_id = s.wtg_id and h.wind_speed_rank = high""",
    "id_remap": "select t.event_id, d.wtg_id from {telemetry} t join {wtg_dim} d on d.idx = concat('S', t.wtg_id)",
    "id_remap_fallback": """
select l_orderkey, l_linenumber, coalesce(m.master_id, concat('W', cast(l_suppkey as string))) as wtg_id
from {lineitem} l left join {masters} m on m.wtg_id = concat('W', cast(l_suppkey as string))""",
    "turbine_sets": "select distinct wtg_id from {state_log} intersect select wtg_id from {wtg_dim}",
    "last_record": "select * from {telemetry} qualify row_number() over (partition by wtg_id order by data_time desc) = 1",
    "carry_union": f"""
select wtg_id, datatime, {M}, datatime = timestamp '{DAY} 00:00:00' as carried from {{marks}}
where datatime between timestamp '{DAY} 00:00:00' and timestamp '{DAY} 00:00:00' + interval 1 day""",
    "grid_fill": f"select wtg_id, day, datatime, {M}, is_filled from {{grid}}",
    "counter_delta": """
select * from (select wtg_id, day, datatime, approduction, rpproduction, apconsumed, rpconsumed,
  approduction - lag(approduction) over w as approduction_delta, rpproduction - lag(rpproduction) over w as rpproduction_delta,
  apconsumed - lag(apconsumed) over w as apconsumed_delta, rpconsumed - lag(rpconsumed) over w as rpconsumed_delta
from {grid} window w as (partition by wtg_id, day order by datatime)) d where datatime > day::timestamp""",
    "state_dedupe": "select wtg_id, kind, starttime, state_id from {changes}",
    "state_seconds": """
select wtg_id, day, nc_id, ss_id, sc_id, count(*) as seconds, min(ts) as first_second, max(ts) as last_second,
  cast(sum(sod) as bigint) as second_sum, cast(sum(sod * 7919 % 10007) as bigint) as second_digest
from {states} group by wtg_id, day, nc_id, ss_id, sc_id""",
    "energy_seconds": f"""
select wtg_id, day, cast(extract(hour from ts) as integer) as hour, count(*) as seconds, {', '.join(
    f"count({p}) as {p}_seconds, cast(sum({_e5(p)}) as bigint) as {p}_e5, min({_e5(p)}) as {p}_least_e5, max({_e5(p)}) as {p}_most_e5"
    for p in ('p0', 'p1', 'p2'))}
from {{calc_spread}} group by 1, 2, 3""",
    "production_base": f"""
select coalesce(c.wtg_id, s.wtg_id) as wtg_id, coalesce(c.day, s.day) as day, nc_id, ss_id, sc_id, count(*) as seconds,
  cast(sum(coalesce(c.sod, s.sod)) as bigint) as second_sum, count(temoutave) as temperature_seconds,
  cast(sum(cast(round(temoutave - 273.15) as bigint)) as bigint) as temperature_sum,
  cast(sum({_e5('p0')}) as bigint) as production_per_second_e5, cast(sum({_e5('p1')}) as bigint) as theory_production_per_second_e5,
  cast(sum({_e5('p2')}) as bigint) as actual_production_per_second_e5,
{_ROW_DIGESTS.lstrip()}
from {{calc_all}} c full outer join {{states}} s on s.wtg_id = c.wtg_id and s.ts = c.ts group by 1, 2, 3, 4, 5""",
    "avg_10m": """
select time_bucket(interval '10 minutes', data_time) as data_time, round(avg(read_wind_speed), 6) as read_wind_speed,
  round(avg(active_power), 6) as active_power, round(avg(temp_out_door), 6) as temp_out_door
from {telemetry} group by 1""",
    "date_spine": """
select s.day, count(o.o_orderkey) as n
from (select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as day from {orders}) s
left join {orders} o on cast(o.o_orderdate as date) = s.day group by 1""",
    "grouped_map": """
select wtg_id, day, count(*) as marks, max(gap) as widest_gap from (
  select wtg_id, cast(datatime - interval 1 microsecond as date) as day,
    date_diff('second', lag(datatime) over (partition by wtg_id, cast(datatime - interval 1 microsecond as date) order by datatime), datatime) as gap
  from {marks}) g group by 1, 2""",
    "ten_minute_marks": """
select loaded_at, wtg_id, datatime from {telemetry_10m} where extract(minute from datatime) % 10 = 0 and extract(second from datatime) = 0""",
    "unit_convert": """
select loaded_at, wtg_id, datatime, temoutave + 273.15 as temoutave, ((nacellepositionave % 360) + 360) % 360 as nacellepositionave
from {telemetry_10m}""",
    "im_flags": "select wtg_id, day, datatime, clean_flag from {clean}",
    "rated_flags": f"select m.wtg_id, datatime, cast({_RATED} as bigint) as rated_flag from {{marks}} m join {{wtg_dim}} d on d.wtg_id = m.wtg_id",
    "flag_decode": f"""
select wtg_id, datatime, cast({_code(3)} as integer) as wind_speed_code, {_reasons()} as reasons
from {{clean}} where datatime > day::timestamp""",
    "air_density": f"select wtg_id, day, datatime, {_ROUNDED_SPEEDS} from {{speeds}}",
    "ntf_asof": "select wtg_id, datatime, scada_ntf_id, round(ntf_wind_speed, 8) as ntf_wind_speed from {transfer} where datatime > day::timestamp",
    "real_energy": f"select wtg_id, datatime, {_REAL}, errors as real_approduction_10m_errors from {{energy}}",
    "error_bits": f"select wtg_id, datatime, {_ERRORS} as errors from {{energy}}",
    "curve_power": f"select wtg_id, datatime, {_ROUNDED_PREDICTED} from {{calc}}",
    "im_calc": f"""
select {_GRID_COLUMNS}, clean_flag, round(ntf_wind_speed, 8) as ntf_wind_speed, {_ROUNDED_SPEEDS}, {_REAL}, real_approduction_10m_errors,
  {_ROUNDED_PREDICTED}
from {{calc}}""",
    "standard_mapping": f"""
select l_orderkey, l_linenumber, concat(f3, '=', v[8], ';', f4, '=', v[9]) as "COMMON_Reserved", v[1] as "COMMON_ProtocolID",
  coalesce(m.master_id, v[2]) as "COMMON_WTGID", v[3] as "COMMON_DateTime", v[4] as "COMMON_Version", {_STANDARD}
from (select l_orderkey, l_linenumber, string_split(split_part(line, chr(9), 2), ',') as v from {{protocol_row}}) r
join (select protocol_id, max(case when pos = 3 then field_desc end) as f3, max(case when pos = 4 then field_desc end) as f4, count(*) as n
      from {{protocol_alias}} group by 1) p on p.protocol_id = v[1] and p.n = len(v) - 4
left join {{masters}} m on m.wtg_id = v[2]""",
    "state_remap": "select s.wtg_id, kind, starttime, msec, state_id from {state_log} s join {wtg_dim} d on d.idx = concat('S', s.wtg_id)",
}
BODIES["stream_means"] = BODIES["avg_10m"]
BODIES["carry_stream"] = BODIES["carry_union"]
BODIES["late_files"] = "select event_id, wtg_id, cast(data_time as date) as hp_date from {telemetry}"
BODIES["export_files"] = BODIES["export_clean"]
BODIES["stage_tables"] = BODIES["production_base"]
BODIES["station_partitions"] = " union all ".join(
    BODIES["weather_station"].replace(DAY, day) for day in (DAY, "2024-01-05")
)
BODIES["ring_export"] = BODIES["ring_partition"]
BODIES["missing_flags"] = "select wtg_id, day, datatime, case when is_filled then cast(1 as bigint) << $MISSING else clean_flag end as clean_flag from {clean}".replace(
    "$MISSING", str(4 * FLAG_FIELDS.index("missing"))
)
BODIES["arity_check"] = """
select v[1] as wtg_id, v[2] as site_id, cast(v[3] as bigint) as data_time, v[4] as date, cast(v[5] as bigint) as production_active_accum,
  try_cast(v[6] as bigint) as production_reactive_accum, cast(v[7] as bigint) as consumption_active_accum,
  cast(v[8] as bigint) as consumption_reactive_accum, $REST
from (select string_split(value, ',') as v from {warehouse_text}) t where len(v) = 22""".replace(
    "$REST", ", ".join(f"try_cast(v[{k}] as double) as {f.name}" for k, f in enumerate(MINUTE_WAREHOUSE.fields, 1) if k > 8)
)
BODIES["minute_chain"] = f"""
with {_IDEAL_CURVE.strip()},
parsed as ({BODIES['kv_parse'].strip()}),
spots as (select t.wtg_id, data_time, case when temp_out_door between -40 and 90 then temp_out_door end as temp_out_door,
    case when read_wind_speed between 0.5 and 100 then read_wind_speed end as read_wind_speed, wtg_type_name, y.rated_power,
    floor(read_wind_speed * 2) / 2 as low, ceil(read_wind_speed * 2) / 2 as high
  from (select * replace (case when read_wind_speed between 0.5 and 100 then read_wind_speed end as read_wind_speed) from parsed) t
  join {{wtg_dim}} d on d.wtg_id = t.wtg_id join {{wtg_type}} y on y.wtg_type_id = d.wtg_type_id
  where d.site_type in (1, 2) and date = '{DAY.replace('-', '')}' and t.wtg_id in (select wtg_id from curve))
select s.* exclude (low, high), round(coalesce(case when low = high then l.power
  else (h.power - l.power) / (high - low) * (read_wind_speed - low) + l.power end, -1), 6) as ideal_active_power
from spots s left join curve l on l.wtg_id = s.wtg_id and l.wind_speed_rank = low
left join curve h on h.wtg_id = s.wtg_id and h.wind_speed_rank = high"""


# Days are compared as text: engines hand a date to pandas in different types.
DAY_COLUMNS = {
    "rolling_reload": "hp_date",
    "late_files": "hp_date",
    **dict.fromkeys(
        "grid_fill counter_delta state_seconds im_flags missing_flags air_density grouped_map date_spine energy_seconds production_base stage_tables".split(), "day"
    ),
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in BODIES.items():
        if name in DAY_COLUMNS:
            day = DAY_COLUMNS[name]
            body = f"select * replace (strftime({day}, '%Y-%m-%d') as {day}) from ({body.strip()}) days_as_text"
        out[name] = views.duckdb_sql(body, STEPS)
    return out
