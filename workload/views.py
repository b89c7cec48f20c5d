"""Telemetry-shaped views over the driver's tables, in SQL that Spark and DuckDB both run.

Every view reads its whole tables. Events are laid out as turbine telemetry: 1008 events make one
turbine's seven days of 10-minute marks. ``$ts`` stands for the engine's plain timestamp literal.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Schemas are given, so that opening a table starts no job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
BASE = "$ts '2024-01-01 00:00:00'"
DBL = "as double)"

VIEWS = {
    # 1-minute warehouse rows: a user is a turbine.
    "telemetry": """
select event_id, cast(user_id as string) as wtg_id, concat('site', cast(user_id % 5 as string)) as site_id, ts as data_time,
  case when event_id % 41 = 0 then null when event_id % 97 = 0 then cast(999 as double)
       else cast(event_id % 70 - 20 as double) end as temp_out_door,
  cast(event_id % 360 as double) as wind_direction,
  cast(event_id % 1081 - 540 as double) * cast(3 as double) as nacelle_position,
  cast(event_id % 181 - 90 as double) as wind_vane,
  cast(event_id % 200 - 10 as double) as pitch_angle,
  case when event_id % 37 = 0 then null else value / cast(10 as double) end as read_wind_speed,
  cast(event_id % 25 as double) as rotor_speed,
  cast(event_id % 7000 - 200 as double) as gen_speed,
  value * cast(30 as double) - cast(150 as double) as active_power
from {events}""",
    # 10-minute rows: every 11th event repeats the mark before its own, which leaves a gap; every fourth turbine is silent
    # on its third day; a few rows lie between the marks.
    "telemetry_10m": f"""
select e.event_id as loaded_at, cast(e.n as string) as wtg_id,
  {BASE} + interval '10' minute * e.k + interval '1' minute * (case when e.event_id % 503 = 0 then 3 else 0 end) as datatime,
  case when e.event_id % 41 = 0 then null else cast(e.event_id % 70 - 20 {DBL} end as temoutave,
  cast(e.event_id % 400 - 20 {DBL} as winddirectionave,
  cast(e.event_id % 1081 - 540 {DBL} as nacellepositionave,
  cast(e.event_id % 140 - 30 {DBL} as bladepitchave,
  case when e.event_id % 37 = 0 then null when e.event_id % 59 = 0 then cast(0 {DBL}
       else e.value / cast(8 {DBL} end as windspeedave,
  cast(e.event_id % 50 {DBL} / cast(100 {DBL} as windspeedstd,
  e.value / cast(9 {DBL} as readwindspeedave,
  case when e.event_id % 43 = 0 then null else cast(e.event_id % 25 {DBL} end as rotorspdave,
  cast(e.event_id % 4000 - 300 {DBL} as genspdave,
  cast(e.event_id % 17000 - 500 {DBL} as torquesetpointave,
  case when e.event_id % 47 = 0 then null else cast(e.event_id % 18000 {DBL} end as torqueave,
  e.value * cast(30 {DBL} - cast(900 {DBL} as activepwave,
  cast(e.event_id % 103 {DBL} as pcurvestsave,
  case when e.event_id % 53 = 0 then null
       else cast((e.event_id * 35 + cast(floor(e.value) as bigint)) % 3000 {DBL} end as approduction,
  cast(e.event_id * 3 {DBL} as rpproduction,
  case when e.event_id % 61 = 0 then null else cast(e.event_id * 2 {DBL} end as apconsumed,
  cast(e.event_id % 500 {DBL} as rpconsumed
from (select event_id, value, cast(floor(event_id / 1008) as bigint) as n,
        greatest(cast(1 as bigint), event_id % 1008 + 1 - case when event_id % 11 = 0 then 1 else 0 end) as k
      from {{events}}) e
where not (e.n % 4 = 1 and e.k between 289 and 432)""",
    "wtg_dim": f"""
select cast(s_suppkey as string) as wtg_id, concat('S', cast(s_suppkey as string)) as idx,
  cast(s_suppkey % 5 as string) as wtg_type_id, cast(s_suppkey % 4 as int) as site_type, s_nationkey as site_id,
  concat('Brand#', cast(s_suppkey % 30 as string)) as scada_ntf_id,
  cast(100 * (s_suppkey % 12) {DBL} as altitude, cast(70 {DBL} as hub_height,
  cast(1500 + 500 * (s_suppkey % 3) {DBL} as rated_power, cast(8100 {DBL} as rated_torque,
  cast(10 {DBL} as on_grid_rotor_speed, cast(1800 {DBL} as on_grid_generator_speed
from {{supplier}}""",
    "wtg_type": f"""
select cast(r_regionkey as string) as wtg_type_id, r_name as wtg_type_name,
  cast(1500 + 500 * r_regionkey {DBL} as rated_power
from {{region}}""",
    "site_dim": f"""
select n_nationkey as site_id, cast(1 {DBL} + cast(n_regionkey {DBL} / cast(20 {DBL} as air_density
from {{nation}}""",
    "ntf_data": f"""
select p_brand as ntf_id, cast(p_size {DBL} / cast(2 {DBL} as rotor_speed,
  max(p_retailprice) / cast(1000000 {DBL} as a, cast(1 {DBL} as b, min(p_retailprice) / cast(10000 {DBL} as c
from {{part}} group by p_brand, p_size""",
    # Several rows per point; the newest counts. Some rows have no speed.
    "power_curve": f"""
select cast(l_suppkey as string) as wtg_id, case when l_orderkey % 97 = 0 then null else l_quantity / cast(2 {DBL} end as wind_speed_rank,
  l_extendedprice as active_power, cast(cast(l_shipdate as date) as string) as created_time
from {{lineitem}}""",
    "wtg_pc": """
select cast(s_suppkey as string) as wtg_id, cast(1 as int) as pc_type, s_suppkey * 2 as pc_id from {supplier}
union all
select cast(s_suppkey as string), cast(3 as int), s_suppkey * 2 + 1 from {supplier}""",
    "pc_data": f"""
select l_suppkey * 2 + l_linenumber % 2 as pc_id, l_quantity as wind_speed_rank,
  max(l_extendedprice) / cast(100 {DBL} as power
from {{lineitem}} group by l_suppkey * 2 + l_linenumber % 2, l_quantity""",
    # Quarter-hour steps, so that several events of one log meet in a second and some fall on midnight; most lie within
    # a second.
    "state_log": f"""
select cast(e.n as string) as wtg_id,
  case when event_type = 'error' then 'nc_id' when event_type in ('click', 'signup') then 'ss_id' else 'sc_id' end as kind,
  {BASE} + interval '1' second * (e.d * 86400 + (event_id % 96) * 900 + event_id % 3)
    + interval '1' millisecond * (event_id % 5 * 200) as starttime,
  cast(event_id % 1000 as int) as msec,
  case when event_id % 13 = 0 then null else cast(event_id % 7 as int) end as state_id
from (select event_id, event_type, cast(floor(event_id / 1008) as bigint) as n,
        cast(floor(event_id % 1008 / 144) as bigint) as d
      from {{events}}) e""",
    "kv_raw": """
select event_id, concat('wtg_id:', cast(user_id as string), ',SITE_ID:', event_type,
  case when event_id % 29 = 0 then ',broken' else '' end,
  case when event_id % 31 = 0 then ',occur_time:N/A'
       else concat(',occur_time:', substring(cast(ts as string), 1, 19)) end,
  ',temout:', cast(event_id % 70 - 20 as string), ',genactivepw:bad',
  ',readwindspeed:', case when event_id % 23 = 0 then 'N/A' else cast(cast(floor(value) as bigint) as string) end,
  case when event_id % 17 = 0 then ',TEMOUT:99' else '' end,
  ',approduction:', cast(event_id * 7 as string)) as all_key_value
from {events}""",
    # Rows of the 1-minute table as text; some with a field too many, some with values that are no numbers.
    "warehouse_text": """
select concat_ws(',', cast(user_id as string), 'site', cast(event_id as string), '20240104', cast(event_id * 7 as string),
  case when event_id % 9 = 0 then 'N/A' else cast(event_id as string) end, '1', '2', cast(event_id % 70 - 20 as string), '3', '4', '5', '6',
  '7.5', case when event_id % 8 = 0 then 'bad' else cast(event_id % 30 as string) end, '8', '9', '10', '11', '12',
  '13', '0', case when event_id % 19 = 0 then 'extra' end) as value
from {events}""",
    "protocol_row": """
select l_orderkey, l_linenumber, concat('k', chr(9), case when l_returnflag = 'N' and l_linenumber = 7 then 'x' else cast(l_linenumber as string) end,
  ',W', cast(l_suppkey as string), ',2024-01-02,1,',
  cast(cast(l_quantity as bigint) as string), ',', cast(cast(floor(l_extendedprice) as bigint) as string), ',N/A,',
  cast(l_partkey as string), ',', l_linestatus, case when l_orderkey % 19 = 0 then ',extra' else '' end) as line
from {lineitem}""",
    "protocol_alias": """
select cast(n_regionkey as string) as protocol_id, cast(pos as int) as pos, n_name as field_desc,
  case pos when 0 then 'WNAC.WindSpeed' when 1 then 'WGEN.GenActivePW' when 2 then 'WROT.TemHub'
           when 3 then 'X.Unknown' else case when n_regionkey % 2 = 0 then 'X.Other' end end as field_alias
from (select n_regionkey, n_name, row_number() over (partition by n_regionkey order by n_nationkey) - 1 as pos
      from {nation}) p""",
    "wtg_master": """
select concat('W', cast(n_nationkey as string)) as wtg_id, concat('M', cast(n_nationkey as string)) as master_id
from {nation}
union all
select concat('W', cast(n_nationkey as string)), concat('A', cast(n_nationkey as string)) from {nation} where n_regionkey < 2""",
    "master_list": """
select cast(s_suppkey as string) as wtg_id,
  case when s_acctbal < 0 then 'NULL' else concat(r_name, '.', n_name, '.', s_name) end as alias, cast(s_nationkey as string) as site_id
from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "rule_lines": """
select case when p_size = 1 then concat('#', p_name) when p_size = 2 then ''
  when p_size % 2 = 0 then concat('P', cast(p_partkey as string), ':(', cast(p_size as string), ',', cast(cast(floor(p_retailprice) as bigint) as string), ']')
  else concat('P', cast(p_partkey as string), ', -', cast(p_size as string), ', +', cast(cast(floor(p_retailprice) as bigint) as string)) end as value
from {part}""",
    "fact_10m": f"""
select concat('site', cast(user_id % 5 as string)) as hp_site, cast(user_id as string) as wtg_id,
  substring(cast(ts as string), 1, 19) as data_time,
  value as read_wind_speed_avg, value + 1 as read_wind_speed_max, value - 1 as read_wind_speed_min, value / 8 as read_wind_speed_std,
  cast(event_id % 360 {DBL} as wind_direction_avg, cast(event_id % 360 + 3 {DBL} as wind_direction_max,
  cast(event_id % 360 - 3 {DBL} as wind_direction_min, cast(event_id % 4 {DBL} as wind_direction_std,
  value * 30 as active_power_avg, value * 31 as active_power_max, value * 29 as active_power_min, value / 4 as active_power_std,
  cast(user_id % 3 as string) as hp_ds, replace(substring(cast(ts as string), 1, 7), '-', '') as hp_yyyymm
from {{events}}""",
    "log_files": """
select event_id, concat('log', event_type, '.', cast(user_id % 20 as string), '.',
  replace(substring(cast(ts as string), 1, 10), '-', ''), '.', substring(cast(ts as string), 12, 2)) as file_name
from {events}""",
}


def _needs(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name].replace("$ts", "timestamp_ntz")
    return spark.sql(sql, **{need: view(spark, sf_dir, need) for need in _needs(sql)})


def duckdb_sql(body: str, steps: dict[str, str] | None = None) -> str:
    """``body`` with the views and steps it names in braces as common table expressions, in order of need."""
    known = VIEWS | (steps or {})
    order: list[str] = []

    def visit(sql: str) -> None:
        for need in _needs(sql):
            if need in known and need not in order:
                visit(known[need])
                order.append(need)

    visit(body)

    def plain(sql: str) -> str:
        return re.sub(r"\{(\w+)\}", r"\1", sql).replace("$ts", "timestamp")

    head = ",\n".join(f"{name} as ({plain(known[name])})" for name in order)
    text = plain(body).strip()
    if not head:
        return text
    return f"with {head}, {text[5:]}" if text.lower().startswith("with ") else f"with {head}\n{text}"
