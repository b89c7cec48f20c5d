"""Table schemas, column renames and the fixed value tables of the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Source point -> warehouse column, in warehouse order. ``occur_time`` also gives ``date``.
MINUTE_POINTS = {
    "wtg_id": "wtg_id",
    "site_id": "site_id",
    "occur_time": "data_time",
    "approduction": "production_active_accum",
    "rpproduction": "production_reactive_accum",
    "apconsumed": "consumption_active_accum",
    "rpconsumed": "consumption_reactive_accum",
    "temout": "temp_out_door",
    "winddirection": "wind_direction",
    "nacelleposition": "nacelle_position",
    "windvanedirection": "wind_vane",
    "blade1position": "pitch_angle",
    "windspeed": "wind_speed",
    "readwindspeed": "read_wind_speed",
    "rotorspd": "rotor_speed",
    "genspd": "gen_speed",
    "torquesetpoint": "torque_setpoint",
    "torque": "torque",
    "activepwcal": "active_power_calc",
    "genactivepw": "active_power",
    "pcurvests": "power_curve_state",
}

MINUTE_RAW = _struct(all_key_value=STRING, hp_date=STRING)

MINUTE_WAREHOUSE = _struct(
    wtg_id=STRING,
    site_id=STRING,
    data_time=LONG,
    date=STRING,
    production_active_accum=LONG,
    production_reactive_accum=LONG,
    consumption_active_accum=LONG,
    consumption_reactive_accum=LONG,
    **{name: DOUBLE for name in list(MINUTE_POINTS.values())[7:]},
)

FEATURE_STAGING = _struct(
    wtg_id=STRING,
    data_time=LONG,
    temp_out_door=DOUBLE,
    wind_direction=DOUBLE,
    wind_vane=DOUBLE,
    pitch_angle=DOUBLE,
    read_wind_speed=DOUBLE,
    rotor_speed=DOUBLE,
    gen_speed=DOUBLE,
    active_power=DOUBLE,
    wtg_type_id=STRING,
    wtg_type_name=STRING,
    rated_power=DOUBLE,
)
FEATURE = T.StructType(FEATURE_STAGING.fields + [T.StructField("ideal_active_power", DOUBLE)])

POWER_CURVE = _struct(wtg_id=STRING, wind_speed_rank=DOUBLE, active_power=DOUBLE, created_time=STRING)

STATION_MEASURES = [
    f"{measure}_{stat}"
    for measure in ("read_wind_speed", "wind_direction", "active_power")
    for stat in ("avg", "max", "min", "std")
]
STATION_10M = _struct(
    site_id=STRING,
    wtg_id=STRING,
    date_time=STRING,
    p_date=STRING,
    **{name: DOUBLE for name in STATION_MEASURES},
    hp_date=STRING,
    hp_ds=STRING,
)

# Valid range per field of the 1-minute table; the upper bound is doubled on use.
MINUTE_RULES = {
    "nacelle_position": (-1080.0, 1080.0),
    "pitch_angle": (-5.0, 90.0),
    "read_wind_speed": (0.5, 50.0),
    "temp_out_door": (-40.0, 45.0),
    "gen_speed": (0.0, 3000.0),
    "active_power": (-100.0, 5000.0),
}

# Valid range per field of the 10-minute table, both ends included.
TEN_MINUTE_RULES = {
    "temoutave": (213.15, 333.15),
    "winddirectionave": (0.0, 360.0),
    "bladepitchave": (-20.0, 100.0),
    "windspeedave": (0.0, 50.0),
    "pcurvestsave": (0.0, 100.0),
}

# Field -> (turbine rating, lower factor, upper factor).
RATED_RULES = {
    "activepwave": ("rated_power", -0.5, 2.0),
    "torquesetpointave": ("rated_torque", 0.0, 2.0),
    "torqueave": ("rated_torque", 0.0, 2.0),
    "rotorspdave": ("on_grid_rotor_speed", -0.5, 2.0),
    "genspdave": ("on_grid_generator_speed", -0.5, 2.0),
}

# Measures of the 10-minute table in column order.
TEN_MINUTE_MEASURES = [
    "temoutave",
    "winddirectionave",
    "nacellepositionave",
    "bladepitchave",
    "windspeedave",
    "windspeedstd",
    "readwindspeedave",
    "rotorspdave",
    "genspdave",
    "torquesetpointave",
    "torqueave",
    "activepwave",
    "pcurvestsave",
    "approduction",
    "rpproduction",
    "apconsumed",
    "rpconsumed",
]
COUNTERS = ["approduction", "rpproduction", "apconsumed", "rpconsumed"]
TEN_MINUTE = T.StructType(
    [T.StructField("wtg_id", STRING), T.StructField("datatime", T.TimestampNTZType())]
    + [T.StructField(name, DOUBLE) for name in TEN_MINUTE_MEASURES]
)

# The order of the fields in the quality flag, four bits each.
FLAG_FIELDS = [
    "temoutave",
    "winddirectionave",
    "bladepitchave",
    "windspeedave",
    "rotorspdave",
    "genspdave",
    "torquesetpointave",
    "torqueave",
    "activepwave",
    "pcurvestsave",
    "approduction",
    "missing",
]

# The bits of the energy error map, lowest bit first.
ENERGY_ERRORS = [
    "DECREASE",
    "OUT_OF_MAX_RANGE",
    "NAN",
    "NAN_PRE",
    "NO_NTF_WIND_SPEED",
    "NO_NTF_SITE_WIND_SPEED",
    "NO_NTF_STANDARD_WIND_SPEED",
    "NO_TEMP_OUT",
]

# The five leading columns and the 158 points of the 1-second standard table, in order.
STANDARD_COMMON = ["COMMON.Reserved", "COMMON.ProtocolID", "COMMON.WTGID", "COMMON.DateTime", "COMMON.Version"]
STANDARD_POINTS = """
WCNV.CosCon WCNV.CurConL1 WCNV.CurConL2 WCNV.CurConL3 WCNV.CurGrid WCNV.CurMotor WCNV.GridFreq
WCNV.GridRePW WCNV.InvPhase1Tmp WCNV.InvPhase2Tmp WCNV.InvPhase3Tmp WCNV.OCCutIn WCNV.TemConv2
WCNV.TemOutCoolSys WCNV.TempINUIGBTMax WCNV.TempISUIGBTMax WCNV.TempTrfmOut WCNV.TmpInvRotU
WCNV.TmpInvRotV WCNV.TmpInvRotW WCNV.Torque WCNV.TorqueSetpoint WCNV.VolConL1 WCNV.VolConL2
WCNV.VolConL3 WGEN.ActivePWCal WGEN.GenActivePW WGEN.GENPreWaterCoolInlet WGEN.GENPreWaterCoolOutlet
WGEN.GenReactivePW WGEN.GenSenMaxTmp WGEN.GenSenTmp1 WGEN.GenSenTmp2 WGEN.GenSenTmp3 WGEN.GenSenTmp4
WGEN.GenSenTmp5 WGEN.GenSenTmp6 WGEN.GenSpd WGEN.GENTemWaterCoolInlet WGEN.GENTemWaterCoolOutlet
WGEN.TemGenDriEnd WGEN.TemGenNonDE WGEN.TemGenStaU WGEN.TemGenStaU2 WGEN.TemGenStaV WGEN.TemGenStaV2
WGEN.TemGenStaW WGEN.TemGenStaW2 WGEN.CoolTemoutGen WNAC.AirPressure WNAC.CtlCabTmp WNAC.HumNacelle
WNAC.TemNacelle WNAC.TemNacelleCab WNAC.TemOut WNAC.TopBoxTmp WNAC.WindDirection WNAC.WindSpeed
WNAC.WindSpeedMode WNAC.WindVaneDirection WNAC.CoolPumpOutTem WNAC.NacellePosition WROT.BatVolBalde1
WROT.BatVolBalde2 WROT.BatVolBalde3 WROT.Blade1Position WROT.Blade1Speed WROT.Blade2Position
WROT.Blade2Speed WROT.Blade3Position WROT.Blade3Speed WROT.BladePosition WROT.BladeTipPres
WROT.CurBlade1Motor WROT.CurBlade2Motor WROT.CurBlade3Motor WROT.PowerStorePres WROT.PowerStoreTmp
WROT.PtCptTmpBl1 WROT.PtCptTmpBl2 WROT.PtCptTmpBl3 WROT.PtMotorTmpBl1 WROT.PtMotorTmpBl2
WROT.PtMotorTmpBl3 WROT.SlipRingTmp WROT.TemAxisCtrl1 WROT.TemAxisCtrl2 WROT.TemAxisCtrl3
WROT.TemB1Cap WROT.TemB1Mot WROT.TemB2Cap WROT.TemB2Mot WROT.TemB3Cap WROT.TemB3Mot
WROT.TemBlade1Inver WROT.TemBlade2Inver WROT.TemBlade3Inver WROT.TemHub WROT.TemPitchBat1
WROT.TemPitchBat2 WROT.TemPitchBat3 WROT.VolB1Cap WROT.VolB2Cap WROT.VolB3Cap WTOW.TemTower
WTOW.TemTowerCab WTOW.TemTowerOut WTRF.TempGCCTrfm WTRF.TempTransfPh1 WTRF.TempTransfPh2
WTRF.TempTransfPh3 WTRM.CoolTemoutGBX WTRM.DiffPFilterIn WTRM.GearBoxDistri WTRM.PGOilFilterIn
WTRM.PowerStoreTRBS WTRM.PrePowerStoreTRBS WTRM.PresGBoxIn WTRM.RotorSpd WTRM.RotorSpdPrcs
WTRM.TemGBoxOilE WTRM.TemGeaHS1 WTRM.TemGeaHS2 WTRM.TemGeaHS3 WTRM.TemGeaMS1 WTRM.TemGeaMS2
WTRM.TemGeaMS3 WTRM.TemGeaMSDE WTRM.TemGeaMSND WTRM.TemGeaOil WTRM.TemGeaZSDE WTRM.TemGeaZSND
WTRM.TemMainBearing WTRM.TemMainBearing2 WTUR.AIStatusCode WTUR.LimitPowerSts WTUR.RemoteControlSts
WTUR.Reset WTUR.ServiceState WTUR.Start WTUR.StatusCode WTUR.Stop WTUR.SetTurbOp WTUR.TurbineSts
WVIB.VibrationL WVIB.VibrationLFil WVIB.VibrationV WVIB.VibrationVFil WWPP.APConsumed
WWPP.APProduction WWPP.RPConsumed WWPP.RPProduction WYAW.OTYawCCW WYAW.OTYawCW WYAW.TotalTwist
WYAW.YawCCWSts WYAW.YawCWSts WYAW.YawSts
""".split()


#: Times of delimited tables.
TEXT_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def column_name(alias: str) -> str:
    return alias.replace(".", "_")


SECOND_STANDARD = T.StructType(
    [T.StructField(column_name(a), STRING) for a in STANDARD_COMMON]
    + [T.StructField(column_name(a), DOUBLE) for a in STANDARD_POINTS]
)


def create_table(
    spark, name: str, schema: T.StructType, partitions: list[str], location: str, sep: str | None = None, rows_per_file: int = 0
) -> None:
    """External partitioned table at ``location``: Parquet, or with ``sep`` delimited text, where ``\\N`` is null.

    ``rows_per_file`` cuts the files of everything that is written to it by name.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{p}`" for p in partitions)
    options = {"sep": sep, "nullValue": r"\N", "timestampNTZFormat": TEXT_STAMP} if sep else {}
    if rows_per_file:
        options["maxRecordsPerFile"] = rows_per_file
    listed = ", ".join("'{}' '{}'".format(k, str(v).replace("\\", "\\\\")) for k, v in options.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {'csv' if sep else 'parquet'} "
        + (f"OPTIONS ({listed}) " if options else "")
        + f"PARTITIONED BY ({keys}) LOCATION '{location}'"
    )
