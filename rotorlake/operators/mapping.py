"""Protocol-specific 1-second rows to the one standard table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlake.operators.cleaning import remap_ids
from rotorlake.operators.joins import lookup_join
from rotorlake.schemas import STANDARD_COMMON, STANDARD_POINTS, column_name

HEAD = 4  # protocol, turbine, time, version


def protocol_layout(fields: DataFrame) -> DataFrame:
    """One row per protocol: field count, place of every standard point in a split line, and the other fields.

    ``fields`` is the point list of the protocols: (protocol_id, pos, field_desc, field_alias), pos from
    0. If an alias occurs twice the later field wins.
    """
    standard = F.array(*[F.lit(a) for a in STANDARD_POINTS])
    # A field without alias is no standard point; it is kept with the others.
    slot = F.coalesce(F.array_position(standard, F.col("field_alias")), F.lit(0)).cast("int")
    sorted_fields = F.array_sort(F.collect_list(F.struct("pos", "slot", "field_desc")))
    grouped = (
        fields.withColumn("slot", slot).groupBy("protocol_id").agg(F.count(F.lit(1)).alias("width"), sorted_fields.alias("f"))
    )
    places = F.transform(
        F.sequence(F.lit(1), F.lit(len(STANDARD_POINTS))),
        lambda s: F.try_element_at(F.filter("f", lambda x: x["slot"] == s), F.lit(-1))["pos"] + F.lit(HEAD),
    )
    others = F.filter("f", lambda x: x["slot"] == 0)
    return grouped.select("protocol_id", "width", places.alias("places"), others.alias("others"))


def _split_line(line: Column) -> Column:
    return F.split(F.get(F.split(F.trim(line), "\t"), 1), ",")


def _matched(rows: DataFrame, fields: DataFrame, col: str) -> DataFrame:
    split = rows.withColumn("_all", _split_line(F.col(col)))
    tagged = split.withColumn("protocol_id", F.get("_all", 0))
    layout = protocol_layout(fields)
    # The size that counts is that of the point list the layout is made from.
    return lookup_join(tagged, layout, "protocol_id", "left")


def _is_good() -> Column:
    number = F.get("_all", 0).try_cast("int").isNotNull()
    fits = F.size("_all") - F.lit(HEAD) == F.col("width")
    return F.coalesce(number & fits, F.lit(False))


def standard_mapping(
    rows: DataFrame, fields: DataFrame, master: DataFrame, col: str = "line", fail_fast: bool = False
) -> DataFrame:
    """Lines ``key<TAB>protocol,turbine,time,version,v1,v2,...`` to the 163 standard columns.

    Fields without a standard point are kept as ``desc=value;...`` in the first column. Turbine ids are
    replaced by master ids where there is one. Lines that fit no protocol are left out; with
    ``fail_fast`` a line of the wrong width stops the job.
    """
    keep = [c for c in rows.columns if c != col]
    matched = _matched(rows, fields, col)
    if fail_fast:
        number = F.coalesce(F.get("_all", 0).try_cast("int").isNotNull(), F.lit(False))
        wrong = F.raise_error(F.concat(F.lit("field count differs from protocol "), F.col("protocol_id")))
        good = matched.where(number).where(F.when(_is_good(), F.lit(True)).otherwise(wrong.cast("boolean")))
    else:
        good = matched.where(_is_good())
    reserved = F.array_join(
        F.transform("others", lambda o: F.concat(o["field_desc"], F.lit("="), F.get("_all", o["pos"] + F.lit(HEAD)))), ";"
    )
    points = [
        f"nanvl(try_cast(get(_all, get(places, {i})) as double), null) as {column_name(alias)}"
        for i, alias in enumerate(STANDARD_POINTS)
    ]
    placed = good.withColumns(
        {
            "COMMON_Reserved": reserved,
            "COMMON_ProtocolID": F.col("protocol_id"),
            "COMMON_WTGID": F.get("_all", 1),
            "COMMON_DateTime": F.get("_all", 2),
            "COMMON_Version": F.get("_all", 3),
        }
    ).selectExpr(*keep, *[column_name(c) for c in STANDARD_COMMON], *points)
    return remap_ids(placed, master, "COMMON_WTGID", "wtg_id", "master_id", keep_unmapped=True)


def mapping_rejects(rows: DataFrame, fields: DataFrame, col: str = "line") -> DataFrame:
    """The lines ``standard_mapping`` leaves out."""
    return _matched(rows, fields, col).where(~_is_good()).select(*rows.columns)
