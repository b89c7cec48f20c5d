"""Daily per-second tables: states, and energy with states."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rotorlake.functions import calendar, physics
from rotorlake.operators.cleaning import remap_ids
from rotorlake.operators.series import DAY, energy_runs, expand_seconds, pad_states, spread_groups, state_intervals

# 10-minute energies and the names of their shares per second.
ENERGIES = {
    "real_approduction_10m": "production_per_second",
    "theory_approduction_10m": "theory_production_per_second",
    "active_approduction_10m": "actual_production_per_second",
}


def turbine_sets(logs: dict[str, DataFrame], roster: DataFrame) -> DataFrame:
    """Turbines that occur in any state log and in the 10-minute output."""
    keys = None
    for log in logs.values():
        one = log.select("wtg_id")
        keys = one if keys is None else keys.union(one)
    return keys.distinct().join(roster.select("wtg_id").distinct(), "wtg_id", "left_semi")


def remap_logs(logs: dict[str, DataFrame], aliases: DataFrame, source: str = "idx", target: str = "mdm_id") -> dict[str, DataFrame]:
    """State logs with turbine ids instead of the logs' own; rows of unknown ids drop."""
    return {kind: remap_ids(log, aliases, "wtg_id", source, target) for kind, log in logs.items()}


def states(logs: dict[str, DataFrame], ten_minute: DataFrame, **options) -> DataFrame:
    """Per-second state table of the turbines and days of the 10-minute output; options of ``pad_states``."""
    return pad_states(logs, ten_minute.select("wtg_id", "day").distinct(), **options)


def production_base(calculated: DataFrame, logs: dict[str, DataFrame], roster: DataFrame | None = None, **options) -> DataFrame:
    """Energy per second with the states of that second.

    ``roster`` names the (wtg_id, day) pairs of the 10-minute output where they are known without computing it;
    further options are those of ``energy_with_states``.
    """
    roster = calculated.select("wtg_id", "day").distinct() if roster is None else roster
    seconds = DAY * roster.count()
    return energy_with_states(calculated, state_intervals(logs, roster, seconds=seconds), seconds, **options)


def energy_with_states(
    calculated: DataFrame,
    intervals: DataFrame,
    seconds: int | None = None,
    on_runs: Callable[[DataFrame], DataFrame] | None = None,
    second: str | None = None,
) -> DataFrame:
    """Every second with its energy, its mark's measures and its states.

    Equal to a full outer join of the two per-second tables, but joined as intervals: marks and state
    changes of a turbine-day are merged in time order and only the merged intervals are spread out.
    ``seconds`` is the number of seconds to come; without it both sides must lie clustered by turbine (stage tables).
    ``on_runs`` and ``second`` as in ``spread_energy``.
    """
    kinds = [c for c in intervals.columns if c not in ("wtg_id", "day", "start_time", "end_time")]
    celsius = calculated.withColumn("temoutave", physics.to_celsius(F.col("temoutave")))
    runs = energy_runs(celsius, "datatime", ENERGIES, on_runs=on_runs)
    measures = [c for c in runs.columns if c not in ("wtg_id", "day", "start_time", "end_time")]
    # The turbine has another name until the end: a union keeps how its sides lie only by columns that were renamed
    # since the tables.
    energy = runs.select(F.col("wtg_id").alias("_turbine"), "day", "start_time", F.struct("end_time", *measures).alias("_energy"))
    state = intervals.select(F.col("wtg_id").alias("_turbine"), "day", "start_time", F.struct("end_time", *kinds).alias("_state"))
    if seconds is not None:
        energy, state = (spread_groups(x, "_turbine", "day", rows=seconds) for x in (energy, state))
    group = Window.partitionBy("_turbine", "day").orderBy("start_time")
    so_far = group.rowsBetween(Window.unboundedPreceding, 0)
    cut = F.col("start_time")
    end_of_day = calendar.shift(F.col("day").cast("timestamp_ntz"), DAY + 1)
    held_energy, held_state = (F.last(c, ignorenulls=True).over(so_far) for c in ("_energy", "_state"))
    merged = (
        energy.unionByName(state, allowMissingColumns=True)
        .withColumns({"end_time": F.coalesce(F.lead("start_time").over(group), end_of_day), "_e": held_energy, "_s": held_state})
        .where("end_time > start_time")
        .withColumns({side: F.when(F.col(side)["end_time"] > cut, F.col(side)) for side in ("_e", "_s")})
        .where("_e is not null or _s is not null")
    )
    values = [*[F.col("_e")[m].alias(m) for m in measures], *[F.col("_s")[k].alias(k) for k in kinds]]
    pieces = merged.select(F.col("_turbine").alias("wtg_id"), "day", "start_time", "end_time", *values)
    spread = expand_seconds(pieces, second=second)
    return spread.select("wtg_id", "day", "ts", *[c for c in spread.columns if c not in ("wtg_id", "day", "ts")])
