"""The daily chain with a stage table between any two jobs: clean, calculation, states, production."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from rotorlake.operators.series import state_intervals
from rotorlake.plans import per_second, ten_minute
from rotorlake.sources.stages import BUCKETS, read_stage, write_stage


@dataclass(frozen=True)
class Stages:
    """Names and folder of the chain's stage tables."""

    prefix: str
    path: str
    buckets: int = BUCKETS

    def write(self, rows: DataFrame, name: str, order: str) -> DataFrame:
        return write_stage(rows, f"{self.prefix}_{name}", f"{self.path}/{name}", order, buckets=self.buckets)

    def read(self, spark: SparkSession, name: str, days: Column | None = None) -> DataFrame:
        return read_stage(spark, f"{self.prefix}_{name}", days)


def run_clean(stages: Stages, raw: DataFrame, turbines: DataFrame, **options) -> DataFrame:
    """Clean marks of the days of ``raw``, each day with the midnight row that it starts from."""
    return stages.write(ten_minute.clean(raw, turbines, **options), "clean", "datatime")


def run_calculation(stages: Stages, dims: list[DataFrame], days: Column | None = None) -> DataFrame:
    """The 10-minute calculation from the stage of clean marks."""
    clean = stages.read(dims[0].sparkSession, "clean", days)
    return stages.write(ten_minute.calculate(clean, *dims), "calculated", "datatime")


def run_states(stages: Stages, logs: dict[str, DataFrame], days: Column | None = None) -> DataFrame:
    """State intervals of the turbine-days that the calculation has."""
    spark = next(iter(logs.values())).sparkSession
    roster = stages.read(spark, "calculated", days).select("wtg_id", "day").distinct()
    return stages.write(state_intervals(logs, roster), "states", "start_time")


def production(stages: Stages, spark: SparkSession, days: Column | None = None, **options) -> DataFrame:
    """The per-second production base, merged bucket by bucket from the two stages; options of ``energy_with_states``."""
    calculated, states = (stages.read(spark, name, days) for name in ("calculated", "states"))
    return per_second.energy_with_states(calculated, states, **options)
