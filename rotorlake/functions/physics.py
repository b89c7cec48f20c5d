"""Air density, corrected wind speed, unit conversion and interpolation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rotorlake.functions.text import nan_to_null

# Physical constants.
ZERO_CELSIUS = 273.15
GAS_DRY_AIR = 287.05
GAS_WATER_VAPOUR = 461.5
RELATIVE_HUMIDITY = 0.5
STANDARD_AIR_DENSITY = 1.225
WIND_SPEED_SCALE = 248.0


def to_kelvin(celsius: Column) -> Column:
    return celsius + F.lit(ZERO_CELSIUS)


def to_celsius(kelvin: Column) -> Column:
    return kelvin - F.lit(ZERO_CELSIUS)


def full_circle(degrees: Column) -> Column:
    return F.pmod(degrees, F.lit(360.0))


def air_pressure(altitude: Column, hub_height: Column, temperature: Column, kelvin_input: bool = False) -> Column:
    """Pressure in kPa at hub height.

    The jobs pass a Kelvin temperature and the formula adds the Celsius offset again; their published
    results rest on that, so it is the default. ``kelvin_input=True`` leaves the second offset out.
    """
    kelvin = temperature if kelvin_input else F.lit(ZERO_CELSIUS) + temperature
    height = (altitude + hub_height) * F.lit(-1.0)
    return F.lit(101.325) * F.exp(F.try_divide(height * F.lit(9.8), F.lit(GAS_DRY_AIR) * kelvin))


def vapour_pressure(temperature: Column) -> Column:
    return F.lit(0.0000205) * F.exp(F.lit(0.0613846) * temperature)


def air_density(temperature: Column, altitude: Column, hub_height: Column, kelvin_input: bool = False) -> Column:
    dry = air_pressure(altitude, hub_height, temperature, kelvin_input) * F.lit(1000.0) / F.lit(GAS_DRY_AIR)
    wet = F.lit(RELATIVE_HUMIDITY) * vapour_pressure(temperature) * F.lit(1 / GAS_DRY_AIR - 1 / GAS_WATER_VAPOUR)
    return F.try_divide(F.lit(1.0), temperature) * (dry - wet)


def density_corrected_speed(speed: Column, density: Column, reference: Column) -> Column:
    """Speed scaled by the cube root of the density ratio; null where the ratio is negative."""
    return nan_to_null(speed * F.pow(F.try_divide(density, reference), F.lit(1.0 / 3)))


def transfer_speed(speed: Column, a: Column, b: Column, c: Column) -> Column:
    return a * speed * speed + b * speed + c


def interpolate(x0: Column, y0: Column, x1: Column, y1: Column, x: Column) -> Column:
    return F.try_divide(y1 - y0, x1 - x0) * (x - x0) + y0


def grid_neighbours(speed: Column, step: float = 0.5) -> tuple[Column, Column]:
    """Grid points around ``speed``, truncating toward zero below it; equal on a grid point."""
    whole = F.signum(speed) * F.floor(F.abs(speed)).cast("double")
    low = F.when(speed - whole > F.lit(step), whole + F.lit(1.0 - step)).otherwise(whole)
    on_grid = F.pmod(speed, F.lit(step)) == F.lit(0.0)
    return F.when(on_grid, speed).otherwise(low), F.when(on_grid, speed).otherwise(low + F.lit(step))
