"""Degree measures of an outside temperature."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Base temperatures in degrees Celsius.
HEATING_BASE = 18
COOLING_BASE = 22


def heating_degree(temperature: Column, base: float = HEATING_BASE) -> Column:
    """Degrees below ``base``; 0 when warmer or unknown."""
    return F.when(temperature < base, base - temperature).otherwise(F.lit(0.0))


def cooling_degree(temperature: Column, base: float = COOLING_BASE) -> Column:
    """Degrees above ``base``; 0 when cooler or unknown."""
    return F.when(temperature > base, temperature - base).otherwise(F.lit(0.0))
