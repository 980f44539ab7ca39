"""Traffic phases of a planned load curve: ramp, steady, burst, steady, cool-down."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def phase(fraction: Column) -> Column:
    """Phase name for the elapsed fraction of the run."""
    return (
        F.when(fraction < 0.20, "ramp_up")
        .when(fraction < 0.60, "steady")
        .when(fraction < 0.75, "burst")
        .when(fraction < 0.90, "steady")
        .otherwise("cool_down")
    )


def _at_least_one(rate: Column) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), rate.cast("bigint"))


def target_rate(fraction: Column, base: int) -> Column:
    """Planned events per second: linear up to the base, base, 3x base, base, linear down."""
    rate = F.lit(float(base))
    name = phase(fraction)
    return (
        F.when(name == "ramp_up", _at_least_one(rate * (fraction / F.lit(0.20))))
        .when(name == "burst", F.lit(3 * base).cast("bigint"))
        .when(name == "steady", F.lit(base).cast("bigint"))
        .otherwise(_at_least_one(rate * ((F.lit(1.0) - fraction) / F.lit(0.10))))
    )
