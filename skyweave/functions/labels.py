"""Class labels and bands derived from telemetry columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four phase names and the climb/descent cut in m/s.
GROUND, CLIMB, DESCENT, CRUISE = "Ground", "Climb", "Descent", "Cruise"
PHASES = (GROUND, CLIMB, DESCENT, CRUISE)
PHASE_CUT = 1.5


def flight_phase(on_ground="on_ground", vertical_rate="vertical_rate", cut: float = PHASE_CUT) -> Column:
    """Phase of one observation.

    Nulls fall through: an unknown ``on_ground`` is decided by the vertical rate, and an unknown
    vertical rate is cruise. The cut is strict on both sides.
    """
    rate = F.col(vertical_rate)
    return (
        F.when(F.col(on_ground), GROUND)
        .when(rate > cut, CLIMB)
        .when(rate < -cut, DESCENT)
        .otherwise(CRUISE)
    )


def altitude_band(altitude: Column, low: float = 3000.0, high: float = 9000.0) -> Column:
    """Colour band of an altitude; null stays null."""
    return F.when(altitude < low, "low").when(altitude < high, "medium").when(altitude >= high, "high")
