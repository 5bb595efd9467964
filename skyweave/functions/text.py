"""Display text and identifier checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shape of the two identifiers.
ADDRESS_PATTERN = "^[0-9a-fA-F]{6}$"
CALLSIGN_PATTERN = "^[A-Z0-9]{2,8} *$"


def compact_number(value: Column) -> Column:
    """1234567 as ``1.2M``: as is below a thousand, then K, M and B with one decimal.

    The unit is chosen after rounding, so 999,950 is ``1.0M``.
    """

    def scaled(unit: float, suffix: str) -> Column:
        return F.concat(F.round(value / unit, 1).cast("string"), F.lit(suffix))

    def fits(unit: float) -> Column:
        return F.round(F.abs(value) / unit, 1) < 1000

    return (
        F.when(F.abs(value) < 1000, value.cast("string"))
        .when(fits(1e3), scaled(1e3, "K"))
        .when(fits(1e6), scaled(1e6, "M"))
        .when(value.isNotNull(), scaled(1e9, "B"))
    )


def grouped_number(value: Column) -> Column:
    """Whole number with thousands separators, 1,234,567."""
    return F.format_number(value, 0)


def clock(ts: Column) -> Column:
    """Time of day as HH:mm:ss."""
    return F.date_format(ts, "HH:mm:ss")


def minute_of_day(ts: Column) -> Column:
    """Minutes since midnight."""
    return F.hour(ts) * 60 + F.minute(ts)


def address_status(address: Column) -> Column:
    """missing, malformed or valid."""
    return (
        F.when(address.isNull(), "missing").when(~address.rlike(ADDRESS_PATTERN), "malformed").otherwise("valid")
    )


def callsign_status(callsign: Column) -> Column:
    """missing, malformed or valid; the fixed-width padding is allowed."""
    return (
        F.when(callsign.isNull(), "missing").when(~callsign.rlike(CALLSIGN_PATTERN), "malformed").otherwise("valid")
    )
