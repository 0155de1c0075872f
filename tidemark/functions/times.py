"""Time columns: epoch seconds and duration strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds per duration unit (fixed values).
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def epoch_of_ntz(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp, whatever the session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (F.unix_date(ts.cast("date")) * F.lit(86400).cast("bigint")
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def parse_duration(col: Column) -> Column:
    """'30s', '5m', '2h', '24h' to BIGINT seconds; anything else to null."""
    number = F.regexp_extract(col, r"^\s*(\d+)\s*([smhdw])\s*$", 1)
    unit = F.regexp_extract(col, r"^\s*(\d+)\s*([smhdw])\s*$", 2)
    factor = F.lit(None).cast("bigint")
    for name, seconds in UNIT_SECONDS.items():
        factor = F.when(unit == name, F.lit(seconds).cast("bigint")).otherwise(factor)
    return F.when(number != "", number.cast("bigint") * factor)


def seconds(text: str) -> int:
    """The same for one configuration value."""
    return int(text[:-1]) * UNIT_SECONDS[text[-1]]
