"""Date helpers at an explicit zone offset (epoch milliseconds in and out).

All three run JVM-side. The formatting helpers need a UTC session, which
``strata.session.configure`` sets.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone the source system stamps its dates in, and the two
# text formats it uses.
DEFAULT_ZONE = "+08:00"
DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def to_ts(text: Column, is_full: bool = False, zone: str = DEFAULT_ZONE,
          strict: bool = True) -> Column:
    """``yyyy-MM-dd`` (or ``yyyy-MM-dd HH:mm:ss`` with ``is_full``) read at
    ``zone`` → epoch milliseconds. ``strict`` raises on bad text (ANSI), else NULL."""
    full = text if is_full else F.concat(text, F.lit(" 00:00:00"))
    stamped = F.concat(full, F.lit(zone))
    fmt = DATETIME_FORMAT + "XXX"
    parsed = F.to_timestamp(stamped, fmt) if strict else F.try_to_timestamp(stamped, F.lit(fmt))
    return F.unix_millis(parsed)


def _local(ms: Column, zone: str) -> Column:
    return F.from_utc_timestamp(F.timestamp_millis(ms), zone)


def to_date(ms: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Epoch milliseconds → ``yyyy-MM-dd`` at ``zone``."""
    return F.date_format(_local(ms, zone), DATE_FORMAT)


def to_ymd_hms(ms: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Epoch milliseconds → ``yyyy-MM-dd HH:mm:ss`` at ``zone``."""
    return F.date_format(_local(ms, zone), DATETIME_FORMAT)
