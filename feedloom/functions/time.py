"""Times in mixed notations as native column expressions; the session zone must be UTC."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

#: The last second of the year 3000; later times are not shown.
MAX_SHOWN = 32_536_850_399
#: Strftime directives and their pattern letters.
DIRECTIVES = {"Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "y": "yy", "B": "MMMM", "b": "MMM", "A": "EEEE", "a": "EEE", "p": "a", "I": "hh", "j": "DDD", "f": "SSSSSS", "%": "'%'"}
_NUMBER = r"^[+-]?\d+(\.\d+)?([eE][+-]?\d+)?$"


def unix_seconds(c: Column | str) -> Column:
    """Epoch seconds, milli-, micro- or nanoseconds by size, or ISO 8601 text (UTC without an offset), as double."""
    text = F.trim(col(c).cast("string"))
    n = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    size = F.abs(n)
    epoch = F.when(size >= 1e17, n / 1e9).when(size >= 1e14, n / 1e6).when(size >= 1e11, n / 1e3).otherwise(n)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
    return F.coalesce(epoch, F.unix_micros(iso) / 1e6)


def java_pattern(strftime: str) -> str:
    """A date_format pattern for a strftime format; raises on a directive that it does not know."""

    def part(m: re.Match) -> str:
        if m[1]:
            if m[1] not in DIRECTIVES:
                raise ValueError(f"unknown directive %{m[1]}")
            return DIRECTIVES[m[1]]
        return "'" + m[0].replace("'", "''") + "'" if re.search(r"[A-Za-z'\[\]{}#]", m[0]) else m[0]

    return re.sub(r"%(.)|[^%]+", part, strftime)


def shown(seconds: Column, pattern: str, offset_hours: float = 0.0) -> Column:
    ok = (seconds <= MAX_SHOWN) & (seconds >= -62_135_596_800)
    at = F.timestamp_micros(F.floor(F.when(ok, seconds) * 1e6).cast("bigint") + int(offset_hours * 3_600_000_000))
    return F.coalesce(F.date_format(at, pattern), F.lit(""))


def format_local(c: Column | str, offset_hours: float = 8.0, strftime: str = "%Y-%m-%d %H:%M") -> Column:
    """The time at a fixed offset, which may have half hours; empty if it cannot be read."""
    return shown(unix_seconds(c), java_pattern(strftime), offset_hours)


def format_utc(c: Column | str) -> Column:
    return shown(unix_seconds(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")
