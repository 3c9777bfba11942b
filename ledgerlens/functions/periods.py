"""Period labels for cash totals.

Weekly bins are left-closed and labelled by the next anchor day; period ends
([end, next end)) by the later end; period starts by the start.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Anchors of weekly frequencies with the ISO number of the day.
WEEKDAYS = {"MON": 1, "TUE": 2, "WED": 3, "THU": 4, "FRI": 5, "SAT": 6, "SUN": 7}
# Frequencies of whole months: start and end labels, and their unit.
STARTS = {"MS": "month", "QS": "quarter", "YS": "year"}
ENDS = {"ME": "month", "QE": "quarter", "YE": "year"}
MONTHS = {"month": 1, "quarter": 3, "year": 12}

SUPPORTED_FREQS = ("D", *(f"W-{d}" for d in WEEKDAYS), *STARTS, *ENDS)


def period_label(day: Column, freq: str) -> Column:
    """Label of the period holding ``day`` (a date column), as a date.

    D: the day.  W-MON (to W-SUN): the next Monday after the day, so Monday
    2024-01-01 is labelled 2024-01-08.  MS, QS, YS: first day of the month,
    quarter or year.  ME, QE, YE: the period end after or on the next day, so an end
    opens the period that the following end labels.
    """
    if freq == "D":
        return day
    if freq in STARTS:
        return F.trunc(day, STARTS[freq])
    if freq in ENDS:
        unit = ENDS[freq]
        return F.date_sub(F.add_months(F.trunc(F.date_add(day, 1), unit), MONTHS[unit]), 1)
    if freq.startswith("W-") and freq[2:] in WEEKDAYS:
        return F.next_day(day, freq[2:].title())
    raise ValueError(f"unsupported freq {freq!r}; one of {SUPPORTED_FREQS}")


def period_label_sql(day: str, freq: str) -> str:
    """The same label as DuckDB SQL text (for the oracle)."""
    if freq == "D":
        return f"cast({day} AS DATE)"
    if freq in STARTS:
        return f"cast(date_trunc('{STARTS[freq]}', {day}) AS DATE)"
    if freq in ENDS:
        unit = ENDS[freq]
        return (f"cast(date_trunc('{unit}', cast({day} AS DATE) + INTERVAL 1 DAY) "
                f"+ INTERVAL {MONTHS[unit]} MONTH - INTERVAL 1 DAY AS DATE)")
    if freq.startswith("W-") and freq[2:] in WEEKDAYS:
        ahead = f"(({WEEKDAYS[freq[2:]]} - isodow(cast({day} AS DATE)) + 6) % 7 + 1)"
        return f"cast(cast({day} AS DATE) + cast({ahead} AS INTEGER) AS DATE)"
    raise ValueError(f"unsupported freq {freq!r}; one of {SUPPORTED_FREQS}")
