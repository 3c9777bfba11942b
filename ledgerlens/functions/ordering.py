"""A single sortable key for "first row by (time, price)" aggregates.

``min``/``max`` over a struct force a sort-based aggregate (struct buffers are
not updatable in place).  Packing the ordering into one ``decimal(38,0)``
lets ``min_by``/``max_by`` run as hash aggregates with map-side combining,
and ties between rows with different prices are broken deterministically.

Layout (decimal digits):  ``[time part] * 10**19 + [price part]`` where

* time part  = microseconds since 0001-01-01 + 1, or ``null_time`` for a
  null time (0 sorts nulls first ascending; ``NULL_TIME_LAST`` above every
  real instant makes a null the *greatest*);
* price part = price as ``decimal(18,7)`` unscaled + 10**18 + 1, or 0 for a
  null price (nulls lowest).

Prices of another type, or of a decimal type with more digits, don't fit: for
them ``order_key`` orders by a struct.

The time part stays below 10**18 and the price part below 10**19, so the key
stays below 10**37 and fits ``decimal(38,0)`` exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Microseconds from 1970-01-01 back to 0001-01-01 (proleptic Gregorian).
_MIN_MICROS = 62_135_596_800_000_000
_PRICE_OFFSET = 10**18 + 1
_SHIFT = 10**19
NULL_TIME_FIRST = 0
NULL_TIME_LAST = 10**18 - 1
# Prices that the packed key holds: whole digits and decimals.
_WHOLE, _DECIMALS = 11, 7


def _dec(x) -> Column:
    # Large Python ints do not fit a JVM long; pass them as decimal text.
    return (x if isinstance(x, Column) else F.lit(str(x))).cast("decimal(38,0)")


def time_price_key(ts: Column, price: Column, null_time: int = NULL_TIME_FIRST) -> Column:
    """decimal(38,0) ordering like ``(ts, price)``; see module doc for nulls."""
    # Under the UTC session zone the operators run in, a wall-clock
    # ``timestamp_ntz`` and its ``timestamp`` cast hold the same microseconds.
    micros = F.unix_micros(ts.cast("timestamp"))
    time_part = F.when(ts.isNull(), _dec(null_time)).otherwise(_dec(micros) + _dec(_MIN_MICROS + 1))
    unscaled = (price.cast("decimal(18,7)") * F.lit(10**7).cast("decimal(8,0)")).cast("decimal(38,0)")
    price_part = F.when(price.isNull(), _dec(0)).otherwise(unscaled + _dec(_PRICE_OFFSET))
    return time_part * _dec(_SHIFT) + price_part


def order_key(df: DataFrame, ts: str, price: str, null_time: int = NULL_TIME_FIRST) -> Column:
    """Key ordering the rows of ``df`` by time and price: packed where the price's
    type fits, else a struct, exact for any type (and a sort-based aggregate)."""
    kind = df.schema[price].dataType
    if isinstance(kind, DecimalType) and kind.scale <= _DECIMALS and kind.precision - kind.scale <= _WHOLE:
        return time_price_key(F.col(ts), F.col(price), null_time)
    null_last = F.col(ts).isNull() if null_time == NULL_TIME_LAST else F.lit(False)
    return F.struct(null_last.alias("none"), F.col(ts).alias("ts"), F.col(price).alias("price"))
