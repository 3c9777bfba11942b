"""Broadcast only what has a size bound known before the job runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DEFAULT_THRESHOLD = 10 * 1024 * 1024


def _threshold(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", str(_DEFAULT_THRESHOLD))
    raw = raw.strip().lower()
    mult = 1
    for suffix, m in (("kb", 1024), ("mb", 1024**2), ("gb", 1024**3), ("b", 1)):
        if raw.endswith(suffix):
            raw, mult = raw[: -len(suffix)], m
            break
    try:
        return int(float(raw) * mult)
    except ValueError:
        return _DEFAULT_THRESHOLD


def broadcast_if_bounded(df: DataFrame, max_rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast when ``max_rows * row_bytes`` fits the broadcast threshold.

    ``max_rows`` must be a proven upper bound (for example days in a window
    times the number of listed currency pairs), not an estimate.  Past the
    bound the frame is returned unchanged: the planner then shuffles, and AQE
    can still switch to a broadcast once it has measured the real size.
    """
    limit = _threshold(df)
    if limit > 0 and max_rows * row_bytes <= limit:
        return F.broadcast(df)
    return df


def carried_keys(keys: DataFrame, most: int = 100_000) -> DataFrame | None:
    """The distinct values of a single column, to be broadcast, if there are at most
    ``most``; else None.  Runs at once: the values come to the driver (at most
    ``most + 1`` of them) and go into the plan of whoever joins them, so what found them
    is not computed again.  Nulls match nothing and are left out."""
    (name,) = keys.columns
    found = keys.where(F.col(name).isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        return None
    return F.broadcast(keys.sparkSession.createDataFrame(found, keys.schema))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    needed: Column,
    left_key: Column,
    right_key: Column,
    spread: Column,
    hot: Column | None = None,
    salts: int = 64,
) -> DataFrame:
    """Left join ``right`` only where ``needed`` holds; other rows keep nulls.

    Rows that do not need the lookup would otherwise all share one key (a
    null or a default value) and land in a single shuffle partition.  They
    get ``spread`` (same type as ``left_key``, e.g. the row's own id) as join
    key instead, which distributes them like any other key, and the
    ``needed`` condition keeps them from matching anything.

    ``hot`` names a key value that many rows that do need the lookup share; it is
    split over ``salts`` keys, on both sides, whatever rows it matches.
    """
    key = F.when(needed, left_key).otherwise(spread)
    if hot is None:
        return left.join(right, needed & (key == right_key), "left")
    # One key value is known to be common: its rows go to ``salts`` keys by
    # ``spread``, and the few right rows of that value are repeated for each.
    names = left.columns
    salt = F.when(needed & (left_key == hot), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(F.lit(0))
    left = left.withColumns({"_key": key, "_needed": needed, "_salt": salt.cast("int")})
    each = F.when(right_key == hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.select(*right.columns, right_key.alias("_right"), F.explode(each).alias("_right_salt"))
    on = F.col("_needed") & (F.col("_key") == F.col("_right")) & (F.col("_salt") == F.col("_right_salt"))
    kept = [*names, *(c for c in right.columns if c not in ("_right", "_right_salt"))]
    return left.join(right, on, "left").select(*kept)
