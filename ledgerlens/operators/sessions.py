"""Login sessions per principal and account (U4)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.dates import day_start
from ledgerlens.scope import Scope
from ledgerlens.sources.fixtures import Tables

# Only principals created on or after this day are listed.
PRINCIPALS_CREATED_FROM = _dt.date(2023, 2, 1)


def login_sessions(t: Tables, scope: Scope, created_from: _dt.date = PRINCIPALS_CREATED_FROM) -> DataFrame:
    """Distinct ``(name, account_code, date, expire_at)``.

    The source joins are written as left then right outer joins, but the
    WHERE clause tests principal columns, which turns both into inner joins.
    Sessions are de-duplicated on ``(user_id, expire_at)`` before the joins:
    partial aggregation collapses repeated sessions map-side, so the join
    input is one row per user and expiry rather than one per login.
    """
    sessions = t.user_sessions.select("user_id", "expire_at").distinct()
    princ = scope.principals(t.principals.where(F.col("created_time") >= day_start(created_from))).select(
        F.col("id").alias("p_id"), "name", F.to_date("created_time").alias("p_day")
    )
    accts = t.accounts.select(F.col("owner_id").alias("acc_owner"), "account_code")
    rows = sessions.join(princ, F.col("user_id") == F.col("p_id")).join(accts, F.col("acc_owner") == F.col("p_id"))
    return rows.select(
        "name",
        "account_code",
        F.col("p_day").cast("timestamp_ntz").alias("date"),
        F.col("expire_at").cast("timestamp_ntz").alias("expire_at"),
    ).distinct()
