"""User and date scope shared by every operator (inventory row U1).

The scope replaces SQL text built by string formatting with column
expressions: one user name gives ``=``, several give ``IN``, none gives
``IS NOT NULL``.  Dates are evaluated per call, not when a module is loaded.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.periods import SUPPORTED_FREQS

# Account ids left out of the trade blotter and of balances.
TRADE_EXCLUDED_ACCOUNT_IDS = (111,)
BALANCE_EXCLUDED_ACCOUNT_IDS = (121, 70500, 213023, 212931)



def _as_date(value: str | _dt.date | None, default: _dt.date) -> _dt.date:
    if value is None:
        return default
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


@dataclass(frozen=True)
class Scope:
    """Which principals and which days a query covers.

    users:      ``None`` (every named principal), one name, a non-empty list,
                or a DataFrame whose first column holds the names (for long
                lists: a semi join instead of literals in the plan).
    date_from:  first day for trades, cash movements and rates.
    date_to:    last day for trades; the bound is inclusive of the *next*
                day as well, as the trade query has always done.
    today:      last day of the rate calendar (defaults to the current date).
    freq:       period for cash totals.
    as_of:      timestamp stamped on open positions (defaults to now).
    """

    users: str | Sequence[str] | DataFrame | None = None
    date_from: str | _dt.date = "2023-03-01"
    date_to: str | _dt.date | None = None
    today: str | _dt.date | None = None
    freq: str = "W-MON"
    as_of: str | None = None
    clearing_code: str = "LIVE"
    trade_excluded_accounts: tuple[int, ...] = field(default=TRADE_EXCLUDED_ACCOUNT_IDS)
    balance_excluded_accounts: tuple[int, ...] = field(default=BALANCE_EXCLUDED_ACCOUNT_IDS)

    def __post_init__(self) -> None:
        users = self.users
        if users is None or isinstance(users, (str, DataFrame)):
            pass
        elif isinstance(users, (list, tuple)):
            if len(users) == 0:
                raise ValueError("users must name at least one principal, or be None")
            if not all(isinstance(u, str) for u in users):
                raise TypeError("users must be strings")
            object.__setattr__(self, "users", tuple(users))
        else:
            raise TypeError("users must be None, a string or a list of strings")
        if self.freq not in SUPPORTED_FREQS:
            raise ValueError(f"unsupported freq {self.freq!r}; one of {SUPPORTED_FREQS}")

    # ---- dates -------------------------------------------------------------
    @property
    def first_day(self) -> _dt.date:
        return _as_date(self.date_from, _dt.date(2023, 3, 1))

    @property
    def last_trade_day(self) -> _dt.date:
        return _as_date(self.date_to, _dt.date.today())

    @property
    def last_rate_day(self) -> _dt.date:
        return _as_date(self.today, _dt.date.today())

    @property
    def rate_days(self) -> int:
        """Number of calendar days in the rate window (bound for broadcasts)."""
        return max(0, (self.last_rate_day - self.first_day).days + 1)

    # ---- predicates --------------------------------------------------------
    def principals(self, principals: DataFrame, name: str = "name") -> DataFrame:
        """``principals`` restricted to the scope's users.

        A DataFrame of names is applied as a semi join, names in a list as an
        ``IN`` predicate."""
        if isinstance(self.users, DataFrame):
            names = self.users.select(F.col(self.users.columns[0]).alias("_scope_name"))
            return principals.join(names, F.col(name) == F.col("_scope_name"), "left_semi")
        return principals.where(self.user_predicate(name))

    def user_predicate(self, name: Column | str) -> Column:
        if isinstance(self.users, DataFrame):
            raise TypeError("a DataFrame of users is applied with Scope.principals, not as a predicate")
        col = F.col(name) if isinstance(name, str) else name
        if self.users is None:
            return col.isNotNull()
        if isinstance(self.users, str):
            return col == F.lit(self.users)
        if len(self.users) == 1:
            return col == F.lit(self.users[0])
        return col.isin(list(self.users))

    def user_sql(self, name: str) -> str:
        """The same predicate as SQL text, for the DuckDB oracle."""

        def q(s: str) -> str:
            return "'" + s.replace("'", "''") + "'"

        if isinstance(self.users, DataFrame):
            raise TypeError("a DataFrame of users has no SQL literal form")
        if self.users is None:
            return f"{name} IS NOT NULL"
        if isinstance(self.users, str):
            return f"{name} = {q(self.users)}"
        if len(self.users) == 1:
            return f"{name} = {q(self.users[0])}"
        return f"{name} IN ({', '.join(q(u) for u in self.users)})"
