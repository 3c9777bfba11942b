"""Order-independent money totals.

A sum of doubles depends on the order rows arrive in, which differs between
runs, partitionings and engines.  Amounts are therefore summed as exact decimals
per conversion rate and converted once; the few products left are added in a
stated order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum_in_order(amount: Column, *order: str) -> Column:
    """Aggregate: sum of a double amount, added in the order of the given columns;
    null without any amount.  Gathers the group's amounts, so groups must be
    small by construction."""
    parts = F.array_sort(F.collect_list(F.when(amount.isNotNull(), F.struct(*order, amount.alias("_amount")))))
    return F.when(F.size(parts) > 0, F.aggregate(parts["_amount"], F.lit(0.0), lambda a, b: a + b))


def sum_in_order_sql(amount: str, *order: str) -> str:
    """The same aggregate as DuckDB SQL text."""
    return f"list_reduce(list({amount} ORDER BY {', '.join(order)}) FILTER ({amount} IS NOT NULL), lambda a, b: a + b)"
