"""JSON payload tables (client accounts, metrics, positions, pending orders,
profiles), derived from the driver's tables.

In production these payloads are API responses stored one document per row
(``key`` column plus a ``body`` JSON text).  Here each document is built
from a *single* source row as text, so building them needs no
grouping and grows linearly with the tables.  The oracle reads the same facts
in relational form.

Layouts (fields, categories and attributes that the operators do not name arrive in
their map columns; each kind of document has some).  Each kind also has documents that
are not as they should be; ``k`` is the row's key:

* client:   ``{"clientId", "accounts": [{"accountCode", "clearingCode",
  "currency", "desk", "categories": [{"category", "value"}]}]}``, with the unnamed
  category TIER; odd customers list a DEMO account first.  No ``accounts`` key
  (``k % 10 = 0``), a document cut short (29: 11), an object in place of the list
  (23: 7), a number between the accounts (6: 1), a category with a further field
  (4: 3), a category that is a bare text (14: 2).
* metrics:  ``{"metrics": [{"account", "equity", "balance", "openPL",
  "totalPL"}, ...]}``, first element meaningful, second a zero row.  An empty list
  (13: 0), a text in place of the second element (9: 4), a text for the equity (12: 5).
* positions: ``{"positions": [{"positionCode", "symbol", "quantity", "side"}]}``
  with ``k % 4`` elements (so some are empty).  An object in place of the list (26: 3),
  a number and an element with a text for its quantity at the end (22: 5).
* orders:   ``{"orders": [{"orderCode", "symbol", "quantity", "type"}]}`` with
  ``l_linenumber % 3`` elements.  No document at all (27: 5), a null at the end (18: 4).
* profiles: ``[{"username", "email", "status", "attributes": {"country": [..],
  "phoneNumber": [..], "language": [..]}}]``; every third customer has no phone number.
  A list in place of the attributes (15: 4), a country that is no list (8: 3), a number
  after the profile (16: 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    """The parts as one text, null if one is null; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _fields(*parts: Column | str) -> Column:
    """A JSON object of fields, without those that are null."""
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.lit(p) if isinstance(p, str) else p for p in parts]), F.lit("}"))


def client_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def category(name: str, value: Column, *more: Column) -> Column:
        return F.when(value.isNotNull(), _fields(f'"category":"{name}"', _text('"value":"', value, '"'), *more))

    listed = F.concat_ws(
        ",",
        category("TIER", _text("T", k % 3), F.when(k % 4 == 3, F.lit('"since":"2020"'))),
        category("SEGMENT", F.col("c_mktsegment")),
        category("NATION", F.col("c_nationkey").cast("string")),
        category("SEGMENT", F.when(k % 7 == 0, F.lit("VIP"))),
        F.when(k % 14 == 2, F.lit('"VIP"')),
    )
    main = _fields(
        _text('"accountCode":"A', k, '"'),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", '"clearingCode":"DEMO"').otherwise('"clearingCode":"LIVE"'),
        '"currency":"USD"',
        _text('"desk":"desk', k % 4, '"'),
        _text('"categories":[', listed, "]"),
    )
    demo = _fields(
        _text('"accountCode":"D', k, '"'), '"clearingCode":"DEMO"', '"currency":"USD"', '"desk":"demo"',
        '"categories":[{"category":"SEGMENT","value":"DEMO"}]',
    )
    odd = F.when(k % 6 == 1, F.lit("5"))
    accounts = F.when(k % 2 == 1, F.concat_ws(",", demo, odd, main)).otherwise(F.concat_ws(",", main, odd, demo))
    start = _text('{"clientId":', k)
    body = (
        F.when(k % 10 == 0, _text(start, "}"))
        .when(k % 29 == 11, _text(start, ',"accounts":[{"accountCo'))
        .when(k % 23 == 7, _text(start, ',"accounts":{"accountCode":"A', k, '"}}'))
        .otherwise(_text(start, ',"accounts":[', accounts, "]}"))
    )
    return c.select(F.col("c_name").alias("user_id"), body.alias("body"))


def metrics_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    code = _text("A", k)
    account = _text('"account":"', code, '"')
    first = _fields(
        account,
        F.when(k % 12 == 5, F.lit('"equity":"n/a"')).otherwise(_text('"equity":', F.col("c_acctbal"))),
        _text('"balance":', F.col("c_acctbal") / 2),
        '"openPL":0.0',
        _text('"totalPL":', F.col("c_acctbal") / 4),
    )
    zero = _fields(account, '"equity":0.0', '"balance":0.0', '"openPL":0.0', '"totalPL":0.0')
    second = F.when(k % 9 == 4, F.lit('"n/a"')).otherwise(zero)
    listed = F.when(k % 13 == 0, F.lit("")).otherwise(F.concat_ws(",", first, second))
    return c.select(code.alias("account_id"), _text('{"metrics":[', listed, "]}").alias("body"))


def position_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    side = F.when(k % 2 == 0, '"side":"BUY"').otherwise('"side":"SELL"')

    def position(i: int) -> Column:
        return F.when(
            k % 4 >= i,
            _fields(
                _text('"positionCode":"', k, f'-{i}"'),
                _text('"symbol":"S', (k + i) % 12, '"'),
                _text('"quantity":', F.col("o_totalprice") / i),
                side,
            ),
        )

    odd = F.when(k % 22 == 5, _text('7,{"positionCode":"', k, '-x","quantity":"abc"}'))
    listed = F.concat_ws(",", position(1), position(2), position(3), odd)
    body = F.when(k % 26 == 3, _text('{"positions":{"positionCode":"', k, '"}}')).otherwise(_text('{"positions":[', listed, "]}"))
    return o.select(_text("A", F.col("o_custkey")).alias("account_id"), body.alias("body"))


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    k, line = F.col("l_orderkey"), F.col("l_linenumber")

    def order(i: int) -> Column:
        return F.when(
            line % 3 >= i,
            _fields(
                _text('"orderCode":"', k, ":", line, f':{i}"'),
                _text('"symbol":"S', (F.col("l_partkey") + i) % 12, '"'),
                _text('"quantity":', F.col("l_quantity") * i),
                '"type":"LIMIT"',
            ),
        )

    listed = F.concat_ws(",", order(1), order(2), F.when(k % 18 == 4, F.lit("null")))
    body = F.when(F.coalesce(k % 27 != 5, F.lit(True)), _text('{"orders":[', listed, "]}"))
    return li.select(_text("A", F.col("l_suppkey")).alias("account_id"), body.alias("body"))


def profile_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    nation = F.col("c_nationkey")

    def listed(value: Column) -> Column:
        return F.coalesce(_text('["', value, '"]'), F.lit("[null]"))

    country = F.when((k % 8 == 3) & nation.isNotNull(), _text('"N', nation, '"')).otherwise(listed(_text("N", nation)))
    attributes = _fields(
        _text('"country":', country),
        F.when(k % 3 != 0, _text('"phoneNumber":', listed(_text("+1-", k)))),
        _text('"language":', listed(_text("L", nation % 5))),
    )
    user = _fields(
        _text('"username":"', F.col("c_name"), '"'),
        _text('"email":"', F.lower(F.regexp_replace("c_name", "#", ".")), '@example.com"'),
        '"status":"ACTIVE"',
        F.when(k % 15 == 4, F.lit('"attributes":["x"]')).otherwise(_text('"attributes":', attributes)),
    )
    body = _text("[", F.concat_ws(",", user, F.when(k % 16 == 1, F.lit("3"))), "]")
    return c.select(F.col("c_name").alias("user_id"), body.alias("body"))
