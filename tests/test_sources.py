"""Sources: view derivation, JSON documents, JDBC options, day calendar."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens.functions.dates import day_series, on_days
from ledgerlens.operators import cash, payloads, trades
from ledgerlens.sources.files import read_payload_files, read_payload_lines
from ledgerlens.sources.fixtures import SCHEMAS, TABLE_NAMES, Tables, load_tables, oracle_with, view_select
from ledgerlens.sources.jdbc import jdbc_options
from tests.conftest import SF_SMALL


def test_views_have_declared_schemas(spark):
    t = load_tables(spark, SF_SMALL)
    for name in TABLE_NAMES:
        got = getattr(t, name).schema
        want = spark.createDataFrame([], SCHEMAS[name]).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in want], name


def test_views_equal_duckdb(spark, duck):
    t = load_tables(spark, SF_SMALL)
    for view in ("accounts", "ord", "positions", "quotes_history"):
        name = "orders" if view == "ord" else view
        a = getattr(t, name).count()
        b = duck.execute(oracle_with(view) + f"SELECT count(*) FROM {view}").fetchone()[0]
        assert a == b
    assert "{ts}" not in view_select("principals", "TIMESTAMP")


def test_tables_require_every_table(spark):
    with pytest.raises(TypeError):
        Tables(principals=spark.range(1))


def test_payload_files_one_document_per_file(spark):
    d = tempfile.mkdtemp(prefix="ledgerlens-docs-")
    docs = {
        "u1.json": {"accounts": [{"accountCode": "L1", "clearingCode": "LIVE",
                                  "categories": [{"category": "NATION", "value": "7"}]}]},
        "u2.json": {"clientId": 2},
    }
    for name, body in docs.items():
        with open(os.path.join(d, name), "w") as fh:
            json.dump(body, fh, indent=2)
    src = read_payload_files(spark, d).withColumn("user_id", F.regexp_extract("key", r"(u\d)\.json$", 1))
    got = [tuple(r) for r in payloads.account_categories(src).select("accountCode", "NATION", "user_id").collect()]
    assert got == [("L1", "7", "u1")]

    lines = os.path.join(d, "lines")
    os.makedirs(lines)
    with open(os.path.join(lines, "part.jsonl"), "w") as fh:
        fh.write('{"positions": [{"positionCode": "a"}]}\n{"positions": []}\n')
    pos = payloads.payload_positions(read_payload_lines(spark, lines, key_col="account_id"))
    assert [r["positionCode"] for r in pos.collect()] == ["a"]


def test_jdbc_options():
    o = jdbc_options(url="jdbc:postgresql://db/x", table="s.t", user="u", password="p",
                     partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "4" and o["dbtable"] == "s.t"
    assert "partitionColumn" not in jdbc_options(url="jdbc:x", table="t")
    with pytest.raises(ValueError):
        jdbc_options(url="jdbc:x", table="t", partition_column="id")


def test_day_series(spark):
    days = [r[0] for r in day_series(spark, dt.date(2024, 2, 27), dt.date(2024, 3, 1)).collect()]
    assert days == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]


def test_on_days_is_date_between(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0),), (dt.datetime(2024, 1, 2, 23, 59, 59),), (dt.datetime(2024, 1, 3),)],
        "ts timestamp_ntz",
    )
    got = df.where(on_days(F.col("ts"), dt.date(2024, 1, 1), dt.date(2024, 1, 2))).count()
    assert got == 2


def test_ordered_variants_sort(spark):
    t = E._tables(spark, SF_SMALL)
    blotter = [r["trade_time"] for r in trades.trade_blotter(t, E.TEST_SCOPE, ordered=True).collect()]
    assert blotter == sorted(blotter)
    moves = [r["date_time"] for r in cash.cash_movements(t, E.TEST_SCOPE, ordered=True).collect()]
    assert moves == sorted(moves, reverse=True)
