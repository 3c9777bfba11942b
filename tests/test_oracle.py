"""Every registered query equals its DuckDB SQL on the smallest scale."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools_compare import digest

# The corpus operators have tests of their own.
CORPUS = {*E.corpus.queries(), "pipeline"} if E.corpus else set()
NAMES = sorted(set(E.queries()) - CORPUS)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sql = E.oracle_sql()
    assert name in sql, f"{name} has no oracle SQL"
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(sql[name]).df()
    assert digest(got) == digest(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["transaction_time", "ADJUSTMENT", "DEPOSIT", "FINANCING", "WITHDRAWAL"]


def test_oracle_keys_match_queries():
    assert set(E.oracle_sql()) - CORPUS == set(NAMES) and set(E.oracle_sql()) <= set(E.queries())


SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "array<string>": "VARCHAR[]",
}


@pytest.mark.parametrize("name", NAMES)
def test_query_types_match_oracle(spark, duck, name):
    spark_types = {f.name: f.dataType.simpleString() for f in E.queries()[name](spark, SF_SMALL).schema.fields}
    duck_types = {r[0]: r[1] for r in duck.execute("DESCRIBE " + E.oracle_sql()[name]).fetchall()}
    assert set(spark_types) == set(duck_types)
    for col, st in spark_types.items():
        want = st.upper() if st.startswith("decimal") else SPARK_TO_DUCKDB[st]
        assert duck_types[col] == want, (col, st, duck_types[col])
