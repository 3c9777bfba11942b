import re

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens.llm import queries as Q
from tools_compare import digest

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = E.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op") and n in Q.queries()} == set(range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert digest(Q.queries()[name](spark, SF).toPandas()) == digest(con.execute(Q.oracle_sql()[name]).df())


CONTRACT = {
    "op2_shards": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op4_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op10_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_site_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint", "n_blocks": "bigint", "n_template": "bigint"},
    "op12_va_clusters": {
        "vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string",
    },
    "op13_hard_negatives": {
        "anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint",
    },
    "op5_packing": {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint",
    },
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns(spark, name):
    assert dict(Q.queries()[name](spark, SF).dtypes) == CONTRACT[name]
