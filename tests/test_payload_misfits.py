"""One misfit costs no other value, and every misfit has an error row."""

import pytest

from ledgerlens.operators import payloads as P


def docs(spark, *bodies, key="account_id"):
    return spark.createDataFrame([(f"k{i}", b) for i, b in enumerate(bodies)], f"{key} string, body string")


def errors(df, kind, key="account_id"):
    return sorted(tuple(r)[1:] for r in P.payload_errors(df, kind, key).collect())


def test_elements_that_are_no_objects(spark):
    df = docs(spark, '{"positions":[{"positionCode":"p","quantity":"abc"},5,null,"s",[1],{"positionCode":"q","quantity":2}]}')
    assert [tuple(r) for r in P.payload_positions(df).collect()] == [("k0", "p", None, None, {"quantity": "abc"}), ("k0", "q", None, 2.0, {})]
    assert errors(df, "positions") == [
        ("k0", "$.positions[0].quantity", "not a double", "abc"),
        ("k0", "$.positions[1]", "not an object", "5"),
        ("k0", "$.positions[2]", "not an object", None),
        ("k0", "$.positions[3]", "not an object", "s"),
        ("k0", "$.positions[4]", "not an object", "[1]"),
    ]


@pytest.mark.parametrize("kind, field", [("client", "accounts"), ("metrics", "metrics"), ("positions", "positions"), ("orders", "orders")])
def test_documents_without_a_list(spark, kind, field):
    df = docs(spark, None, "", "{", "[]", "7", "{}", f'{{"{field}":null}}', f'{{"{field}":[]}}', f'{{"{field}":{{"a":1}}}}', f'{{"{field}":"x"}}')
    assert errors(df, kind) == [
        ("k0", "$", "no JSON", None), ("k1", "$", "no JSON", ""), ("k2", "$", "no JSON", "{"),
        ("k3", "$", "not an object", "[]"), ("k4", "$", "not an object", "7"),
        ("k8", f"$.{field}", "not a list", '{"a":1}'), ("k9", f"$.{field}", "not a list", "x"),
    ]


def test_first_metrics_element_survives_a_bad_second(spark):
    df = docs(spark, '{"metrics":[{"account":"A","equity":1.5},"n/a"]}', '{"metrics":["n/a",{"account":"B"}]}')
    got = {r.account_id: (r.account, r.equity) for r in P.account_metrics(df).collect()}
    assert got == {"k0": ("A", 1.5), "k1": (None, None)}
    assert errors(df, "metrics") == [("k0", "$.metrics[1]", "not an object", "n/a"), ("k1", "$.metrics[0]", "not an object", "n/a")]


def test_accounts_and_categories(spark):
    body = (
        '{"accounts":[3,{"accountCode":"A","clearingCode":"LIVE","categories":["VIP",{"category":"TIER","value":"1","since":"2020"},'
        '{"value":"lost?"},{"category":"TIER","value":"2","since":"2021","by":{"x":1}}]},'
        '{"accountCode":"B","clearingCode":"LIVE","categories":{"category":"TIER"}}]}'
    )
    df = docs(spark, body, key="user_id")
    a, b = sorted(P.account_categories(df).collect(), key=lambda r: r.accountCode)
    assert (a.other_categories, a.category_fields, a.other) == ({"TIER": "1 2"}, {"TIER.since": "2020 2021", "TIER.by": '{"x":1}'}, {})
    assert (b.other_categories, b.category_fields, b.other) == ({}, {}, {"categories": '{"category":"TIER"}'})
    assert errors(df, "client", "user_id") == [
        ("k0", "$.accounts[0]", "not an object", "3"),
        ("k0", "$.accounts[1].categories[0]", "not an object", "VIP"),
        ("k0", "$.accounts[1].categories[2]", "no category", '{"value":"lost?"}'),
        ("k0", "$.accounts[2].categories", "not a list", '{"category":"TIER"}'),
    ]


def test_profiles(spark):
    df = docs(
        spark,
        '[{"username":"u","attributes":{"country":"DE","phoneNumber":["1"],"n":null,"pets":{"a":1}}},4]',
        '[{"username":"v","attributes":["x"]},{"username":"w"}]',
        '{"username":"x"}',
        key="user_id",
    )
    got = {r.username: r for r in P.profile_attributes(df).collect()}
    u, v, w = got["u"], got["v"], got["w"]
    assert (u.country, u.phoneNumber, u.other_attributes, u.other) == (["DE"], ["1"], {"n": None, "pets": ['{"a":1}']}, {})
    assert (v.country, v.other_attributes, v.other) == (None, {}, {"attributes": '["x"]'})
    assert (w.country, w.other) == (None, {})
    assert errors(df, "profiles", "user_id") == [
        ("k0", "$[0].attributes.country", "not a list", "DE"),
        ("k0", "$[0].attributes.pets", "not a list", '{"a":1}'),
        ("k0", "$[1]", "not an object", "4"),
        ("k1", "$[0].attributes", "not an object", '["x"]'),
        ("k2", "$", "not a list", '{"username":"x"}'),
    ]


def test_every_element_is_a_row_or_an_error(spark):
    """Over the fixture: rows and errors of a kind add up to the elements."""
    from pyspark.sql import functions as F

    from ledgerlens.sources import payloads as docs_
    from tests.conftest import SF_SMALL

    df = docs_.position_payloads(spark, SF_SMALL)
    elements = df.select(F.explode(F.from_json("body", "struct<positions:array<string>>")["positions"])).count()
    broken = P.payload_errors(df, "positions", "account_id").where("problem = 'not an object'").count()
    assert P.payload_positions(df).count() + broken == elements and broken > 0


def test_wide_categories(spark):
    def client(code, *categories):
        listed = ",".join(f'{{"category":"{c}","value":"{v}"}}' for c, v in categories)
        return f'{{"accounts":[{{"accountCode":"{code}","clearingCode":"LIVE","categories":[{listed}]}}]}}'

    first = docs(spark, client("A", ("TIER", 1), ("NEW", 2)), client("B", ("TIER", 3), ("TIER", 4), ("currency", "x")), key="user_id")
    wide = P.account_categories_wide(first)
    assert wide.columns == ["accountCode", "clearingCode", "currency", "NEW", "TIER", "category_currency", "user_id", "category_fields", "other"]
    assert sorted((r.accountCode, r.NEW, r.TIER, r.category_currency) for r in wide.collect()) == [("A", "2", "1", None), ("B", None, "3 4", "x")]
    second = P.account_categories_wide(docs(spark, client("C", ("ZONE", 9)), key="user_id"))
    both = P.union_wide(wide, second)
    assert sorted((r.accountCode, r.TIER, r.ZONE) for r in both.collect()) == [("A", "1", None), ("B", "3 4", None), ("C", None, "9")]
    with pytest.raises(ValueError, match="more than 2"):
        P.account_categories_wide(first, most=2)
    assert P.account_categories_wide(docs(spark, "{}", key="user_id")).count() == 0


@pytest.mark.parametrize("kind", P.DOCUMENT_KINDS)
def test_no_filter_parses_the_documents_again(spark, kind):
    from ledgerlens.plans.inspect import physical_plan

    before = spark.conf.get("spark.sql.maxPlanStringLength")
    spark.conf.set("spark.sql.maxPlanStringLength", str(10**6))
    plan = physical_plan(P.payload_errors(docs(spark, '[{"a":1}]', "{}"), kind, "account_id"))
    spark.conf.set("spark.sql.maxPlanStringLength", before)
    assert plan.count("parseJson(") == 1 and plan.count("from_json") > 0
