"""Nested JSON account payloads flattened into tables (U10-U15).

Payloads arrive as a table of JSON documents (``body`` text column), one per
API response.  No row leaves the JVM.  Per-account category pivots are computed
inside the row with higher-order functions over the account's own
``categories``, so they need no shuffle at all, and a category repeated within an
account is joined with a space in its listed order.

Documents are read element by element: a list becomes the texts of its elements, and
each element is parsed by itself, so one that is no object costs no other.  Named
fields become (typed) columns; all others, as well as named values that don't have the
field's type, go to a map column, nested ones as JSON text.  What no row can show (a
document that is no JSON, a list that is none, an element that is no object) and every
value that was not of its column's kind has a row in ``payload_errors``.  Numbers inside
map columns keep 17 digits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Category names turned into columns, in column order.
ACCOUNT_CATEGORIES = ("NATION", "SEGMENT")
# Profile attribute keys turned into columns.
PROFILE_ATTRIBUTES = ("country", "phoneNumber")
# Named fields with their types; every other field goes to the map ``other``.
ACCOUNT_FIELDS = ("accountCode", "clearingCode", "currency")
PROFILE_FIELDS = ("username", "email")
METRICS_FIELDS = {"account": "string", "equity": "double", "balance": "double", "openPL": "double", "totalPL": "double"}
POSITION_FIELDS = {"positionCode": "string", "symbol": "string", "quantity": "double"}
ORDER_FIELDS = {"orderCode": "string", "symbol": "string", "quantity": "double"}

_OBJECT = "map<string,string>"  # nested values stay JSON text
_LIST = "array<string>"  # elements stay JSON text
_ERRORS = "array<struct<path:string,problem:string,value:string>>"


def _object(text: Column) -> Column:
    """The fields of a JSON object, null if ``text`` is none."""
    return F.from_json(text, _OBJECT)


def _list(text: Column) -> Column:
    """The elements of a JSON list, null if ``text`` is none."""
    return F.from_json(text, _LIST)


def _get(obj: Column, name: str) -> Column:
    return F.try_element_at(obj, F.lit(name))


def _value(obj: Column, name: str, kind: str = "string") -> Column:
    raw = _get(obj, name)
    return (raw if kind == "string" else raw.try_cast(kind)).alias(name)


def _misfit(value: Column, kind: str) -> Column:
    return value.isNotNull() & value.try_cast(kind).isNull()


def _other(obj: Column, fields: Mapping[str, str], shown: Column | None = None, name: str = "") -> Column:
    """The entries of ``obj`` that no column shows: unnamed ones, and named ones
    whose text doesn't have the column's type.  The field ``name`` is left out where
    ``shown`` holds."""

    def hidden(key: Column, value: Column) -> Column:
        out = ~key.isin(list(fields))
        if shown is not None:
            out = out & ~((key == name) & shown)
        for f, kind in fields.items():
            if kind != "string":
                out = out | ((key == f) & _misfit(value, kind))
        return out

    return F.map_filter(obj, hidden).alias("other")


def unparseable(payloads: DataFrame, body_col: str = "body") -> DataFrame:
    """The rows whose document is null or no JSON, as they are: no other
    operator has rows for them."""
    return payloads.where(F.try_parse_json(F.col(body_col)).isNull())


def _elements(payloads: DataFrame, field: str, body_col: str, *keep: Column) -> DataFrame:
    """``keep`` and, as ``e``, the fields of each element of the list ``field`` that is
    an object."""
    items = F.from_json(body_col, f"struct<{field}:{_LIST}>")[field]
    return payloads.select(*keep, F.explode(items).alias("e")).select("*", _object(F.col("e")).alias("o")).where("o is not null").drop("e")


def _joined(entries: Column, key: Column | str) -> Column:
    """The values of the ``(key, value)`` entries with this key, joined by a space; null
    without any."""
    picked = F.filter(entries, lambda e: e["key"] == key)
    return F.when(F.size(picked) > 0, F.array_join(F.transform(picked, lambda e: e["value"]), " "))


def _joined_map(entries: Column, skip: Sequence[str] = ()) -> Column:
    names = F.array_distinct(F.filter(F.transform(entries, lambda e: e["key"]), lambda n: n.isNotNull() & ~n.isin(list(skip))))
    out = F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), _joined(entries, n).alias("value"))))
    return F.coalesce(out, F.create_map().cast(_OBJECT))


def _categories(account: Column) -> Column:
    """The categories of an account that are objects, as maps."""
    return F.filter(F.transform(_list(_get(account, "categories")), _object), lambda c: c.isNotNull())


def account_categories(
    clients: DataFrame,
    clearing_code: str = "LIVE",
    categories: Sequence[str] = ACCOUNT_CATEGORIES,
    body_col: str = "body",
    user_col: str = "user_id",
    account_fields: Sequence[str] = ACCOUNT_FIELDS,
) -> DataFrame:
    """One row per account with the given clearing code: account fields, one
    column per category (values of a repeated category joined by a space, null when
    absent), ``user_id``, the map ``other_categories`` (all others, joined alike), the
    map ``category_fields`` (what a category says besides its value, as
    ``CATEGORY.field``, joined alike) and the map ``other`` of further account fields.
    Any JSON value is kept as its text.  A client without a list of ``accounts`` yields no
    rows.  Categories are matched to their own account, never by position in a
    filtered list.
    """
    acc = _elements(clients, "accounts", body_col, F.col(user_col).alias("user_id")).withColumnRenamed("o", "a")
    acc = acc.where(_get(F.col("a"), "clearingCode") == clearing_code)
    acc = acc.select("user_id", "a", _categories(F.col("a")).alias("c"))
    values = F.transform("c", lambda c: F.struct(_get(c, "category").alias("key"), _get(c, "value").alias("value")))

    def details(c: Column) -> Column:
        rest = F.map_entries(F.map_filter(c, lambda k, _: ~k.isin("category", "value")))
        prefix = F.coalesce(_get(c, "category"), F.lit(""))
        return F.transform(rest, lambda e: F.struct(F.concat_ws(".", prefix, e["key"]).alias("key"), e["value"].alias("value")))

    acc = acc.select("user_id", "a", values.alias("l"), F.flatten(F.transform("c", details)).alias("d"), F.col("c").isNotNull().alias("listed"))
    return acc.select(
        *[_value(F.col("a"), f) for f in account_fields],
        *[_joined(F.col("l"), F.lit(c)).alias(c) for c in categories],
        "user_id",
        _joined_map(F.col("l"), categories).alias("other_categories"),
        _joined_map(F.col("d")).alias("category_fields"),
        _other(F.col("a"), dict.fromkeys(account_fields, "string"), F.col("listed"), "categories"),
    )


def account_categories_wide(
    clients: DataFrame, most: int = 200, clearing_code: str = "LIVE", body_col: str = "body", user_col: str = "user_id"
) -> DataFrame:
    """``account_categories`` with one column for every category that any account of the
    clearing code has, in alphabetical order: a first pass finds the names.  More than
    ``most`` of them raise ``ValueError``, as that many columns are rather values; a name
    that an account field or map column has already gets ``category_`` in front.  Results
    of several batches go together by ``union_wide``."""
    acc = _elements(clients, "accounts", body_col).where(_get(F.col("o"), "clearingCode") == clearing_code)
    names = acc.select(F.explode(F.transform(_categories(F.col("o")), lambda c: _get(c, "category"))).alias("n"))
    found = sorted(r["n"] for r in names.where("n is not null").distinct().limit(most + 1).collect())  # at most most + 1 names
    if len(found) > most:
        raise ValueError(f"more than {most} categories; name those that should be columns")
    rows = account_categories(clients, clearing_code, (), body_col, user_col)
    taken = {c.lower() for c in rows.columns}
    columns, used = [], set(taken)
    for n in found:
        name = n
        while name.lower() in used:
            name = f"category_{name}"
        used.add(name.lower())
        columns.append(_get(F.col("other_categories"), n).alias(name))
    return rows.select(*ACCOUNT_FIELDS, *columns, "user_id", "category_fields", "other")


def union_wide(*batches: DataFrame) -> DataFrame:
    """All rows of all batches, columns by name; a column that a batch lacks is null."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def account_metrics(payloads: DataFrame, body_col: str = "body", key_col: str = "account_id") -> DataFrame:
    """``account_id`` (the document's key), the metrics fields and the map ``other``
    from the first element of ``metrics``; all but the key null when the list is
    empty or its first element is no object."""
    first = F.try_element_at(F.from_json(body_col, f"struct<metrics:{_LIST}>")["metrics"], F.lit(1))
    rows = payloads.select(F.col(key_col).alias("account_id"), _object(first).alias("m"))
    return rows.select("account_id", *[_value(F.col("m"), f, k) for f, k in METRICS_FIELDS.items()], _other(F.col("m"), METRICS_FIELDS))


def _explode_list(payloads: DataFrame, field: str, fields: Mapping[str, str], key_col: str, body_col: str) -> DataFrame:
    rows = _elements(payloads, field, body_col, F.col(key_col))
    return rows.select(key_col, *[_value(F.col("o"), f, k) for f, k in fields.items()], _other(F.col("o"), fields))


def payload_positions(
    payloads: DataFrame, key_col: str = "account_id", body_col: str = "body", fields: Mapping[str, str] = POSITION_FIELDS
) -> DataFrame:
    """One row per element of ``positions`` that is an object: named ``fields`` and the
    map ``other``; an empty list gives no rows."""
    return _explode_list(payloads, "positions", fields, key_col, body_col)


def payload_orders(
    payloads: DataFrame, key_col: str = "account_id", body_col: str = "body", fields: Mapping[str, str] = ORDER_FIELDS
) -> DataFrame:
    """One row per pending order (element of ``orders``), columns alike."""
    return _explode_list(payloads, "orders", fields, key_col, body_col)


def profile_attributes(
    payloads: DataFrame,
    attributes: Sequence[str] = PROFILE_ATTRIBUTES,
    body_col: str = "body",
    fields: Sequence[str] = PROFILE_FIELDS,
) -> DataFrame:
    """Profile ``fields``, one list-valued column per attribute key (null when the
    profile lacks it; a value that is no list is a list of one), the map
    ``other_attributes`` of all other lists, and the map ``other`` of further fields.
    Every profile of every document is kept."""
    users = payloads.select(F.explode(_list(F.col(body_col))).alias("e")).select(_object(F.col("e")).alias("u")).where("u is not null")
    users = users.select("u", _object(_get(F.col("u"), "attributes")).alias("m"))
    lists = F.transform_values("m", lambda _, v: F.coalesce(_list(v), F.when(v.isNotNull(), F.array(v))))
    users = users.select("u", F.coalesce(lists, F.create_map().cast("map<string,array<string>>")).alias("l"), F.col("m").isNotNull().alias("listed"))
    return users.select(
        *[_value(F.col("u"), f) for f in fields],
        *[F.try_element_at("l", F.lit(a)).alias(a) for a in attributes],
        F.map_filter("l", lambda k, v: ~k.isin(list(attributes))).alias("other_attributes"),
        _other(F.col("u"), dict.fromkeys(fields, "string"), F.col("listed"), "attributes"),
    )


# ---- misfits -----------------------------------------------------------------------


def _error(path: Column, problem: str, value: Column) -> Column:
    return F.struct(path.alias("path"), F.lit(problem).alias("problem"), value.alias("value"))


def _errors(*found: Column) -> Column:
    """Structs, null where there is nothing to say, as one array."""
    return F.array_compact(F.array(*found)).cast(_ERRORS)


def _each(parsed: Column, path: Column, inner) -> Column:
    """``inner(fields, path)`` of every element ``(text, fields)`` that is an object, and an
    error for every other one."""

    def one(e: Column, i: Column) -> Column:
        at = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        broken = _errors(_error(at, "not an object", e["text"]))
        return F.when(e["fields"].isNull(), broken).otherwise(inner(e["fields"], at))

    return F.coalesce(F.flatten(F.transform(parsed, one)), F.array().cast(_ERRORS))


def _parsed(items: Column) -> Column:
    return F.transform(items, lambda e: F.struct(e.alias("text"), _object(e).alias("fields")))


def _typed_errors(fields: Mapping[str, str]):
    def inner(obj: Column, at: Column) -> Column:
        return _errors(
            *[
                F.when(_misfit(_get(obj, f), kind), _error(F.concat(at, F.lit(f".{f}")), f"not a {kind}", _get(obj, f)))
                for f, kind in fields.items()
                if kind != "string"
            ]
        )

    return inner


def _account_errors(obj: Column, at: Column) -> Column:
    raw, path = _get(obj, "categories"), F.concat(at, F.lit(".categories"))

    def category(c: Column, here: Column) -> Column:
        return _errors(F.when(_get(c, "category").isNull(), _error(here, "no category", F.to_json(c))))

    return F.concat(
        _errors(F.when(raw.isNotNull() & _list(raw).isNull(), _error(path, "not a list", raw))),
        _each(_parsed(_list(raw)), path, category),
    )


def _profile_errors(obj: Column, at: Column) -> Column:
    raw, path = _get(obj, "attributes"), F.concat(at, F.lit(".attributes"))
    scalars = F.map_entries(F.map_filter(_object(raw), lambda _, v: v.isNotNull() & _list(v).isNull()))
    return F.concat(
        _errors(F.when(raw.isNotNull() & _object(raw).isNull(), _error(path, "not an object", raw))),
        F.coalesce(F.transform(scalars, lambda e: _error(F.concat(path, F.lit("."), e["key"]), "not a list", e["value"])), F.array().cast(_ERRORS)),
    )


# Per kind of document: the field that holds its list (none: the document is the list)
# and what may be wrong with an element.
DOCUMENT_KINDS = {
    "client": ("accounts", _account_errors),
    "metrics": ("metrics", _typed_errors(METRICS_FIELDS)),
    "positions": ("positions", _typed_errors(POSITION_FIELDS)),
    "orders": ("orders", _typed_errors(ORDER_FIELDS)),
    "profiles": (None, _profile_errors),
}


def payload_errors(payloads: DataFrame, kind: str, key_col: str, body_col: str = "body") -> DataFrame:
    """``(kind, key, path, problem, value)``: a row for everything in the documents of a
    kind (``DOCUMENT_KINDS``) that is not as its operator reads it.

    ``path`` names the place (``$.positions[3].quantity``), ``value`` the text that stands
    there.  A missing or JSON-null list is no error, it has no elements.  One projection
    and one explode: no shuffle, and a document's errors are as many as its values at
    most.
    """
    field, inner = DOCUMENT_KINDS[kind]
    body, root = F.col(body_col), F.lit("$")
    whole = _list(body) if field is None else _list(_get(_object(body), field))
    rows = payloads.select(F.col(key_col).cast("string").alias("key"), body.alias("body"), F.try_parse_json(body).isNotNull().alias("json"), whole.alias("items"))
    if field is None:
        path, misshaped = root, F.when(F.col("json") & F.col("items").isNull(), _error(root, "not a list", F.col("body")))
    else:
        path, raw = F.lit(f"$.{field}"), _get(_object(F.col("body")), field)
        misshaped = F.when(F.col("json") & _object(F.col("body")).isNull(), _error(root, "not an object", F.col("body"))).when(
            F.col("json") & raw.isNotNull() & F.col("items").isNull(), _error(path, "not a list", raw)
        )
    first = _errors(F.when(~F.col("json"), _error(root, "no JSON", F.col("body"))), misshaped)
    rows = rows.select("key", F.when(F.col("json"), F.concat(first, _each(_parsed(F.col("items")), path, inner))).otherwise(first).alias("errors"))
    # Not ``inline``: Spark infers a filter on the array's size from it and pushes that below
    # the projections, where every document is parsed again, many times over.
    found = rows.select(F.lit(kind).alias("kind"), "key", F.inline_outer("errors"))
    return found.where("problem is not null")


def maps_as_json(df: DataFrame) -> DataFrame:
    """Map columns as JSON text, for comparison with other engines."""
    return df.select(*[F.to_json(c).alias(c) if t.startswith("map") else F.col(c) for c, t in df.dtypes])
