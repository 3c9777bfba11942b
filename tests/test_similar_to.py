import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.functions.text import similar_to_pattern

CASES = [
    # pattern, what it matches, what it does not
    ("abc", ["abc"], ["ab", "abcd", "xabc"]),
    ("a_c", ["abc", "a\nc", "a.c"], ["ac", "abbc"]),
    ("a%c", ["ac", "a\n\nc", "abbc"], ["acd"]),
    ("a.c", ["a.c"], ["abc"]),
    ("%(b|d)%", ["abc", "d", "xd"], ["ac", ""]),
    ("(ab|cd)*", ["", "ab", "abcdab"], ["a", "abc"]),
    ("ab+c?", ["ab", "abbb", "abbc"], ["a", "abcc"]),
    ("a{2}b{1,}c{0,2}", ["aab", "aabbcc"], ["ab", "aabccc", "aac"]),
    ("[a-cx]_", ["a1", "x\n"], ["d1", "a"]),
    ("[^a-c]", ["d", "-", "["], ["a", "dd"]),
    ("[]a]", ["]", "a"], ["b"]),
    ("[[:digit:]a&&b]+", ["1a", "&b"], ["c", ""]),
    (r"10\%|\_", ["10%", "_"], ["10x", "a"]),
    (r"\\", ["\\"], ["a", "\\\\"]),
    ("$^|\\#", ["$^", "#"], ["", "$"]),
    ("(a|)b", ["ab", "b"], ["a"]),
    ("", [""], ["a"]),
    ("a|b|", ["a", "b", ""], ["ab"]),
    ("ä_", ["äö"], ["ao"]),
]


@pytest.mark.parametrize("pattern, yes, no", CASES)
def test_both_engines_agree(spark, pattern, yes, no):
    regex = similar_to_pattern(pattern)
    rows = [(s,) for s in yes + no]
    got = {r.s: r.m for r in spark.createDataFrame(rows, "s string").selectExpr("s", "s rlike '" + regex.replace("\\", "\\\\").replace("'", "\\'") + "' AS m").collect()}
    con = duckdb.connect()
    want = {s: s in yes for s in yes + no}
    assert got == want
    assert {s: con.execute("SELECT regexp_matches(?, ?)", [s, regex]).fetchone()[0] for s in yes + no} == want


def test_another_escape():
    assert re.match(similar_to_pattern("a!%!!", "!").replace(r"\z", r"\Z"), "a%!")
    assert re.match(similar_to_pattern("a\\%", "").replace(r"\z", r"\Z"), "a\\xyz")


@pytest.mark.parametrize("pattern", ["(a", "a)", "[a", "*a", "a**", "(|*)", "a{2,1}", "a{x}", "a\\", "[[:nope:]]"])
def test_not_well_formed(pattern):
    with pytest.raises(ValueError):
        similar_to_pattern(pattern)


def matches(pattern: str, text: str) -> bool:
    """Without groups, classes and quantifiers: a plain LIKE, by recursion."""
    if not pattern:
        return not text
    if pattern[0] == "%":
        return any(matches(pattern[1:], text[i:]) for i in range(len(text) + 1))
    return bool(text) and pattern[0] in ("_", text[0]) and matches(pattern[1:], text[1:])


@settings(max_examples=300, deadline=None)
@given(st.text("ab.%_^$ \n-&~#'", max_size=6), st.text("ab.^$ \n-&~#'", max_size=6))
def test_like_patterns(pattern, text):
    assert bool(re.match(similar_to_pattern(pattern).replace(r"\z", r"\Z"), text)) == matches(pattern, text)
