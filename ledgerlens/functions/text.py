"""String helpers that keep SQL semantics the operators depend on."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_chars(col: Column, chars: str) -> Column:
    """``trim(BOTH chars FROM col)``: strips any of the *characters* from both ends."""
    return F.trim(col, F.lit(chars))


def rtrim_chars(col: Column, chars: str) -> Column:
    """``trim(TRAILING chars FROM col)``."""
    return F.rtrim(col, F.lit(chars))


def similar_to_regex(alternatives: Iterable[str]) -> str:
    """Java regex for ``SIMILAR TO '%(a|b|...)%'``.

    ``_`` is one arbitrary character (newlines included) and ``%`` any run of
    characters; everything else is literal.  The result is meant for
    ``rlike``, which finds a match anywhere, so the outer ``%`` are implied.
    """
    parts = []
    for alt in alternatives:
        out = []
        for ch in alt:
            if ch == "_":
                out.append(".")
            elif ch == "%":
                out.append(".*")
            else:
                out.append(re.escape(ch))
        parts.append("".join(out))
    return "(?s)(" + "|".join(parts) + ")"


# Named classes inside a bracket expression.
_CLASSES = {
    "alpha": "A-Za-z", "digit": "0-9", "alnum": "A-Za-z0-9", "upper": "A-Z", "lower": "a-z", "space": r" \t\n\r\f\x0B", "blank": r" \t",
    "xdigit": "0-9A-Fa-f", "punct": r"!-/:-@\[-`{-~",
}


def similar_to_pattern(pattern: str, escape: str = "\\") -> str:
    """The regex of an SQL ``SIMILAR TO`` pattern, read alike by Java and RE2.

    It matches whole strings.  ``%`` is any run of characters and ``_`` any one, newlines
    included; ``|``, ``( )``, ``*``, ``+``, ``?``, ``{m}``, ``{m,}``, ``{m,n}`` and bracket
    expressions with ranges, ``^`` and ``[:class:]`` have their SQL meaning; everything
    else, the dot too, stands for itself, as does any character after ``escape`` (an empty
    ``escape`` switches it off).  A pattern that is not well formed raises ``ValueError``.
    """
    if len(escape) > 1:
        raise ValueError("escape is one character or empty")
    out, depth, i = [], 0, 0
    repeatable = False  # whether something stands here that a quantifier may repeat

    def literal(c: str) -> str:
        return re.escape(c) if c.isascii() else c

    while i < len(pattern):
        c = pattern[i]
        if escape and c == escape:
            if i + 1 == len(pattern):
                raise ValueError(f"nothing after the escape at the end of {pattern!r}")
            out.append(literal(pattern[i + 1]))
            i, repeatable = i + 2, True
            continue
        if c == "[":
            text, i = _bracket(pattern, i, escape)
            out.append(text)
            repeatable = True
            continue
        if c in "*+?{":
            if not repeatable:
                raise ValueError(f"nothing to repeat at {i} in {pattern!r}")
            if c == "{":
                m = re.compile(r"\{(\d+)(?:,(\d*))?\}").match(pattern, i)
                if not m or (m[2] and int(m[2]) < int(m[1])):
                    raise ValueError(f"no repetition at {i} in {pattern!r}")
                c = m[0]
            out.append(c)
            i, repeatable = i + len(c), False
            continue
        if c == "(":
            depth += 1
            out.append("(?:")
        elif c == ")":
            depth -= 1
            if depth < 0:
                raise ValueError(f"a ) without ( in {pattern!r}")
            out.append(")")
        else:
            out.append({"%": "(?:.*)", "_": ".", "|": "|"}.get(c) or literal(c))
        repeatable = c not in "(|"
        i += 1
    if depth:
        raise ValueError(f"a ( without ) in {pattern!r}")
    return r"(?s)\A(?:" + "".join(out) + r")\z"


def _bracket(pattern: str, i: int, escape: str) -> tuple[str, int]:
    """The bracket expression at ``i`` as a regex class, and where it ends."""
    out, j = ["["], i + 1
    if pattern[j : j + 1] == "^":
        out.append("^")
        j += 1
    start = j
    while j < len(pattern) and (pattern[j] != "]" or j == start):
        if pattern.startswith("[:", j):
            end = pattern.find(":]", j)
            name = pattern[j + 2 : end]
            if end < 0 or name not in _CLASSES:
                raise ValueError(f"unknown class at {j} in {pattern!r}")
            out.append(_CLASSES[name])
            j = end + 2
            continue
        if escape and pattern[j] == escape and j + 1 < len(pattern):
            j += 1
            out.append("\\" + pattern[j] if not pattern[j].isalnum() and pattern[j].isascii() else pattern[j])
        else:
            # A hyphen makes a range; what Java or RE2 would read otherwise is escaped.
            out.append("\\" + pattern[j] if pattern[j] in "[]&^\\~" else pattern[j])
        j += 1
    if j >= len(pattern):
        raise ValueError(f"a [ without ] in {pattern!r}")
    return "".join(out) + "]", j + 1


def not_similar_to_or_null(col: Column, pattern: str, escape: str = "\\") -> Column:
    """``col NOT SIMILAR TO pattern ESCAPE escape OR col IS NULL``."""
    return col.isNull() | ~col.rlike(similar_to_pattern(pattern, escape))


def not_similar_or_null(col: Column, alternatives: Iterable[str]) -> Column:
    """``col NOT SIMILAR TO '%(...)%' OR col IS NULL``."""
    return col.isNull() | ~col.rlike(similar_to_regex(alternatives))


def text_after_slash(col: Column) -> Column:
    """Everything after the first ``/``; null when there is no ``/``."""
    return F.when(col.contains("/"), F.regexp_extract(col, r"/(.*)", 1))
