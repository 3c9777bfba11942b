import random

from ledgerlens.llm.line_dedup import line_dedup


def plain(rows, width=3):
    """(id, text) in order of id to cleaned texts."""
    seen, out = set(), []
    for _, text in rows:
        lines = (text or "").split("\n")
        good = [i for i, l in enumerate(lines) if l.strip(" \t\n\x0b\x0c\r")]
        gone = set()
        for at in range(len(good) - width + 1):
            window = tuple(lines[i].strip(" ") for i in good[at : at + width])
            if window in seen:
                gone |= set(good[at : at + width])
            seen.add(window)
        out.append(text if not gone else "\n".join(l for i, l in enumerate(lines) if i not in gone))
    return out


def test_random_texts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        n = rng.choice([0, 1, 2, 3, 8, 30])
        rows.append((i, "\n".join(rng.choice(["", " ", "a", "b ", " b", "c", f"u{rng.random()}"]) for _ in range(n))))
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == plain(rows)


def test_shared_passage(spark):
    """The first occurrence of a passage stays; later ones go, also merged and within
    one text."""
    passage = "\n".join(f"line {k} of a passage that repeats" for k in range(5))
    rows = [(1, f"first\n{passage}\nend"), (2, f"{passage}\nmore"), (3, f"x\n{passage}\n{passage}"), (4, passage)]
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "more", 3: "x", 4: ""}


def test_hot_window(spark):
    df = spark.range(3000).selectExpr("id doc_id", "concat('own ', id, '\n', 'a\nb\nc', if(id % 3 = 0, '', '\nd')) text")
    got = {r.doc_id: r.text for r in line_dedup(df).collect()}
    assert got[0] == "own 0\na\nb\nc" and got[1] == "own 1\nd" and got[3] == "own 3" and got[2999] == "own 2999"


def test_odd_rows(odd, empty):
    out = line_dedup(odd)
    assert out.columns == [*odd.columns, "_lines", "_removed"]
    rows = out.collect()
    texts = sorted((r.doc_id or 0, r.text is None, r.text or "") for r in rows)
    assert len(rows) == odd.count()
    assert [t for i, _, t in texts if i == 6] == [""]  # later copy of document 1
    assert [t[:3] for i, _, t in texts if i == 1] == ["a b", "a b", "ano"]  # equal rows alike
    assert [(n, t) for i, n, t in texts if i in (2, 3, 4)] == [(True, ""), (False, ""), (False, " \t\n \n")]
    assert line_dedup(empty).collect() == []
