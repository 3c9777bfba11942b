import re
from collections import Counter

from ledgerlens.llm.quality_rules import BASE, FULL, MEASURES, RULES, Policy, ablations, ledger, measure, passes


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + d for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines = [l for l in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(c.isupper() for c in text),
        len(lines), len(lines) - len(set(lines)), len(covered),
    )


def test_documents(documents):
    text = {r.doc_id: r.text for r in documents.collect()}
    for r in measure(documents).collect():
        assert tuple(r[m] for m in MEASURES) == plain(text[r.doc_id]), r.doc_id


def test_odd_rows(odd, odder):
    rows = ledger(odder).collect()
    assert len(rows) == odd.count()
    want = Counter((r.doc_id, *plain(r.text)) for r in odd.collect())
    assert Counter((r.doc_id, *(r[m] for m in MEASURES)) for r in rows) == want


def test_repeats(spark):
    texts = ["a a a a", "a b c a b c", "a b c x a b c", "a b", "a b a b a", "x\n\nx\n \ny", "\x0b a\x0cb\r"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in measure(df).collect():
        assert tuple(r[m] for m in MEASURES) == plain(texts[r.doc_id])


def test_policies_and_ablations(documents, empty):
    entries = ledger(documents).cache()
    rows = entries.collect()
    for policy in (BASE, FULL, Policy("symbols only", 2, ("symbols",))):
        kept = {r.doc_id for r in entries.where(passes(policy)).collect()}
        assert kept == {r.doc_id for r in rows if not r.failed & policy.mask}
        for a in ablations(entries, policy).collect():
            bit = 1 << list(RULES).index(a.rule)
            assert a.n_failed == sum(bool(r.failed & bit) for r in rows)
            assert a.n_only == sum(r.failed & policy.mask == bit for r in rows)
            assert a.kept_without == sum(not r.failed & policy.mask & ~bit for r in rows)
    assert ledger(empty).collect() == []
    assert ablations(ledger(empty), FULL).collect() == []


def test_no_python_in_the_plan(documents):
    plan = ledger(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_labels(spark):
    """Low-quality documents fail, the others stay unless too short or repetitive."""
    sf = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = ledger(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert all(r.failed for r in rows if marks.get(r.doc_id) == 0)
    assert all(not r.failed & ~BASE.mask for r in rows if marks.get(r.doc_id) == 1)
