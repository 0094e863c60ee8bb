import collections
import re

from hilvan.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    n = len(w)
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {j for i in range(n - 2) if seen[(w[i], w[i + 1], w[i + 2])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside),
            n < 50 or 100 * len(inside) > 50 * n)


GOOD = " ".join(f"word{i} and{i * 7}" for i in range(60))
TEXTS = [
    GOOD, None, "", " \t\n\x0b\x0c\r ", "a b c a b c", "one\ntwo\none\n\n \none", "é ü " * 40, "x" * 5000,
    "the cat sat " * 60, GOOD + " ###" * 40, " | ".join(GOOD.split()), "\n".join([GOOD] * 3), "a b c",
    GOOD.upper().replace(" ", "!! "), GOOD, "a b c d " * 3000, "\ta  b\x0bc\n\nd ",
]


def test_counts_verdict_filter_and_plan(docs):
    table = docs(TEXTS)
    found = Q.quality_counts(table)
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(TEXTS[r.doc_id]), r.doc_id
    kept = {r.doc_id for r in rows if r.kept}
    assert {0, 14} <= kept
    assert not kept & {1, 2, 3, 4, 7, 8, 9, 10, 13}
    out = Q.keep_good(table)
    assert out.columns == table.columns
    assert {r.doc_id for r in out.collect()} == kept


def test_order_puts_rejection_per_cost_first_and_keeps_the_verdict(docs):
    from pyspark.sql import functions as F

    table = docs([GOOD + " ###" * 40] * 30 + [GOOD] * 10, clashes=False)
    order = Q.rule_order(table, Q.METHOD_RULES)
    assert order[0].name == "symbols"
    work = table.select("doc_id", F.col("text").alias("t"), Q.words(F.col("text")).alias("w"))
    one = {r.doc_id: r.alive for r in Q.cascade(work, order).select("doc_id", "alive").collect()}
    assert one == {i: i >= 30 for i in range(40)}


def test_empty_table(docs):
    assert Q.quality_counts(docs([], clashes=False)).collect() == []
