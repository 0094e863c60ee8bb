import math
import random
import re
from collections import Counter

import pandas as pd
import pytest

from hilvan.llm import ranked_search, source_audit

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def letters(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


def audited(rows, least, k):
    """Plain version over (text, lang, source) rows."""
    rows = [(letters(t), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == lang]
        held = Counter(t for terms, _, _ in mine for t in set(terms))
        kept = sorted((t for t, n in held.items() if n >= least), key=str.encode)
        counts = {s: Counter(t for terms, _, x in mine if x == s for t in terms if t in set(kept)) for _, _, s in mine}
        whole = sum(counts.values(), Counter())

        def share(count, t):
            return 1 + 10**9 * (count[t] + 2) // (sum(count.values()) + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for s in counts:
            pair = [(-sum(f(share(counts[s], t), share(counts[o], t)) for t in kept), o.encode(), o)
                    for o in counts if o != s]
            term = [(-f(share(counts[s], t), share(whole, t)), t.encode(), t) for t in kept
                    if counts[s][t] and share(counts[s], t) > share(whole, t)]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:k])):
                out += [(lang, s, part, item, -v, r) for r, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def some_rows(seed, n, sources):
    draw = random.Random(seed)
    names = [*(chr(97 + i) * 2 for i in range(20)), "é", "漢", "Ab", "\U0001f600", "zz9q"]
    return [(" ".join(draw.choices(names, weights=range(1, 26), k=draw.randrange(30))) if draw.random() > 0.1 else None,
             draw.choice(["en", "de", None, ""]), draw.choice([None, "", *(f"s{i}" for i in range(sources))]))
            for _ in range(n)]


@pytest.mark.parametrize(("seed", "sources", "block", "shard", "held"), [(1, 4, 64, 1000, 1000), (2, 7, 2, 5, 3)])
def test_sources_against_a_plain_version(spark, monkeypatch, seed, sources, block, shard, held):
    monkeypatch.setattr(source_audit, "BLOCK", block)
    monkeypatch.setattr(source_audit, "SHARD_ROWS", shard)
    monkeypatch.setattr(source_audit, "HELD_ENTRIES", held)
    rows = some_rows(seed, 150, sources)
    rows += [("lone", "xx", "a"), (None, "xx", "b"), ("", "xx", None), *[rows[0]] * 3]
    df = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr(
        "*", "'x' AS term", "1 AS n", "'y' AS number", "2 AS p")
    got = source_audit.audit_sources(df, min_docs=4, k=3).collect()
    assert sorted(map(tuple, got)) == audited(rows, 4, 3)


def test_sources_of_an_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string, source string")
    assert source_audit.audit_sources(df).collect() == []


def test_shares_beyond_64_bits(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000, 9_100_000_000_000_000, 7)], "n long, whole long, v long")
    got = df.select(source_audit.share("n", "whole", "v").alias("p")).first().p
    assert got == 1 + 10**9 * 9_000_000_000_000_002 // (9_100_000_000_000_000 + 14)


def test_skyband_keeps_what_fewer_than_k_dominate():
    draw = random.Random(4)
    rows = pd.DataFrame([(f"t{i:03d}", draw.randrange(8), draw.randrange(8)) for i in range(200)],
                        columns=["term", "n", "total"])
    for k in (1, 3, 10):
        want = {a.term for a in rows.itertuples() if sum(
            b.term < a.term and b.n >= a.n and b.total <= a.total for b in rows.itertuples()) < k}
        assert set(source_audit.skyband(rows, k)["term"]) == want


def searched(docs, items, k):
    bags = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in set(words(text)) if t in df}
        found = []
        for doc, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n // length
            score = sum(w * (10**9 * bag[t] // (1000 * bag[t] + 20 * m)) for t, w in weights.items() if t in bag)
            if score > 0:
                found.append((-score, (doc is not None, doc or 0)))
        out += [(item, r, doc if some else None, -s) for r, (s, (some, doc)) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("cell", "block", "step"), [(250_000, 256, 8192), (40, 3, 1), (7, 2, 4)])
def test_search_against_a_plain_version(spark, monkeypatch, cell, block, step):
    for name, value in (("CELL", cell), ("BLOCK", block), ("STEP", step)):
        monkeypatch.setattr(ranked_search, name, value)
    draw = random.Random(cell)
    names = [*(f"w{i}" for i in range(30)), "É", "漢", "a_b", "X9"]

    def text(most):
        return " ".join(draw.choices(names, weights=range(34, 0, -1), k=draw.randrange(most)))

    docs = [(draw.randrange(60), text(40)) for _ in range(90)] + [(None, "w1 w2 w30"), (3, None), (4, ""), (5, "w3 " * 4000)]
    docs += [docs[0]] * 3
    items = [(i, text(12)) for i in range(9)] + [(20, None), (21, "unseen"), (None, "w29 w30"), (22, "w30"), (22, "w30")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS id", "1 AS uid", "2 AS size")
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS id", "1 AS block")
    got = ranked_search.best_documents(df, asked, k=5)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == searched(docs, items, 5)


def test_search_in_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.best_documents(docs.limit(0), items).collect() == []
    assert ranked_search.best_documents(docs, items.limit(0)).collect() == []
