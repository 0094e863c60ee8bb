import hashlib
import random
import re

import pytest

from hilvan.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items):
    out = {}
    for key, text in enumerate(texts):
        w = words(text)
        hit, met = set(), set()
        for item, content in items:
            v = words(content)
            for i in range(max(1, len(v) - 9) if v else 0):
                window = v[i : i + 10]
                for j in range(len(w) - len(window) + 1):
                    if w[j : j + len(window)] == window:
                        hit.update(range(j, j + len(window)))
                        met.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out[key] = (len(w), len(hit), len(met), digest, bool(hit))
    return out


def data(seed):
    rng = random.Random(seed)
    vocabulary = ["Äb", "cd", "e1", "F2", "gh", "9", "漢字", "x-y", "Zz"][: rng.randint(2, 9)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 9, 10, 11, 25])))) for i in range(8)]
    items += [(50, None), (51, ""), (52, "--- !!"), (3, items[4][1]), (None, items[5][1])]
    texts = [None, "", "?!", items[3][1].upper()]
    for _ in range(40):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            text[3:3] = [rng.choice(items)[1] or ""]
        texts.append(rng.choice([" ", "\n", ", "]).join(text))
    return texts, items


@pytest.mark.parametrize(("seed", "limit"), [(1, D.PATTERN_BYTES), (2, 900), (3, D.PATTERN_BYTES)])
def test_equals_brute_force(spark, docs, seed, limit):
    texts, items = data(seed)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(docs(texts), benchmark, pattern_bytes=limit).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute(texts, items)
    assert len(got) == len(texts)


def test_repeated_documents_in_several_passes(spark, docs):
    benchmark = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "e f")], "item_id long, text string")
    table = docs([(7, "a b c d"), (7, "a b c d"), (7, "e f"), (None, "c d")])
    rows = sorted((r.n_hit, r.n_items) for r in D.contamination(table, benchmark, pattern_bytes=1).collect())
    assert rows == [(2, 1), (2, 1), (4, 2), (4, 2)]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contamination(docs([]), some).collect() == []
    assert [r.contaminated for r in D.contamination(docs(["a b"]), none).collect()] == [False]


def test_drop_keeps_columns_and_clean_rows(spark, docs):
    texts, items = data(2)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    table = docs(texts)
    out = D.drop_contaminated(table, benchmark)
    assert out.columns == table.columns
    assert {r.doc_id for r in out.collect()} == {k for k, v in brute(texts, items).items() if not v[4]}
