import random
import re
from itertools import combinations

import numpy as np

from hilvan.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = {k: shingles(t) for k, t in rows}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rng.choice([8, 60, 900]))]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 90))] for _ in range(12)]
    out = []
    for _ in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            at = rng.randrange(len(words) + 1)
            kind = rng.random()
            if kind < 0.4 and words:
                words[at % len(words)] = rng.choice(vocabulary)
            elif kind < 0.7:
                words.insert(at, rng.choice(vocabulary))
            else:
                words = words[:at] + words[at + 1 :]
        if rng.random() < 0.3:
            words = words + passage
        out.append(" ".join(words).upper() if rng.random() < 0.2 else "\t".join(words))
    return list(enumerate(out))


def test_equals_brute_force_on_mixed_cases(docs):
    """Random near copies, a chain of links, a large group of near copies, and odd rows at once."""
    rows = [(1000 * s + i, f"s{s} " + t.replace("w", f"s{s}w") if s else t) for s in range(3) for i, t in corpus(s + 1, 60)]
    words = [f"c{i}" for i in range(200)]
    rows += [(5000 + i, " ".join(words[4 * i : 4 * i + 100])) for i in range(20)]
    near = [f"n{i}" for i in range(120)]
    rows += [(6000 + i, " ".join([*near[: i % 110], f"x{i}", *near[i % 110 :]])) for i in range(120)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One  two"), (905, "two one")]
    want = brute(rows)
    assert {want[5000 + i][1] for i in range(20)} == {5000}
    text = " ".join(f"r{i}" for i in range(20))
    more = [(None, text), (9003, text), (9003, text), (None, None), (1 << 60 | 1, "far away words only here")]
    got = J.jaccard_components(docs(rows + more)).collect()
    assert len(got) == len(rows) + len(more)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert {k: by[k] for k in want} == want
    assert by[9003] == (16, None) and by[1 << 60 | 1] == (1, 1 << 60 | 1)


def test_empty_table(docs):
    assert J.jaccard_components(docs([])).collect() == []


def test_components_of_a_long_path(spark):
    from hilvan.llm.groups import components

    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_marks_differ_in_no_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(5)
    for size in (0, 1, 40, 700, 5000):
        x = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        y = np.unique(np.concatenate([x[size // 4 :], rng.integers(0, 1 << 64, size // 3, dtype=np.uint64)]))
        bits = sum(int(v).bit_count() for v in (J.mark_of(x) ^ J.mark_of(y)).view(np.uint64))
        assert bits <= len(np.setxor1d(x, y))
        assert not (J.mark_of(x) ^ J.mark_of(x)).any()
        big, small = sorted((J.wide_mark_of(x), J.wide_mark_of(y)), key=len, reverse=True)
        while len(big) > len(small):
            big = big[: len(big) // 2] ^ big[len(big) // 2 :]
        assert sum(int(v).bit_count() for v in (big ^ small).view(np.uint64)) <= len(np.setxor1d(x, y))


def test_words_of_equal_structure_differ():
    """Words that powers of one base mod 2**64 can't tell apart."""
    from hilvan.llm.bytehash import SPACED, Words

    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    one, two, again = Words([f"{word} {other}".encode(), word.encode()], SPACED).hashes
    assert one != two and one == again


def test_keep_one_keeps_rows_not_ids(docs):
    far = [" ".join(f"{c}{i}" for i in range(9)) for c in "abcd"]
    rows = [(3, far[0]), (5, far[0]), (5, far[1]), (7, far[2]), (7, far[2]), (None, far[3]), (9, far[3]), (8, None), (8, None), (8, "")]
    got = J.keep_one(docs(rows))
    assert got.columns == docs(rows).columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    assert kept == sorted([(3, far[0]), (5, far[1]), (7, far[2]), (None, far[3]), (8, None), (8, None), (8, "")], key=repr)


def test_large_family_is_dealt_over_tasks(docs, monkeypatch):
    monkeypatch.setattr(J, "FAMILY", 3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[:i], f"x{i}", *words[i:]])) for i in range(40)]
    assert {r.component_id for r in J.jaccard_components(docs(rows)).collect()} == {0}


def test_long_texts_by_wide_marks(docs):
    """Long sets around the limit, also where the marks of two sets differ in size."""
    rng, rows = random.Random(9), []
    for i, n in enumerate((1000, 1020, 1040, 2040, 2060)):
        words = [f"v{rng.randrange(10**6)}" for _ in range(n)]
        for j, (changes, cut) in enumerate(((0, 0), (15, 0), (21, 10), (25, 0), (0, 180), (200, 0))):
            other = list(words[cut:])
            for at in range(changes):
                other[at * len(other) // max(1, changes)] = f"c{rng.randrange(10**6)}"
            rows.append((10 * i + j, " ".join(other)))
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs(rows)).collect()}
    assert got == want
