import hashlib
import random

import numpy as np
import pytest

from hilvan.llm import chunk_dedup as C
from hilvan.llm import suffix_dedup as D
from hilvan.llm import suffixes as S


@pytest.mark.parametrize("small", [0, 600])
def test_suffix_array_equals_sorting(monkeypatch, small):
    monkeypatch.setattr(S, "SMALL_ALPHABET", small)
    rng = random.Random(small)
    for _ in range(150):
        n, letters = rng.randint(1, 70), rng.choice([1, 2, 3, 20])
        text = np.zeros(n + 1, dtype=np.int64)
        text[:n] = [rng.randint(1, letters) for _ in range(n)]
        assert S.suffix_array(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())


def test_repeated_starts_equal_brute_force():
    rng = random.Random(7)
    for _ in range(150):
        n, width = rng.randint(1, 60), rng.randint(1, 12)
        raw = bytes(rng.choice([0, 97, 98, 254]) for _ in range(n))
        want = [i + width <= n and raw.find(raw[i : i + width]) != raw.rfind(raw[i : i + width]) for i in range(n)]
        assert S.repeated_starts(np.frombuffer(raw, np.uint8), width).tolist() == want


def brute(rows, width):
    places = {}
    for at, (_, text) in enumerate(rows):
        raw = (text or "").encode()
        for i in range(len(raw) - width + 1):
            places.setdefault(raw[i : i + width], []).append((at, i))
    cover = [bytearray(len((t or "").encode())) for _, t in rows]
    for where in places.values():
        if len(where) > 1:
            for at, i in where:
                cover[at][i : i + width] = b"\1" * width
    out = []
    for (key, text), c in zip(rows, cover, strict=True):
        raw = (text or "").encode()
        kept = bytes(b for b, gone in zip(raw, c, strict=True) if not gone)
        spans = sum(1 for i in range(len(c)) if c[i] and not (i and c[i - 1]))
        out.append((str(key), len(raw), sum(c), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)

    def words(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))

    passages = [words(40) for _ in range(3)]
    texts = [None, "", "short", "x" * 900, "ab" * 400, passages[0], passages[0], passages[0][:50] * 6]
    for _ in range(40):
        parts = [words(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randint(0, 60)
            parts += [p[cut:], words(rng.randint(0, 20))]
        texts.append(" ".join(parts))
    return [*enumerate(texts), (7, texts[20]), (8, texts[20]), (9, texts[9]), (9, texts[9]), (None, texts[12])]


@pytest.mark.parametrize(("seed", "hot"), [(1, D.HOT), (3, 1)])
def test_removed_bytes_equal_brute_force(docs, seed, hot):
    rows = corpus(seed)
    got = D.remove_repeats(docs(rows), width=60, anchor=24, hot=hot, shard_bytes=3000).collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in got) == brute(rows, 60)


def test_empty_tables(docs):
    assert D.remove_repeats(docs([])).collect() == []
    assert C.dedup_chunks(docs([])).collect() == []


def test_chunks_cover_texts_and_survive_insertions():
    rng = random.Random(3)
    text = bytes(rng.randrange(97, 123) for _ in range(5000))
    (ends,) = C.chunk_ends([text])
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(text) and sizes.max() <= C.MAX_CHUNK
    (moved,) = C.chunk_ends([text[:1000] + b"INSERTED" + text[1000:]])
    old = {text[a:b] for a, b in zip([0, *ends], ends, strict=False)}
    other = text[:1000] + b"INSERTED" + text[1000:]
    new = [other[a:b] for a, b in zip([0, *moved], moved, strict=False)]
    assert sum(c not in old for c in new) <= 4
    # a text is cut alike whatever stands before it in the block
    assert C.chunk_ends([b"other " * 50, text])[1] == ends


def test_passages_are_caught_and_clean_texts_left(docs):
    rng = random.Random(5)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))

    passage = words(55)
    rows = [(i, f"{words(60)} {passage} {words(40)}") for i in range(10)] + [(100 + i, words(150)) for i in range(10)]
    got = {r.doc_id: r for r in C.dedup_chunks(docs(rows)).collect()}
    assert all(got[i].repeats for i in range(10)) and got[0].n_removed == 0
    assert all(got[i].n_removed >= 120 for i in range(1, 10))
    assert not any(got[100 + i].repeats or got[100 + i].n_removed for i in range(10))


def test_equal_rows_are_one_document(docs):
    text = " ".join(f"word{i * i}" for i in range(90))
    rows = C.dedup_chunks(docs([(1, text), (1, text), (None, "x"), (2, None)])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in rows) == [("1", 0), ("1", 0), ("2", 0), ("None", 0)]
    copies = {r.doc_id: r.n_removed for r in C.dedup_chunks(docs([(1, text), (2, text)])).collect()}
    assert copies == {1: 0, 2: len(text)}


def test_short_copies_and_whole_passages_go(docs, monkeypatch):
    monkeypatch.setattr(C.grown, "__defaults__", (2,))  # several rounds
    rng = random.Random(11)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))

    texts, passages = ["a short text", "a short text", "tiny", "tiny", "tiny"], []
    for _ in range(60):
        passages.append(words(51))
        texts += [f"{words(30)} {passages[-1]} {words(30)}", f"{words(40)} {passages[-1]} {words(20)}"]
    got = {r.doc_id: r for r in C.dedup_chunks(docs(texts)).collect()}
    assert [got[i].n_removed for i in range(5)] == [0, 12, 0, 4, 4] and all(got[i].repeats for i in range(5))
    whole = 0
    for at, passage in enumerate(passages):
        first, second = got[5 + 2 * at], got[6 + 2 * at]
        assert first.n_removed == 0 and first.repeats == second.repeats == (second.n_removed > 0)
        # the blanks around go too, and bytes that agree by chance
        assert second.n_removed == 0 or len(passage) + 2 <= second.n_removed == first.n_repeated <= len(passage) + 12
        whole += second.n_removed > 0
    assert whole >= 58
