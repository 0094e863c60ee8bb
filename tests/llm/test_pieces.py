import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hilvan.llm import piece_bpe
from hilvan.llm.catalog import vocabulary

PATH = vocabulary("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "\n", "the quick brown fox", "▁a ▁▁ b", "x" * 3000, " " * 700 + "t",
    "漢字\U0001f600é", "\x00\x01", "<s>a</s> <0x0A> <unk>", "t​he﻿", "1234567890" * 50, "ﬁ ① İ", "the" * 5000,
]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as file:
        return piece_bpe.Encoder(piece_bpe.Model(file.read()))


def ids_of(own, text):
    return np.frombuffer(own.encode(text), "<u4").tolist()


def test_equals_the_library(own, library):
    for text in TEXTS:
        ids = library.encode(text)
        assert ids_of(own, text) == ids
        assert own.decode(own.encode(text)) == library.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\tabtheins'.1é漢▁ \U0001f600<0x>")), max_size=40))
def test_any_text_equals_the_library(own, library, text):
    assert ids_of(own, text) == library.encode(text)


def test_texts_made_of_pieces(own, library):
    pieces, draw = list(own.model.id_of), random.Random(3)
    for _ in range(3000):
        text = "".join(draw.choices(pieces, k=draw.randrange(1, 6)))
        assert ids_of(own, text) == library.encode(text)


def test_any_ids_decode_as_the_library_does(own, library):
    draw = random.Random(5)
    for _ in range(3000):
        ids = [draw.choice([draw.randrange(3, 259), draw.randrange(32000), 1, 2]) for _ in range(draw.randrange(7))]
        assert own.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)


def test_pairs_agree_with_plain_merging(own):
    pieces, draw = list(own.model.id_of), random.Random(7)
    for _ in range(3000):
        a, b = draw.sample(pieces, 2)
        assert own.merges.compatible(a, b) == (own.merges.merge(a + b)[0] == [a, b])


def test_merges_out_of_rank_order():
    """A token whose parts rank after it is compared by merging the text itself."""
    rank = {"abc": 0, "bc": 9, "ab": 5, "cd": 3}
    merges = piece_bpe.Merges(rank)
    assert merges.of("abc")[:2] == (True, False)
    for a, b in (("abc", "d"), ("ab", "cd"), ("a", "bc")):
        assert merges.compatible(a, b) == (merges.merge(a + b)[0] == [a, b])


def test_operator_rows(docs, library):
    rows = [*enumerate(TEXTS), (100, None), (100, None), (None, "null id"), (1 << 60 | 1, "big id")]
    got = piece_bpe.encode_column(docs(rows), PATH).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for key, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        raw = np.array(ids, dtype="<u4").tobytes()
        r = by[key]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(raw).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert r.ids == raw


def test_id_named_like_an_inner_column(docs):
    for name in ("found", "key", "r"):
        got = piece_bpe.encode_column(docs(["a"], clashes=False).withColumnRenamed("doc_id", name), PATH, id_column=name)
        assert got.columns[0] == name and got.count() == 1


def test_empty_table(docs):
    assert piece_bpe.encode_column(docs([]), PATH).collect() == []
