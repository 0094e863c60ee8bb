import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hilvan.llm import bpe
from hilvan.llm.catalog import vocabulary

PATH = vocabulary("byte_bpe_50k.json")
TEXTS = [
    "", "a", "  a\n\n b  ", "a<|endoftext|>b <|endoftext|> c", " " * 500, "x" * 3000, "héé" * 400,
    "don't we'll 'S  x", "漢字" * 300, "\U0001f600" * 100, "1234567890" * 60 + "!?" * 200, "a \n \n b", "a  \nb", "a\n\n b ",
    "\x00\x1c\x85　\xa0x", "The quick brown fox\njumps over.", "abc" * 43, "q" * 128, "q" * 129,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(PATH)
    made.no_truncation()
    made.no_padding()
    return made


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Encoder(bpe.Vocabulary(file.read()))


def test_equals_the_library(own, library):
    for text, ids in zip(TEXTS, own.encode(TEXTS), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\tab'srevlm.!1é漢_ 　\U0001f600<|>")), max_size=40))
def test_any_text_equals_the_library(own, library, text):
    ids = own.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == text


def test_long_and_short_words_agree(own):
    word = "abracadabra" * 9
    assert bpe.encode_long(own.vocab, word.encode()) == bpe.encode_side_by_side(own.vocab, [word.encode()])[0]


def test_tables_stay_bounded_and_right(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEEP_WORDS", 3)
    for text in ("one two three four", "five six seven", "one two five"):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_operator_rows(docs, library):
    rows = [*enumerate(TEXTS), (100, None), (100, None), (None, "null id"), (1 << 60 | 1, "big id")]
    got = bpe.encode_column(docs(rows), PATH).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for key, text in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids, dtype="<u4")
        r = by[key]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table(docs):
    assert bpe.encode_column(docs([]), PATH).collect() == []
