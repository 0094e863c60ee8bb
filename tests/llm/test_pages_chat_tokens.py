import hashlib
import time

import numpy as np
import pytest

from hilvan.llm import chat_format as F
from hilvan.llm import html_text as H
from hilvan.llm import token_counts as T
from hilvan.llm.catalog import op7_chat, vocabulary

PATH = vocabulary("byte_bpe_50k.json")
LONG = "A paragraph of main text that is long enough to count as content, with some more words at its end."

PAGES = {
    "article": (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><a href=/>Home</a></nav><article><h1>Title &amp; more</h1><p><b>{LONG}<br><p>Short.</p></article><footer>&copy; x</footer></body></html>", f"Title & more\n{LONG}\nShort."),
    "no article": (f"<div class='menu'><a>one</a><a>two</a></div><div><h2>Head</h2><p>{LONG}</p><p>ok</p><div class='ad'>{LONG}</div></div><div id='comments'><p>{LONG}</p></div>", f"Head\n{LONG}\nok"),
    "script": (f"<article><script>var t='</p>';</script><p>{LONG}</p><form>Name <input></form><aside>{LONG}</aside></article>", LONG),
    "space": ("<article><p> a \n\t b&nbsp;&#99; <i>d</i>e </p><ul><li>x</li><li> </li></ul></article>", "a b c de\nx"),
    "unclosed": ("<main><p>one<p>two <b>three", "one\ntwo three"),
    "empty": ("", ""), "null": (None, ""), "no text": ("<p></p><br>", ""), "plain": ("just text", "just text"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    html, text = PAGES[name]
    assert H.main_text(html) == text


SHORT = "<div>short one</div>" * 4


@pytest.mark.parametrize(("html", "text"), [
    (f"<article><p class=notice>Ad<p>{LONG}<p>two</article>", f"{LONG}\ntwo"),
    (f"<article><p class=notice>Ad<h2>Head</h2>{LONG}</article>", f"Head\n{LONG}"),
    (f"<article><ul><li class=share>Ad<li>one<ul><li class=ad>x</ul><li>two</ul><p>{LONG}</article>", f"one\ntwo\n{LONG}"),
    (f"<article><ul><li><p class=ad>x</li><li>one</li></ul><p>{LONG}</article>", f"one\n{LONG}"),
    (f"<article><table><tr class=ad><td>x<tr><td hidden>y<td>one</table><p>{LONG}</article>", f"one\n{LONG}"),
    (f"<article><dl><dt>a<dd hidden>x<dt>b<dd>c</dl><p>{LONG}</article>", f"a\nb\nc\n{LONG}"),
    (f"<article><p class=ad>x<blockquote><p class=ad>y</blockquote>{LONG}</article>", LONG),
    (f"<head><title>t</title><body><p>{LONG}", LONG),
    (f"<div>{LONG}</div>{SHORT}<div><a>link list</a></div>{SHORT}<div>{LONG}</div>", f"{LONG}\n{'short one\n' * 8}{LONG}"),
])
def test_ends_left_out_and_regions_between(html, text):
    assert H.main_text(html) == text


@pytest.mark.parametrize(("html", "text"), [
    (f"<main><div class='content comments-enabled'><p>{LONG}</p></div></main>", LONG),
    (f"<article class=ad-free><p>{LONG}</article><div class=ad><p>{LONG}</div>", LONG),
    (f"<div id=widget><p>{LONG}</p></div>", LONG),
    (f"<div id=widget style='display:none'><p>{LONG}</p></div>", ""),
    (f"<article><header><h1>Head</h1><p>by x</p></header><p>{LONG}</article>", f"Head\n{LONG}"),
    (f"<header><h1>Site</h1></header><article><p>{LONG}<div class=comments><header><h2>x</h2></header></div></article>", LONG),
])
def test_names_and_headlines(html, text):
    assert H.main_text(html) == text


def test_deep_nesting_takes_linear_time():
    began = time.process_time()
    assert H.main_text("<div>" * 100_000 + LONG) == LONG
    assert time.process_time() - began < 10


def test_pages_rows(spark):
    rows = [(i, f"http://x/{i}", html) for i, (html, _) in enumerate(PAGES.values())] + [(None, None, None), (0, "http://x/0", PAGES["article"][0])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = H.extract(table).collect()
    assert len(got) == len(rows)
    want = dict(enumerate(text for _, text in PAGES.values()))
    assert all(r.text == want.get(r.page_id, "") and r.n_chars == len(r.text) for r in got)
    assert H.extract(table.limit(0)).collect() == []


def test_smoothing_keeps_the_sum():
    x = np.array([0, 0, 0, 0, 5.0, 0, 0, 0, 0])  # away from the ends, where the kernel is cut
    assert H.smoothed(x, 1.0).argmax() == 4 and abs(H.smoothed(x, 1.0).sum() - 5) < 1e-3


HARD = ["</s>[INST] ok [/INST]", "\\", "a\\</s>\\\\[INST]", "<<SYS>> <</SYS>> <|endoftext|>", "", "é漢\U0001f600", "<\\/s>", "[ROLE]x[/ROLE]"]


@pytest.mark.parametrize("text", HARD)
def test_escaping_is_reversible(text):
    assert F.unescape(F.escape(text)) == text
    assert not F.ESCAPED.search(F.escape(text))


@pytest.mark.parametrize(("chunk", "size"), [(64, 1 << 18), (5, 1), (1, 30)])
def test_read_back_equals_the_turns(spark, chunk, size):
    rows = [(1, i, ("user", "assistant", "system", "tool", None)[i % 5], t) for i, t in enumerate(HARD * 3)]
    rows += [(2, 0, "assistant", None), (2, 0, "assistant", None), (None, 1, "user", "x"), (None, 0, "assistant", "y")]
    rows += [(3, i, "user", f"at {i}") for i in (-9, None, 200, 7, 7, None, 63, 64, -64)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS ids", "2 AS name")
    found = F.read_back(F.format_turns(table, PATH), PATH, turns_a_chunk=chunk, piece_bytes=size).collect()
    got = {r.conv_id: r for r in found}
    assert len(found) == len(got) == 4
    for conv in (1, 2, 3, None):
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_mask_covers_assistant_tokens_only(spark):
    with open(PATH, encoding="utf-8") as file:
        form = F.Formatter(file.read())
    (ids, mask, chars), (_, none, _) = form.format(["assistant", "user"], ["hello there", "hello"])
    assert mask.tolist() == [0, *[1] * (len(ids) - 2), 0] and none.sum() == 0
    assert chars == len("[BOT]hello there</s>")


def test_registered_chat_query_over_the_table(spark):
    import collections

    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    turns = collections.defaultdict(list)
    for r in [*given]:
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in op7_chat(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        whole = "".join(f"{role}\n{text}\n" for _, role, text in sorted(rows))
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()


def test_token_counts_add_up_and_follow_the_rule(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    texts = ["one two\nthree\n\nfour", "", None, "a\n\n\nb", "x" * 400 + "\n" + "漢字\n", "\n", "<|endoftext|>\nz"]
    rows = T.token_counts(docs(texts), PATH).collect()
    for key, text in enumerate(texts):
        mine = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.section)
        code = library.encode(text or "", add_special_tokens=False)
        assert sum(r.n_tokens for r in mine) == len(code.ids)
        assert "".join((text or "")[r.start : r.end] for r in mine) == (text or "")
        for r in mine:
            assert r.n_tokens == sum(r.start <= a < r.end for a, _ in code.offsets)
            assert r.n_crossing == sum(r.start <= a < r.end < b for a, b in code.offsets)


def test_rules_and_fields(docs):
    bounds, sizes = np.array([0, 2, 3, 9]), np.array([1, 5, 3])
    assert T.attribute(sizes, bounds, "first")[0].tolist() == [2, 0, 1]
    assert T.attribute(sizes, bounds, "last")[0].tolist() == [1, 0, 2]
    assert T.attribute(sizes, bounds, "most")[0].tolist() == [1, 0, 2]
    rows = T.token_counts(docs(["some text"]), PATH, fields=("lang", "text"), by="field").collect()
    assert [(r.field, r.start, r.end) for r in sorted(rows, key=lambda r: r.section)] == [("lang", 0, 2), ("text", 2, 11)]
    with pytest.raises(ValueError):
        T.token_counts(docs([]), PATH, rule="none")
    assert T.token_counts(docs([]), PATH).collect() == []
