import base64
import bz2
import gzip
import hashlib
import io
import lzma
import re
import zipfile
import zlib
from urllib.parse import quote

import pytest

from hilvan.llm import secret_scan as S

PATTERNS = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"(AKIA)([A-Z0-9]+)"),
    ("hex", r"()([0-9a-f]+)"),
)


def brute(text):
    out = []
    for place, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


KEY = "AKIA" + "Q7" * 9
TEXTS = [
    None, "", "plain words only", "password = hunter2x and Token:'abcdef'", "api_key=ab12", 'APIKEY" : "abc.def=="',
    f"é {KEY} tail", "AKIAX AKIA" + "Z" * 30, "0123456789abcdef" * 2, "deadbeef" * 3 + "g" + "deadbee", "paſsword=abcdefg",
    "secret=token=abcdef", "toKen=abcdefgh", "x" * 3000 + " passwd:" + "y" * 20, "password: short password: longer1",
]


def test_base_equals_plain_patterns(docs):
    rows = {r.doc_id: r for r in S.secret_spans(docs(TEXTS)).collect()}
    for i, text in enumerate(TEXTS):
        spans = brute(text)
        assert rows[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), text
        assert (rows[i].n_assign, rows[i].n_access, rows[i].n_hex) == tuple(
            sum(s.startswith(k) for s in spans) for k in S.KINDS)
        assert set(spans) <= set(rows[i].spans.split(","))  or not spans


def b64(raw):
    return base64.b64encode(raw).decode()


SECRET = "password=hunter2secret"


@pytest.mark.parametrize("wrapped", [
    quote(SECRET, safe=""), "".join(f"\\u{ord(c):04x}" for c in SECRET), b64(SECRET.encode()), b64(gzip.compress(SECRET.encode())),
    b64(zlib.compress(SECRET.encode())), b64(b64(SECRET.encode()).encode()), quote(quote(SECRET, safe=""), safe=""),
    b64(gzip.compress(b64(quote(SECRET, safe="").encode()).encode())), b64(gzip.compress(zlib.compress(SECRET.encode()))),
])
def test_layers_are_unwrapped_and_mapped(wrapped):
    text = f"é start {wrapped} end"
    base, every = S.scan(text)
    assert every
    found = {text[s:e] for s, _, e in every if (s, _, e) not in base}
    assert any(part in wrapped and len(part) >= 8 for part in found)
    assert all(8 <= s and e <= 8 + len(wrapped) for s, _, e in every)


def test_span_inside_a_url_layer_is_exact():
    text = "go password%3Dhunter2secret now"
    assert S.written(S.scan(text)[1]) == "assign:3:27"


def test_cycles_and_junk_end():
    for text in ("%25" * 500, "%2525252541", "\\u005cu0041" * 50, "A" * 4000, b64(bytes(range(256)) * 4), "%zz%e9\\uD800"):
        S.scan(text)


def test_redaction_leaves_no_base_secret_and_keeps_columns(docs):
    table = docs(TEXTS)
    out = S.redact(table)
    assert out.columns == table.columns
    for r in out.collect():
        assert (r.text is None) == (TEXTS[r.doc_id] is None)
        if r.text and brute(TEXTS[r.doc_id]):
            assert "[SECRET]" in r.text and "hunter2x" not in r.text
        elif r.text is not None:
            assert r.text == TEXTS[r.doc_id]


def test_empty_table_and_null_ids(docs):
    assert S.secret_spans(docs([])).collect() == []
    rows = S.secret_spans(docs([(None, "password=abcdefg"), (1 << 60 | 1, "x")])).collect()
    assert {r.doc_id for r in rows} == {None, 1 << 60 | 1}


@pytest.mark.parametrize("char", ["\u00a0", "\u3000", "\ufeff", "\u200b", "\u00ad", "\u2028", "\f", "\0"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_no_character_hides_a_layer(char, pack):
    text = f"go {b64(pack(f'user{char}x {SECRET}'.encode()))} end"
    assert {k for _, k, _ in S.scan(text)[1]} == {0} and "[SECRET]" in S.masked(text, S.scan(text)[1], "[SECRET]")


@pytest.mark.parametrize("coding", ["utf-16", "utf-16-le", "utf-16-be", "utf-32", "utf-32-le", "utf-32-be", "latin-1", "cp1252"])
def test_no_coding_hides_a_layer(coding):
    for inner in (SECRET, quote(SECRET, safe=""), b64(SECRET.encode())):
        raw = f"é user {inner}".encode(coding)
        for packed in (raw, gzip.compress(raw), b"\xff" + raw):
            assert S.scan(f"go {b64(packed)} end")[1], (coding, inner)


def test_wide_text_in_url_escapes_is_exact():
    text = f"go {quote(SECRET.encode('utf-16-le'), safe='')} now"
    assert S.written(S.scan(text)[1]) == f"assign:3:{len(text) - 4}"


def bare(raw):
    packer = zlib.compressobj(wbits=-15)
    return packer.compress(raw) + packer.flush()


def zipped(raw):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.txt", b"no more than words")
        z.writestr("b.txt", raw)
    return out.getvalue()


PACKS = {
    "plain": bytes, "gzip": gzip.compress, "zlib": zlib.compress, "bare": bare, "bz2": bz2.compress, "xz": lzma.compress, "zip": zipped,
    "lzma": lambda raw: lzma.compress(raw, format=lzma.FORMAT_ALONE),
    "members": lambda raw: gzip.compress(b"words " * 9) + gzip.compress(raw[:9]) + b"\0\0" + gzip.compress(raw[9:]),
    "bz2 members": lambda raw: bz2.compress(raw[:9]) + bz2.compress(raw[9:]), "xz members": lambda raw: lzma.compress(raw[:9]) + lzma.compress(raw[9:]),
    "behind other bytes": lambda raw: b"\x01\x02\x03\x04\x05" + gzip.compress(raw), "nested": lambda raw: bz2.compress(bare(lzma.compress(raw))),
}
NOISE = "".join(hashlib.sha256(str(i).encode()).hexdigest()[:23] + "." for i in range(20))  # doesn't compress away


@pytest.mark.parametrize("pack", PACKS)
def test_every_form_is_unwrapped(pack):
    for tail in ("", "é", "éé"):  # each length of padding
        run = b64(PACKS[pack](f"{NOISE} user {SECRET} {tail}".encode()))
        for text in (run, run.rstrip("="), run.replace("+", "-").replace("/", "_")):
            for glue in ("", "https://h.org/v/", "a_", "x-y/", "key-", "abc_de/fgh-"):
                assert S.scan(f"go {glue}{text} end")[1], (pack, glue)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\n> ", "\\n"])
@pytest.mark.parametrize("width", [64, 76, 7])
@pytest.mark.parametrize("pack", PACKS)
def test_wrapped_runs_are_joined(pack, width, end):
    for at in range(0, 60, 21):
        run = b64(PACKS[pack](f"{NOISE[:at]} {SECRET} {NOISE}".encode()))
        text = end.join(run[i : i + width] for i in range(0, len(run), width))
        for before, behind in (("", ""), ("see", "then words"), ("-----BEGIN X-----", "-----END X-----")):
            whole = f"some words {before}{end}{text}{end}{behind}"
            found = [(s, e) for s, _, e in S.scan(whole)[1]]
            assert found, (at, before)
            assert width < 64 or any(whole[s:e].strip("n") in text for s, e in found)


def test_chance_bytes_show_nothing():
    raw = b"".join(hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(4000))
    assert S.scan(b64(raw))[1] == [] == S.scan("\n".join(b64(raw[i : i + 57]) for i in range(0, len(raw), 57)))[1]
