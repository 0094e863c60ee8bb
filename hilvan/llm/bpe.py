"""Byte-level BPE encoding and decoding.

A word's adjacent pairs are the leaves of a segment tree; a leaf holds the pair's merge rank
and place, so the root is the leftmost pair of lowest rank. A merge changes three leaves, and
each change climbs to the root in logarithmic steps, until no pair can be merged. Words of
like size run side by side in one array of trees; very long words have a tree of their own.

The vocabulary file is a parameter. It is the public JSON form of a byte-level BPE without
normaliser: vocabulary, merges in rank order, and special strings that are cut out first.

Defined cases: a null or empty text has no tokens. Words are encoded once per task and kept
in a table of bounded size. Decoding joins the bytes of the tokens; bytes that aren't UTF-8
become U+FFFD.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hilvan.llm.bytehash import as_bytes

#: Fixed: the word pattern of byte-level BPE.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A space between white space, or after white space at the end.
JOINED = regex.compile(r"\s (?=\s|\Z)")

NONE = np.iinfo(np.int32).max
PLACE_BITS = 7
UNRANKED = NONE >> PLACE_BITS
WIDE = 128  # words with more bytes get a tree of their own
KEEP_WORDS = 600_000


def byte_names() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class Vocabulary:
    def __init__(self, content: str):
        spec = json.loads(content)
        vocab = spec["model"]["vocab"]
        names = byte_names()
        of_name = {name: b for b, name in enumerate(names)}
        self.byte_ids = np.array([vocab[n] for n in names], dtype=np.int32)
        pairs = []
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pairs.append((vocab[left] << 32 | vocab[right], rank, vocab[left + right]))
        self.pair = {key: (rank, new) for key, rank, new in reversed(pairs)}
        order = sorted(self.pair)
        self.keys = np.array([*order, 1 << 62], dtype=np.int64)
        self.ranks = np.array([*(self.pair[k][0] for k in order), UNRANKED], dtype=np.int32)
        self.merged = np.zeros(len(pairs) + 1, dtype=np.int32)
        for _, rank, new in pairs:
            self.merged[rank] = new
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for name, i in vocab.items():
            self.bytes_of[i] = bytes(of_name[c] for c in name)
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs; UNRANKED where there is no merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], np.int32(UNRANKED))


def encode_side_by_side(vocab: Vocabulary, words: list[bytes]) -> list[bytes]:
    """Ids, as little-endian unsigned 32-bit integers, of words of up to WIDE bytes.

    Row r of each array starts at r * width (trees: r * 2 * width), so that one flat index
    reaches a symbol or a tree node.
    """
    n = len(words)
    sizes = np.fromiter(map(len, words), dtype=np.int32, count=n)
    bits = max(1, int(sizes.max() - 1).bit_length())
    width = 1 << bits
    raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), dtype=np.uint8).reshape(n, width)
    grid = vocab.byte_ids[raw]
    places = np.arange(width, dtype=np.int32)
    tree2 = np.full((n, 2 * width), NONE, dtype=np.int32)
    rank = vocab.rank(grid[:, :-1], grid[:, 1:])
    fits = (places[None, :-1] + 1 < sizes[:, None]) & (rank != UNRANKED)
    tree2[:, width : 2 * width - 1] = np.where(fits, rank << PLACE_BITS | places[:-1], NONE)
    for level in range(bits - 1, -1, -1):
        low = 1 << level
        np.minimum(tree2[:, 2 * low : 4 * low : 2], tree2[:, 2 * low + 1 : 4 * low : 2], out=tree2[:, low : 2 * low])
    ids, tree = grid.ravel(), tree2.ravel()
    after = np.where(places[None, :] + 1 < sizes[:, None], places + 1, width).ravel()  # width: none
    before = np.tile(places - 1, n)  # -1: none
    alive = (places[None, :] < sizes[:, None]).ravel()
    rows = np.flatnonzero(tree2[:, 1] != NONE).astype(np.int32)

    def leaves(symbol: np.ndarray, following: np.ndarray, place: np.ndarray) -> np.ndarray:
        rank = vocab.rank(ids[symbol], ids[following])
        return np.where(rank == UNRANKED, NONE, rank << PLACE_BITS | place)

    while len(rows):
        line, top = rows << bits, rows << (bits + 1)
        root = tree[top + 1]
        left = root & ((1 << PLACE_BITS) - 1)
        at = line + left
        right = after[at]
        ids[at] = vocab.merged[root >> PLACE_BITS]
        alive[line + right] = False
        beyond = after[line + right]
        after[at] = beyond
        some = np.flatnonzero(beyond < width)
        changed = np.full(len(rows), NONE, dtype=np.int32)
        follow = line[some] + beyond[some]
        before[follow] = left[some]
        changed[some] = leaves(at[some], follow, left[some])
        tree[top + width + right] = NONE
        tree[top + width + left] = changed
        prior = before[at]
        some = np.flatnonzero(prior >= 0)
        prior, base = prior[some], top[some]
        tree[base + width + prior] = leaves(line[some] + prior, at[some], prior)
        for start, leaf in ((top, width + right), (top, width + left), (base, width + prior)):
            for _ in range(bits):
                leaf = leaf >> 1
                child = start + 2 * leaf
                tree[start + leaf] = np.minimum(tree[child], tree[child + 1])
        rows = rows[tree[top + 1] != NONE]
    flat = ids[alive].astype("<u4").tobytes()
    ends = (np.cumsum(alive.reshape(n, width).sum(axis=1)) * 4).tolist()
    return [flat[s:e] for s, e in zip([0, *ends], ends, strict=False)]


def encode_long(vocab: Vocabulary, word: bytes) -> bytes:
    """Ids of one word of any length, with a tree of plain lists."""
    n = len(word)
    ids = [int(vocab.byte_ids[b]) for b in word]
    following, before = [*range(1, n + 1)], [*range(-1, n - 1)]
    width = 1 << (n - 1).bit_length()
    none, pair = (NONE, -1), vocab.pair
    tree: list[tuple[int, int]] = [none] * (2 * width)
    new_of: dict[int, int] = {}

    def leaf(i: int) -> tuple[int, int]:
        j = following[i]
        found = pair.get(ids[i] << 32 | ids[j]) if j < n else None
        if found is None:
            return none
        new_of[i] = found[1]
        return found[0], i

    for i in range(n):
        tree[width + i] = leaf(i)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: tuple[int, int]) -> None:
        node = width + i
        tree[node] = value
        node >>= 1
        while node:
            best = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                return
            tree[node] = best
            node >>= 1

    while tree[1][1] >= 0:
        i = tree[1][1]
        j = following[i]
        ids[i], ids[j] = new_of[i], -1
        following[i] = following[j]
        if following[i] < n:
            before[following[i]] = i
        put(j, none)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    return np.array([i for i in ids if i >= 0], dtype="<u4").tobytes()


class Encoder:
    """Encodes texts; keeps the ids of words and pieces seen before, in tables of bounded size.

    A piece is what stands between two single spaces. A word never reaches over such a space
    unless more white space stands on both sides of it, so pieces can be cut apart first;
    texts with such a space (``JOINED``) are cut into words as a whole.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.known: dict[str, bytes] = {}  # ids of words
        self.pieces: dict[str, bytes] = {}  # ids of a space and the piece after it
        self.words = regex.compile(WORD)
        special = sorted(vocab.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def forget(self) -> None:
        """Empties the tables; the worker stays for other tasks, which need that memory."""
        self.known, self.pieces = {}, {}

    def parts(self, text: str) -> list[tuple[str, str]]:
        """Plain text up to each special string, and that string (empty at the end)."""
        if self.special is None or not self.special.search(text):
            return [(text, "")]
        cut = self.special.split(text)
        return list(zip(cut[0::2], [*cut[1::2], ""], strict=True))

    def learn(self, words: set[str]) -> None:
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            raw = as_bytes(word)
            size = len(raw)
            by_size.setdefault(size if size > WIDE else (size - 1).bit_length(), []).append((word, raw))
        for size, those in by_size.items():
            if size > WIDE:
                for word, raw in those:
                    self.known[word] = encode_long(self.vocab, raw)
                continue
            step = max(1, (1 << 16) >> size)
            for at in range(0, len(those), step):
                some = those[at : at + step]
                ids = encode_side_by_side(self.vocab, [raw for _, raw in some])
                self.known.update(zip([word for word, _ in some], ids, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > KEEP_WORDS:
            self.known.clear()
        if len(self.pieces) > KEEP_WORDS:
            self.pieces.clear()
        find, piece_ids = self.words.findall, self.pieces.get
        missing: dict[str, list[tuple[list, int]]] = {}  # words and pieces, and where their ids go
        lost: dict[str, list[tuple[list, int]]] = {}
        out = []
        for text in texts:
            ids: list = []
            for plain, mark in self.parts(text):
                if JOINED.search(plain):
                    first, pieces = find(plain), []
                else:
                    first, *pieces = plain.split(" ")
                    first = find(first)
                for word in first:
                    missing.setdefault(word, []).append((ids, len(ids)))
                    ids.append(None)
                base = len(ids)
                ids += map(piece_ids, pieces)
                if None in ids[base:]:
                    for i, piece in enumerate(pieces, base):
                        if ids[i] is None:
                            lost.setdefault(piece, []).append((ids, i))
                if mark:
                    ids.append(self.vocab.special[mark].to_bytes(4, "little"))
            out.append(ids)
        made = [(piece, find(" " + piece)) for piece in lost]
        known = self.known
        self.learn({w for w in missing if w not in known} | {w for _, inner in made for w in inner if w not in known})
        for word, places in missing.items():
            for ids, i in places:
                ids[i] = known[word]
        for piece, inner in made:
            got = known[inner[0]] if len(inner) == 1 else b"".join([known[w] for w in inner])
            self.pieces[piece] = got
            for ids, i in lost[piece]:
                ids[i] = got
        return [b"".join(ids) for ids in out]

    def decode(self, ids: bytes) -> str:
        table = self.vocab.bytes_of
        return b"".join(map(table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def encoder(name: str, content: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(Vocabulary(content))
    return _encoders[name]


def shared_vocabulary(docs: DataFrame, path: str):
    """The vocabulary file, read by the driver; one to two MB whatever the data."""
    with open(path, encoding="utf-8") as file:
        content = file.read()
    name = hashlib.sha256(content.encode()).hexdigest()
    return name, docs.sparkSession.sparkContext.broadcast(content)


def text_groups(texts: list[str], size: int = 1 << 20) -> Iterator[list[str]]:
    group, total = [], 0
    for text in texts:
        if group and total + len(text) > size:
            yield group
            group, total = [], 0
        group.append(text)
        total += len(text)
    if group:
        yield group


def encode_column(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of tokens, the ids and their digest, and the digest of the decoded text."""
    name, shared = shared_vocabulary(docs, path)

    @F.pandas_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string,ids:binary>")
    def encoded(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = encoder(name, shared.value)
        try:
            for batch in texts:
                out = []
                for group in text_groups([t if isinstance(t, str) else "" for t in batch]):
                    for ids in bpe.encode(group):
                        back = bpe.decode(ids).encode("utf-8", "surrogatepass")
                        out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), ids))
                yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256", "ids"])
        finally:
            bpe.forget()

    return docs.select(F.col(id_column), encoded(F.col(text)).alias("r")).select(id_column, "r.*")
