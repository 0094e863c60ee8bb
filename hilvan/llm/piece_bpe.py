"""SentencePiece BPE encoding and decoding by a table of prefixes.

The encoding of every prefix of a word ends in exactly one token. An automaton over all pieces
gives the tokens that may end at a place; the one that belongs there is the token that is
compatible with the last token of the prefix before it: merging the two texts together would
leave both as they are. The table therefore holds one token per place, is filled in one pass
over the word, and the ids are read from it backwards.

Two tokens are compatible if no merge across their border ever comes first. Each token's edge
grows along the merges that made it (its spine), so the test walks both spines in merge order.

The model file is a parameter: the public protobuf form of a BPE model without rewriting rules
(identity normaliser) and without user-defined pieces.

Defined cases: a null or empty text is the begin and the end id, or nothing if neither is asked
for. A character without a piece becomes its UTF-8 bytes, or the unknown id if the model has no
byte pieces. Equal rows give equal rows. Words are encoded once per task and kept in a table of
bounded size; a word of any length takes time and memory in proportion to it.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import groupby

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hilvan.llm.bpe import text_groups

# Kinds of pieces in the model file, and the mark that stands for a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE_MODEL = 2
SPACE = "▁"

NEVER = 1 << 60
KEEP_WORDS = 300_000
KEEP_PAIRS = 1_000_000
KEEP_SIZE = 64  # longer words aren't kept


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = raw[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message; nested messages and texts are bytes."""
    at = 0
    while at < len(raw):
        head, at = _varint(raw, at)
        number, kind = head >> 3, head & 7
        if kind == 0:
            value, at = _varint(raw, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(raw, at)
            value, at = raw[at : at + size], at + size
        yield number, value


class Model:
    """Pieces, their merge ranks and the settings of a model file."""

    def __init__(self, raw: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer: dict[int, int | bytes] = {}
        normaliser: dict[int, int | bytes] = {}
        for number, value in fields(raw):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normaliser = dict(fields(value))
        if trainer.get(3, 1) != BPE_MODEL:
            raise ValueError("not a BPE model")
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1) or trainer.get(24, 0):
            raise ValueError("the normaliser of this model rewrites text")
        if USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("user-defined and unused pieces aren't supported")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.bytes_back = bool(trainer.get(35, 0))
        self.unknown = self.kinds.index(UNKNOWN)
        self.begin = trainer.get(41, 1)
        self.end = trainer.get(42, 2)
        self.id_of = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        place = {s: r for r, s in enumerate(sorted({scores[i] for i in self.id_of.values()}, reverse=True))}
        self.rank = {p: place[scores[i]] for p, i in self.id_of.items()}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        # Where no piece has a space after another character, words can be encoded one by one.
        self.cut_at_spaces = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id_of)


class Merges:
    """Merge history of tokens, and which tokens may stand side by side.

    Tokens are the texts of pieces.
    """

    def __init__(self, rank: dict[str, int]):
        self.rank = rank
        self.history: dict[str, tuple[bool, bool, list, list]] = {}

    def merge(self, text: str) -> tuple[list[str], list[tuple[int, str, str, bool, bool]]]:
        """Tokens of a short text by merging the best pair again and again.

        Also the merges made: rank, both sides, and whether they took in the first or last symbol.
        """
        symbols, made = list(text), []
        while True:
            best, at = NEVER, -1
            for i in range(len(symbols) - 1):
                rank = self.rank.get(symbols[i] + symbols[i + 1], NEVER)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                return symbols, made
            made.append((best, symbols[at], symbols[at + 1], at == 0, at == len(symbols) - 2))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def of(self, token: str) -> tuple[bool, bool, list, list]:
        """(reached, in order, left spine, right spine).

        A spine lists the symbols at one edge, from the single character to the token, each with
        the rank of the merge that ends it.
        """
        known = self.history.get(token)
        if known is None:
            symbols, made = self.merge(token)
            ranks = [m[0] for m in made]
            left = [(token[0], NEVER)]
            right = [(token[-1], NEVER)]
            for rank, a, b, first, last in made:
                if first:
                    left[-1:] = [(left[-1][0], rank), (a + b, NEVER)]
                if last:
                    right[-1:] = [(right[-1][0], rank), (a + b, NEVER)]
            known = self.history[token] = (len(symbols) == 1, ranks == sorted(ranks), left, right)
        return known

    def compatible(self, a: str, b: str) -> bool:
        """Whether the text of two tokens is encoded as these two."""
        _, plain_a, _, right = self.of(a)
        _, plain_b, left, _ = self.of(b)
        if not (plain_a and plain_b):  # merges that don't come in order of rank: merge the text itself
            return self.merge(a + b)[0] == [a, b]
        i = j = 0
        while True:
            (edge, ends), (start, begins) = right[i], left[j]
            across = self.rank.get(edge + start, NEVER)
            # Of equal ranks the leftmost goes first: the left token's, the one across, the right's.
            if ends <= begins:
                if across < ends:
                    return False
                if ends == NEVER:
                    return True
                i += 1
            else:
                if across <= begins:
                    return False
                j += 1


class Encoder:
    def __init__(self, model: Model):
        self.model = model
        self.merges = Merges(model.rank)
        self.automaton = ahocorasick.Automaton()
        for piece, i in model.id_of.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.alphabet = {p for p in model.id_of if len(p) == 1}
        if not all(self.alphabet.issuperset(p) for p in model.id_of):
            raise ValueError("a piece holds a character that isn't a piece")
        self.sizes = [len(p) for p in model.pieces]
        self.names = [i.to_bytes(4, "little") for i in range(len(model.pieces))]
        self.pairs: dict[int, bool] = {}
        self.control = np.array(model.kinds) == CONTROL
        self.known: dict[str, bytes] = {}
        self.segments = re.compile(" ( *[^ ]*)").findall
        self.surface = [
            b"" if kind == CONTROL else b" \xe2\x81\x87 " if kind == UNKNOWN else bytes([int(piece[3:5], 16)])
            if kind == BYTE else piece.replace(SPACE, " ").encode()
            for piece, kind in zip(model.pieces, model.kinds, strict=True)
        ]

    def last_tokens(self, run: str) -> list[int]:
        """The last token of the encoding of each prefix of a run, by the prefix's length less one."""
        pairs, compatible, reached = self.pairs, self.compatible, self.reached
        last, done = [0] * len(run), -1
        for end, (piece, size) in self.automaton.iter(run):  # longer ones first
            if end == done:
                continue
            before = end - size
            if before < 0:
                fits = reached(piece)
            else:
                key = last[before] << 32 | piece
                fits = pairs.get(key)
                if fits is None:
                    fits = compatible(key)
            if fits:
                last[end] = piece
                done = end
        return last

    def reached(self, piece: int) -> bool:
        return self.merges.of(self.model.pieces[piece])[0]

    def compatible(self, key: int) -> bool:
        if len(self.pairs) >= KEEP_PAIRS:
            self.pairs.clear()
        a, b = key >> 32, key & 0xFFFFFFFF
        pieces = self.model.pieces
        fits = self.pairs[key] = self.reached(b) and self.merges.compatible(pieces[a], pieces[b])
        return fits

    def run_ids(self, run: str) -> bytes:
        last, sizes, names = self.last_tokens(run), self.sizes, self.names
        at, out = len(run) - 1, []
        while at >= 0:
            token = last[at]
            out.append(names[token])
            at -= sizes[token]
        out.reverse()
        return b"".join(out)

    def word_ids(self, word: str) -> bytes:
        """Ids of one word as little-endian unsigned 32-bit integers."""
        if self.alphabet.issuperset(word):
            return self.run_ids(word)
        model, out = self.model, []
        # No merge takes in a character without a piece.
        for known, run in groupby(word, self.alphabet.__contains__):
            if known:
                out.append(self.run_ids("".join(run)))
            elif model.bytes_back:
                raw = "".join(run).encode("utf-8", "surrogatepass")
                out.append(np.array([model.byte_ids[b] for b in raw], dtype="<u4").tobytes())
            else:
                out.append(self.names[model.unknown])  # unknown characters side by side are one token
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of one text, without begin and end."""
        if not text:
            return b""
        text = text.replace(SPACE, " ")
        if not (self.model.cut_at_spaces and self.model.dummy_prefix):
            return self.word_ids(((" " if self.model.dummy_prefix else "") + text).replace(" ", SPACE))
        words = self.segments(" " + text) if "  " in text or text.startswith(" ") else text.split(" ")
        known = self.known
        ids = list(map(known.get, words))
        if None in ids:
            if len(known) > KEEP_WORDS:
                known.clear()
            for i, found in enumerate(ids):
                if found is None:
                    word = words[i]
                    found = known.get(word)
                    if found is None:
                        found = self.word_ids(SPACE + word.replace(" ", SPACE))
                        if len(word) <= KEEP_SIZE:
                            known[word] = found
                    ids[i] = found
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        """Text of ids; every byte that isn't part of a character becomes U+FFFD."""
        row, kinds = np.frombuffer(ids, dtype="<u4"), self.model.kinds
        numbers = row.tolist()
        raw = b"".join(map(self.surface.__getitem__, numbers))
        prefix = self.model.dummy_prefix and raw.startswith(b" ")
        prefix = prefix and kinds[next(i for i in numbers if self.surface[i])] == NORMAL
        try:
            text = raw.decode()
            if not self.control[row[1:-1]].any():
                return text[prefix:]
        except UnicodeDecodeError:
            pass
        # Bytes on both sides of a control id don't make up a character.
        runs = groupby(numbers, lambda i: kinds[i] == CONTROL)
        return "".join(plain(b"".join(map(self.surface.__getitem__, run))) for mark, run in runs if not mark)[prefix:]


def plain(raw: bytes) -> str:
    """UTF-8 text in which each byte outside a whole character is one U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as wrong:
            out += [raw[at : at + wrong.start].decode(), "\N{REPLACEMENT CHARACTER}"]
            at += wrong.start + 1
    return "".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(name: str, raw: bytes) -> Encoder:
    """One encoder per worker and model."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(Model(raw))
    return _encoders[name]


def encode_column(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text: str = "text",
    begin: bool = True,
    end: bool = True,
) -> DataFrame:
    """Per row: the id, the number of tokens, ids, their digest and the digest of the decoded text.

    ``path``: the model file, read by the driver and sent to the workers; its size doesn't depend
    on the data.
    """
    with open(path, "rb") as file:
        raw = file.read()
    name = hashlib.sha256(raw).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    @F.pandas_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string,ids:binary>")
    def encoded(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(name, shared.value)
        first = own.model.begin.to_bytes(4, "little") if begin else b""
        last = own.model.end.to_bytes(4, "little") if end else b""
        for batch in texts:
            out = []
            for group in text_groups([t if isinstance(t, str) else "" for t in batch]):
                for one in group:
                    ids = first + own.encode(one) + last
                    back = own.decode(ids).encode("utf-8", "surrogatepass")
                    out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), ids))
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256", "ids"])

    rows = docs.select(F.col(id_column).alias("key"), encoded(F.col(text)).alias("found"))
    names = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    return rows.select(F.col("key").alias(id_column), *[F.col("found")[c].alias(c) for c in names])
