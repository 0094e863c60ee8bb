"""Chat formatting at token level.

Each turn's text is encoded by itself, and reserved ids are spliced around it; they lie past
the vocabulary, so no text can yield them. Control strings inside a text are escaped, so that
the formatted string can be parsed as well as the ids. The loss mask comes from prefix sums
over the lengths of the segments: it covers the tokens of assistant texts and nothing else.

Escaping: a backslash becomes two, and a control string gets one after its first character.

Defined cases: a null text or role is empty; a role other than user, assistant and system is
written as a segment of its own. Turns are ordered by turn, role and text, nulls first;
repeated rows are turns of their own. A null conversation id is one conversation. Turns are
formatted row by row, and read back in chunks of turn numbers; no conversation is held whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

CONTROLS = (
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[BOT]",
)
ESCAPED = re.compile("|".join(map(re.escape, CONTROLS)))
ESCAPE = re.compile(r"\\(.)", re.DOTALL)

#: Reserved ids before and after the text of a turn, by role.
OPEN = {"user": ("<s>", "[INST]"), "assistant": ("[BOT]",), "system": ("<<SYS>>",)}
CLOSE = {"user": ("[/INST]",), "assistant": ("</s>",), "system": ("<</SYS>>",)}
#: Turns that are decoded together, bytes of decoded text in a row, and the chunk of null turns.
CHUNK = 64
PIECE_BYTES = 1 << 18
FIRST = -(1 << 62)

OTHER_OPEN, OTHER_MIDDLE, OTHER_CLOSE = ("[ROLE]",), ("[/ROLE]",), ("</s>",)


def escape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPE.sub(r"\1", text)


class Formatter:
    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.base = self.tokenizer.get_vocab_size()
        self.id_of = {c: self.base + i for i, c in enumerate(CONTROLS)}

    def segments(self, role: str) -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
        """Controls before the role's own segment (if any), between, and at the end."""
        if role in OPEN:
            return (), OPEN[role], CLOSE[role]
        return OTHER_OPEN, OTHER_MIDDLE, OTHER_CLOSE

    def format(self, roles: list[str], texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """Ids, loss mask and formatted length of each turn."""
        coded = self.tokenizer.encode_batch([escape(t) for t in texts], add_special_tokens=False)
        odd = [r for r in roles if r not in OPEN]
        names = dict(zip(odd, self.tokenizer.encode_batch([escape(r) for r in odd], add_special_tokens=False), strict=True))
        out = []
        for role, text, code in zip(roles, texts, coded, strict=True):
            first, second, last = self.segments(role)
            name = names[role].ids if role in names else []
            parts = [[self.id_of[c] for c in first], name, [self.id_of[c] for c in second], code.ids,
                     [self.id_of[c] for c in last]]
            sizes = np.array([len(p) for p in parts])
            ends = np.cumsum(sizes)
            edge = np.zeros(int(ends[-1]) + 1, dtype=np.int8)
            if role == "assistant":
                edge[ends[2]] += 1
                edge[ends[3]] -= 1
            ids = np.array([i for p in parts for i in p], dtype=np.int32)
            chars = sum(map(len, first + second + last)) + len(escape(text)) + (len(escape(role)) if name else 0)
            out.append((ids, np.cumsum(edge[:-1]).astype(np.int8), chars))
        return out

    def read_back(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str]:
        """Role, text and text under the mask of one formatted turn."""
        marks = np.flatnonzero(ids >= self.base)
        names = [CONTROLS[i - self.base] for i in ids[marks].tolist()]
        bounds = list(zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True))
        inner = [unescape(self.tokenizer.decode(ids[a + 1 : b].tolist(), skip_special_tokens=False)) for a, b in bounds]
        role = {"<s>": "user", "[BOT]": "assistant", "<<SYS>>": "system"}.get(names[0])
        text = inner[-1]
        under = ids[(mask == 1) & (ids < self.base)]
        loss = unescape(self.tokenizer.decode(under.tolist(), skip_special_tokens=False)) if len(under) else ""
        return (inner[0] if role is None else role), text, loss


_formatters: dict[str, Formatter] = {}


def formatter(content: str) -> Formatter:
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _formatters:
        _formatters.clear()
        _formatters[key] = Formatter(content)
    return _formatters[key]


def plain(value) -> str:
    return value if isinstance(value, str) else ""


def format_turns(conversations: DataFrame, path: str) -> DataFrame:
    """Every row with the ids, the loss mask and the formatted length of its turn.

    Columns conv_id, turn, role and text are read; the output has conv_id, turn, role, text,
    ids (array of int), mask (array of byte) and chars.
    """
    with open(path, encoding="utf-8") as file:  # one to two MB whatever the data
        shared = conversations.sparkSession.sparkContext.broadcast(file.read())
    base = conversations.select("conv_id", "turn", "role", "text")

    @F.pandas_udf("struct<ids:array<int>,mask:array<byte>,chars:long>")
    def formatted(role: pd.Series, text: pd.Series) -> pd.DataFrame:
        rows = formatter(shared.value).format([plain(r) for r in role], [plain(t) for t in text])
        return pd.DataFrame({"ids": [r[0] for r in rows], "mask": [r[1] for r in rows], "chars": [r[2] for r in rows]})

    out = base.withColumn("f", formatted("role", "text"))
    return out.select("conv_id", "turn", "role", "text", "f.ids", "f.mask", "f.chars")


class Piece:
    """Decoded turns of one chunk, in order."""

    COLUMNS = ("name", "chunk", "place", "n_turns", "whole", "loss", "loss_chars", "chars")

    def __init__(self, name: str, chunk: int, place: int):
        self.name, self.chunk, self.place = name, chunk, place
        self.whole: list[bytes] = []
        self.loss: list[bytes] = []
        self.size = self.loss_chars = self.chars = 0

    def add(self, role: str, text: str, loss: str, chars: int) -> None:
        self.whole.append(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.loss.append(loss.encode("utf-8", "surrogatepass"))
        self.size += len(self.whole[-1]) + len(self.loss[-1])
        self.loss_chars += len(loss)
        self.chars += chars

    def row(self) -> tuple:
        return (self.name, self.chunk, self.place, len(self.whole), b"".join(self.whole), b"".join(self.loss),
                self.loss_chars, self.chars)


def read_back(turns: DataFrame, path: str, turns_a_chunk: int = CHUNK, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Per conversation, from ids and masks alone: turns, digests and lengths.

    Tokens are decoded chunk by chunk, so a long conversation is spread over the tasks. A
    digest needs the whole order: one task per conversation runs over the decoded pieces,
    and keeps running digests and one piece at a time only.
    """
    with open(path, encoding="utf-8") as file:
        shared = turns.sparkSession.sparkContext.broadcast(file.read())
    kind = turns.schema["conv_id"].dataType.simpleString()
    number = isinstance(turns.schema["turn"].dataType, NumericType)
    chunk = F.floor(F.col("turn") / turns_a_chunk) if number else F.lit(0)
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("name"), chunk.cast("long").alias("chunk"),
        "turn", "role", "text", "ids", "mask", "chars")
    parted = rows.repartition("name", "chunk").sortWithinPartitions("name", "chunk", "turn", "role", "text").select(
        "name", F.coalesce("chunk", F.lit(FIRST)).alias("chunk"), "ids", "mask", "chars")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        form = formatter(shared.value)
        piece: Piece | None = None
        for batch in batches:
            out = []
            columns = (batch[c] for c in ("name", "chunk", "ids", "mask", "chars"))
            for name, at, ids, mask, chars in zip(*columns, strict=True):
                if piece is None or (name, at) != (piece.name, piece.chunk):
                    out += [] if piece is None else [piece.row()]
                    piece = Piece(name, at, 0)
                elif piece.size >= piece_bytes:
                    out.append(piece.row())
                    piece = Piece(name, at, piece.place + 1)
                piece.add(*form.read_back(np.asarray(ids), np.asarray(mask)), int(chars))
            if out:
                yield pd.DataFrame(out, columns=Piece.COLUMNS)
        if piece is not None:
            yield pd.DataFrame([piece.row()], columns=Piece.COLUMNS)

    pieces = parted.mapInPandas(
        decode, "name string, chunk long, place long, n_turns long, whole binary, loss binary, loss_chars long, chars long")
    ordered = pieces.repartition("name").sortWithinPartitions("name", "chunk", "place")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None

        def line() -> dict:
            n, turns_hash, loss_chars, loss_hash, chars = state
            return {"name": current, "n_turns": n, "turns_sha256": turns_hash.hexdigest(), "loss_chars": loss_chars,
                    "loss_sha256": loss_hash.hexdigest(), "formatted_chars": chars}

        for batch in batches:
            out = []
            columns = (batch[c] for c in ("name", "n_turns", "whole", "loss", "loss_chars", "chars"))
            for name, n, whole, loss, loss_chars, chars in zip(*columns, strict=True):
                if name != current:
                    if current is not None:
                        out.append(line())
                    current, state = name, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += int(n)
                state[1].update(whole)
                state[2] += int(loss_chars)
                state[3].update(loss)
                state[4] += int(chars)
            if out:
                yield pd.DataFrame(out)
        if current is not None:
            yield pd.DataFrame([line()])

    found = ordered.mapInPandas(
        digest, "name string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return found.select(
        F.when(F.col("name") != "", F.col("name").cast(kind)).alias("conv_id"),
        "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
    )
