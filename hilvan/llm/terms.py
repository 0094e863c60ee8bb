"""Terms of whole texts as bytes, cut inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cutter(digits: bool) -> bytes:
    """Byte table: A-Z become small, everything that isn't part of a term becomes a space.

    Letters and every byte past ASCII belong to terms, and digits if asked for.
    """
    kept = [*range(0x61, 0x7B), *range(0x80, 0x100), *(range(0x30, 0x3A) if digits else ())]
    table = bytearray(b" " * 256)
    for byte in kept:
        table[byte] = byte
    for byte in range(0x41, 0x5B):
        table[byte] = byte + 32
    return bytes(table)


LETTERS = cutter(digits=False)
WORDS = cutter(digits=True)


def terms_of(text: bytes | None, table: bytes) -> list[bytes]:
    """The terms of a text in order; null has none."""
    return text.translate(table).split() if text else []


def texts_of(batch: pa.RecordBatch, column: str) -> Iterator[bytes | None]:
    for cell in batch.column(column):
        yield cell.as_py()


def as_binary(docs: DataFrame, text: str):
    return F.col(text).cast("binary").alias("text")
