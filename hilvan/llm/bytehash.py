"""Vectorised hashing of byte ranges and words, used inside tasks.

A block is a list of byte strings laid end to end. Range hashes come from one running sum
of ``byte * BASE**i`` (mod 2**64), so that any range of the block is hashed in constant time
and equal ranges have equal hashes wherever they lie.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: int, size: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < size:
        table = np.full(max(size, 1 << 20), base, dtype=np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        if size <= 1 << 23:
            _powers[name] = table
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * M1
    x = x ^ (x >> np.uint64(27))
    x = x * M2
    return x ^ (x >> np.uint64(31))


class Ranges:
    """Hashes of any ranges of one block."""

    def __init__(self, block: np.ndarray, salt: int = 1):
        n = len(block)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(salt)) * _power_table("up", BASE, n)[:n], out=self.sums[1:])
        self.down = _power_table("down", INVERSE, n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw + (end - start).astype(np.uint64) * M2)

    def every(self, width: int) -> np.ndarray:
        """Hashes of all ranges of one width, by start."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


def blocks(items: Iterable[tuple[object, bytes]], size: int = 1 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """Groups (key, bytes) into blocks of about ``size`` bytes; an item is never divided."""
    keys: list = []
    texts: list[bytes] = []
    total = 0
    for key, text in items:
        if texts and total + len(text) > size:
            yield keys, texts
            keys, texts, total = [], [], 0
        keys.append(key)
        texts.append(text)
        total += len(text)
    if texts:
        yield keys, texts


def laid(texts: list[bytes], gap: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """The block and where each text starts in it (one entry more: past the last gap)."""
    sizes = np.fromiter((len(t) + len(gap) for t in texts), dtype=np.int64, count=len(texts))
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(sizes, out=starts[1:])
    return np.frombuffer(gap.join(texts) + gap, dtype=np.uint8), starts


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """Words of a block of texts: where they lie, whose they are, and their hashes.

    ``is_word`` marks the bytes of words; a gap byte outside them parts the texts. A word's hash
    is the sum of well-mixed values of its (place, byte) pairs: unlike powers of one base, these
    have no structure that different words could share.
    """

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        block, self.text_starts = laid(texts, b" ")
        self.block = LOWER[block]
        inside = is_word[self.block]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.text_starts)  # first word of each text
        sizes = self.ends - self.starts
        at = np.flatnonzero(inside)
        place = (at - np.repeat(self.starts, sizes)).astype(np.uint64)
        values = mix((place << np.uint64(8) | self.block[at]) * M1 + M2)
        sums = np.add.reduceat(values, np.cumsum(sizes) - sizes) if len(at) else values
        self.hashes = mix(sums + sizes.astype(np.uint64) * M2)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def as_bytes(text) -> bytes:
    """UTF-8 of a cell; null is empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SPACED = ~WHITE  # words are everything but ASCII white space

ALNUM = np.zeros(256, dtype=bool)  # digits, small letters and every byte past ASCII
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
