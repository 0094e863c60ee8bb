"""Benchmark decontamination by multi-pattern search over words.

Every window of ten benchmark words is a pattern (a shorter item is one pattern of its own).
The search is Wu-Manber's with a pair of words as block: a table of shifts by block hash says
how far the window may move on, a bucket by the hash of the last block selects patterns where
the shift is nought, and the words themselves are compared before a hit counts.

Patterns are handed to tasks in blocks of bounded size (``PATTERN_BYTES``); a larger
benchmark takes several searches of each document, whose hits are united in its row.

Defined cases: words are runs of digits, ASCII letters (lower-cased) and characters past
ASCII. Null texts have no words: as documents they are clean, as items they give no pattern.
Repeated items count by their ids; equal ids count once. A null item id is written as
nothing. Repeated documents are searched one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hilvan.llm.bytehash import ALNUM, Words, as_bytes, blocks, mix

WINDOW = 10
PATTERN_BYTES = 16 << 20
TABLE_BITS = 20


def item_words(text) -> list[bytes]:
    found = Words([as_bytes(text)], ALNUM)
    whole = found.block.tobytes()
    return [whole[s:e] for s, e in zip(found.starts.tolist(), found.ends.tolist(), strict=True)]


def windows(items: list[bytes], size: int = WINDOW) -> set[bytes]:
    """Patterns of an item: words joined by one space."""
    if not items:
        return set()
    return {b" ".join(items[i : i + size]) for i in range(max(1, len(items) - size + 1))}


def pattern_blocks(benchmark: DataFrame, id_column: str, text: str, size: int, limit: int) -> Iterator[dict[bytes, set[str]]]:
    """Patterns with the ids of their items, in blocks of about ``limit`` bytes."""
    block: dict[bytes, set[str]] = {}
    total = 0
    for item, words in benchmark.select(id_column, text).toLocalIterator():
        name = "" if item is None else str(item)
        for pattern in windows(item_words(words), size):
            block.setdefault(pattern, set()).add(name)
            total += len(pattern) + len(name) + 200
            if total > limit:
                yield block
                block, total = {}, 0
    if block:
        yield block


class Searcher:
    """Wu-Manber tables, one set per pattern length in words."""

    def __init__(self, patterns: dict[bytes, set[str]]):
        self.classes = []
        by_length: dict[int, list[bytes]] = {}
        for pattern in patterns:
            by_length.setdefault(pattern.count(b" ") + 1, []).append(pattern)
        for length, those in sorted(by_length.items()):
            words = Words(those, ALNUM)
            hashes = words.hashes.reshape(len(those), length)
            width = min(2, length)
            block = self.block_hashes(hashes, width)
            shifts = np.full(1 << TABLE_BITS, length - width + 1, dtype=np.int8)
            for place in range(block.shape[1]):
                np.minimum.at(shifts, self.slot(block[:, place]), length - width - place)
            buckets: dict[int, set[bytes]] = {}
            for key, pattern in zip(block[:, -1].tolist(), those, strict=True):
                buckets.setdefault(key, set()).add(pattern)
            self.classes.append((length, width, shifts, buckets))
        self.items = patterns

    @staticmethod
    def block_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
        if width == 1:
            return hashes
        with np.errstate(over="ignore"):
            return mix(hashes[..., :-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[..., 1:])

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """Per text: number of words, runs of hit words, and the items met."""
        words = Words(texts, ALNUM)
        first = words.first.tolist()
        runs: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        whole = None
        pairs = {1: words.hashes, 2: self.block_hashes(words.hashes, 2)}
        for length, width, shifts, buckets in self.classes:
            keys = pairs[width]
            moves = shifts[self.slot(keys)].tobytes()
            for t in range(len(texts)):
                low = first[t]
                at, last = low + length - width, first[t + 1] - width
                while at <= last:
                    move = moves[at]
                    if move:
                        at += move
                        continue
                    those = buckets.get(int(keys[at]))
                    if those:
                        if whole is None:
                            whole = words.block.tobytes()
                        begin = at - length + width
                        window = b" ".join(
                            whole[words.starts[i] : words.ends[i]] for i in range(begin, begin + length)
                        )
                        if window in those:
                            runs[t].append((begin - low, begin - low + length))
                            items[t] |= self.items[window]
                    at += 1
        return [(first[t + 1] - first[t], merged(runs[t]), items[t]) for t in range(len(texts))]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def searched(spark: SparkSession, patterns: dict[bytes, set[str]]):
    """A function of a text column: number of words, runs of hit words, and items met."""
    shared = spark.sparkContext.broadcast(patterns)
    made: dict[str, Searcher] = {}

    @F.pandas_udf("struct<n_words:long,runs:array<struct<s:int,e:int>>,items:array<string>>")
    def search(texts: pd.Series) -> pd.DataFrame:
        if "s" not in made:
            made["s"] = Searcher(shared.value)
        out = []
        for _, part in blocks((None, as_bytes(t)) for t in texts):
            out += made["s"].search(part)
        return pd.DataFrame({
            "n_words": [x[0] for x in out],
            "runs": [[{"s": s, "e": e} for s, e in x[1]] for x in out],
            "items": [sorted(x[2]) for x in out],
        })

    return search


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, pattern_bytes: int = PATTERN_BYTES,
) -> DataFrame:
    """Per document: words, hit words, items met, digest of their ids, and the verdict."""
    parts = list(pattern_blocks(benchmark, item_id, item_text, window, pattern_bytes)) or [{}]
    found = docs.select(F.col(id_column).alias("key"), *[
        searched(docs.sparkSession, block)(F.col(text)).alias(f"r{i}") for i, block in enumerate(parts)
    ]).select(
        "key", F.col("r0.n_words").alias("n_words"),
        F.array_sort(F.flatten(F.array(*[F.col(f"r{i}.runs") for i in range(len(parts))]))).alias("runs"),
        F.array_distinct(F.flatten(F.array(*[F.col(f"r{i}.items") for i in range(len(parts))]))).alias("items"),
    )
    hit = F.aggregate(
        "runs", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, r: F.struct(
            F.greatest(a["end"], r["e"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), r["e"] - F.greatest(a["end"], r["s"]))).cast("long").alias("n"),
        ),
        lambda a: a["n"],
    )
    return found.select(
        F.col("key").alias(id_column), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, with their columns."""
    parts = list(pattern_blocks(benchmark, options.get("item_id", "item_id"), options.get("item_text", "text"),
                                options.get("window", WINDOW), options.get("pattern_bytes", PATTERN_BYTES)))
    for block in parts:
        shared = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.filter(~_meets(shared)(F.col(text)))
    return docs


def _meets(shared):
    made: dict[str, Searcher] = {}

    @F.pandas_udf("boolean")
    def meets(texts: pd.Series) -> pd.Series:
        if "s" not in made:
            made["s"] = Searcher(shared.value)
        out: list[bool] = []
        for _, part in blocks((None, as_bytes(t)) for t in texts):
            out += [bool(items) for _, _, items in made["s"].search(part)]
        return pd.Series(out, dtype=bool)

    return meets
