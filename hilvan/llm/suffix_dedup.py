"""Repeated byte strings across documents, by suffix arrays of shards.

A byte goes if a string of ``width`` bytes that covers it starts anywhere else as well, in
another document or the same one. The steps:

1. Each start of such a string is assigned to the least hash among the ``ANCHOR``-byte
   strings inside it (the leftmost of equals). Equal strings have equal least hashes at equal
   places, so they meet in one shard; neighbouring starts mostly share theirs, and form a
   segment of at most ``2 * width - anchor`` bytes.
2. Segments that are alone with their hash can't repeat. Segments that are equal repeat whole.
3. What is left, each distinct segment once, is put into shards by hash. A shard is sorted by
   induced sorting, and common prefixes with the predecessor in the suffix array tell which
   starts repeat.
4. A hash with more than ``HOT`` distinct segments would make a shard too large for a task:
   its strings are counted one by one by digest instead, in a grouped aggregation.

Defined cases: null is empty; texts shorter than ``width`` lose nothing. Repeated rows are
documents of their own, so both lose what they share. Matches never cross documents. Null
ids are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hilvan.llm.bytehash import Ranges, as_bytes, blocks, laid
from hilvan.llm.groups import stored
from hilvan.llm.spans import cut_out, id_of, rows_of
from hilvan.llm.suffixes import repeated_starts

WIDTH = 200
ANCHOR = 80
HOT = 20_000
SHARD_BYTES = 1 << 20
#: No UTF-8 text holds this byte.
GAP = b"\xff"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    n = len(values)
    whole = -(-n // width) * width
    padded = np.full(whole, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    lanes = padded.reshape(-1, width)
    left = np.minimum.accumulate(lanes, axis=1).ravel()
    right = np.minimum.accumulate(lanes[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def segments(texts: list[bytes], width: int, anchor: int) -> list[np.ndarray]:
    """text, start, end (in the text), least hash and digest of each segment."""
    block, at = laid(texts)
    ranges = Ranges(block)
    hashes = ranges.every(anchor)
    least = sliding_least(hashes, width - anchor + 1)
    starts, ends = at[:-1], at[1:] - width + 1
    long = ends > starts
    owner = np.flatnonzero(long)
    inside = np.zeros(len(block) + 1, dtype=np.int8)
    inside[starts[owner]] += 1
    np.add.at(inside, ends[owner], -1)
    inside = np.cumsum(inside[: len(least)]).astype(bool)
    fresh = np.ones(len(least), dtype=bool)
    # A segment ends where the hash changes, or where its leftmost place is left behind.
    fresh[1:] = (least[1:] != least[:-1]) | (hashes[: len(least) - 1] == least[:-1]) | ~inside[:-1]
    fresh[starts[owner]] = True
    first = np.flatnonzero(fresh & inside)
    stop = np.flatnonzero(np.r_[fresh | ~inside, True])
    last = stop[np.searchsorted(stop, first, side="right")] + width - 1
    text = np.searchsorted(at, first, side="right") - 1
    return [text, first - at[text], last - at[text], least[first].view(np.int64), ranges.hash(first, last).view(np.int64)]


def segment_rows(rows: DataFrame, width: int, anchor: int) -> DataFrame:
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [as_bytes(t) for t in batch["text"]]
            named = [(row, r) for row, r in enumerate(raw) if len(r) >= width]
            keys, hashes = batch["key"].to_numpy(), batch["h"].to_numpy()
            for those, texts in blocks(named):
                text, start, end, least, digest = segments(texts, width, anchor)
                row = np.array(those)[text]
                yield pd.DataFrame({"least": least, "digest": digest, "key": keys[row], "h": hashes[row],
                                    "s": start.astype(np.int32), "e": end.astype(np.int32)})

    return rows.mapInPandas(run, f"least long, digest long, key {kind}, h long, s int, e int")


def pieces_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of each wanted (least, digest, key, h, s, e)."""
    held = wanted.groupBy("key", "h").agg(F.collect_list(F.struct("least", "digest", "s", "e")).alias("parts"))
    both = rows.join(held, ["key", "h"]).select("text", "parts")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, parts in zip(batch["text"], batch["parts"], strict=True):
                raw = as_bytes(text)
                out += [(p["least"], p["digest"], raw[p["s"] : p["e"]]) for p in parts]
            yield pd.DataFrame(out, columns=["least", "digest", "piece"])

    return both.mapInPandas(run, "least long, digest long, piece binary")


def runs_of(starts: np.ndarray, width: int) -> list[dict]:
    """Byte runs covered by strings that begin at the given (sorted) starts."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > width)
    low = np.r_[starts[0], starts[breaks + 1]]
    high = np.r_[starts[breaks], starts[-1]] + width
    return [{"s": int(a), "e": int(b)} for a, b in zip(low, high, strict=True)]


def shard_runs(shard: list[tuple[int, int, bytes]], width: int) -> pd.DataFrame:
    block, at = laid([p for _, _, p in shard], GAP)
    found = np.flatnonzero(repeated_starts(block, width))
    text = np.searchsorted(at, found, side="right") - 1
    inside = found + width < at[text + 1]
    found, text = found[inside], text[inside]
    cut = np.searchsorted(text, np.arange(len(shard) + 1))
    rows = [
        (least, digest, runs_of(found[cut[i] : cut[i + 1]] - at[i], width))
        for i, (least, digest, _) in enumerate(shard) if cut[i + 1] > cut[i]
    ]
    return pd.DataFrame(rows, columns=["least", "digest", "runs"])


RUNS = "least long, digest long, runs array<struct<s:int,e:int>>"


def sorted_shards(pieces: DataFrame, width: int, shard_bytes: int) -> DataFrame:
    """Runs inside each distinct segment, from suffix arrays of whole hash groups."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard: list[tuple[int, int, bytes]] = []
        total, last = 0, None
        for batch in batches:
            for least, digest, piece in zip(batch["least"], batch["digest"], batch["piece"], strict=True):
                if (least, digest) == last:
                    continue  # the same segment of a repeated row
                if last is not None and least != last[0] and total >= shard_bytes:
                    yield shard_runs(shard, width)
                    shard, total = [], 0
                shard.append((least, digest, piece))
                total += len(piece)
                last = (least, digest)
        if shard:
            yield shard_runs(shard, width)

    return pieces.repartition("least").sortWithinPartitions("least", "digest").mapInPandas(run, RUNS)


def counted_strings(pieces: DataFrame, width: int) -> DataFrame:
    """The same runs for hashes with very many segments: strings are counted by digest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for least, digest, piece in zip(batch["least"], batch["digest"], batch["piece"], strict=True):
                n = len(piece) - width + 1
                yield pd.DataFrame({
                    "least": least, "digest": digest, "at": np.arange(n, dtype=np.int32),
                    "string": [hashlib.blake2b(piece[i : i + width], digest_size=16).digest() for i in range(n)],
                })

    strings = stored(pieces.dropDuplicates(["least", "digest"]).mapInPandas(
        run, "least long, digest long, at int, string binary"))
    again = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("string")
    return strings.join(again, "string", "left_semi").groupBy("least", "digest").agg(
        F.collect_list(F.struct(F.col("at").alias("s"), (F.col("at") + width).alias("e"))).alias("runs"))


def repeated_ranges(
    rows: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, hot: int = HOT, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(key, h, s, e): byte ranges of ``rows`` (key, h, text) to remove; they may overlap."""
    met = Window.partitionBy("least").orderBy("digest", "key", "h", "s")
    before, after = F.lag("digest").over(met), F.lead("digest").over(met)
    group = Window.partitionBy("least")
    marks = segment_rows(rows, width, anchor).select(
        "*", before.alias("before"), after.alias("after"),
        (F.min("digest").over(group) != F.max("digest").over(group)).alias("several"),
    ).filter(F.col("before").isNotNull() | F.col("after").isNotNull()).select(
        "least", "digest", "key", "h", "s", "e", "several",
        (F.coalesce(F.col("before") == F.col("digest"), F.lit(False))
         | F.coalesce(F.col("after") == F.col("digest"), F.lit(False))).alias("equal"),
        F.coalesce(F.col("before") != F.col("digest"), F.lit(True)).alias("leads"),
    )
    marks = stored(marks)
    wanted = marks.filter("several and leads").select("least", "digest", "key", "h", "s", "e")
    many = stored(wanted.groupBy("least").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("least"))
    if many.isEmpty():
        found = sorted_shards(pieces_of(rows, wanted), width, shard_bytes)
    else:
        pieces = stored(pieces_of(rows, wanted))
        found = sorted_shards(pieces.join(many, "least", "left_anti"), width, shard_bytes).union(
            counted_strings(pieces.join(many, "least", "left_semi"), width).select("least", "digest", "runs"))
    found = stored(found)
    whole = marks.filter("equal").select("key", "h", "s", "e")
    part = marks.filter("several and not equal").join(found, ["least", "digest"]).select(
        "key", "h", "s", F.explode("runs").alias("r")
    ).select("key", "h", (F.col("s") + F.col("r.s")).alias("s"), (F.col("s") + F.col("r.e")).alias("e"))
    return whole.union(part)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH, **options) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans and kept_sha256."""
    rows = rows_of(docs, id_column, text)
    return cut_out(rows, repeated_ranges(rows, width, **options)).select(
        id_of().alias(id_column), "n_bytes", "n_removed", "n_spans", "kept_sha256")
