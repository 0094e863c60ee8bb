"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last ``REACH`` bytes decides where chunks end, so an insertion
moves the cuts near it and no others. Chunks are deduplicated by a 64-bit digest; the first
(by id, text hash and place) stays. Runs of chunks that repeat one place are extended at both
ends, byte by byte, as far as they agree with the first occurrence. What is shorter than
``MIN_RUN`` bytes after that, and not a whole document, stays: phrases that meet by chance. (A
passage of over 50 words has 101 bytes at least.) ``n_repeated`` counts the bytes of repeated
passages with the first occurrence included. A passage in which no chunk begins and ends at the
same places in both texts isn't found.

Defined cases: null is empty and has no chunks. Rows that repeat an id with the same text are
one document: a chunk that only they share isn't a repeat, and they get equal results. The
same chunk twice in one document is a repeat. Null ids are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hilvan.llm.bytehash import Ranges, as_bytes, blocks, laid, mix
from hilvan.llm.groups import stored
from hilvan.llm.spans import id_of, merged, rows_of, without

REACH = 16
MIN_CHUNK = 24
MAX_CHUNK = 256
#: One place in 2 ** CUT_BITS ends a chunk.
CUT_BITS = 4
MIN_RUN = 64
#: Bytes compared at each end at first, and bytes of a block.
FIRST_WIDTH = 64

GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(block: np.ndarray) -> np.ndarray:
    """Sum of GEAR[byte] << age over the last REACH bytes, by doubling."""
    h = GEAR[block]
    reach = 1
    while reach < REACH:
        older = np.zeros_like(h)
        older[reach:] = h[:-reach] << np.uint32(reach)
        h = h + older
        reach *= 2
    return h


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """Ends of the chunks of each text."""
    block, at = laid(texts)
    # The newest bytes sit in the low bits: mix before taking the top ones.
    h = (gear_hashes(block) & np.uint32(0xFFFF)) * np.uint32(0x9E3779B1)
    places = (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist()
    out = []
    i, n = 0, len(places)
    for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        ends, start = [], low
        while i < n and places[i] <= low:
            i += 1
        while i < n and places[i] < high:
            place = places[i]
            i += 1
            if place - start < MIN_CHUNK:
                continue
            while place - start > MAX_CHUNK:
                start += MAX_CHUNK
                ends.append(start - low)
            if place - start < MIN_CHUNK and ends:
                continue
            ends.append(place - low)
            start = place
        while high - start > MAX_CHUNK:
            start += MAX_CHUNK
            ends.append(start - low)
        if high > start:
            ends.append(high - low)
        out.append(ends)
    return out


def chunk_rows(rows: DataFrame) -> DataFrame:
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [(row, r) for row, r in enumerate(as_bytes(t) for t in batch["text"]) if r]
            keys, hashes = batch["key"].to_numpy(), batch["h"].to_numpy()
            for those, texts in blocks(raw):
                block, at = laid(texts)
                cuts = chunk_ends(texts)
                sizes = np.array([len(c) for c in cuts])
                ends = np.array([e for c in cuts for e in c], dtype=np.int64)
                text = np.repeat(np.arange(len(texts)), sizes)
                first = np.cumsum(sizes) - sizes
                starts = np.r_[0, ends[:-1]]
                starts[first] = 0
                place = np.arange(len(ends)) - first[text]
                digest = Ranges(block).hash(starts + at[text], ends + at[text])
                row = np.array(those)[text]
                yield pd.DataFrame({"digest": digest.view(np.int64), "key": keys[row], "h": hashes[row],
                                    "i": place.astype(np.int32), "s": starts.astype(np.int32), "e": ends.astype(np.int32)})

    return rows.mapInPandas(run, f"digest long, key {kind}, h long, i int, s int, e int")


def surroundings(rows: DataFrame, asked: DataFrame, width: int, far: bool) -> DataFrame:
    """(key, h, s, e, before, after): what lies on both sides of the asked ranges, outwards.

    Near: up to ``width`` bytes. Far: 64-bit hashes of all blocks of ``width`` bytes.
    """
    lists = asked.distinct().groupBy("key", "h").agg(F.collect_list(F.struct("s", "e")).alias("asked"))
    both = rows.join(lists, ["key", "h"]).select("key", "h", "text", "asked")
    kind = rows.schema["key"].dataType.simpleString()
    names = ["key", "h", "s", "e", "before", "after"]

    def hashes(raw: bytes, places: range) -> bytes:
        return b"".join(hashlib.blake2b(raw[at : at + width], digest_size=8).digest() for at in places)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, held = [], 0
            for key, h, text, places in zip(batch["key"], batch["h"], batch["text"], batch["asked"], strict=True):
                raw = as_bytes(text)
                for p in places:
                    s, e = p["s"], p["e"]
                    if far:
                        before = hashes(raw, range(s - width, -1, -width))
                        after = hashes(raw, range(e, len(raw) - width + 1, width))
                    else:
                        before, after = raw[max(0, s - width) : s][::-1], raw[e : e + width]
                    out.append((key, h, s, e, before, after))
                    held += len(before) + len(after) + 100
                    if held > 1 << 22:
                        yield pd.DataFrame(out, columns=names)
                        out, held = [], 0
            yield pd.DataFrame(out, columns=names)

    return both.mapInPandas(run, f"key {kind}, h long, s int, e int, before binary, after binary")


def shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


MATCH = ("key", "h", "s", "e", "fk", "fh", "fs")


ONE = ("key", "h", "fk", "fh", "shift")


def joined_up(matches: DataFrame) -> DataFrame:
    """Matches of the same two texts and shift that touch or overlap become one."""
    order = Window.partitionBy(*ONE).orderBy("s", "e")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = matches.withColumn("shift", F.col("fs") - F.col("s")).withColumn("apart", (F.col("s") > reach).cast("int"))
    return apart.withColumn("island", F.coalesce(F.sum("apart").over(order), F.lit(0))).groupBy(*ONE, "island").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.min("fs").alias("fs"), F.max("further").alias("further"))


def grown(rows: DataFrame, matches: DataFrame, width: int = FIRST_WIDTH) -> DataFrame:
    """The matches as long as their bytes agree with the first occurrence, both ways.

    Those that agree for ``width`` bytes go on by hashes of whole blocks to the ends of the
    texts, and then by less than a block of bytes.
    """
    kinds = {f.name: f.dataType.simpleString() for f in matches.schema.fields}
    done, ahead = None, matches
    for far in (False, True, False):
        source = [F.col("fk").alias("key"), F.col("fh").alias("h"), F.col("fs").alias("s"), (F.col("fs") + F.col("e") - F.col("s")).alias("e")]
        around = surroundings(rows, ahead.select("key", "h", "s", "e").union(ahead.select(*source)), width, far)
        other = around.select(F.col("key").alias("fk"), F.col("h").alias("fh"), F.col("s").alias("fs"), F.col("e").alias("fe"),
                              F.col("before").alias("f_before"), F.col("after").alias("f_after"))
        both = ahead.withColumn("fe", F.col("fs") + F.col("e") - F.col("s")).join(
            around, ["key", "h", "s", "e"]).join(other, ["fk", "fh", "fs", "fe"])

        def run(batches: Iterator[pd.DataFrame], far: bool = far) -> Iterator[pd.DataFrame]:
            for batch in batches:
                left, right = (
                    np.array([shared(a, b) for a, b in zip(batch[c], batch[f"f_{c}"], strict=True)], dtype=np.int32)
                    for c in ("before", "after"))
                if far:
                    left, right = left // 8 * width, right // 8 * width
                out = batch[list(MATCH)].copy()
                out["s"], out["fs"], out["e"] = out["s"] - left, out["fs"] - left, out["e"] + right
                out["further"] = far | (left == width) | (right == width)
                yield out

        made = stored(joined_up(both.select(*MATCH, "before", "after", "f_before", "f_after").mapInPandas(
            run, ", ".join(f"{c} {kinds[c]}" for c in MATCH) + ", further boolean")))
        whole = made.filter("NOT further").select(*MATCH)
        done = whole if done is None else done.union(whole)
        ahead = made.filter("further").select(*MATCH)
        if ahead.isEmpty():
            return done
    return done.union(ahead)


def long_enough(ranges: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    return [(s, e) for s, e in merged(ranges) if e - s >= MIN_RUN or e - s == size]


def finished(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Results of each row; ``ranges``: (key, h, s, e, later), as many per row as it has bytes at most."""
    lists = ranges.groupBy("key", "h").agg(F.collect_list(F.struct("s", "e", "later")).alias("cuts"))
    both = rows.join(lists, ["key", "h"], "left").select("key", "h", "text", "cuts")
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, h, text, cuts in zip(batch["key"], batch["h"], batch["text"], batch["cuts"], strict=True):
                raw = as_bytes(text)
                cuts = [] if cuts is None else cuts
                gone = long_enough([(c["s"], c["e"]) for c in cuts if c["later"]], len(raw))
                seen = long_enough([(c["s"], c["e"]) for c in cuts], len(raw))
                out.append((key, h, len(raw), sum(e - s for s, e in gone), len(gone),
                            hashlib.sha256(without(raw, gone)).hexdigest(), sum(e - s for s, e in seen)))
            yield pd.DataFrame(out, columns=["key", "h", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated"])

    return both.mapInPandas(
        run, f"key {kind}, h long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_repeated long")


def dedup_chunks(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated and ``repeats``."""
    rows = rows_of(docs, id_column, text)
    met = Window.partitionBy("digest").orderBy("key", "h", "i")
    later = chunk_rows(rows).select(
        "key", "h", "i", "s", "e", F.dense_rank().over(met).alias("rank"), F.first("key").over(met).alias("fk"),
        F.first("h").over(met).alias("fh"), F.first("s").over(met).alias("fs"),
    ).filter("rank > 1").dropDuplicates(["key", "h", "i"])
    found = grown(rows, stored(joined_up(later.withColumn("further", F.lit(True))).select(*MATCH)))
    ranges = found.select("key", "h", "s", "e", F.lit(True).alias("later")).union(found.select(
        F.col("fk"), F.col("fh"), F.col("fs"), F.col("fs") + F.col("e") - F.col("s"), F.lit(False)))
    # one range for each start, so that what a much repeated text gathers is bounded by its length
    ranges = ranges.groupBy("key", "h", "s", "later").agg(F.max("e").alias("e"))
    return finished(rows, ranges).select(
        id_of().alias(id_column), "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated",
        (F.col("n_repeated") > 0).alias("repeats"),
    )
