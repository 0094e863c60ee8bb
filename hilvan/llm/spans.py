"""Documents without some of their byte ranges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hilvan.llm.bytehash import as_bytes


#: Set in ``h`` where the id is null.
NO_ID = 1 << 32


def row_name(docs: DataFrame, id_column: str, text: str) -> tuple[Column, Column]:
    """Key and hash that together name a row; equal rows share them.

    Neither is null: a null id is written as nought or nothing, and marked in the hash, so that
    ids pass through pandas unchanged.
    """
    key = F.col(id_column)
    zero = F.lit("0").cast(docs.schema[id_column].dataType)
    h = F.hash(text).cast("long").bitwiseAND(F.lit(NO_ID - 1)) + F.when(key.isNull(), NO_ID).otherwise(0)
    return F.coalesce(key, zero), h


def rows_of(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(key, h, text): the name of each row (:func:`row_name`) and its text."""
    key, h = row_name(docs, id_column, text)
    return docs.select(key.alias("key"), h.alias("h"), F.col(text).alias("text"))


def id_of(key: str = "key", h: str = "h") -> Column:
    return F.when(F.col(h) < NO_ID, F.col(key))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs; ranges that touch become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def without(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for start, end in runs:
        kept.append(raw[at:start])
        at = end
    return b"".join([*kept, raw[at:]])


def cut_out(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """(key, h, n_bytes, n_removed, n_spans, kept_sha256) for each row of ``rows``.

    ``ranges``: (key, h, s, e), byte ranges to remove, in any order and overlap. The ranges of
    a row are gathered per row, so their number is bounded by its length.
    """
    held = ranges.groupBy("key", "h").agg(F.collect_list(F.struct("s", "e")).alias("cuts"))
    both = rows.join(held, ["key", "h"], "left").select("key", "h", "text", "cuts")
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, h, text, cuts in zip(batch["key"], batch["h"], batch["text"], batch["cuts"], strict=True):
                raw = as_bytes(text)
                runs = merged([(c["s"], c["e"]) for c in cuts]) if cuts is not None else []
                out.append((key, h, len(raw), sum(e - s for s, e in runs), len(runs),
                            hashlib.sha256(without(raw, runs)).hexdigest()))
            names = ["key", "h", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pd.DataFrame(out, columns=names)

    return both.mapInPandas(run, f"key {kind}, h long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
