"""Token counts by section, from one encoding of the whole document.

A document is encoded once. Each token's byte span follows from the lengths of the tokens
before it, and its characters from those bytes. Token spans are joined to section spans by
their starts; a token that reaches over a boundary goes to one section by an explicit rule:

* ``first`` (the default): the section that holds its first character,
* ``last``: the section that holds its last character,
* ``most``: the section that holds most of its bytes, the first of equals.

The counts of a document's sections therefore add up to the tokens of the document. Sections
are the lines of a text (each with the line feed that ends it) or whole fields.

Defined cases: a null or empty field has one empty section without tokens. An empty section
gets no token. Repeated rows are counted one by one. Columns of any other name are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hilvan.llm.bpe import Encoder, encoder, shared_vocabulary, text_groups

RULES = ("first", "last", "most")


def lines_of(text: str) -> list[str]:
    """Lines, each with its line feed; nothing follows a line feed that ends the text."""
    parts = text.split("\n")
    lines = [p + "\n" for p in parts[:-1]]
    return lines + [parts[-1]] if parts[-1] or not lines else lines


def attribute(sizes: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many of them reach into another one.

    ``sizes``: bytes of each token; ``bounds``: byte starts of the sections and the end.
    """
    n = len(bounds) - 1
    ends = np.cumsum(sizes)
    starts = ends - sizes
    first = np.searchsorted(bounds[1:], starts, side="right")
    last = np.searchsorted(bounds[1:], ends - 1, side="right")
    crossing = first != last
    if rule == "first":
        place = first
    elif rule == "last":
        place = last
    else:
        place = first.copy()
        for i in np.flatnonzero(crossing).tolist():
            shares = [
                min(ends[i], bounds[s + 1]) - max(starts[i], bounds[s]) for s in range(first[i], last[i] + 1)
            ]
            place[i] = first[i] + int(np.argmax(shares))
    return np.bincount(place, minlength=n), np.bincount(place[crossing], minlength=n)


def token_counts(
    docs: DataFrame, path: str, id_column: str = "doc_id", fields: Sequence[str] = ("text",), by: str = "line",
    rule: str = "first",
) -> DataFrame:
    """Per document and section: name, character span, tokens, and tokens that reach over its end.

    With ``by="line"`` the sections are the lines of each field, with ``by="field"`` the fields.
    Fields are laid end to end, and the whole is encoded at once.
    """
    if rule not in RULES or by not in ("line", "field"):
        raise ValueError(f"unknown rule {rule!r} or section kind {by!r}")
    base = docs.select(
        F.coalesce(F.col(id_column), F.lit("0").cast(docs.schema[id_column].dataType)).alias("key"),
        F.col(id_column).isNull().alias("none"),
        *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"f{i}") for i, f in enumerate(fields)],
    )
    names = list(fields)
    name, shared = shared_vocabulary(docs, path)
    kind = base.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bpe: Encoder = encoder(name, shared.value)
            lengths = getattr(bpe, "lengths", None)
            if lengths is None:
                lengths = bpe.lengths = np.array([len(b) for b in bpe.vocab.bytes_of], dtype=np.int64)
            cells = [batch[f"f{i}"].tolist() for i in range(len(names))]
            wholes = ["".join(parts) for parts in zip(*cells, strict=True)]
            keys, none, at = batch["key"].to_numpy(), batch["none"].to_numpy(), 0
            for group in text_groups(wholes):
                out: list[pd.DataFrame] = []
                for ids, row in zip(bpe.encode(group), range(at, at + len(group)), strict=True):
                    pieces, owners = [], []
                    for f, column in zip(names, cells, strict=True):
                        own = lines_of(column[row]) if by == "line" else [column[row]]
                        pieces += own
                        owners += [f] * len(own)
                    bounds = np.concatenate([[0], np.cumsum([len(p.encode("utf-8", "surrogatepass")) for p in pieces])])
                    chars = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
                    counts, crossing = attribute(lengths[np.frombuffer(ids, dtype="<u4")], bounds, rule)
                    out.append(pd.DataFrame({
                        "key": np.repeat(keys[row : row + 1], len(pieces)), "none": none[row], "field": owners,
                        "section": np.arange(len(pieces)), "start": chars[:-1], "end": chars[1:],
                        "n_tokens": counts, "n_crossing": crossing,
                    }))
                at += len(group)
                if out:
                    yield pd.concat(out, ignore_index=True)

    return base.mapInPandas(
        run, f"key {kind}, none boolean, field string, section long, start long, end long, n_tokens long, n_crossing long"
    ).select(F.when(~F.col("none"), F.col("key")).alias(id_column), "field", "section", "start", "end", "n_tokens",
             "n_crossing")
