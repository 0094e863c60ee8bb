"""Column names. All of this acts on the schema, before a plan exists."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def loader_name(name: str) -> str:
    """Spaces and dashes become '_', other marks go, lower case; accents stay."""
    return "".join(ch for ch in re.sub("[ -]", "_", name) if ch.isalnum() or ch == "_").lower()


def ascii_name(name: str | None) -> str:
    """Plain ASCII name; one '_' per run of other characters; never starts with a digit."""
    if not name:
        return "columna"
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    plain = re.sub(r"_+", "_", re.sub(r"\W", "_", plain))
    return (f"_{plain}" if plain[:1].isdigit() else plain).lower()


def unique_names(names: Iterable[str], clean=ascii_name) -> list[str]:
    """Repeated names get a suffix ``_n``; a generated name is never handed out twice."""
    taken: set[str] = set()
    out = []
    for raw in names:
        base = name = clean(raw)
        n = 0
        while name in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        out.append(name)
    return out


def with_names(df: DataFrame, clean=ascii_name) -> DataFrame:
    return df.toDF(*unique_names(df.columns, clean))


def find_column(columns: Sequence[str], aliases: Iterable[str]) -> str | None:
    """First alias that exists, whatever the case and edge space."""
    by_name = {c.strip().lower(): c for c in columns}
    return next((by_name[a.strip().lower()] for a in aliases if a.strip().lower() in by_name), None)


def find_by_part(
    columns: Sequence[str], parts: Iterable[Sequence[str]], position: int | None = None
) -> str | None:
    """Last column that contains every part of the first matching set; else by position."""
    for wanted in parts:
        hits = [c for c in columns if all(w in c.strip().lower() for w in wanted)]
        if hits:
            return hits[-1]
    if position is not None and position < len(columns):
        return columns[position]
    return None


def select_aliases(
    df: DataFrame, aliases: Mapping[str, Sequence[str]], keep: Sequence[str] = (),
    required: Sequence[str] = (),
) -> DataFrame:
    """Logical columns from whatever headers the file has; missing ones are null text."""
    picked: list[Column | str] = list(keep)
    for logical, names in aliases.items():
        source = find_column(df.columns, names)
        if source is None and logical in required:
            raise ValueError(f"column {logical!r} not found among {df.columns}")
        value = F.lit(None).cast("string") if source is None else F.col(f"`{source}`")
        picked.append(value.alias(logical))
    return df.select(*picked)
