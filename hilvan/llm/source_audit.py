"""Source divergence audit: which sources of a language differ, and by which terms.

Terms are counted once per (language, source). A language keeps the terms that enough of its
documents hold. Each source's share of a kept term, and the whole language's, are smoothed and
scaled to integers; the divergence of two shares p and q is floor((p-q)^2 / (p+q)).

The leading terms of a source come from a dominance skyband. Among terms that a source uses more
than its language, the divergence grows with the source's count and falls with the language's, and
ties go to the earlier term. So a term with k others of count at least as high, language count at
most as high and earlier name can't be among the first k. Every partition retains the terms
dominated by fewer than k others, the retained terms of all partitions go through the same test,
and only what is left is ranked exactly.

Sources are compared with each other in cells of two source blocks and a shard of terms; a cell
holds a dense table of shares and returns sums, so no task sees a whole language and no pair of
rows is sent anywhere. Terms that neither block uses come in by their number.

Defined cases: null text, language and source are empty strings. A group without terms is still a
group; where a language keeps no term, its pairs have value 0 and there are no term rows. Equal
rows count as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hilvan.llm.groups import stored
from hilvan.llm.terms import LETTERS, as_binary, terms_of, texts_of

SCALE = 1_000_000_000
#: Counted entries that a task holds before it hands them on.
HELD_ENTRIES = 300_000
#: Sources in a block, and rows of shares in a shard of terms.
BLOCK, SHARD_ROWS = 64, 200_000


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed in tasks as far as they fit.

    A group can have several rows for one term; their sums are its counts.
    """
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source"),
        as_binary(docs, text),
    )
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()),
                        ("n", pa.int64()), ("docs", pa.int64())])

    def packed(counts: dict, holders: dict) -> pa.RecordBatch:
        keys = [(group, term) for group, found in counts.items() for term in found]
        return pa.record_batch([
            pa.array([g[0] for g, _ in keys], pa.string()), pa.array([g[1] for g, _ in keys], pa.string()),
            pa.array([t for _, t in keys], pa.binary()),
            pa.array([n for found in counts.values() for n in found.values()], pa.int64()),
            pa.array([holders[g][t] for g, t in keys], pa.int64()),
        ], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], Counter] = {}
        holders: dict[tuple[str, str], Counter] = {}
        size = 0
        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for group, raw in zip(groups, texts_of(batch, "text"), strict=True):
                terms = terms_of(raw, LETTERS)
                if not terms:
                    continue
                held = counts.setdefault(group, Counter())
                size -= len(held)
                held.update(terms)
                size += len(held)
                holders.setdefault(group, Counter()).update(set(terms))
                if size > HELD_ENTRIES:
                    yield packed(counts, holders)
                    counts, holders, size = {}, {}, 0
        if size:
            yield packed(counts, holders)

    found = rows.mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    return found.withColumn("term", F.col("term").cast("string"))


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, total): counts of terms that enough documents of the language hold.

    One shuffle: all rows of a term of a language meet, at most one per source and task.
    """
    met = counts.repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    held = met.withColumn("total", F.sum("n").over(term)).withColumn("holders", F.sum("docs").over(term))
    return held.filter(F.col("holders") >= min_docs).select("lang", "source", "term", "n", "total")


def share(n: str | Column, whole: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (whole + 2 * kept)) without overflow."""
    n = F.col(n) if isinstance(n, str) else n
    part, size = [c.cast("decimal(27,0)") for c in (n + 2, F.col(whole) + 2 * F.col(kept))]
    return (1 + F.call_function("div", part * F.lit(SCALE).cast("decimal(10,0)"), size)).cast("long")


def divergence(p: str, q: str) -> Column:
    """Floor of (p-q)^2 / (p+q); shares are at most SCALE + 1, so the square fits."""
    p, q = F.col(p), F.col(q)
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_groups(docs: DataFrame, kept: DataFrame, lang: str, source: str) -> DataFrame:
    """(lang, source, number, whole, terms, lang_whole): every group that occurs, with its sums.

    ``number`` counts the sources of a language from nought; ``terms`` is how many it keeps.
    """
    names = docs.select(
        F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source")).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("whole"))
    langs = sums.groupBy("lang").agg(F.sum("whole").alias("lang_whole"))
    sizes = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    made = names.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang", "left")
    made = made.na.fill(0, ["whole", "lang_whole", "terms"])
    order = Window.partitionBy("lang").orderBy("source")
    return made.withColumn("number", (F.row_number().over(order) - 1).cast("long"))


def skyband(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Rows of one group that fewer than ``k`` others dominate.

    A row that is dominated at all often enough is so by rows of the skyband alone, so it is
    compared with those retained before it in an order that no dominated row precedes.
    """
    rows = rows.sort_values(["n", "total", "term"], ascending=[False, True, True], kind="stable")
    name = rows["term"].rank(method="first").to_numpy().astype(np.int64)
    total = rows["total"].to_numpy()
    chosen = np.zeros(len(rows), dtype=np.int64)
    kept_total, kept_name = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    size = 0
    for i, (t, x) in enumerate(zip(total.tolist(), name.tolist(), strict=True)):
        if size < k or np.count_nonzero((kept_total[:size] <= t) & (kept_name[:size] < x)) < k:
            kept_total[size], kept_name[size], chosen[size] = t, x, i
            size += 1
    return rows.iloc[chosen[:size]]


def leading_terms(kept: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """(lang, source, item, value, rank): the ``k`` first terms of each group."""
    rows = kept.join(groups, ["lang", "source"])
    rows = rows.withColumn("p", share("n", "whole", "terms")).withColumn("q", share("total", "lang_whole", "terms"))
    rows = rows.filter("p > q").withColumn("value", divergence("p", "q"))
    rows = rows.select("lang", "source", "term", "n", "total", "value")
    schema = "lang string, source string, term string, n long, total long, value long"

    def retain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], pd.DataFrame] = {}
        for batch in batches:
            for group, some in batch.groupby(["lang", "source"], sort=False):
                held[group] = skyband(pd.concat([held[group], some]) if group in held else some, k)
        yield from held.values()

    part = rows.mapInPandas(retain, schema)
    merged = part.groupBy("lang", "source").applyInPandas(lambda some: skyband(some, k), schema)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "term")
    ranked = merged.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def cell_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of divergence between the sources of two blocks, over the terms of one shard.

    A source's row without a term holds its share of a term that it doesn't use.
    """
    first = rows.iloc[0]
    lang, low, high = first["lang"], first["low"], first["high"]
    base = rows[rows["term"].isna()].sort_values("number")
    used = rows[rows["term"].notna()]
    names, place = np.unique(used["term"].to_numpy(dtype=object), return_inverse=True) if len(used) else ([], [])
    numbers, basic = base["number"].to_numpy(), base["p"].to_numpy()
    table = np.tile(basic, (len(names), 1))
    if len(used):
        table[place, np.searchsorted(numbers, used["number"].to_numpy())] = used["p"].to_numpy()
    block = base["block"].to_numpy()
    out = []
    for a in np.flatnonzero(block == low):
        others = np.flatnonzero((block == high) & (numbers > numbers[a]))
        if not len(others):
            continue
        p, q = table[:, a : a + 1], table[:, others]
        value = ((p - q) ** 2 // (p + q)).sum(axis=0)
        x = basic[others]
        out.append(pd.DataFrame({"lang": lang, "a": numbers[a], "b": numbers[others], "value": value,
                                 "seen": len(names), "rest": (basic[a] - x) ** 2 // (basic[a] + x)}))
    names_ = ["lang", "a", "b", "value", "seen", "rest"]
    return pd.concat(out) if out else pd.DataFrame(columns=names_)


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of a language by divergence."""
    shards = 1 + kept.count() // SHARD_ROWS
    own = groups.filter("terms > 0").withColumn("block", F.expr(f"number div {BLOCK}"))
    own = own.withColumn("blocks", F.max("block").over(Window.partitionBy("lang")))
    used = kept.join(own, ["lang", "source"]).select(
        "lang", "number", "block", "blocks", "term", share("n", "whole", "terms").alias("p"),
        F.expr(f"pmod(xxhash64(term), {shards})").alias("shard"))
    unused = own.select(
        "lang", "number", "block", "blocks", F.lit(None).cast("string").alias("term"),
        share(F.lit(0), "whole", "terms").alias("p"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    dealt = used.unionByName(unused).withColumn("other", F.explode(F.expr("sequence(0L, blocks)")))
    dealt = dealt.select("lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                         "shard", "number", "block", "term", "p")
    sums = dealt.groupBy("lang", "low", "high", "shard").applyInPandas(
        cell_sums, "lang string, a long, b long, value long, seen long, rest long")
    sums = sums.groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.first("rest").alias("rest"))
    both = sums.unionByName(sums.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), "value", "seen", "rest"))
    one = groups.select("lang", F.col("number").alias("a"), "source", "terms")
    two = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    found = both.join(one, ["lang", "a"]).join(two, ["lang", "b"]).select(
        "lang", "source", "item", (F.col("value") + (F.col("terms") - F.col("seen")) * F.col("rest")).alias("value"))
    bare = groups.filter("terms = 0").select("lang", "source")
    nothing = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    found = found.unionByName(nothing.withColumn("value", F.lit(0).cast("long")))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return found.withColumn("rank", F.row_number().over(order))


def audit_sources(
    docs: DataFrame,
    min_docs: int = 10,
    k: int = 10,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` and part ``term`` of every group."""
    kept = stored(kept_terms(term_counts(docs, text, lang, source), min_docs))
    groups = stored(source_groups(docs, kept, lang, source))
    pairs = source_pairs(kept, groups).withColumn("part", F.lit("pair"))
    leading = leading_terms(kept, groups, k).withColumn("part", F.lit("term"))
    return pairs.unionByName(leading).select("lang", "source", "part", "item", "value", "rank")
