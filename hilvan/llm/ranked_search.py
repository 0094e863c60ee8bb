"""Ranked lexical search over a length-stratified index.

The score of a document depends on its length only through an integer normaliser m. Documents of
equal m form a stratum, and within a stratum the postings of a term are ordered by tf; all postings
of one term, stratum and tf add the same impact, which is worked out once. A stratum's bound for a
query is the sum of its terms' highest impacts there. Strata are visited by falling bound, and what
is left is skipped once its bounds are under the score of the last document that would be returned.

Index rows are made in one pass over the texts and joined with the terms that queries use, so a
document that shares no term with a query costs one row. Strata are packed into cells of bounded
size; a large stratum is split by document. Queries come in blocks of bounded number, and a cell
receives only the postings of the block's terms. Each cell returns at most ``k`` documents per
query, and a last window merges them.

Defined cases: null text has no terms. Every row is a document of its own, and every row of the
queries a query of its own, whatever their ids; equal scores go by ascending id, nulls first.
Documents without terms count nowhere. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hilvan.llm.groups import stored
from hilvan.llm.terms import WORDS, as_binary, terms_of, texts_of

#: Postings in a cell (up to twice as many), and queries in a block on average.
CELL, BLOCK = 250_000, 256
#: Strata are visited until this many postings are scored, then bounds are compared again.
STEP = 8_192


def bags(rows: DataFrame, text: str) -> DataFrame:
    """(uid, id, size, terms, counts) per row: its distinct terms with their numbers of occurrence.

    ``rows`` holds ``id`` and ``text``. ``uid`` names the row; it is fixed once the result is stored.
    """
    kind = rows.schema["id"].dataType
    given = rows.select(F.monotonically_increasing_id().alias("uid"), "id", as_binary(rows, text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts, offsets, sizes = [], [], [0], []
            for raw in texts_of(batch, "text"):
                terms = terms_of(raw, WORDS)
                bag: dict[bytes, int] = {}
                for term in terms:
                    bag[term] = bag.get(term, 0) + 1
                found += bag
                counts += bag.values()
                offsets.append(len(found))
                sizes.append(len(terms))
            ends = pa.array(offsets, pa.int32())
            yield pa.record_batch({
                "uid": batch.column("uid"), "id": batch.column("id"), "size": pa.array(sizes, pa.int64()),
                "terms": pa.ListArray.from_arrays(ends, pa.array(found, pa.binary())),
                "counts": pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
            })

    schema = f"uid long, id {kind.simpleString()}, size long, terms array<binary>, counts array<long>"
    return given.mapInArrow(count, schema)


def query_terms(queries: DataFrame, id_column: str, text: str) -> DataFrame:
    """(uid, id, block, term): the distinct terms of every query; stored."""
    found = stored(bags(queries.select(F.col(id_column).alias("id"), F.col(text).alias("text")), "text"))
    blocks = 1 + found.count() // BLOCK
    return found.select("uid", "id", F.expr(f"pmod(xxhash64(uid), {blocks})").alias("block"),
                        F.explode("terms").alias("term"))


def postings(docs: DataFrame, wanted: DataFrame, id_column: str, text: str) -> DataFrame:
    """(uid, id, size, term, tf) for the wanted terms, and one row with an empty term per document; stored."""
    rows = bags(docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")), "text").filter("size > 0")
    mark = F.array(F.struct(F.lit(b"").alias("terms"), F.lit(1).cast("long").alias("counts")))
    each = rows.select("uid", "id", "size", F.explode(F.concat(mark, F.arrays_zip("terms", "counts"))).alias("t"))
    each = each.select("uid", "id", "size", F.col("t.terms").alias("term"), F.col("t.counts").alias("tf"))
    return stored(each.join(wanted, "term", "left_semi"))


def scored(
    rows: pd.DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]], k: int, enough: int
) -> Iterator[tuple[int, int, int]]:
    """(query, doc row, score) of the ``k`` best documents of a cell for each query.

    ``rows``: (m, doc, order, number, tf), doc counting the cell's documents and order ranking their
    ids; ``queries``: (query, numbers of its terms, their weights). Bounds are compared again after
    every ``enough`` postings.
    """
    rows = rows.sort_values(["number", "m", "tf"], kind="stable")
    m, tf, number = (rows[c].to_numpy() for c in ("m", "tf", "number"))
    doc = rows["doc"].to_numpy()
    # Runs of one term, stratum and tf share their impact.
    new_run = np.ones(len(rows), dtype=bool)
    new_run[1:] = (m[1:] != m[:-1]) | (tf[1:] != tf[:-1]) | (number[1:] != number[:-1])
    run_starts = np.flatnonzero(new_run)
    run_impact = 1_000_000_000 * tf[run_starts] // (1000 * tf[run_starts] + 20 * m[run_starts])
    impact = np.repeat(run_impact, np.diff([*run_starts, len(rows)]))
    # Lists of one term in one stratum; the last run of a list has its highest impact.
    new_list = np.ones(len(rows), dtype=bool)
    new_list[1:] = (m[1:] != m[:-1]) | (number[1:] != number[:-1])
    starts = np.flatnonzero(new_list)
    ends = np.append(starts[1:], len(rows))
    highest = impact[ends - 1]
    strata, stratum = np.unique(m[starts], return_inverse=True)
    of_term = number[starts]
    order = np.empty(doc.max() + 1, dtype=np.int64)
    order[doc] = rows["order"].to_numpy()
    score = np.zeros(len(order), dtype=np.int64)
    for query, numbers, weights in queries:
        low, high = np.searchsorted(of_term, numbers), np.searchsorted(of_term, numbers, side="right")
        some = high > low
        if not some.any():
            continue
        lists = np.concatenate([np.arange(a, b) for a, b in zip(low[some], high[some], strict=True)])
        weight = np.repeat(weights[some], (high - low)[some])
        bound = np.zeros(len(strata), dtype=np.int64)
        np.add.at(bound, stratum[lists], weight * highest[lists])
        work = np.zeros(len(strata), dtype=np.int64)
        np.add.at(work, stratum[lists], ends[lists] - starts[lists])
        visits = np.lexsort((strata, -bound))
        visits = visits[bound[visits] > 0]
        step = np.cumsum(work[visits]) // enough
        turn = np.full(len(strata), -1, dtype=np.int64)
        turn[visits] = step
        by_turn = np.argsort(turn[stratum[lists]], kind="stable")
        lists, weight = lists[by_turn], weight[by_turn]
        turns = turn[stratum[lists]]
        best_doc, best_score = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for one in np.unique(step):
            if len(best_doc) >= k and bound[visits[np.searchsorted(step, one)]] < best_score[k - 1]:
                break
            a, b = np.searchsorted(turns, one), np.searchsorted(turns, one, side="right")
            sizes = ends[lists[a:b]] - starts[lists[a:b]]
            at = np.repeat(starts[lists[a:b]] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            np.add.at(score, doc[at], impact[at] * np.repeat(weight[a:b], sizes))
            touched = np.unique(doc[at])
            found = touched[score[touched] > 0]
            best_doc = np.concatenate([best_doc, found])
            best_score = np.concatenate([best_score, score[found]])
            score[touched] = 0
            first = np.lexsort((order[best_doc], -best_score))[:k]
            best_doc, best_score = best_doc[first], best_score[first]
        yield from zip([query] * len(best_doc), best_doc.tolist(), best_score.tolist(), strict=True)


def best_documents(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    id_column: str = "doc_id",
    text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """(query id, rank, document id, score): the ``k`` highest-scoring documents of every query."""
    terms = query_terms(queries, query_id, query_text)
    marks = terms.limit(0).select("term").union(docs.sparkSession.range(1).select(F.lit(b"").alias("term")))
    index = postings(docs, stored(terms.select("term").distinct().union(marks)), id_column, text)

    whole = index.filter("term = X''").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("l")).first()
    n_docs, length = whole["n"], whole["l"] or 1
    found = index.filter("term <> X''").withColumn("m", F.expr(f"50 + (50 * size * {n_docs}L) div {length}L"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weights = found.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", weight.alias("w"))
    used = terms.join(weights.filter("w > 0"), "term")
    in_block = Window.partitionBy("block").orderBy("term")
    numbered = stored(used.withColumn("number", F.dense_rank().over(in_block).cast("long")))
    payload = numbered.groupBy("block").agg(
        F.collect_list(F.struct("uid", "number", "w")).alias("parts"))
    wanted = numbered.select("block", "term", "number").distinct()

    sizes = found.groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("m").rowsBetween(Window.unboundedPreceding, -1))
    cells = stored(sizes.select("m", F.expr(f"1 + n div {CELL}").alias("splits"),
                                F.coalesce(before, F.lit(0)).alias("before")))
    cells = cells.select("m", "splits", F.expr(f"before div {CELL}").alias("cell"))
    dealt = found.join(cells, "m").join(wanted, "term").select(
        "block", "cell", F.expr("pmod(xxhash64(uid), splits)").alias("split"), "m", "uid", "id", "number", "tf")
    key = ["block", "cell", "split"]
    asked = dealt.select(*key).distinct().join(payload, "block")
    asked = asked.select(*[F.col(c).alias(f"for_{c}") for c in key], "parts")
    kind, enough = index.schema["id"].dataType.simpleString(), STEP

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows["doc"] = rows["uid"].factorize()[0]
        ids = rows.drop_duplicates("doc")[["doc", "uid", "id"]].sort_values(["id", "uid"], na_position="first")
        place = np.empty(len(ids), dtype=np.int64)
        place[ids["doc"].to_numpy()] = np.arange(len(ids))
        rows["order"] = place[rows["doc"].to_numpy()]
        parts = pd.DataFrame([tuple(p.values()) for p in asked["parts"].iloc[0]], columns=["uid", "number", "w"])
        each = [(q, some["number"].to_numpy(), some["w"].to_numpy()) for q, some in parts.groupby("uid")]
        out = list(scored(rows, each, k, enough))
        by_doc = ids.set_index("doc")
        chosen = [d for _, d, _ in out]
        return pd.DataFrame({"query": [q for q, _, _ in out], "uid": by_doc["uid"].reindex(chosen).to_numpy(),
                             "id": by_doc["id"].reindex(chosen).to_numpy(), "score": [s for _, _, s in out]})

    hits = dealt.groupBy(*key).cogroup(asked.groupBy(*[f"for_{c}" for c in key])).applyInPandas(
        search, f"query long, uid long, id {kind}, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_first(), "uid")
    best = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = terms.select(F.col("uid").alias("query"), F.col("id").alias("item")).distinct()
    return best.join(named, "query").select(
        F.col("item").alias(query_id), "rank", F.col("id").alias(id_column), "score")
