"""Exact n-gram Jaccard self-join of texts, answered as connected groups.

A text's set holds the 64-bit hashes of its distinct word shingles. Two sets link when
``100 * |intersection| >= percent * |union|``. The steps:

1. Equal sets are one class; the smallest key stands for it. Only classes are joined.
2. Sets are put into one global order of shingles: by hash, those that a fixed-size count
   sketch of the whole corpus finds frequent last. Linked sets share a shingle among the
   first ``n - ceil(t n) + 1`` of the larger one and ``n - ceil(2 t / (1 + t) n) + 1`` of the
   smaller one, so only these enter the index lists. The order changes the work only.
3. First answers: each list is led by its smallest set. An entry is compared with the leader
   that it meets in most lists, unless sizes, positions or bit marks already rule a link out
   (sets differ in at least as many elements as their marks of parities in bits). Lists whose
   entries are in several groups by then are led by other entries, a few a round, for as long
   as rounds find links: each entry asks about one of them, so a round's work grows with the
   entries, and a family of near copies becomes one group before its pairs are looked at.
4. Derived answers: a list whose entries are all in one group by now needs nothing more. For
   the other lists, entries of different groups are compared: a list is cut into blocks by
   set size, and blocks too far from a size are skipped, as are pairs whose positions leave
   too little room, or for which marks or the known overlaps with the common leader decide
   (an overlap is at most ``o(y, leader) + |x| - o(x, leader)``). The rest is compared exactly.
5. Groups are the connected classes.

No group of copies is ever expanded into its pairs: within a group, entries meet only its
leaders.

Defined cases: null, empty and white-space texts have an empty set, link with nothing and
are their own component; fewer words than the shingle length give one shingle, the whole
sequence. Rows that repeat a key with the same text are one document and come back as often
as they went in; a null key is kept, and comes first among keys. Texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hilvan.llm.bytehash import M1, M2, SPACED, Words, as_bytes, blocks, mix
from hilvan.llm.groups import components, dropped, short_lived_shuffles, small_batches, stored
from hilvan.llm.spans import NO_ID, row_name, rows_of

SHINGLE = 5
PERCENT = 80

#: Counters of the sketch; its size doesn't depend on the data.
SLOTS = 1 << 18
PART = 1 << 13

#: Bits of a set's mark.
MARK_BITS = 512
#: Further leaders of a list in each round. Rounds end early once fewer than one answer in
#: LINK_SHARE is a link; what they leave open is compared pair by pair.
LEADERS = (8, 64)
#: Pairs with one leader that a task compares, on average, and texts unpacked at a time.
FAMILY, SOME_TEXTS = 2_000, 64
#: Bytes of text hashed at a time; a task holds some 35 times as much for it.
BLOCK = 1 << 18
LINK_SHARE = 50
#: Passes over the index entries, each of a share of the shingles; the shuffle of one goes before the next.
PASSES = 4


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(texts, SPACED)
    hashes, first = words.hashes, words.first
    n = len(hashes)
    rolled = np.zeros(n, dtype=np.uint64)
    if n >= size:
        for j in range(size):
            rolled[: n - size + 1] = rolled[: n - size + 1] * M1 + hashes[j : n - size + 1 + j]
        rolled = mix(rolled)
    out = []
    for t in range(len(texts)):
        low, high = int(first[t]), int(first[t + 1])
        if high - low >= size:
            out.append(np.unique(rolled[low : high - size + 1]))
        elif high > low:
            whole = np.uint64(high - low)
            for h in hashes[low:high].tolist():
                whole = np.uint64((int(whole) * int(M2) + h) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix(np.array([whole])))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def batch_sets(keys, texts, size: int) -> Iterator[tuple[object, np.ndarray]]:
    for those, part in blocks(zip(keys, (as_bytes(t) for t in texts), strict=True), BLOCK):
        yield from zip(those, shingle_sets(part, size), strict=True)


def frequent_slots(docs: DataFrame, size: int) -> np.ndarray:
    """Which sketch slots count clearly more texts than their share; of fixed size."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for _, part in blocks(((None, as_bytes(t)) for t in batch["text"]), BLOCK):
                slots = np.concatenate(shingle_sets(part, size)) & np.uint64(SLOTS - 1)
                total += np.bincount(slots.astype(np.int64), minlength=SLOTS)
        if total.any():
            lane = int(total.sum()) % 61
            for part in range(SLOTS // PART):
                yield pd.DataFrame({"part": [part], "lane": [lane],
                                    "counts": [total[part * PART : (part + 1) * PART].tobytes()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PART, dtype=np.int64)
        for counts in group["counts"]:
            total += np.frombuffer(counts, dtype=np.int64)
        return pd.DataFrame({"part": [group["part"].iloc[0]], "lane": [0], "counts": [total.tobytes()]})

    shape = "part int, lane int, counts binary"
    partial = docs.select("text").mapInPandas(count, shape)
    summed = partial.groupBy("part", "lane").applyInPandas(add, shape)
    total = np.zeros(SLOTS, dtype=np.int64)
    for row in summed.groupBy("part").applyInPandas(add, shape).collect():  # SLOTS counters, whatever the data
        total[row["part"] * PART : (row["part"] + 1) * PART] = np.frombuffer(row["counts"], dtype=np.int64)
    mean = total.mean()
    excess = total - (mean + 8 * np.sqrt(mean) + 16)
    return np.where(excess > 0, 1 + np.log2(np.maximum(excess, 1)).astype(np.int64), 0).astype(np.uint8)


def ordered(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """A set in the global order."""
    rank = frequent[(s & np.uint64(SLOTS - 1)).astype(np.int64)]
    return s[np.argsort(rank, kind="stable")]


def mark_of(s: np.ndarray) -> np.ndarray:
    """Parities of the counts of elements by their top bits, as whole words."""
    places = (s >> np.uint64(64 - MARK_BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=MARK_BITS) & 1).astype(np.uint8)).view(np.int64)


def wide_mark_of(s: np.ndarray) -> np.ndarray:
    """Parities by low bits, at least two places an element; halves laid over each other give half the size."""
    bits = max(MARK_BITS, 1 << (2 * len(s) - 1).bit_length() if len(s) else 0)
    places = (s & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).view(np.int64)


#: Bits in which two wide marks (columns big and small) differ; linked sets differ in size by less than 2.
WIDE_BITS = """aggregate(sequence(0, size(small) - 1), 0L, (sum, i) -> sum + bit_count(
    big[i] ^ small[i] ^ if(size(big) > size(small), big[i + size(small)], 0L)))"""


def ceil_of(x: Column, by: int) -> Column:
    """ceil(x / by) of whole numbers."""
    up = x.cast("long") + (by - 1)
    return ((up - up % by) / by).cast("long")


def overlap_needed(a: Column, b: Column, percent: int) -> Column:
    """Least intersection of two linked sets: ceil(t / (1 + t) * (a + b))."""
    return ceil_of((a + b) * percent, 100 + percent)


def classes(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """(doc, n, d1, d2, prefix, mark): a row per document; prefix in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_slots(docs, size))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, s in batch_sets(list(zip(batch["key"], batch["h"], strict=True)), batch["text"], size):
                n = len(s)
                d1 = int(np.add.reduce(mix(s))) if n else 0
                d2 = int(np.bitwise_xor.reduce(mix(s ^ M2))) if n else 0
                keep = n - -(-n * percent // 100) + 1 if n else 0
                prefix = ordered(s, shared.value)[:keep].view(np.int64)
                out.append((key[0], key[1], n, d1 - (1 << 64) * (d1 >> 63), d2 - (1 << 64) * (d2 >> 63), prefix, mark_of(s), wide_mark_of(s)))
            yield pd.DataFrame(out, columns=["key", "h", "n", "d1", "d2", "prefix", "mark", "wide"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInPandas(run, f"key {kind}, h long, n long, d1 long, d2 long, "
                               "prefix array<long>, mark array<long>, wide array<long>")


def packed_texts(docs: DataFrame, who: DataFrame) -> DataFrame:
    """(id, packed): the compressed text of each class in ``who`` (id, key, h)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = (t.as_buffer() if t.is_valid else b"" for t in part.column("text"))
                packed = pa.array([press.compress(t) for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("h"), packed], names=["key", "h", "packed"])

    kind = docs.schema["key"].dataType.simpleString()
    packed = docs.select("key", "h", "text").mapInArrow(pack, f"key {kind}, h long, packed binary")
    return stored(packed.join(who, ["key", "h"]).dropDuplicates(["key", "h"]).select("id", "packed"))


def compared(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, b, o, na, nb): the overlap of each pair, from whole texts (id, packed).

    Every ``b`` is sent once to each task that compares it, ahead of its pairs, however many
    they are; a large family is dealt over several tasks.
    """
    asked = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    held = texts.join(asked, "id", "left_semi")
    turns = pairs.groupBy("b").agg(F.expr(f"1 + count(1) div {FAMILY}").alias("turns"))
    dealt = pairs.select("a", "b").join(turns, "b").withColumn("turn", F.expr("pmod(xxhash64(a), turns)"))
    leaders = dealt.select("b", "turn").distinct().join(held.withColumnRenamed("id", "b"), "b")
    others = dealt.select("b", "turn", "a").join(held.withColumnRenamed("id", "a"), "a")
    rows = leaders.select("b", "turn", F.lit(None).cast("long").alias("a"), "packed").unionByName(others)
    rows = rows.repartition("b", "turn").sortWithinPartitions("b", "turn", F.col("a").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        leader, own = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, SOME_TEXTS):
                part = batch.slice(at, SOME_TEXTS)
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                raw = [press.decompress(t.as_buffer()) for t in part.column("packed")]
                out = []
                for i, s in batch_sets_of(raw, size):
                    if a[i] is None:
                        leader, own = b[i], s
                    else:
                        assert leader == b[i]
                        out.append((a[i], leader, len(np.intersect1d(s, own, assume_unique=True)), len(s), len(own)))
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(out, columns=["a", "b", "o", "na", "nb"], dtype="int64"), preserve_index=False)

    return rows.select("b", "a", "packed").mapInArrow(run, "a long, b long, o long, na long, nb long")


def batch_sets_of(texts: list[bytes], size: int) -> Iterator[tuple[int, np.ndarray]]:
    for those, part in blocks(enumerate(texts), BLOCK):
        yield from zip(those, shingle_sets(part, size), strict=True)


def linked(table: DataFrame, percent: int) -> DataFrame:
    return table.filter(100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o")))


def class_links(docs: DataFrame, reps: DataFrame, percent: int, size: int) -> DataFrame:
    """Links (a, b) between class ids that connect every group of classes; deletes the table ``reps``."""
    entries = reps.select("id", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    n, pos, n2, pos2 = (F.col(c) for c in ("n", "pos", "n2", "pos2"))
    # A smaller set needs to be indexed by fewer shingles than it is probed with.
    short = pos <= n - ceil_of(n * (2 * percent), 100 + percent)
    lane = Window.partitionBy("token").orderBy(F.when(short, 0).otherwise(1), "n", "id")
    indexed = entries.select(
        "*", F.first(F.struct("id", "n", "pos")).over(lane).alias("lead"), F.lead("id").over(lane).alias("next"),
    ).filter((F.col("lead.id") != F.col("id")) | F.col("next").isNotNull()).select(
        "token", "id", "n", "pos", F.col("lead.id").alias("id2"), F.col("lead.n").alias("n2"),
        F.col("lead.pos").alias("pos2"),
    )
    # The filter on the share is on the window's key, so it goes below the window and its shuffle.
    crowded = stored(*[indexed.filter(F.pmod("token", F.lit(PASSES)) == turn) for turn in range(PASSES)])
    texts = packed_texts(docs, reps.join(crowded.select("id").distinct(), "id", "left_semi").select(
        "id", F.col("who.k.key").alias("key"), F.col("who.h").alias("h")))

    def near(n: Column, pos: Column, n2: Column, pos2: Column) -> Column:
        """Sizes and, at the first common shingle, what follows in both sets allow a link."""
        room = F.least(n - pos, n2 - pos2)
        short2 = pos2 <= n2 - ceil_of(n2 * (2 * percent), 100 + percent)
        return short2 & (n2 <= n) & (100 * n2 >= percent * n) & (room >= overlap_needed(n, n2, percent))

    marks = stored(reps.select("id", "n", "mark", "wide").join(crowded.select("id").distinct(), "id", "left_semi"))
    dropped(reps)

    def possible(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose marks allow a link."""
        both = pairs.join(marks.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("mark").alias("ma")), "a")
        both = both.join(marks.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("mark").alias("mb")), "b")
        differ = sum(
            (F.bit_count(F.col("ma")[i].bitwiseXOR(F.col("mb")[i])) for i in range(MARK_BITS // 64)), F.lit(0))
        room = F.col("na") + F.col("nb") - 2 * overlap_needed(F.col("na"), F.col("nb"), percent)
        return both.filter(differ <= room).select(*pairs.columns)

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose wide marks allow a link; the marks of long sets are wide enough to tell."""
        both = pairs.join(marks.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("wide").alias("wa")), "a")
        both = both.join(marks.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("wb")), "b")
        larger = F.size("wa") >= F.size("wb")
        both = both.withColumn("big", F.when(larger, F.col("wa")).otherwise(F.col("wb"))).withColumn(
            "small", F.when(larger, F.col("wb")).otherwise(F.col("wa")))
        room = F.col("na") + F.col("nb") - 2 * overlap_needed(F.col("na"), F.col("nb"), percent)
        return both.filter(F.expr(WIDE_BITS) <= room).select("a", "b")

    def ask(met: DataFrame, by: list[str], before: DataFrame | None) -> DataFrame:
        """Answers for each entry and the leader that it meets in most lists; ``met`` (a, b, c, ...)."""
        if before is not None:
            met = met.join(before.select("a", "b"), ["a", "b"], "left_anti")
        best = possible(met).groupBy(*by).agg(F.max(F.struct("c", "b", "a")).alias("best"))
        pairs = stored(likely(best.select(F.col("best.a").alias("a"), F.col("best.b").alias("b")).distinct()))
        found = stored(compared(pairs, texts, size))
        dropped(pairs)
        return found

    def mixed_rows(rows: DataFrame, group: DataFrame) -> DataFrame:
        """Entries with their groups, of lists whose entries are in several groups.

        Groups only grow, so a list that is left out once needn't be looked at again.
        """
        placed = rows.drop("component").join(group, "id", "left").withColumn(
            "component", F.coalesce("component", "id"))
        mixed = placed.groupBy("token").agg(
            F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
        return stored(placed.join(mixed.select("token"), "token", "left_semi"))

    def other_leaders(rows: DataFrame, turn: int) -> DataFrame:
        """(a, b, who, seed, c): entries and leaders, by a hash of the round, of other groups.

        Entries that are in the group of their list's first leader, mostly the largest, don't ask.
        """
        seed = F.pmod(F.xxhash64(F.lit(turn), "id"), F.lit(LEADERS[turn])).alias("seed")
        by_hash = F.struct(F.xxhash64("id", F.lit(turn)).alias("o"), "id", "n", "pos", "component")
        leads = rows.filter(short).groupBy("token", seed).agg(F.min(by_hash).alias("lead"))
        main = leads.groupBy("token").agg(F.min(F.struct("lead.o", "lead.component")).alias("main"))
        met = rows.drop("id2", "n2", "pos2").join(main, "token").filter(
            F.col("component") != F.col("main.component")).join(leads, "token")
        met = met.select("id", "n", "pos", "component", "seed", F.col("lead.id").alias("id2"), F.col("lead.n").alias(
            "n2"), F.col("lead.pos").alias("pos2"), F.col("lead.component").alias("component2"))
        larger = (n > n2) | ((n == n2) & (F.col("id") > F.col("id2")))
        return met.filter(
            (F.col("component") != F.col("component2"))
            & F.when(larger, near(n, pos, n2, pos2)).otherwise(near(n2, pos2, n, pos))
        ).groupBy(
            F.when(larger, F.col("id")).otherwise(F.col("id2")).alias("a"),
            F.when(larger, F.col("id2")).otherwise(F.col("id")).alias("b"), F.col("id").alias("who"), "seed",
        ).agg(F.count(F.lit(1)).alias("c"))

    first = crowded.filter((F.col("id") != F.col("id2")) & near(n, pos, n2, pos2)).groupBy(
        F.col("id").alias("a"), F.col("id2").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    answers = led = ask(first, ["a"], None)  # led has the overlaps, answers what was asked so far
    group = components(linked(answers, percent).select("a", "b"))
    rows = mixed_rows(crowded, group)
    dropped(crowded)
    for turn in range(len(LEADERS)):
        found = ask(other_leaders(rows, turn), ["who", "seed"], answers)
        asked, links = found.count(), linked(found, percent).count()
        if links:
            stars = group.select(F.col("id").alias("a"), F.col("component").alias("b"))
            group, old = components(stars.union(linked(found, percent).select("a", "b"))), group
            dropped(old)
            rows, old = mixed_rows(rows, group), rows
            dropped(old)
        both = stored(answers.select("a", "b").union(found.select("a", "b")))
        dropped(found, *([] if answers is led else [answers]))
        answers = both
        if LINK_SHARE * links <= asked:
            break
    first_links = group.select(F.col("id").alias("a"), F.col("component").alias("b"))
    known = led.select(F.col("a").alias("id"), F.col("b").alias("id2"), "o")
    open_lists = stored(rows.select("token", "id", "n", "pos", "id2", "component").join(
        known, ["id", "id2"], "left").withColumn(
        "o", F.when(F.col("id") == F.col("id2"), F.col("n").cast("long")).otherwise(F.col("o"))))
    # Blocks by size: linked sets lie in the same block or in neighbours.
    block = F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    probe = open_lists.select("*", F.explode(F.array(block, block - 1, block - 2)).alias("block"))
    index = open_lists.filter(short).select(
        "token", block.alias("block"), *[F.col(c).alias(c + "_y") for c in ("id", "n", "pos", "component", "o")])
    need = overlap_needed(n, F.col("n_y"), percent)
    most = F.least(F.col("o") + F.col("n_y") - F.col("o_y"), F.col("o_y") + n - F.col("o"))
    left = probe.join(index, ["token", "block"]).filter(
        (F.col("component") != F.col("component_y"))
        & ((n > F.col("n_y")) | (F.col("id") > F.col("id_y")))
        & near(n, pos, F.col("n_y"), F.col("pos_y"))
        & (most.isNull() | (most >= need))
    ).select(F.col("id").alias("a"), F.col("id_y").alias("b")).distinct()
    left = stored(likely(possible(left.join(answers.select("a", "b"), ["a", "b"], "left_anti"))))
    more = linked(compared(left, texts, size), percent).select("a", "b")
    links = stored(first_links.union(more))
    dropped(texts, marks, rows, led, answers, group, open_lists, left)
    return links


def placed_rows(base: DataFrame, percent: int, size: int) -> tuple[DataFrame, DataFrame]:
    """Rows (k, h, n, d1, d2) of ``base``, and per set (d1, d2, n) the first row ``name`` of its group."""
    named = F.struct((F.col("h") < NO_ID).alias("has"), "key")
    made = stored(classes(base, percent, size).withColumn("k", named).drop("key"))
    who = F.struct("k", "h")
    # One row per class carries its prefix and mark; what follows never reads them from all rows again.
    reps = stored(made.filter("n > 0").groupBy("d1", "d2", "n").agg(
        F.min(who).alias("who"), F.min_by(F.struct("prefix", "mark", "wide"), who).alias("own")).select(
        "d1", "d2", "n", "who", "own.*", F.monotonically_increasing_id().alias("id")))
    slim, sets = stored(made.select("k", "h", "n", "d1", "d2")), stored(reps.select("id", "d1", "d2", "n", "who"))
    dropped(made)
    links = class_links(base, reps, percent, size)
    group = components(links)
    placed = sets.join(group, "id", "left").withColumn("component", F.coalesce("component", "id"))
    names = placed.groupBy("component").agg(F.min("who").alias("name"))
    named = stored(placed.join(names, "component").select("d1", "d2", "n", "name"))
    dropped(links, group, sets)
    return slim, named


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = SHINGLE,
) -> DataFrame:
    """Every row with its set size and ``component_id``, the least key reachable by links."""
    with short_lived_shuffles(docs.sparkSession), small_batches(docs.sparkSession):
        made, sets = placed_rows(rows_of(docs, id_column, text), percent, size)
    name = F.coalesce("name.k", "k")  # rows without words name themselves
    return made.join(sets, ["d1", "d2", "n"], "left").select(
        F.when(F.col("k.has"), F.col("k.key")).alias(id_column), F.col("n").alias("n_shingles"),
        F.when(name["has"], name["key"]).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT,
             size: int = SHINGLE) -> DataFrame:
    """One row of each group, its first by id; rows without words stay.

    Rows are told apart by id and text, so a repeated id loses only the texts that have a copy
    elsewhere, and of rows equal in both one stays.
    """
    with short_lived_shuffles(docs.sparkSession), small_batches(docs.sparkSession):
        made, sets = placed_rows(rows_of(docs, id_column, text), percent, size)
    same = (F.col("name.k") == F.col("k")) & (F.col("name.h") == F.col("h"))
    stays = made.join(sets, ["d1", "d2", "n"], "left").filter((F.col("n") == 0) | same).select(
        F.col("k.key").alias("__key"), F.col("h").alias("__h"), (F.col("n") == 0).alias("__bare")).distinct()
    key, h = row_name(docs, id_column, text)
    marked = docs.select(F.struct(*docs.columns).alias("__row"), key.alias("__key"), h.alias("__h")).join(
        stays, ["__key", "__h"])
    once = marked.filter("NOT __bare").dropDuplicates(["__key", "__h"])
    return marked.filter("__bare").unionByName(once).select("__row.*")
