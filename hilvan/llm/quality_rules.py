"""Quality rules as a short-circuit cascade, in built-in functions only.

Each rule rejects a text by a few counts. The cascade runs the rules one after another and
stops at the first rejection; their order comes from a sample: rules with the highest
rejection per cost go first. The order changes the work, never the verdict.

Defined cases: a null text has no words and fails the base; so does an empty one. Words are
parted by space, tab, line feed, vertical tab, form feed and carriage return. Repeated rows
are judged one by one. Input columns of any name are kept as they are: while rules run, a
row's own columns are held in one struct.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = ("\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


def dropped(text: Column, characters: str) -> Column:
    return reduce(lambda c, x: F.replace(c, F.lit(x), F.lit("")), characters, text)


def spaced(text: Column) -> Column:
    return reduce(lambda c, x: F.replace(c, F.lit(x), F.lit(" ")), WHITE, F.coalesce(text, F.lit("")))


def words(text: Column) -> Column:
    return F.array_remove(F.split(spaced(text), " ", -1), "")


def word_chars(text: Column) -> Column:
    return F.char_length(F.replace(spaced(text), F.lit(" "), F.lit(""))).cast("long")


def count_of(text: Column, characters: str) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return (F.octet_length(whole) - F.octet_length(dropped(whole, characters))).cast("long")


def with_lines(work: DataFrame, alive: Column) -> DataFrame:
    filled = F.filter(
        F.split(F.coalesce(F.col("t"), F.lit("")), "\n", -1),
        lambda x: F.btrim(x, F.lit(" " + "".join(WHITE))) != "",
    )
    return work.withColumn("lines", F.when(alive, filled)).withColumns({
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
    }).drop("lines")


def with_repeats(work: DataFrame, alive: Column) -> DataFrame:
    """``n_repeat_words``: words inside 3-word windows that occur twice or more.

    Windows are compared by their 64-bit hashes. Texts whose windows all differ end after
    one hash set; only the others sort their windows, where equal ones are neighbours.
    """
    hashes = F.transform(
        F.col("w"), lambda x, i: F.xxhash64(x, F.get(F.col("w"), i + 1), F.get(F.col("w"), i + 2))
    )
    work = work.withColumn("h", F.when(alive & (F.size("w") > 3), F.slice(hashes, 1, F.size("w") - 2)))
    again = F.size(F.array_distinct("h")) < F.size("h")
    placed = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    work = work.withColumn("s", F.when(again, placed))
    at = lambda i: F.get(F.col("s"), i)["h"]
    equal = F.filter("s", lambda x, i: F.coalesce(x["h"] == at(i - 1), F.lit(False))
                     | F.coalesce(x["h"] == at(i + 1), F.lit(False)))
    covered = F.aggregate(
        F.sort_array(F.transform(equal, lambda x: x["p"])),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(
            (p + 3).alias("end"), (a["n"] + (p + 3 - F.greatest(p, a["end"]))).cast("long").alias("n")
        ),
        lambda a: a["n"],
    )
    return work.withColumn(
        "n_repeat_words", F.when(alive, F.when(F.col("s").isNull(), F.lit(0).cast("long")).otherwise(covered))
    ).drop("h", "s")


def with_count(work: DataFrame, name: str, alive: Column) -> DataFrame:
    """Adds a count of the columns t (text) and w (its words); null where not alive."""
    if name in work.columns:
        return work
    if name in ("n_lines", "n_dup_lines"):
        return with_lines(work, alive)
    if name == "n_repeat_words":
        return with_repeats(work, alive)
    plain = {
        "n_words": lambda: F.size("w").cast("long"),
        "word_chars": lambda: word_chars(F.col("t")),
        "n_symbols": lambda: count_of(F.col("t"), SYMBOLS),
        "n_shouts": lambda: count_of(F.col("t"), "!"),
    }
    return work.withColumn(name, F.when(alive, plain[name]()))


@dataclass(frozen=True)
class Rule:
    """``counts`` names what the rule reads; ``rejects`` says no on those counts."""

    name: str
    counts: tuple[str, ...]
    rejects: Callable[[dict[str, Column]], Column]


#: Cost of one count, in passes over the bytes of the text.
COST = {
    "n_words": 6.0, "word_chars": 3.0, "n_symbols": 4.0, "n_shouts": 1.0, "n_dup_lines": 4.0, "n_lines": 4.0,
    "n_repeat_words": 30.0,
}

BASE_RULES = (
    Rule("few_words", ("n_words",), lambda c: c["n_words"] < MIN_WORDS),
    Rule("repeated_words", ("n_words", "n_repeat_words"),
         lambda c: 100 * c["n_repeat_words"] > MAX_REPEATED_PERCENT * c["n_words"]),
)

#: Symbols at one word in ten or more, shouting at every second word, words of impossible
#: mean length, and texts where more than half of the filled lines only repeat others.
METHOD_RULES = (
    Rule("symbols", ("n_words", "n_symbols"), lambda c: 10 * c["n_symbols"] > c["n_words"]),
    Rule("shouts", ("n_words", "n_shouts"), lambda c: 2 * c["n_shouts"] > c["n_words"]),
    Rule("word_length", ("n_words", "word_chars"),
         lambda c: (c["word_chars"] > 14 * c["n_words"]) | (c["word_chars"] < 2 * c["n_words"])),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda c: 2 * c["n_dup_lines"] > c["n_lines"]),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_shouts", "n_dup_lines", "n_lines", "n_repeat_words")


def counted(work: DataFrame, names: tuple[str, ...], alive: Column) -> DataFrame:
    return reduce(lambda w, name: with_count(w, name, alive), names, work)


def have(names: tuple[str, ...]) -> dict[str, Column]:
    return {k: F.col(k) for k in names}


def rule_order(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", sample_rows: int = 2000,
               seed: int = 11) -> list[Rule]:
    """Rules by rejection per cost on a sample of about ``sample_rows`` rows of ``docs``.

    Ties, and an empty sample, leave the order as given.
    """
    n = docs.count()
    sample = docs.select(F.col(text).alias("t")).sample(min(1.0, sample_rows / max(n, 1)), seed)
    flags = counted(sample.withColumn("w", words(F.col("t"))), COUNTS, F.lit(True))
    seen = flags.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(r.rejects(have(COUNTS)).cast("int")).alias(r.name) for r in rules],
    ).first()
    gain = {r.name: (seen[r.name] or 0) / max(seen["n"], 1) / sum(COST[c] for c in r.counts) for r in rules}
    return sorted(rules, key=lambda r: -gain[r.name])


def cascade(work: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``alive``: no rule rejects. Later counts aren't made for rows already rejected."""
    work = work.withColumn("alive", F.lit(True))
    for rule in rules:
        work = counted(work, rule.counts, F.col("alive"))
        # The row number keeps the steps apart: else the optimizer copies each verdict into
        # every later one, and plans grow by powers.
        step = F.monotonically_increasing_id() >= 0
        work = work.withColumn(
            "alive", F.col("alive") & ~F.coalesce(rule.rejects(have(rule.counts)), F.lit(True)) & step)
    return work


def quality_counts(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its counts, ``base_failed`` and ``kept``."""
    work = docs.select(F.col(id_column), F.col(text).alias("t"), words(F.col(text)).alias("w"))
    work = counted(work, COUNTS, F.lit(True))
    c = have(COUNTS)
    failed = BASE_RULES[0].rejects(c) | BASE_RULES[1].rejects(c)
    return cascade(work, rule_order(docs, METHOD_RULES, text)).select(
        id_column, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("alive")).alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with the columns of ``docs``."""
    order = rule_order(docs, BASE_RULES + METHOD_RULES, text)
    work = docs.select(F.struct("*").alias("row"), F.col(text).alias("t"), words(F.col(text)).alias("w"))
    return cascade(work, order).filter("alive").select("row.*")
