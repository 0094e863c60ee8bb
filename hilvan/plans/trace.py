"""Trace text to element rows, and the anomalies of each trace.

A trace is a long ordered text. What the next line needs to know of earlier lines (the
strand, the cable, the open building) is carried forward chunk by chunk, so a trace is
not bound to one task; a trace of few lines is one chunk. A splice is written when a building came since the last splice or
the strand differs from that of the last named splice; that rule needs no recursion,
since after every named splice, written or not, the last written strand is its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hilvan.functions import rules as R
from hilvan.functions.text import blank, loose_date, null_if_empty, once, strip, text_or_empty
from hilvan.operators.groups import (
    PART_BYTES,
    first_part,
    majority,
    order_struct,
    ordered_text,
)
from hilvan.operators.ordered import carry_forward, collapse_repeats, previous_value
from hilvan.session import cut_lineage

LINES_PER_CHUNK = 50_000

# Steps within a line, and after the last line.
CLOSED, CLOSED_AT_ONCE, SPLICE = 0, 1, 2
FORCED_SPLICE, OPEN_AT_END, INITIAL = 10, 11, 12


# Nested brackets up to this depth are matched by one pattern, deeper ones bracket by bracket.
PATTERN_DEPTH = 16


def _closed_text() -> str:
    """Pattern of the text up to the bracket that closes it; possessive, so it reads a line once."""
    text = r"[^()]*+"
    for _ in range(PATTERN_DEPTH):
        text = rf"[^()]*+(?:\({text}\)[^()]*+)*+"
    return rf"^({text})\)"


def inside_brackets(line: Column, marker: str) -> Column:
    """Text from the bracket right after the first ``marker`` to the one that closes it.

    Brackets may be nested to any depth. '' without the marker or without a closing bracket.
    """
    opening = marker + "("
    at = F.locate(opening, line)
    rest = F.when(at > 0, F.substring(line, at + len(opening), F.length(line)))
    pattern = _closed_text()

    def closed(rest: Column) -> Column:
        found = F.regexp_extract(rest, pattern, 1)
        opened = F.length(rest) - F.length(F.replace(rest, F.lit("("), F.lit("")))
        # Nothing is nested deeper than there are opening brackets.
        return F.when(rest.isNull(), "").when((opened <= PATTERN_DEPTH) | (found != ""), found).otherwise(_closed_deep(rest))

    return once(rest, closed)


def _closed_deep(rest: Column) -> Column:
    """The same text at any depth: the depth is a running sum over the brackets, read once."""
    # Brackets in order, and the lengths of the texts before each of them.
    marks = F.regexp_extract_all(rest, F.lit("([()])"), F.lit(1))
    texts = F.transform(F.split(rest, "[()]", -1), F.length)
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("length"), F.lit(-1).alias("end"))

    def step(state: Column, one: Column) -> Column:
        depth = state["depth"] + F.when(one["mark"] == "(", 1).otherwise(-1)
        length = state["length"] + one["text"]
        return F.struct(
            depth.alias("depth"), (length + 1).alias("length"),
            F.when((state["end"] < 0) & (depth == 0), length).otherwise(state["end"]).alias("end"),
        )

    brackets = F.filter(F.arrays_zip(marks.alias("mark"), texts.alias("text")), lambda one: one["mark"].isNotNull())
    end = F.aggregate(brackets, start, step)["end"]
    return F.when(end >= 0, F.substring(rest, F.lit(1), end)).otherwise("")


def _pick(line: Column, pattern: str, group: int = 1) -> Column:
    return null_if_empty(F.regexp_extract(line, pattern, group))


def fibre_number(line: Column) -> Column:
    """Digits after the first ':' of a line, when a ')' follows."""
    return _pick(line, r"^[^:]*:\s*(\d+)[^)]*\)")


def cable_label(line: Column) -> Column:
    """'(48h) | id' of a 'Cable de FO (Ductado 48h, 'id')', null unless both are there."""

    def label(content: Column) -> Column:
        strands = null_if_empty(strip(F.regexp_extract(content, r"Ductado ([^h]*)h", 1)))
        cable = _pick(content, r"^[^']*'([^']*)'")
        return F.when(content != "", F.concat(F.lit("("), strands, F.lit("h) | "), cable))

    return once(inside_brackets(line, "Cable de FO "), label)


def building_label(line: Column) -> Column:
    """Quoted name after 'Edificio', with '(ED) ' in front unless the line has 'NODO'."""
    pattern = r"Edificio[^']*'([^']*)'"
    name = F.regexp_extract(line, pattern, 1)
    return F.when(
        line.rlike(pattern),
        F.when(line.contains("NODO"), null_if_empty(name)).otherwise(F.concat(F.lit("(ED) "), name)),
    )


def splice_label(line: Column) -> Column:
    """'(EM 2) | id' or '(EM CL) | id'."""
    client = r"^[^,]*,[^']*'([^']*)'"
    typed = r"Tipo (\d*)[^,]*,[^']*'([^']*)'"

    def label(content: Column) -> Column:
        return (
            F.when(content == "", None)
            .when(
                content.contains("Empalme Cliente"),
                F.when(content.rlike(client), F.concat(F.lit("(EM CL) | "), F.regexp_extract(content, client, 1))),
            )
            .when(
                content.rlike(typed),
                F.concat(
                    F.lit("(EM "), F.regexp_extract(content, typed, 1), F.lit(") | "),
                    F.regexp_extract(content, typed, 2),
                ),
            )
        )

    return once(inside_brackets(line, "at Empalme de Fibra "), label)


def port_label(line: Column) -> Column:
    """Rack, subrack, bay, shelf, card and port of a line, joined ', '; null when none."""
    words = ("Rack", "Subrack", "Bay", "Shelf", "Card", "Port")
    found = [
        F.when(line.contains(f"{w} ("), null_if_empty(strip(F.regexp_extract(line, rf"{w} \(([^)]*)\)", 1)))) for w in words
    ]
    return null_if_empty(F.concat_ws(", ", *found))


def trace_elements(
    lines: DataFrame,
    file: str = "file_path",
    order: Sequence[str] = ("line_no",),
    chunk: Sequence[Column] | None = None,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Rows ``(file, order…, step, part, elemento, cable, hilo)`` of every trace.

    ``lines`` has the file, the order columns and ``line``. ``chunk`` never decreases
    along the order and defaults to ranges of line numbers. Rows that close a trace have
    null order columns and steps from 10 on. A row lists the ports of its building up to
    part 0 of their list (``part`` says so); :func:`trace_port_lists` has all parts.
    """
    return _trace(lines, file, order, chunk, part_bytes)[0]


def trace_port_lists(
    lines: DataFrame,
    file: str = "file_path",
    order: Sequence[str] = ("line_no",),
    chunk: Sequence[Column] | None = None,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """List table of the ports of every building of a trace.

    ``(file, building order…, before_strands, part, entries, puertos)``: the order columns are
    those of the building's line, null for ports that no building follows;
    ``before_strands`` marks the ports before the first strand, which come first in a cell.
    """
    order = list(order)
    lists = _trace(lines, file, order, chunk, part_bytes)[1]
    return lists.select(
        file, *[F.col("_b_at")[f"o{i}"].alias(c) for i, c in enumerate(order)],
        F.col("_is_first").alias("before_strands"), "part", "entries", "puertos",
    )


def _trace(
    lines: DataFrame, file: str, order: Sequence[str], chunk: Sequence[Column] | None, part_bytes: int
) -> tuple[DataFrame, DataFrame]:
    order = list(order)
    cuts = chunk or [F.floor(F.col(order[0]) / LINES_PER_CHUNK)]
    cut_names = [f"_chunk{i}" for i in range(len(cuts))]
    keys = [file]
    text = F.col("_text")
    at = order_struct([F.col(c) for c in order])
    # Only long traces are cut, at most one per LINES_PER_CHUNK lines of the input; the chunk of
    # the others is null, and nothing has to be carried between their chunks.
    long = lines.groupBy(F.col(file).alias("_long")).count().filter(F.col("count") > LINES_PER_CHUNK).select("_long")
    known = F.col(file).isNotNull()
    for n in cut_names:
        known = known & F.col(n).isNotNull()
    uncut = F.col(cut_names[0]).isNull()
    marked = (
        lines.select(
            file, *order, "line", strip("line").alias("_text"), *[c.alias(n) for c, n in zip(cuts, cut_names)]
        )
        .filter((F.col("_text") != "") & known)
        .join(F.broadcast(long), F.col(file) == F.col("_long"), "left")
        .withColumns({n: F.when(F.col("_long").isNotNull(), F.col(n)) for n in cut_names})
        .drop("_long")
        # The chunks are windowed below; parting the raw lines that way first spreads the parsing.
        .repartition(file, *cut_names)
        .withColumns(
            {
                "_at": at,
                "_is_fibre": text.contains("Fibre ("),
                "_is_building": text.contains("Edificio"),
                "_is_splice": text.contains("Empalme de Fibra"),
                "_is_port": text.contains("Port ("),
            }
        )
        .withColumns(
            {
                "_building": F.when(F.col("_is_building"), building_label(text)),
                "_splice": F.when(F.col("_is_splice"), splice_label(text)),
            }
        )
    )
    named = F.col("_building").isNotNull()
    marker = F.col("_is_building") | F.col("_is_splice")
    opens = named & ~F.col("_is_splice")
    # A marker line closes the building before it; a named one without splice opens its own.
    state = F.when(marker, F.struct(opens.alias("open"), F.col("_at").alias("at")))
    wait = F.when(F.col("_splice").isNotNull(), 0).when(named, 1)
    carried = carry_forward(
        marked, keys, cut_names, order,
        values={
            "_fibre": F.when(F.col("_is_fibre"), fibre_number(text)),
            "_cable": F.when(F.col("_is_fibre"), cable_label(text)),
            "_seen": F.when(F.col("_is_fibre"), F.lit(True)),
            "_now": state,
        },
        before={
            "_seen_before": F.when(F.col("_is_fibre"), F.lit(True)),
            "_prev": state,
            "_waiting": wait,
            "_prev_named": F.when(named, F.col("_at")),
        },
        whole=uncut,
    ).withColumns(
        {"_fibre": F.coalesce("_fibre", F.lit("")), "_cable": F.coalesce("_cable", F.lit(""))}
    )
    # Read by many branches below: written once instead of carried forward in each.
    carried = cut_lineage(carried)
    strand = F.concat(F.lit("H"), F.col("_fibre"))

    # Ports belong to the building that is open; ports before the first strand to the next
    # named building, or to none.
    buildings = carried.filter(named).select(
        *keys, F.col("_at").alias("_b_at"), F.col("_prev_named").alias("_b_prev"),
        F.col("_building").alias("_name"), strand.alias("_b_strand"),
        F.col("_building").contains("NODO").alias("_node"),
    )
    is_first = F.col("_seen_before").isNull()
    inside = F.col("_seen").isNotNull() & F.coalesce(F.col("_now")["open"], F.lit(False))
    ports = carried.filter(F.col("_is_port") & (is_first | inside)).select(
        *keys, *cut_names, "_at", "line", is_first.alias("_is_first"),
        F.when(is_first, F.col("_prev_named")).alias("_after"), F.when(~is_first, F.col("_now")["at"]).alias("_in"),
    )
    first_ports = ports.filter("_is_first").join(
        buildings.select(F.col(file).alias("_k_file"), "_b_at", "_b_prev"),
        (F.col(file) == F.col("_k_file")) & F.col("_after").eqNullSafe(F.col("_b_prev")), "left",
    ).select(*keys, *cut_names, "_at", "line", "_is_first", "_b_at")
    own_ports = ports.filter("NOT _is_first").select(
        *keys, *cut_names, "_at", "line", "_is_first", F.col("_in").alias("_b_at")
    )
    entries = (
        first_ports.unionByName(own_ports)
        .join(buildings.drop("_b_prev"), [*keys, "_b_at"], "left")
        .withColumn(
            "_entry",
            F.when(F.col("_is_first") | F.col("_node"), F.col("line")).otherwise(port_label(strip("line"))),
        )
        .filter("_entry IS NOT NULL")
    )
    slot = [*keys, "_b_at", "_name", "_b_strand", "_node"]
    # Of the ports before the first strand, and of a node's, whole lines are listed.
    separator = F.when(F.col("_is_first") | F.coalesce("_node", F.lit(True)), "\n").otherwise(", ")
    lists = ordered_text(
        entries, [*slot, "_is_first"], F.col("_entry"), [F.col("_at")], separator, part_bytes, "puertos"
    )
    between = F.when(F.col("_node"), "\n").otherwise(", ")
    of = lambda first: null_if_empty(F.max(F.when(F.col("_is_first") == first, F.col("puertos"))))
    texts = first_part(lists).groupBy(*slot).agg(of(True).alias("_first"), of(False).alias("_own")).withColumn(
        "_ports",
        F.coalesce(F.concat("_first", between, "_own"), F.col("_first"), F.col("_own")),
    )

    # Everything that may become a row, written once: buildings where they close, splices,
    # and what is left at the end of a trace.
    last_line = carried.groupBy(*keys).agg(
        F.max_by(F.struct(F.col("_cable").alias("cable"), F.col("_now").alias("now")), "_at").alias("_end")
    )
    no_cut = [F.lit(None).cast(t).alias(n) for n, t in carried.select(*cut_names).dtypes]
    no_order = [F.lit(None).cast(t).alias(n) for n, t in carried.select(*order).dtypes]
    placed = [*keys, *cut_names, *order]

    def event(rows: DataFrame, where: list, step: int, element, cable, hilo, write=True) -> DataFrame:
        as_col = lambda c: c if isinstance(c, Column) else F.lit(c)
        return rows.select(
            *where, F.lit(step).alias("step"), F.lit(0).cast("bigint").alias("part"),
            as_col(element).alias("elemento"), as_col(cable).alias("cable"), as_col(hilo).alias("hilo"),
            as_col(write).alias("write"),
        )

    c = F.col
    closing = carried.filter(marker & F.coalesce(c("_prev")["open"], F.lit(False))).select(
        *placed, c("_prev")["at"].alias("_b_at"), "_cable"
    )
    at_once = carried.filter(named & c("_is_splice")).select(*placed, c("_at").alias("_b_at"), "_cable")
    whole, only_first = F.concat("_name", F.lit(" | "), "_ports"), F.concat("_name", F.lit(" | "), "_first")
    splices = previous_value(
        carried.filter("_splice IS NOT NULL").select(
            *placed, "_at", "_splice", "_cable", "_fibre", "_building", "_waiting"
        ),
        keys, cut_names, order, c("_fibre"), "_last_fibre", uncut,
    )
    write = (
        c("_splice").contains("(EM CL)") | named | F.coalesce(c("_waiting") == 1, F.lit(False))
        | (c("_fibre") != F.coalesce("_last_fibre", F.lit("")))
    )
    still_open = last_line.filter(F.coalesce(c("_end")["now"]["open"], F.lit(False))).select(
        *keys, c("_end")["now"]["at"].alias("_b_at"), c("_end")["cable"].alias("_cable")
    )
    at_end = [*keys, *no_cut, *no_order]
    events = cut_lineage(
        event(closing.join(texts, [*keys, "_b_at"]), placed, CLOSED, whole, c("_cable"), c("_b_strand"))
        .unionByName(
            event(at_once.join(texts.filter("_first IS NOT NULL"), [*keys, "_b_at"]), placed, CLOSED_AT_ONCE,
                  only_first, c("_cable"), c("_b_strand"))
        )
        .unionByName(event(splices, placed, SPLICE, c("_splice"), c("_cable"), strand, write))
        .unionByName(
            event(still_open.join(texts, [*keys, "_b_at"]), at_end, OPEN_AT_END, whole, c("_cable"), c("_b_strand"))
        )
        .unionByName(
            event(texts.filter("_b_at IS NULL"), at_end, INITIAL,
                  F.concat(F.lit("NODO INICIAL | "), "_first"), "", "")
        )
    )
    row = ["elemento", "cable", "hilo"]
    met = collapse_repeats(
        events.filter(c("write") & (c("step") <= SPLICE)), keys, cut_names, [*order, "step"], row, uncut
    )

    # The last splice is written at the end if it was not, and the open building unless
    # it repeats the row before. One row per trace on every side of these joins.
    when = F.struct(*order, "step")
    last_met = met.groupBy(*keys).agg(
        F.max_by(F.struct(*row), when).alias("_last"),
        F.max(F.when(c("step") == SPLICE, at)).alias("_written_at"),
    )
    last_splice = events.filter(c("step") == SPLICE).groupBy(*keys).agg(
        F.max(at).alias("_splice_at"), F.max_by(F.struct(*row), at).alias("_spl")
    )
    ends = last_splice.join(last_met, keys, "left").withColumn(
        "_forced", ~c("_splice_at").eqNullSafe(c("_written_at"))
    )
    forced = event(
        ends.filter("_forced").select(*keys, *no_order, "_spl.*"), [*keys, *order], FORCED_SPLICE, *map(c, row)
    )
    before = last_met.join(ends.select(*keys, "_forced", "_spl"), keys, "full").select(
        *keys, F.when(c("_forced"), c("_spl")).otherwise(c("_last")).alias("_before")
    )
    final = (
        events.filter(c("step") > SPLICE).join(before, keys, "left")
        .filter((c("step") != OPEN_AT_END) | ~c("_before").eqNullSafe(F.struct(*row)))
        .drop("_before")
    )
    out = [*keys, *order, "step", "part", *row]
    return met.select(*out).unionByName(forced.select(*out)).unionByName(final.select(*out)), lists


# --- anomalies -------------------------------------------------------------------------

BAD_TRACE = "TRAZE ERRONEO"
NO_OWNER = "SIN RESPONSABLE"


def element_kind(element: Column | str) -> Column:
    """'ED', 'OB', 'EA' or 'ET' of an element row, else null."""
    e = F.col(element) if isinstance(element, str) else element
    return (
        F.when(is_client(e), "ED")
        .when(e.contains("(EM CL)"), "OB")
        .when(e.contains("(EM") & e.contains("EA"), "EA")
        .when(e.contains("(EM") & e.contains("ET"), "ET")
    )


def is_client(element: Column) -> Column:
    return element.contains("ED:") | element.contains("(ED)")


def strand_anomalies(elements: DataFrame, file: str, order: Sequence[str]) -> DataFrame:
    """``(file, level, first, message)``: strands with clients and no or too few terminals.

    Counts per (cable, strand) are plain aggregates; ``first`` is where the strand first
    occurs and ``level`` puts missing terminals before multiple elements.
    """
    at = order_struct([F.col(c) for c in order])
    counts = (
        elements.withColumn("_kind", element_kind("elemento"))
        .filter("_kind IS NOT NULL")
        .groupBy(file, "cable", "hilo")
        .agg(
            F.count_if(F.col("_kind") == "ED").alias("_ed"), F.count_if(F.col("_kind") == "OB").alias("_ob"),
            F.min(at).alias("first"),
        )
    )
    cable = F.when(
        F.col("cable").contains("|"), strip(F.regexp_replace("cable", r"^[^|]*\|", ""))
    ).otherwise(F.col("cable"))
    missing = F.concat(F.lit("(FALTA OB "), cable, F.lit(", "), "hilo", F.lit(")"))
    multiple = F.concat(
        F.lit("MULTIPLES ELEMENTOS "), F.col("_ed").cast("string"), F.lit(" , ("), cable, F.lit(", "), "hilo", F.lit(")")
    )
    return counts.select(
        file, F.when(F.col("_ob") == 0, 1).otherwise(2).alias("level"), "first",
        F.when((F.col("_ed") > 0) & (F.col("_ob") == 0), missing)
        .when((F.col("_ob") > 0) & (F.col("_ed") > 2), multiple)
        .alias("message"),
    ).filter("message IS NOT NULL")


def file_counts(elements: DataFrame, file: str) -> DataFrame:
    """Clients, strand splices and node rows per trace."""
    e = F.col("elemento")
    return elements.groupBy(file).agg(
        F.count_if(is_client(e)).alias("clientes"),
        F.count_if(e.contains("ET") & e.contains("(EM")).alias("empalmes_et"),
        F.count_if(e.contains("NODO")).alias("nodos"),
    )


def ring_of_file(stem: Column | str) -> Column:
    """Third part of a file name split at '_', else the whole name; upper case."""
    name = F.col(stem) if isinstance(stem, str) else stem
    parts = F.split(name, "_")
    return F.upper(strip(F.when(F.size(parts) >= 3, F.get(parts, 2)).otherwise(name)))


def ring_owners(sheet: DataFrame) -> DataFrame:
    """Owner and client count per ring; the newest date wins, the first row on a tie.

    ``sheet``: anillo, responsable, total_clientes, fecha, seq.
    """
    total = text_or_empty("total_clientes")
    usable = F.regexp_replace(total, r"^([^.]*)\.", "$1").rlike(r"^\d+$")
    rows = sheet.filter(~blank("anillo")).select(
        F.upper(strip("anillo")).alias("anillo"), text_or_empty("responsable").alias("responsable"),
        F.when(usable, total).otherwise("").alias("total_clientes"),
        loose_date("fecha").alias("_date"), "seq",
    ).withColumn("_date", F.coalesce("_date", F.lit("0001-01-01").cast("date")))
    return rows.groupBy("anillo").agg(
        F.max_by(F.struct("responsable", "total_clientes"), F.struct("_date", -F.col("seq"))).alias("_r")
    ).select("anillo", "_r.responsable", "_r.total_clientes")


def trace_report(
    files: DataFrame, elements: DataFrame, owners: DataFrame, order: Sequence[str] = ("line_no", "step", "part"),
    part_bytes: int = PART_BYTES, only_faults: bool = True,
) -> DataFrame:
    """``(archivo, hoja, estado, parte)``, one row per trace that is not OK.

    ``files``: file_path, folder, stem, one row per trace. The file name carries the most
    frequent owner of the folder's rings (ties by name; an empty owner can win). The state
    holds part 0 of the trace's messages (``parte`` says so); :func:`state_lists` has all.
    """
    whole, both = _states(files, elements, owners, order)
    state = first_part(state_lists(both, part_bytes))
    name = F.when(F.col("_usual") == "", F.concat("folder", F.lit(".xlsx"))).otherwise(
        F.concat("folder", F.lit("_"), "_usual", F.lit(".xlsx"))
    )
    rows = whole.join(state, "file_path", "left").select(
        name.alias("archivo"), F.col("stem").alias("hoja"),
        F.coalesce("estado", F.lit("OK")).alias("estado"), F.lit(0).cast("bigint").alias("parte"),
    )
    return rows.filter("estado <> 'OK'") if only_faults else rows


def state_lists(messages: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """List table of the messages of every trace in order: file_path, part, entries, estado."""
    return ordered_text(
        messages, ["file_path"], F.col("message"), [F.col("level"), F.col("first")], " | ", part_bytes, "estado"
    )


def trace_messages(
    files: DataFrame, elements: DataFrame, owners: DataFrame, order: Sequence[str] = ("line_no", "step", "part")
) -> DataFrame:
    """(file_path, level, first, message) of every trace, its own messages and its strands'."""
    return _states(files, elements, owners, order)[1]


def _states(
    files: DataFrame, elements: DataFrame, owners: DataFrame, order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    elements = cut_lineage(elements)  # counted per trace and per strand below
    placed = files.withColumn("anillo", ring_of_file("stem")).join(owners, "anillo", "left").withColumns(
        {"responsable": F.coalesce("responsable", F.lit("")), "total_clientes": F.coalesce("total_clientes", F.lit(""))}
    )
    rings = placed.select("folder", "anillo", "responsable").distinct()
    usual = majority(rings, ["folder"], "responsable", ["responsable"]).select(
        "folder", F.col("majority").alias("_usual")
    )
    counted = placed.join(file_counts(elements, "file_path"), "file_path", "left").na.fill(
        0, ["clientes", "empalmes_et", "nodos"]
    )
    nodes = counted.groupBy("folder").agg(F.sum("nodos").alias("_folder_nodes"))
    whole = counted.join(nodes, "folder").join(usual, "folder")
    expected = F.when(F.col("total_clientes").rlike(r"^\d+$"), F.col("total_clientes").try_cast("bigint"))
    of_file = lambda level, cond, message: F.struct(
        F.lit(level).alias("level"), F.when(cond, message).alias("message")
    )
    mismatch = R.text("NCLIENTES (TZ:", F.col("clientes"), ", RESP:", expected, ")")
    fixed = F.array(
        of_file(0, F.col("empalmes_et") == 0, F.lit(BAD_TRACE)),
        of_file(3, F.col("responsable") == "", F.lit(NO_OWNER)),
        of_file(4, expected != F.col("clientes"), mismatch),
        of_file(5, F.col("_folder_nodes") == 0, F.lit(BAD_TRACE)),
    )
    own = whole.select("file_path", F.explode(fixed).alias("_m")).select("file_path", "_m.level", "_m.message").filter(
        "message IS NOT NULL"
    )
    found = strand_anomalies(elements, "file_path", order)
    return whole, found.unionByName(own, allowMissingColumns=True)


def missing_files(files: DataFrame, owners: DataFrame) -> DataFrame:
    """Rings that have an owner but no trace."""
    present = files.select(ring_of_file("stem").alias("anillo")).distinct()
    return owners.join(present, "anillo", "left_anti").select(
        F.col("anillo").alias("archivo"), F.lit("responsable").alias("hoja"), F.lit("FALTA ARCHIVO").alias("estado"),
        F.lit(0).cast("bigint").alias("parte"),
    )
