"""Ordered text lines: trace files, change files and sheets saved as CSV."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hilvan.functions.text import (
    blank,
    clean_port,
    equipment_name,
    literal_regex,
    null_if_empty,
    panel_number,
    ring_from_origin,
    strip,
)

FILE_KEY = ["file_path"]


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def read_lines(
    spark: SparkSession, path: str | Sequence[str], pattern: str | None = None,
    recursive: bool = True,
) -> DataFrame:
    """``(file_path, file, folder, line_no, line)`` with the true line number.

    Big files are read in blocks. Row ids grow within a block, so a line number is the
    lines of earlier blocks (a slim table, one row per block) plus the place in its own
    block. No file has to fit into one task.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    raw = reader.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.regexp_replace("value", "^﻿", "").alias("line"),
    )
    earlier = (
        Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        raw.groupBy("file_path", "_block")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_low"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    return raw.join(blocks, ["file_path", "_block"]).select(
        "file_path", "file",
        F.try_element_at(F.split("file_path", "/"), F.lit(-2)).alias("folder"),
        (F.col("_before") + F.col("_id") - F.col("_low") + 1).alias("line_no"),
        "line",
    )


def read_trace(
    spark: SparkSession, path: str, exclusions: DataFrame | None = None, pattern: str = "*.txt"
) -> DataFrame:
    """Trace lines without the folders and files named in ``exclusions(name)``."""
    lines = read_lines(spark, path, pattern).withColumn("stem", file_stem(F.col("file")))
    if exclusions is None:
        return lines
    names = exclusions.select(strip("name").alias("_name")).filter("_name <> ''").distinct()
    return lines.join(names, F.col("folder") == F.col("_name"), "left_anti").join(
        names, F.col("stem") == F.col("_name"), "left_anti"
    )


#: One CSV cell and the comma after it; a quoted cell may hold commas and doubled quotes.
CELL = r'([ \t]*+"[^"]*+(?:""[^"]*+)*+"[ \t]*+|[^,]*+),'


def cells(line: Column) -> Column:
    """Raw cells of one CSV line, as many as it has."""
    return F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(CELL), F.lit(1))


def cell_text(cell: Column) -> Column:
    """Trimmed text of a raw cell without its quotes; null when empty."""
    trimmed = strip(cell)
    inner = F.replace(F.regexp_extract(trimmed, r'(?s)^"(.*)"$', 1), F.lit('""'), F.lit('"'))
    return null_if_empty(F.when(trimmed.startswith('"') & trimmed.endswith('"') & (F.length(trimmed) > 1), strip(inner)).otherwise(trimmed))


# First row of data, rows and columns searched for headers, header words by column.
DATA_STARTS_AT = 7
HEADER_ROWS = 10
SEARCHED_COLUMNS = 6
HEADER_WORDS = (
    ("puerto", ("puerto", "interfaz", "port")),
    ("odf", ("odf",)),
    ("cassetera", ("cassetera", "cassette")),
    ("pos", ("pos", "posición")),
)


def _header_places(seen: Column) -> Column:
    """Column index of each wanted header among the first cells of a file.

    Cells are visited in reading order; a cell serves the first wanted header that it
    names and that is still open. At most 60 short cells per file.
    """
    start = F.struct(*[F.lit(None).cast("int").alias(k) for k, _ in HEADER_WORDS])

    def visit(state: Column, cell: Column) -> Column:
        names = {k: F.rlike(cell["text"], F.lit("|".join(words))) for k, words in HEADER_WORDS}
        taken, fields = F.lit(False), []
        for k, _ in HEADER_WORDS:
            use = ~taken & state[k].isNull() & F.coalesce(names[k], F.lit(False))
            fields.append(F.when(use, cell["at"]).otherwise(state[k]).alias(k))
            taken = taken | use
        return F.struct(*fields)

    return F.aggregate(seen, start, visit)


def _positional_places(first: Column) -> Column:
    """Places when headers are missing, from the first row with data in column B."""
    numeric = lambda c: F.coalesce(F.regexp_replace(c, r"^([^.]*)\.", "$1").rlike(r"^\d+$"), F.lit(False))
    a, c = F.get(first, 0), F.get(first, 2)
    places = (
        F.when(a.isNotNull(), F.array(*[F.lit(i) for i in (2, 3, 4, 5)]))
        .when(numeric(c), F.array(*[F.lit(i) for i in (1, 2, 3, 4)]))
        .otherwise(F.array(*[F.lit(i) for i in (1, 3, 4, 5)]))
    )
    return F.struct(*[F.get(places, i).alias(k) for i, (k, _) in enumerate(HEADER_WORDS)])


def central_sheets(
    lines: DataFrame, data_starts_at: int = DATA_STARTS_AT, header_rows: int = HEADER_ROWS,
    searched_columns: int = SEARCHED_COLUMNS,
) -> DataFrame:
    """Equipment sheets: port, panel, tray and position columns found by header or place.

    ``lines`` come from :func:`read_lines`; all files of a folder at once. Headers are
    searched in the first rows and columns that the layout has for them, and only these are
    grouped; the data rows are joined with one row per file.
    """
    first_cells = F.transform(F.slice(cells(F.col("line")), 1, searched_columns), cell_text)
    rows = lines.filter(~blank("line")).withColumn("cells", first_cells)
    head = rows.filter(F.col("line_no") <= header_rows)
    cell = F.posexplode("cells").alias("at", "text")
    seen = (
        head.select("file_path", "line_no", cell)
        .filter("text IS NOT NULL")
        .groupBy("file_path")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("line_no", "at", F.lower("text").alias("text")))
            ).alias("seen")
        )
        .select("file_path", _header_places(F.col("seen")).alias("_by_header"))
    )
    data = rows.filter(F.col("line_no") >= data_starts_at)
    first = (
        data.filter(F.get("cells", 1).isNotNull())
        .groupBy("file_path")
        .agg(F.min_by("cells", "line_no").alias("_first"))
        .select("file_path", _positional_places(F.col("_first")).alias("_by_place"))
    )
    names = (
        head.filter("line_no = 2")
        .groupBy("file_path")
        .agg(equipment_name(F.max(F.get("cells", 1))).alias("_name"))
    )
    complete = F.lit(True)
    for k, _ in HEADER_WORDS:
        complete = complete & F.col("_by_header")[k].isNotNull()
    places = (
        seen.join(first, "file_path", "left")
        .withColumn("_at", F.when(complete, F.col("_by_header")).otherwise(F.col("_by_place")))
        .filter("_at IS NOT NULL")
        .join(names, "file_path", "left")
        .select("file_path", "_at", "_name")
    )
    value = lambda k: F.get("cells", F.col("_at")[k])
    return data.join(places, "file_path").select(
        F.col("file").alias("archivo"),
        F.coalesce(null_if_empty(F.col("_name")), file_stem(F.col("file"))).alias("equipo"),
        clean_port(value("puerto")).alias("puerto"),
        panel_number(value("odf")).alias("odf"),
        value("odf").alias("odf_original"),
        value("cassetera").alias("cassetera"),
        value("pos").alias("pos"),
        F.lit(None).cast("string").alias("pos2"),
        "file_path", "line_no",
    )


# Headers of a cable sheet.
CABLE_HEADERS = {
    "ec": "EC", "port_ec": "PORT_EC", "patcheo": "PATCHEO", "port_ot": "PORT_OT",
    "hilo": "HILO", "anillo_origen": "ANILLO ORIGEN", "bul": "BUL",
}


def cable_sheets(lines: DataFrame, headers: Mapping[str, str] = CABLE_HEADERS) -> DataFrame:
    """Cable sheets: rows marked ``BUL = 1`` with equipment, port or patch; fibre = file stem.

    A sheet may have any number of columns. The places of its headers, the last of equal
    ones, come from its first line that isn't blank, one row per file.
    """
    rows = lines.filter(~F.col("file").startswith("~$") & ~blank("line"))
    # Lines are joined as they are and cut into cells last: hundreds of cells weigh many times their line.
    first = rows.groupBy("file_path").agg(F.min("line_no").alias("_first"))
    head = (
        rows.join(first, "file_path").filter("line_no = _first")
        .groupBy("file_path").agg(F.min_by("line", "line_no").alias("_line"))
    )
    place = lambda name: F.max(F.when(cell_text(F.col("_cell")) == name, F.col("_at")))
    heads = (
        head.select("file_path", F.posexplode(cells(F.col("_line"))).alias("_at", "_cell"))
        .groupBy("file_path").agg(*[place(v).alias(f"_p_{k}") for k, v in headers.items()])
        .filter("_p_ec IS NOT NULL AND _p_port_ec IS NOT NULL AND _p_patcheo IS NOT NULL")
    )
    # One struct per line from an outer explode: cells are cut once, and no filter is pushed below it.
    values = F.transform(
        F.array(cells(F.col("line"))),
        lambda cut: F.struct(*[cell_text(F.get(cut, F.col(f"_p_{k}"))).alias(k) for k in headers]),
    )
    return (
        rows.filter("line_no >= 2")
        .join(heads, "file_path")
        .select("file", "file_path", "line_no", F.explode_outer(values).alias("_v"))
        .filter("_v.bul = '1'")
        .select(
            file_stem(F.col("file")).alias("fibra"),
            F.col("_v.ec").alias("ec"),
            clean_port("_v.port_ec").alias("port_ec"),
            F.col("_v.patcheo").alias("patcheo"),
            F.col("_v.port_ot").alias("odf_calle"),
            F.col("_v.hilo").alias("hilo"),
            F.col("_v.anillo_origen").alias("anillo_origen"),
            ring_from_origin("_v.anillo_origen").alias("anillo"),
            "file_path", "line_no",
        )
        .filter("ec IS NOT NULL OR port_ec IS NOT NULL OR patcheo IS NOT NULL")
    )


# Labels of a key: value file and the columns they fill.
LABELS = (
    ("IP DEMARCADOR:", "ip_demarcador"),
    ("PTO METRO:", "pto_metro"),
    ("EQUIPO:", "nemonico"),
    ("ANILLO:", "anillo"),
    ("ETIQUETA METRO:", "etiqueta_metro"),
    ("ID DE SERVICIO:", "id_servicio"),
)


def first_values(
    lines: DataFrame, file: str, order: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """One row per file: for each value the first line on which it is not null.

    A plain aggregate; files without any value stay, with ''.
    """
    at = F.struct(*order)
    return lines.groupBy(file).agg(
        *[
            F.coalesce(F.min_by(v, F.when(v.isNotNull(), at)), F.lit("")).alias(name)
            for name, v in values.items()
        ]
    )


def read_change_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, line)`` of one change file."""
    return read_lines(spark, path).select("line_no", "line")


def split_text_list(text: Column, separator: str = "\n") -> Column:
    """Items of a text list, blanks dropped."""
    return F.filter(F.split(text, literal_regex(separator)), lambda s: ~blank(s))
