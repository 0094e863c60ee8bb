"""Normalisation of inventory text. Every function maps Columns to a Column.

All of it stays on built-in expressions, so it runs inside generated code and can be
pushed next to the scan. ``None`` in gives ``None`` out unless stated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything that counts as white space at the edge of a cell, not only U+0020.
EDGE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` names it.

    Rules that name a cleaned text a dozen times otherwise clean it as often, and make
    generated methods too long for the JVM to compile.
    """
    return F.get(F.transform(F.array(value), use), 0)


def strip(c: Column | str) -> Column:
    """Trim all white space; the built-in ``trim`` removes U+0020 only.

    Trimming looks both edge characters up in the whole list of spaces. A named column whose
    edges are printable ASCII is passed on as it is; other expressions would be computed again
    for each test, so they are always trimmed.
    """
    trimmed = F.btrim(as_column(c), F.lit(EDGE_SPACE))
    if not isinstance(c, str):
        return trimmed
    value = F.col(c).cast("string")
    last = F.substring(value, -1, 1)
    clean = (value >= "!") & (value < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(clean, value).otherwise(trimmed)


def blank(c: Column | str) -> Column:
    """True for null, empty and white-space-only text; never null."""
    return F.coalesce(strip(c) == "", F.lit(True))


def text_or_empty(c: Column | str) -> Column:
    """Trimmed text, '' for null."""
    return F.coalesce(strip(c), F.lit(""))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that yields null instead of '' when nothing matches.

    For groups that cannot be empty.
    """
    return null_if_empty(F.regexp_extract(c, pattern, group))


def starts_with_any(c: Column, prefixes: Iterable[str]) -> Column:
    out = F.lit(False)
    for prefix in prefixes:
        out = out | c.startswith(prefix)
    return out


def contains_any(c: Column, parts: Iterable[str]) -> Column:
    out = F.lit(False)
    for part in parts:
        out = out | c.contains(part)
    return out


# --- identifiers ---------------------------------------------------------------------

def normalise_id(c: Column | str, numeric: bool = False) -> Column:
    """Null and '' become ''; numbers become integer text; text is trimmed."""
    text = as_column(c).cast("bigint").cast("string") if numeric else strip(c)
    return F.coalesce(text, F.lit(""))


def expand_exponent_id(c: Column | str) -> Column:
    """Ids that a spreadsheet turned into '1.2E+10' become integer text again.

    The cast to bigint of such text is null, so it goes through double and decimal.
    """
    c = as_column(c)
    value = F.when(c.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d+\s*$"), c).try_cast("double")
    whole = (value - value % 1).try_cast("decimal(38,0)").cast("string")
    return F.coalesce(whole, c)


def first_item(c: Column | str, separator: str = ",") -> Column:
    """Text before the first separator, trimmed."""
    return strip(F.substring_index(as_column(c), separator, 1))


# --- ports ---------------------------------------------------------------------------

def clean_port(c: Column | str) -> Column:
    """Keep digits, '/' and '-', drop one trailing '/', strip zeros per '/' segment.

    An empty segment reads '0'. Replacements only, so it stays in generated code.
    """
    kept = F.regexp_replace(as_column(c), "[^0-9/-]", "")
    kept = F.regexp_replace(kept, "/$", "")
    stripped = F.regexp_replace(kept, "(^|/)0+(?=[^/])", "$1")
    return F.regexp_replace(stripped, "(?<=^|/)(?=/|$)", "0")


def port_parts(c: Column | str) -> Column:
    """'XG 3/0/12' -> struct(slot, mid, number); null unless three integers.

    A number beyond 64 bits is null in its field, the others stay.
    """
    text = strip(F.regexp_replace(as_column(c), r"^[A-Z]+[\s-]?", ""))
    parts = F.split(text, "/")
    # The pattern comes first: casting text that is no number costs an exception per row.
    integer = r"\s*[+-]?\d+\s*"
    return F.when(
        text.rlike(f"^{integer}/{integer}/{integer}$"),
        F.struct(
            *[F.get(parts, i).try_cast("bigint").alias(name) for i, name in enumerate(("slot", "mid", "number"))]
        ),
    )


def ring_from_origin(c: Column | str) -> Column:
    """Ring code inside a free origin text, upper case; null when there is none."""
    text = strip(c)

    parts = F.transform(
        F.split(text, "[_/]"), lambda p: F.regexp_replace(p, r"\(.*\)", "")
    )
    usable = F.filter(
        parts,
        lambda p: (F.length(p) >= 6)
        & ~p.rlike(r"^\d+$")
        & ~p.rlike(r"^\d+\.\d+\.\d+\.\d+$"),
    )
    # A trailing part wins over a leading one; parts are cut only where no code is found.
    last_part = F.try_element_at(usable, F.lit(-1))
    found = F.upper(
        F.coalesce(
            extract(text, "((?i)ME[A-Z0-9]{4,})"), extract(text, "((?i)[A-Z]{2}[A-Z0-9]{4,})"), last_part
        )
    )
    return F.when(~text.isin("", "N/A", "#N/A"), found)


def panel_number(c: Column | str) -> Column:
    """Number of a distribution panel: digits, else after 'ODF', else the last number."""
    text = strip(c)
    last_number = F.try_element_at(
        F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0)), F.lit(-1)
    )
    return F.coalesce(extract(text, r"(?i)ODF\s*(\d+)"), last_number, text)


def equipment_name(c: Column | str) -> Column:
    """Drop a leading 'EQUIPO ' and keep the first word."""
    text = strip(c)
    return F.substring_index(F.regexp_replace(text, "^EQUIPO ", ""), " ", 1)


def trunk_panel_parts(c: Column | str) -> Column:
    """'OT123_4 1/12' -> struct(fibre, panel, rest); null unless it starts with 'OT'."""
    raw = as_column(c)
    text = F.substring(strip(raw), 3, 1 << 30)
    split_by_panel = text.contains("_")
    after = F.regexp_replace(text, "(?s)^[^_]*_", "")
    rest_of = lambda s: F.when(
        s.contains(" "), F.regexp_replace(s, "(?s)^[^ ]* ", "")
    ).otherwise("")
    return F.when(
        raw.startswith("OT"),
        F.struct(
            F.when(split_by_panel, F.substring_index(text, "_", 1))
            .otherwise(F.substring_index(text, " ", 1))
            .alias("fibre"),
            F.when(split_by_panel, F.substring_index(after, " ", 1)).otherwise("").alias("panel"),
            F.when(split_by_panel, rest_of(after)).otherwise(rest_of(text)).alias("rest"),
        ),
    )


def slot_number(c: Column | str) -> Column:
    return extract(as_column(c), r"Slot\s*(\d+)").try_cast("bigint")


def port_kind(c: Column | str) -> Column:
    """'XG-12' -> 'XG', 'G-3' -> 'G', else null."""
    return extract(as_column(c), r"^(XG|G)-\d+$")


def port_number(c: Column | str) -> Column:
    return extract(as_column(c), r"^(?:XG|G)-(\d+)$").try_cast("bigint")


def tray_letter(c: Column | str) -> Column:
    return F.upper(extract(as_column(c), r"BANDEJA[^A-Za-z]*([A-Za-z])"))


# --- names ---------------------------------------------------------------------------

def fibre_base_name(c: Column | str) -> Column:
    """'12-3-4' -> '12-3'; 'n' and 'n-d' stay; else the leading 'd' or 'd-d'."""
    name = as_column(c)
    return (
        F.when(~name.contains("-") | name.rlike(r"^[^-]*-\d+$"), name)
        .when(name.rlike(r"^[^-]*-\d+-\d+$"), F.substring_index(name, "-", 2))
        .otherwise(F.coalesce(extract(name, r"^(\d+(?:-\d+)?)"), name))
    )


# Legal-form endings, removed wherever they occur and in this order.
LEGAL_FORMS = (
    r"\s+S\.?A\.?S\.?",
    r"\s+S\.?A\.?",
    r"\s+L\.?T\.?D\.?A\.?",
    r"\s+E\.?U\.?",
    r"\s+N\.?I\.?T\.?\s*\d+",
    r"\s+&?\s*CIE\.?",
    r"\s+LTDA\.?",
    r"\s+LTD\.?",
    r"\s+INC\.?",
    r"\s+CORP\.?",
    r"\s+S\.?C\.?S\.?",
    r"\s+E\.?I\.?R\.?L\.?",
)
ANY_LEGAL_FORM = r"\s(?:" + "|".join(form.removeprefix(r"\s+") for form in LEGAL_FORMS) + ")"


def company_name(c: Column | str) -> Column:
    """Upper case without legal form, dots, commas and repeated spaces; '' for null."""
    whole = name = F.upper(text_or_empty(c))
    for form in LEGAL_FORMS:
        name = F.regexp_replace(name, form, "")
    # Most names have none of the forms, which one look tells.
    name = F.when(whole.rlike(ANY_LEGAL_FORM), name).otherwise(whole)
    return strip(F.regexp_replace(F.regexp_replace(name, "[.,]", ""), r"\s+", " "))


def comparison_key(c: Column | str) -> Column:
    """Spelling-insensitive key: 'Acme S. A. S.' and 'ACME SAS' give 'acme sas'."""
    key = F.regexp_replace(F.lower(as_column(c)), r"[.,;()]", "")
    key = strip(F.regexp_replace(key, r"\s+", " "))
    return F.regexp_replace(key, r"(?<=(?:^| )\p{L}) (?=\p{L}(?: |$))", "")


def report_text(c: Column | str) -> Column:
    """One line without tabs, repeated or edge white space."""
    return strip(F.regexp_replace(as_column(c), r"\s+", " "))


def odd_characters(c: Column | str, allowed: str) -> Column:
    """Characters outside ``allowed`` (a regex), once each, in code-point order."""
    rest = F.regexp_replace(as_column(c), allowed, "")
    characters = F.regexp_extract_all(rest, F.lit("(?s)."), F.lit(0))
    return F.array_join(F.sort_array(F.array_distinct(characters)), "")


def without_control(c: Column | str) -> Column:
    return F.regexp_replace(as_column(c), r"[\x00-\x1f\x7f]", "")


# --- codes and values ----------------------------------------------------------------

def construction_status(c: Column | str, decode: bool = True) -> Column:
    """Short codes of bulk exports spelled out; other text stays; '' for null."""
    text = text_or_empty(c)
    if not decode:
        return text
    # Short code and long text.
    return (
        F.when(F.lower(text) == "is", F.lit("En servicio"))
        .when(F.lower(text) == "pa", F.lit("Plan Abandono"))
        .when(F.lower(text) == "pf", F.lit("Plan Uso Futuro"))
        .otherwise(text)
    )


def strand_count(c: Column | str) -> Column:
    """'Ductado 48 Hilos' -> 48; 0 when absent."""
    return F.coalesce(
        extract(as_column(c), r"(?i)(\d+)\s+hilos").try_cast("bigint"), F.lit(0).cast("bigint")
    )


def expected_splice_type(c: Column | str) -> Column:
    """Splice type that belongs to a cable specification."""
    spec = F.lower(as_column(c))
    return (
        F.when(spec.startswith("ductado 144"), F.lit("Tipo 0"))
        .when(spec.startswith("ductado 96"), F.lit("Tipo 1"))
        .when(
            starts_with_any(spec, ("ductado 12", "ductado 24", "ductado 36", "ductado 48")),
            F.lit("Tipo 2"),
        )
        .when(spec.contains("empalme cliente"), F.lit("Empalme Cliente"))
        .when(spec.contains("nap sotano"), F.lit("Nap Sotano"))
        .otherwise("Desconocido")
    )


def is_zero(c: Column | str) -> Column:
    """True for a number or text that is zero; never null."""
    # A pattern: casting text that is no number costs an exception per row.
    text = as_column(c).cast("string")
    zero = strip(text).rlike(r"^[+-]?(0+\.?0*|\.0+)([eE][+-]?\d+)?$")
    return F.coalesce(F.when(text.contains("0"), zero), F.lit(False))


def loose_date(c: Column | str) -> Column:
    """'5-Jan' (year 1900), '5-Jan-24' or '05/01/2024'; else the smallest date."""
    text = strip(c)
    short_year = F.regexp_extract(text, r"^\d{1,2}-[A-Za-z]{3}-(\d{2})$", 1).try_cast("int")
    year = F.when(short_year >= 69, short_year + 1900).otherwise(short_year + 2000)
    day_month = F.regexp_extract(text, r"^(\d{1,2}-[A-Za-z]{3})(?:-\d{2})?$", 1)
    spelled = F.concat_ws("-", day_month, F.coalesce(year, F.lit(1900)).cast("string"))
    parsed = F.coalesce(
        F.when(day_month != "", F.try_to_timestamp(spelled, F.lit("d-MMM-yyyy"))),
        F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(text, F.lit("d/M/yyyy"))),
    )
    return F.coalesce(parsed.cast("date"), F.lit("0001-01-01").cast("date"))


def iso_date(c: Column | str) -> Column:
    """Any date-like text or timestamp as 'yyyy-MM-dd'; '' when it is none."""
    return F.coalesce(F.date_format(as_column(c).try_cast("timestamp"), "yyyy-MM-dd"), F.lit(""))


def looks_like_timestamp(c: Column | str) -> Column:
    return as_column(c).rlike(r"^\d{2}/\d{2}/\d{4}\s+\d{2}:\d{2}:\d{2}")


def is_present(c: Column | str, *trivial: str) -> Column:
    """Not null and not one of the trivial texts."""
    c = as_column(c)
    return c.isNotNull() & ~c.isin("", *trivial)


def joined_values(a: Column | str, b: Column | str, separator: str = "|") -> Column:
    """'a|b' when both are present and differ, else the one that is present."""
    a, b = as_column(a), as_column(b)
    return F.when(a != b, F.concat_ws(separator, a, b)).otherwise(F.coalesce(a, b))


# --- assumptions ---------------------------------------------------------------------
# The studied SQL calls two functions that are defined nowhere. The two below follow the
# shapes that the audit accepts for the same attributes; they are an ASSUMPTION.

def equipment_in_text(c: Column | str) -> Column:
    """First token of six letters and more that holds at least four digits."""
    tokens = F.regexp_extract_all(as_column(c), F.lit(r"[A-Z]{6}[A-Z0-9]*"), F.lit(0))
    return F.get(
        F.filter(tokens, lambda t: F.length(F.regexp_replace(t, "[^0-9]", "")) >= 4), 0
    )


def port_in_text(c: Column | str) -> Column:
    return extract(as_column(c), r"(\d+/\d+(?:/\d+)?)")


# --- key: value lines ----------------------------------------------------------------

def labelled_value(line: Column | str, label: str) -> Column:
    """Text after the last ``label`` of a line, blanks collapsed; null when empty."""
    found = F.regexp_extract(as_column(line), f"^.*{literal_regex(label)}\\s*(.*)", 1)
    return null_if_empty(strip(F.regexp_replace(found, "[ \t]+", " ")))


def metro_port_value(line: Column | str, label: str = "PTO METRO:") -> Column:
    """As ``labelled_value`` without the interface word; else what follows that word."""
    line = as_column(line)
    own = F.regexp_replace(labelled_value(line, label), r"^\s*(?:GigabitEthernet|GE)\s*", "")
    after = F.regexp_extract(line, r"(?:GigabitEthernet|GE)\s*(.*)", 1)
    collapsed = lambda s: null_if_empty(strip(F.regexp_replace(s, "[ \t]+", " ")))
    return F.when(labelled_value(line, label).isNotNull(), collapsed(own)).otherwise(
        collapsed(after)
    )


def literal_regex(text: str) -> str:
    return "".join(ch if ch.isalnum() or ch.isspace() else "\\" + ch for ch in text)
