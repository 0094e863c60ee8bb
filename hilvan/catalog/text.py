"""Normalisation functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hilvan.catalog.base import select, shape, table
from hilvan.functions import rules as R
from hilvan.functions import text as T
from hilvan.sources import lines as L

# Port-like texts built from line items.
PORTS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "CAST(l_quantity AS BIGINT) AS q",
    "CASE l_linenumber WHEN 1 THEN 'XG ' || CAST(l_suppkey % 9 AS STRING) || '/0/' || CAST(l_partkey AS STRING) "
    "WHEN 2 THEN '00' || CAST(l_suppkey AS STRING) || '/000/' WHEN 3 THEN 'GE-' || CAST(l_partkey AS STRING) || '-1/x' "
    "WHEN 4 THEN 'A1/b/3' WHEN 5 THEN ' G-0' || CAST(l_suppkey AS STRING) || '/1/2 ' WHEN 6 THEN '' ELSE NULL END AS port",
    "CASE l_linenumber WHEN 1 THEN ' ODF ' || CAST(l_partkey AS STRING) || ' b' WHEN 2 THEN CAST(l_suppkey AS STRING) "
    "WHEN 3 THEN 'panel ' || CAST(l_partkey AS STRING) || ' of ' || CAST(l_suppkey AS STRING) WHEN 4 THEN 'sin numero' "
    "WHEN 5 THEN 'odf7 odf8' ELSE NULL END AS panel",
    "CASE l_linenumber WHEN 1 THEN 'x_MEABC' || CAST(l_partkey AS STRING) || '_y' WHEN 2 THEN 'AB' || CAST(l_partkey AS STRING) "
    "WHEN 3 THEN '10.0.0.1_9f8e7d' || CAST(l_partkey AS STRING) || '(z)' WHEN 4 THEN 'N/A' WHEN 5 THEN 'me1/zona' "
    "WHEN 6 THEN 'HUZONA' || CAST(l_suppkey AS STRING) ELSE '#N/A' END AS origin",
    "CASE l_linenumber WHEN 1 THEN 'OT' || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) || ' 1/12 x' "
    "WHEN 2 THEN 'OT' || CAST(l_partkey AS STRING) || ' 13/24' WHEN 3 THEN 'OT' || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) "
    "WHEN 4 THEN 'OT12' WHEN 5 THEN 'PP1' ELSE NULL END AS shelf",
    "CASE l_linenumber WHEN 1 THEN '  EQUIPO  ABC' WHEN 2 THEN 'EQUIPO BOGOTA' || CAST(l_suppkey AS STRING) || ' x y' "
    "WHEN 3 THEN 'VILLA ' || CAST(l_suppkey AS STRING) ELSE 'SOLO' END AS equipment",
    "CASE l_linenumber WHEN 1 THEN 'Slot ' || CAST(l_suppkey AS STRING) WHEN 2 THEN 'BANDEJA 1-' || substr(l_returnflag, 1, 1) "
    "WHEN 3 THEN 'x Slot7y' WHEN 4 THEN 'BANDEJA: b2' ELSE 'nada' END AS place",
    "CASE l_linenumber WHEN 1 THEN 'XG-' || CAST(l_partkey AS STRING) WHEN 2 THEN 'G-0' || CAST(l_suppkey AS STRING) "
    "WHEN 3 THEN 'G-1/2' ELSE 'T-1' END AS description",
]

# Names, codes and dates built from customers.
NAMES = [
    "c_custkey",
    "CASE c_custkey % 8 WHEN 0 THEN CAST(c_custkey AS STRING) WHEN 1 THEN CAST(c_custkey AS STRING) || '-' || CAST(c_nationkey AS STRING) "
    "WHEN 2 THEN CAST(c_custkey AS STRING) || '-' || CAST(c_nationkey AS STRING) || '-9' WHEN 3 THEN CAST(c_custkey AS STRING) || '-4-SUB' "
    "WHEN 4 THEN CAST(c_custkey AS STRING) || '-SUB' WHEN 5 THEN 'A-' || CAST(c_custkey AS STRING) || '-x' WHEN 6 THEN '' ELSE NULL END AS fibre",
    "CASE c_custkey % 9 WHEN 0 THEN c_name || ' s.a.s.' WHEN 1 THEN c_name || '  Ltda.' WHEN 2 THEN c_name || ' S.A, NIT 900' || CAST(c_custkey AS STRING) "
    "WHEN 3 THEN c_name || ' & CIE' WHEN 4 THEN ' ' || c_name || ' Inc  norte ' WHEN 5 THEN c_name || ' E.U. sur' WHEN 6 THEN 'EIRL' "
    "WHEN 7 THEN c_name || ' CORP.' ELSE NULL END AS company",
    "CASE c_custkey % 5 WHEN 0 THEN 'is' WHEN 1 THEN ' PA ' WHEN 2 THEN 'Pf' WHEN 3 THEN 'otro' ELSE NULL END AS status",
    "CASE c_custkey % 6 WHEN 0 THEN 'Ductado 144 hilos' WHEN 1 THEN 'ductado 96  HILOS' WHEN 2 THEN 'Ductado 48' WHEN 3 THEN 'Empalme Cliente 12 Hilos' "
    "WHEN 4 THEN 'Nap Sotano 24' ELSE 'aereo 6 hilos' END AS spec",
    "CASE c_custkey % 6 WHEN 0 THEN '1.2345E+10' WHEN 1 THEN CAST(c_custkey AS STRING) WHEN 2 THEN 'e' WHEN 3 THEN '12e3' WHEN 4 THEN '' ELSE NULL END AS ident",
    "CASE c_custkey % 7 WHEN 0 THEN '0' WHEN 1 THEN ' 0.0 ' WHEN 2 THEN 'x' WHEN 3 THEN '' WHEN 4 THEN '00' WHEN 5 THEN '1' ELSE NULL END AS zero",
    "CASE c_custkey % 7 WHEN 0 THEN '5-Jan' WHEN 1 THEN '07-Mar-24' WHEN 2 THEN '7-DEC-70' WHEN 3 THEN '03/02/2021' WHEN 4 THEN '31/02/2021' "
    "WHEN 5 THEN 'ayer' ELSE NULL END AS fecha",
    "CASE c_custkey % 3 WHEN 0 THEN '01/02/2024  10:11:12 x' WHEN 1 THEN '1/2/2024 10:11:12' ELSE NULL END AS stamp",
    "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN c_mktsegment ELSE 'B' END AS left_value",
    "CASE c_custkey % 3 WHEN 0 THEN NULL ELSE c_mktsegment END AS right_value",
    "CAST(c_custkey AS STRING) || '/' || CAST(c_nationkey AS STRING) || ' , ' || CAST(c_custkey + 1 AS STRING) AS listed",
]

# Document texts with tabs, repeated and edge spaces put in.
TEXTS = [
    "doc_id",
    "CASE doc_id % 4 WHEN 0 THEN ' ' || text WHEN 1 THEN replace(text, chr(10), chr(9)) "
    "WHEN 2 THEN replace(text, ' ', '  ') ELSE text END AS text",
]


def ports(spark, d):
    parts, trunk = T.port_parts("port"), T.trunk_panel_parts("shelf")
    return shape(spark, d, "lineitem", PORTS).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "q",
        T.clean_port("port").alias("clean"),
        parts["slot"].alias("slot"), parts["mid"].alias("mid"), parts["number"].alias("number"),
        T.panel_number("panel").alias("panel"), T.ring_from_origin("origin").alias("ring"),
        trunk["fibre"].alias("fibre"), trunk["panel"].alias("trunk_panel"), trunk["rest"].alias("rest"),
        T.equipment_name("equipment").alias("equipment"), T.slot_number("place").alias("place_slot"),
        T.tray_letter("place").alias("tray"), T.port_kind("description").alias("kind"),
        T.port_number("description").alias("kind_number"),
    )


def names(spark, d):
    return shape(spark, d, "customer", NAMES).select(
        "c_custkey",
        T.fibre_base_name("fibre").alias("base"), T.company_name("company").alias("company"),
        T.construction_status("status").alias("status"), T.construction_status("status", False).alias("raw_status"),
        T.strand_count("spec").alias("strands"), T.expected_splice_type("spec").alias("splice_type"),
        T.expand_exponent_id("ident").alias("ident"), T.normalise_id("ident").alias("norm_id"),
        T.is_zero("zero").alias("zero"), T.loose_date("fecha").cast("string").alias("fecha"),
        T.looks_like_timestamp("stamp").alias("stamp"),
        T.joined_values("left_value", "right_value").alias("joined"),
        T.first_item("listed").alias("first_item"), T.first_item("listed", "/").alias("first_cable"),
    )


def whitespace(spark, d):
    """White-space marks of every document; the cleaned text by its hash."""
    return shape(spark, d, "documents", TEXTS).select(
        "doc_id", F.array_join(R.whitespace_kinds("text"), ",").alias("kinds"),
        F.md5(F.array_join(R.whitespace("text", "TEXTO"), "|")).alias("messages"),
        F.md5(T.report_text("text")).alias("cleaned"),
    )


def charset(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", T.odd_characters("text", R.NAME_CHARACTERS).alias("odd"),
        F.md5(T.without_control("text")).alias("printable"),
    )


# Labels looked for in the mark-up of pages.
PAGE_LABELS = {"titulo": "<title>", "idioma": "lang=", "ruta": "href="}


def key_values(spark, d):
    """First value per page of each label, over the lines of the whole mark-up."""
    lines = table(spark, d, "pages").select("page_id", F.posexplode(F.split("html", "\n")).alias("line_no", "line"))
    values = {name: T.labelled_value("line", label) for name, label in PAGE_LABELS.items()}
    return L.first_values(lines, "page_id", ["line_no"], values | {"metro": T.metro_port_value("line", "<p>")})


QUERIES = {
    "port_text": ports,
    "name_text": names,
    "whitespace_audit": whitespace,
    "charset_audit": charset,
    "key_value_extract": key_values,
}

_LABEL = (
    "COALESCE(arg_min(NULLIF({0}, ''), n) FILTER (WHERE {0} <> ''), '')"
)


def _labelled(label: str) -> str:
    found = rf"regexp_extract(line, '^.*{T.literal_regex(label)}\s*(.*)', 1)"
    return rf"trim(regexp_replace({found}, '[ \t]+', ' ', 'g'), ' ' || chr(9) || chr(13))"


_METRO = (
    r"CASE WHEN {0} <> '' THEN trim(regexp_replace({0}, '^\s*(?:GigabitEthernet|GE)\s*', '')) "
    r"ELSE trim(regexp_replace(regexp_extract(line, '(?:GigabitEthernet|GE)\s*(.*)', 1), '[ \t]+', ' ', 'g'), ' ' || chr(9) || chr(13)) END"
).format(_labelled("<p>"))
_FORMS = [f.replace("'", "''") for f in T.LEGAL_FORMS]


def _company() -> str:
    out = "upper(trim(coalesce(company, '')))"
    for form in _FORMS:
        out = f"regexp_replace({out}, '{form}', '', 'g')"
    return rf"trim(regexp_replace(regexp_replace({out}, '[.,]', '', 'g'), '\s+', ' ', 'g'))"


SQL = {
    "port_text": rf"""WITH r AS ({select('lineitem', PORTS)}),
p AS (SELECT *, regexp_replace(regexp_replace(port, '[^0-9/-]', '', 'g'), '/$', '') AS k,
        string_split(trim(regexp_replace(port, '^[A-Z]+[\s-]?', '')), '/') AS pp,
        substr(trim(shelf), 3) AS sh,
        list_filter(regexp_extract_all(origin, '(?i)ME[A-Z0-9]+'), lambda x: length(x) >= 6)[1] AS r1,
        list_filter(regexp_extract_all(origin, '(?i)[A-Z]{{2,}}[A-Z0-9]{{3,}}'), lambda x: length(x) >= 6)[1] AS r2,
        list_filter(list_transform(regexp_split_to_array(origin, '[_/]'), lambda x: regexp_replace(x, '\(.*\)', '', 'g')),
          lambda x: length(x) >= 6 AND NOT regexp_full_match(x, '\d+') AND NOT regexp_full_match(x, '\d+\.\d+\.\d+\.\d+'))[-1] AS r3
      FROM r),
q2 AS (SELECT *, len(pp) = 3 AND TRY_CAST(pp[1] AS BIGINT) IS NOT NULL AND TRY_CAST(pp[2] AS BIGINT) IS NOT NULL
        AND TRY_CAST(pp[3] AS BIGINT) IS NOT NULL AS full_port FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, q,
  array_to_string(list_transform(string_split(k, '/'), lambda s: CASE WHEN ltrim(s, '0') = '' THEN '0' ELSE ltrim(s, '0') END), '/') AS clean,
  CASE WHEN full_port THEN TRY_CAST(pp[1] AS BIGINT) END AS slot, CASE WHEN full_port THEN TRY_CAST(pp[2] AS BIGINT) END AS mid,
  CASE WHEN full_port THEN TRY_CAST(pp[3] AS BIGINT) END AS number,
  COALESCE(NULLIF(regexp_extract(trim(panel), '(?i)ODF\s*(\d+)', 1), ''), regexp_extract_all(panel, '\d+')[-1], trim(panel)) AS panel,
  CASE WHEN origin NOT IN ('', 'N/A', '#N/A') THEN upper(COALESCE(r1, r2, r3)) END AS ring,
  CASE WHEN shelf LIKE 'OT%' THEN CASE WHEN contains(sh, '_') THEN string_split(sh, '_')[1] ELSE string_split(sh, ' ')[1] END END AS fibre,
  CASE WHEN shelf LIKE 'OT%' THEN CASE WHEN contains(sh, '_') THEN string_split(regexp_replace(sh, '^[^_]*_', ''), ' ')[1] ELSE '' END END AS trunk_panel,
  CASE WHEN shelf LIKE 'OT%' THEN CASE WHEN contains(sh, ' ') THEN regexp_replace(sh, '^[^ ]* ', '') ELSE '' END END AS rest,
  string_split(regexp_replace(trim(equipment), '^EQUIPO ', ''), ' ')[1] AS equipment,
  TRY_CAST(NULLIF(regexp_extract(place, 'Slot\s*(\d+)', 1), '') AS BIGINT) AS place_slot,
  upper(NULLIF(regexp_extract(place, 'BANDEJA[^A-Za-z]*([A-Za-z])', 1), '')) AS tray,
  NULLIF(regexp_extract(description, '^(XG|G)-\d+$', 1), '') AS kind,
  TRY_CAST(NULLIF(regexp_extract(description, '^(?:XG|G)-(\d+)$', 1), '') AS BIGINT) AS kind_number
FROM q2""",
    "name_text": rf"""WITH r AS ({select('customer', NAMES)})
SELECT c_custkey,
  CASE WHEN NOT contains(fibre, '-') OR regexp_matches(fibre, '^[^-]*-\d+$') THEN fibre
       WHEN regexp_matches(fibre, '^[^-]*-\d+-\d+$') THEN string_split(fibre, '-')[1] || '-' || string_split(fibre, '-')[2]
       ELSE COALESCE(NULLIF(regexp_extract(fibre, '^(\d+(?:-\d+)?)', 1), ''), fibre) END AS base,
  {_company()} AS company,
  CASE lower(trim(coalesce(status, ''))) WHEN 'is' THEN 'En servicio' WHEN 'pa' THEN 'Plan Abandono' WHEN 'pf' THEN 'Plan Uso Futuro'
    ELSE trim(coalesce(status, '')) END AS status,
  trim(coalesce(status, '')) AS raw_status,
  COALESCE(TRY_CAST(NULLIF(regexp_extract(spec, '(?i)(\d+)\s+hilos', 1), '') AS BIGINT), 0) AS strands,
  CASE WHEN lower(spec) LIKE 'ductado 144%' THEN 'Tipo 0' WHEN lower(spec) LIKE 'ductado 96%' THEN 'Tipo 1'
    WHEN regexp_matches(lower(spec), '^ductado (12|24|36|48)') THEN 'Tipo 2' WHEN lower(spec) LIKE '%empalme cliente%' THEN 'Empalme Cliente'
    WHEN lower(spec) LIKE '%nap sotano%' THEN 'Nap Sotano' ELSE 'Desconocido' END AS splice_type,
  CASE WHEN contains(lower(ident), 'e') THEN COALESCE(CAST(CAST(TRY_CAST(ident AS DOUBLE) AS DECIMAL(38,0)) AS VARCHAR), ident) ELSE ident END AS ident,
  trim(coalesce(ident, '')) AS norm_id,
  COALESCE(TRY_CAST(trim(zero) AS DOUBLE) = 0, false) AS zero,
  CASE c_custkey % 7 WHEN 0 THEN '1900-01-05' WHEN 1 THEN '2024-03-07' WHEN 2 THEN '1970-12-07' WHEN 3 THEN '2021-02-03' ELSE '0001-01-01' END AS fecha,
  regexp_matches(stamp, '^\d{{2}}/\d{{2}}/\d{{4}}\s+\d{{2}}:\d{{2}}:\d{{2}}') AS stamp,
  CASE WHEN left_value <> right_value THEN left_value || '|' || right_value ELSE COALESCE(left_value, right_value) END AS joined,
  trim(string_split(listed, ',')[1]) AS first_item, string_split(listed, '/')[1] AS first_cable
FROM r""",
    "whitespace_audit": rf"""WITH r AS ({select('documents', TEXTS)}),
k AS (SELECT *, contains(text, chr(9)) AS t, contains(text, '  ') OR starts_with(text, ' ') OR ends_with(text, ' ') AS e FROM r)
SELECT doc_id, concat_ws(',', CASE WHEN t THEN 'TABS' END, CASE WHEN e THEN 'ESPACIOS_DOBLES' END) AS kinds,
  md5(concat_ws('|', CASE WHEN t THEN 'TEXTO: TABS - valor: ''' || text || '''' END,
                     CASE WHEN e THEN 'TEXTO: ESPACIOS_DOBLES - valor: ''' || text || '''' END)) AS messages,
  md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS cleaned FROM k""",
    "charset_audit": r"""SELECT doc_id, array_to_string(list_sort(list_distinct(
  regexp_extract_all(regexp_replace(text, '[A-Za-z0-9 ñÑ()&.,\-]', '', 'g'), '(?s).'))), '') AS odd,
  md5(regexp_replace(text, '[\x00-\x1f\x7f]', '', 'g')) AS printable FROM documents""",
    "key_value_extract": f"""WITH l AS (SELECT page_id, unnest(string_split(html, chr(10))) AS line, generate_subscripts(string_split(html, chr(10)), 1) AS n FROM pages)
SELECT page_id, {', '.join(f"{_LABEL.format(_labelled(label))} AS {name}" for name, label in PAGE_LABELS.items())},
  {_LABEL.format('(' + _METRO + ')')} AS metro FROM l GROUP BY page_id""",
}
