"""Trace text built from line items: one trace per supplier, one line per row."""

from __future__ import annotations

from pyspark.sql import functions as F

from hilvan.catalog.base import LINE_ORDER, select, shape
from hilvan.functions.text import strip
from hilvan.plans import trace as T

ORDER = [c for c in LINE_ORDER if c != "l_suppkey"]
LINES = [
    "CAST(l_suppkey AS STRING) AS file_path", *ORDER,
    "CASE (l_linenumber + l_partkey) % 8 "
    "WHEN 0 THEN 'Fibre (1: ' || CAST(l_orderkey % 3 + 1 AS STRING) || ') Cable de FO (Ductado 48h, ''C' || CAST(l_partkey % 2 AS STRING) || ''')' "
    "WHEN 1 THEN '  Edificio ''SITIO ' || CAST(l_partkey % 6 AS STRING) || '''' "
    "WHEN 2 THEN 'Edificio ''NODO ' || CAST(l_partkey % 3 AS STRING) || '''' "
    "WHEN 3 THEN 'at Empalme de Fibra (Tipo 2, ''ET' || CAST(l_partkey % 3 AS STRING) || ''')' "
    "WHEN 4 THEN 'at Empalme de Fibra (Tipo 1, ''EA' || CAST(l_partkey % 3 AS STRING) || ''')' "
    "WHEN 5 THEN 'at Empalme de Fibra (Empalme Cliente, ''OB' || CAST(l_partkey % 3 AS STRING) || ''')' "
    "ELSE 'Port (' || CAST(l_partkey % 9 AS STRING) || ') Card (c' || CAST(l_linenumber AS STRING) || ') Shelf (S)' END AS line",
]
FILES = [
    "CAST(s_suppkey AS STRING) AS file_path", "'cable' || CAST(s_nationkey AS STRING) AS folder",
    "'tz_ms_r' || CAST(s_suppkey % 60 AS STRING) || '_x' AS stem",
]
OWNERS = [
    "'R' || CAST(c_custkey % 90 AS STRING) || ' ' AS anillo",
    "CASE c_custkey % 5 WHEN 0 THEN '' ELSE 'resp' || CAST(c_nationkey AS STRING) END AS responsable",
    "CASE c_custkey % 4 WHEN 0 THEN 'x' WHEN 1 THEN '7.5' ELSE CAST(c_custkey % 50 AS STRING) END AS total_clientes",
    "CASE c_custkey % 4 WHEN 0 THEN '0' || CAST(c_custkey % 9 + 1 AS STRING) || '/03/2021' WHEN 1 THEN CAST(c_custkey % 9 + 1 AS STRING) || '-Mar-21' "
    "WHEN 2 THEN 'ayer' ELSE '5-Jan' END AS fecha",
    "c_custkey AS seq",
]


def lines(spark, d):
    return shape(spark, d, "lineitem", LINES)


def elements(spark, d):
    return T.trace_elements(lines(spark, d), order=ORDER, chunk=[F.floor(F.col("l_orderkey") / 1000)])


def owners(spark, d):
    return T.ring_owners(shape(spark, d, "customer", OWNERS))


def anomalies(spark, d):
    out = T.strand_anomalies(elements(spark, d), "file_path", [*ORDER, "step", "part"])
    return out.select("file_path", "level", "message")


def report(spark, d):
    """State of every trace; the order of messages follows the first line of a strand."""
    rows = elements(spark, d)
    return T.trace_report(
        shape(spark, d, "supplier", FILES), rows, owners(spark, d), [*ORDER, "step", "part"], only_faults=False
    )


def missing(spark, d):
    return T.missing_files(shape(spark, d, "supplier", FILES), owners(spark, d))


def labels(spark, d):
    """The label of every line, by kind."""
    text = F.col("_text")
    return lines(spark, d).withColumn("_text", strip("line")).select(
        "file_path", *ORDER, T.fibre_number(text).alias("fibre"), T.cable_label(text).alias("cable"),
        T.building_label(text).alias("building"), T.splice_label(text).alias("splice"), T.port_label(text).alias("port"),
    )


#: Lines with brackets nested to eleven levels, some left open.
NESTED = [
    "l_orderkey", "l_linenumber",
    "'Fibre (1: 1) Cable de FO (Ductado ' || CAST(l_partkey % 90 AS STRING) || 'h' || repeat('(x', CAST(l_partkey % 12 AS INT)) "
    "|| repeat(')', CAST(l_partkey % 12 - CASE WHEN l_suppkey % 9 = 4 THEN 1 ELSE 0 END AS INT)) || ', ''C' || CAST(l_suppkey AS STRING) "
    "|| ''') y (''Z'') ' AS fibre",
    "'at Empalme de Fibra (Tipo 2' || repeat('(', CAST(l_suppkey % 11 AS INT)) || 'a' || repeat(')', CAST(l_suppkey % 11 AS INT)) "
    "|| ', ''ET' || CAST(l_partkey AS STRING) || '''' || CASE WHEN l_linenumber = 5 THEN '' ELSE ')' END || ' ''W''' AS splice",
]


def nested(spark, d):
    """Cable and splice labels of lines with deeply nested brackets."""
    return shape(spark, d, "lineitem", NESTED).select(
        "l_orderkey", "l_linenumber", T.cable_label(F.col("fibre")).alias("cable"), T.splice_label(F.col("splice")).alias("splice")
    )


QUERIES = {
    "trace_labels": labels,
    "trace_elements": lambda s, d: elements(s, d).withColumn("l_shipdate", F.col("l_shipdate").cast("date")),
    "trace_anomalies": anomalies,
    "trace_owners": owners,
    "trace_report": report,
    "trace_missing_files": missing,
    "trace_labels_nested": nested,
}

_O = ", ".join(ORDER)
_R = f"""r AS (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY {_O}) AS n FROM ({select('lineitem', LINES)})),
t AS (SELECT *, trim(line) AS x,
  CASE WHEN contains(line, 'Edificio') THEN 'B' WHEN contains(line, 'Empalme') THEN 'S' WHEN contains(line, 'Port (') THEN 'P' ELSE 'F' END AS k FROM r),
g AS MATERIALIZED (SELECT *, NULLIF(regexp_extract(x, '^[^:]*:\\s*(\\d+)', 1), '') AS num, CASE WHEN k = 'F' THEN '(48h) | ' || regexp_extract(x, '''([^'']*)''', 1) END AS cab,
  CASE WHEN k = 'B' THEN CASE WHEN contains(x, 'NODO') THEN '' ELSE '(ED) ' END || regexp_extract(x, '''([^'']*)''', 1) END AS nm,
  CASE WHEN contains(x, 'Cliente') THEN '(EM CL) | ' || regexp_extract(x, '''([^'']*)''', 1)
       WHEN k = 'S' THEN '(EM ' || regexp_extract(x, 'Tipo (\\d*)', 1) || ') | ' || regexp_extract(x, '''([^'']*)''', 1) END AS sp,
  CASE WHEN k = 'P' THEN regexp_extract(x, 'Shelf \\(([^)]*)', 1) || ', ' || regexp_extract(x, 'Card \\(([^)]*)', 1) || ', ' || regexp_extract(x, 'Port \\(([^)]*)', 1) END AS pl
  FROM t)"""
_W = "PARTITION BY file_path ORDER BY n"
_ELEMENTS = f"""{_R},
h AS MATERIALIZED (SELECT *,
  coalesce(last_value(num IGNORE NULLS) OVER ({_W}), '') AS fb, coalesce(last_value(cab IGNORE NULLS) OVER ({_W}), '') AS cb,
  max(CASE WHEN k = 'F' THEN 1 END) OVER ({_W}) IS NOT NULL AS seen,
  last_value(CASE WHEN k IN ('B', 'S') THEN n END IGNORE NULLS) OVER ({_W}) AS mk,
  last_value(CASE WHEN k IN ('B', 'S') THEN k END IGNORE NULLS) OVER ({_W}) AS mkk,
  last_value(CASE WHEN k IN ('B', 'S') THEN n END IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pk,
  last_value(CASE WHEN k IN ('B', 'S') THEN k END IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pkk,
  first_value(CASE WHEN k = 'B' THEN n END IGNORE NULLS) OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nb FROM g),
b AS MATERIALIZED (SELECT file_path, n AS bn, nm, 'H' || fb AS bs, contains(nm, 'NODO') AS nodo FROM h WHERE k = 'B'),
i AS MATERIALIZED (SELECT file_path, nb, string_agg(line, chr(10) ORDER BY n) AS t FROM h WHERE k = 'P' AND NOT seen GROUP BY ALL),
w AS MATERIALIZED (SELECT h.file_path, mk, CASE WHEN nodo THEN string_agg(line, chr(10) ORDER BY n) ELSE string_agg(pl, ', ' ORDER BY n) END AS t
      FROM h JOIN b ON h.file_path = b.file_path AND mk = bn WHERE k = 'P' AND seen AND mkk = 'B' GROUP BY h.file_path, mk, nodo),
p AS MATERIALIZED (SELECT b.*, nm || ' | ' || CASE WHEN nodo THEN concat_ws(chr(10), i.t, w.t) ELSE concat_ws(', ', i.t, w.t) END AS el
      FROM b LEFT JOIN i ON b.file_path = i.file_path AND bn = i.nb LEFT JOIN w ON b.file_path = w.file_path AND bn = w.mk WHERE i.t IS NOT NULL OR w.t IS NOT NULL),
s0 AS (SELECT *, coalesce(lag(fb) OVER ({_W}), '') AS lf, pkk = 'B' AS waiting FROM h WHERE k = 'S'),
s AS MATERIALIZED (SELECT *, contains(sp, '(EM CL)') OR coalesce(waiting, false) OR fb <> lf AS wr FROM s0),
e AS (SELECT h.file_path, h.n, 0 AS step, el AS elemento, cb AS cable, bs AS hilo FROM h JOIN p ON h.file_path = p.file_path AND h.pk = p.bn AND h.pkk = 'B' WHERE k IN ('B', 'S')
      UNION ALL SELECT file_path, n, 2, sp, cb, 'H' || fb FROM s WHERE wr),
e2 AS (SELECT *, lag((elemento, cable, hilo)) OVER (PARTITION BY file_path ORDER BY n, step) AS prev FROM e),
m AS MATERIALIZED (SELECT * FROM e2 WHERE prev IS NULL OR prev <> (elemento, cable, hilo)),
z AS (SELECT file_path, arg_max(cb, n) AS ec, arg_max(mk, n) AS em, arg_max(mkk, n) AS emk FROM h GROUP BY file_path),
ls AS (SELECT file_path, max(n) AS sn, arg_max((sp, cb, 'H' || fb), n) AS row FROM s GROUP BY file_path),
lm AS (SELECT file_path, max(CASE WHEN step = 2 THEN n END) AS wn, arg_max((elemento, cable, hilo), (n, step)) AS row FROM m GROUP BY file_path),
fo AS (SELECT ls.* FROM ls LEFT JOIN lm ON ls.file_path = lm.file_path WHERE sn IS DISTINCT FROM wn),
op AS (SELECT p.file_path, el AS elemento, ec AS cable, bs AS hilo, coalesce(fo.row, lm.row) AS prev FROM z JOIN p ON z.file_path = p.file_path AND em = bn AND emk = 'B'
       LEFT JOIN fo ON p.file_path = fo.file_path LEFT JOIN lm ON p.file_path = lm.file_path),
x AS (SELECT file_path, n, step, elemento, cable, hilo FROM m
      UNION ALL SELECT file_path, NULL, 10, row[1], row[2], row[3] FROM fo
      UNION ALL SELECT file_path, NULL, 11, elemento, cable, hilo FROM op WHERE prev IS NULL OR prev <> (elemento, cable, hilo)
      UNION ALL SELECT file_path, NULL, 12, 'NODO INICIAL | ' || t, '', '' FROM i WHERE nb IS NULL),
el AS MATERIALIZED (SELECT x.file_path, {', '.join('r.' + c for c in ORDER)}, step, CAST(0 AS BIGINT) AS part, elemento, cable, hilo, coalesce(x.n, 1000000000) * 100 + step AS pos
       FROM x LEFT JOIN r ON x.file_path = r.file_path AND x.n = r.n)"""
_ANOMALIES = f"""{_ELEMENTS},
kd AS (SELECT *, CASE WHEN contains(elemento, 'ED:') OR contains(elemento, '(ED)') THEN 'ED' WHEN contains(elemento, '(EM CL)') THEN 'OB'
         WHEN contains(elemento, '(EM') AND contains(elemento, 'EA') THEN 'EA' WHEN contains(elemento, '(EM') AND contains(elemento, 'ET') THEN 'ET' END AS kind FROM el),
ct AS (SELECT file_path, cable, hilo, count(*) FILTER (WHERE kind = 'ED') AS ed, count(*) FILTER (WHERE kind = 'OB') AS ob,
         min(CASE WHEN step >= 10 THEN step - 100 ELSE pos END) AS first FROM kd WHERE kind IS NOT NULL GROUP BY ALL),
an AS (SELECT file_path, CASE WHEN ob = 0 THEN 1 ELSE 2 END AS level, first,
         CASE WHEN ed > 0 AND ob = 0 THEN '(FALTA OB ' || CASE WHEN contains(cable, '|') THEN trim(string_split(cable, '|')[2]) ELSE cable END || ', ' || hilo || ')'
              WHEN ob > 0 AND ed > 2 THEN 'MULTIPLES ELEMENTOS ' || ed || ' , (' || CASE WHEN contains(cable, '|') THEN trim(string_split(cable, '|')[2]) ELSE cable END || ', ' || hilo || ')' END AS message FROM ct)"""
_OWNERS = f"""ow0 AS (SELECT *, upper(trim(anillo)) AS ring, CASE c_mod WHEN 0 THEN make_date(2021, 3, CAST(left(fecha, 2) AS INT)) WHEN 1 THEN make_date(2021, 3, CAST(string_split(fecha, '-')[1] AS INT))
  WHEN 2 THEN DATE '0001-01-01' ELSE DATE '1900-01-05' END AS dt,
  CASE WHEN regexp_matches(regexp_replace(total_clientes, '^([^.]*)\\.', '\\1'), '^\\d+$') THEN total_clientes ELSE '' END AS tc
  FROM (SELECT *, seq % 4 AS c_mod FROM ({select('customer', OWNERS)}))),
ow AS (SELECT ring AS anillo, arg_max(responsable, (dt, -seq)) AS responsable, arg_max(tc, (dt, -seq)) AS total_clientes FROM ow0 GROUP BY ring)"""
_FILES = f"""fl AS (SELECT *, upper(string_split(stem, '_')[3]) AS anillo FROM ({select('supplier', FILES)}))"""

SQL = {
    "trace_labels_nested": f"""WITH r AS (SELECT *, row_number() OVER () AS n FROM ({select('lineitem', NESTED)})),
x AS (SELECT n, 'c' AS kind, split_part(fibre, 'Cable de FO (', 2) AS t FROM r UNION ALL SELECT n, 's', split_part(splice, 'Fibra (', 2) FROM r),
c AS (SELECT n, kind, t, unnest(string_split(t, '')) AS ch, generate_subscripts(string_split(t, ''), 1) AS i FROM x),
d AS (SELECT n, kind, t, i, 1 + sum(CASE ch WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY n, kind ORDER BY i) AS depth FROM c),
e AS (SELECT n, kind, left(any_value(t), min(i) - 1) AS inner_text FROM d WHERE depth = 0 GROUP BY n, kind),
l AS (SELECT n, kind, regexp_extract(inner_text, '''([^'']*)''', 1) AS id, inner_text FROM e WHERE contains(inner_text, chr(39)))
SELECT l_orderkey, l_linenumber, '(' || regexp_extract(a.inner_text, 'Ductado ([^h]*)h', 1) || 'h) | ' || a.id AS cable, '(EM 2) | ' || b.id AS splice
FROM r LEFT JOIN l a ON r.n = a.n AND a.kind = 'c' LEFT JOIN l b ON r.n = b.n AND b.kind = 's'""",
    "trace_labels": f"WITH {_R} SELECT file_path, {_O}, num AS fibre, cab AS cable, nm AS building, sp AS splice, pl AS port FROM g",
    "trace_elements": f"WITH {_ELEMENTS} SELECT * EXCLUDE (pos) REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM el",
    "trace_anomalies": f"WITH {_ANOMALIES} SELECT file_path, level, message FROM an WHERE message IS NOT NULL",
    "trace_owners": f"WITH {_OWNERS} SELECT * FROM ow",
    "trace_report": f"""WITH {_ANOMALIES}, {_OWNERS}, {_FILES},
pl0 AS (SELECT fl.*, coalesce(responsable, '') AS responsable, coalesce(total_clientes, '') AS tc FROM fl LEFT JOIN ow ON fl.anillo = ow.anillo),
uc AS (SELECT folder, responsable, count(*) AS n FROM (SELECT DISTINCT folder, anillo, responsable FROM pl0) GROUP BY folder, responsable),
us AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY n DESC, responsable) AS rn FROM uc),
fc AS (SELECT file_path, count(*) FILTER (WHERE contains(elemento, 'ED:') OR contains(elemento, '(ED)')) AS cl,
         count(*) FILTER (WHERE contains(elemento, 'ET') AND contains(elemento, '(EM')) AS et, count(*) FILTER (WHERE contains(elemento, 'NODO')) AS nd FROM el GROUP BY file_path),
q AS (SELECT pl0.*, coalesce(cl, 0) AS cl, coalesce(et, 0) AS et, sum(coalesce(nd, 0)) OVER (PARTITION BY folder) AS nds FROM pl0 LEFT JOIN fc ON pl0.file_path = fc.file_path),
ms AS (SELECT file_path, level, first, message FROM an WHERE message IS NOT NULL
  UNION ALL SELECT file_path, 0, 0, 'TRAZE ERRONEO' FROM q WHERE et = 0
  UNION ALL SELECT file_path, 3, 0, 'SIN RESPONSABLE' FROM q WHERE responsable = ''
  UNION ALL SELECT file_path, 4, 0, 'NCLIENTES (TZ:' || cl || ', RESP:' || tc || ')' FROM q WHERE regexp_matches(tc, '^\\d+$') AND CAST(tc AS BIGINT) <> cl
  UNION ALL SELECT file_path, 5, 0, 'TRAZE ERRONEO' FROM q WHERE nds = 0),
st AS (SELECT file_path, string_agg(message, ' | ' ORDER BY level, first, message) AS t FROM ms GROUP BY file_path)
SELECT CASE WHEN us.responsable = '' THEN q.folder ELSE q.folder || '_' || us.responsable END || '.xlsx' AS archivo, stem AS hoja, coalesce(t, 'OK') AS estado, CAST(0 AS BIGINT) AS parte
FROM q JOIN us ON q.folder = us.folder AND rn = 1 LEFT JOIN st ON q.file_path = st.file_path""",
    "trace_missing_files": f"""WITH {_OWNERS}, {_FILES} SELECT anillo AS archivo, 'responsable' AS hoja, 'FALTA ARCHIVO' AS estado, CAST(0 AS BIGINT) AS parte
FROM ow WHERE anillo NOT IN (SELECT anillo FROM fl)""",
}
