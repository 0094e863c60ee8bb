"""Port matching: parts as the port inventory, customers and orders as sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from hilvan.catalog.base import select, shape
from hilvan.operators import ports as P
from hilvan.plans import port_matching as M

# Half of the parts are equipment ports, half patch-panel ports.
INVENTORY = [
    "'P' || CAST(p_partkey AS STRING) AS id",
    "CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 3 = 0 THEN 'XG-' ELSE 'G-' END || CAST(p_partkey % 8 AS STRING) "
    "ELSE CAST(p_partkey % 12 AS STRING) END AS desc1",
    "CASE WHEN p_partkey % 2 = 0 THEN 'Slot ' || CAST(p_size % 4 AS STRING) ELSE 'BANDEJA ' || chr(CAST(65 + p_partkey % 4 AS INT)) END AS desc2",
    "CASE WHEN p_partkey % 2 = 0 THEN 'EQ' || CAST(p_partkey % 20 AS STRING) "
    "ELSE 'OPEQ' || CAST(p_size % 20 AS STRING) || '_' || CAST(p_partkey % 5 AS STRING) END AS desc3",
    "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 'B' || CAST(p_size % 3 AS STRING) END AS id_bay",
    "p_partkey AS seq",
]
# Trunk panels: one strand port per part.
TRUNK = [
    "'T' || CAST(p_partkey AS STRING) AS id", "CAST(p_partkey % 24 + 1 AS STRING) AS desc1",
    "CASE WHEN p_partkey % 9 = 0 THEN 'PP7' ELSE 'OT' || CAST(p_size AS STRING) || '_' || CAST(p_partkey % 2 AS STRING) || ' ' "
    "|| CAST(p_partkey % 3 * 12 + 1 AS STRING) || '/24' END AS desc_shelf",
    "p_partkey AS seq",
]
SHEETS = [
    "'hoja' || CAST(c_nationkey AS STRING) AS archivo", "' EQ' || CAST(c_custkey % 10 * 2 AS STRING) || ' ' AS equipo",
    "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS STRING) || '/' || CAST(c_custkey % 3 % 2 AS STRING) || '/0' "
    "|| CAST(c_custkey % 8 AS STRING) END AS puerto",
    "CAST(c_custkey % 5 AS STRING) AS odf", "lower(chr(CAST(65 + c_custkey % 4 AS INT))) AS cassetera",
    "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '1,3. 5' WHEN 3 THEN CAST(c_custkey % 12 AS STRING) ELSE '7.,9' END AS pos",
    "CASE c_custkey % 7 WHEN 0 THEN '11' ELSE NULL END AS pos2",
    "c_custkey AS seq",
]
CABLES = [
    "CAST(o_custkey % 50 + 1 AS STRING) AS fibra",
    "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'EQ' || CAST(o_orderkey % 10 * 2 AS STRING) END AS ec",
    "CAST(o_orderkey % 4 AS STRING) || '/' || CAST(o_orderkey % 3 % 2 AS STRING) || '/' || CAST(o_orderkey % 8 AS STRING) AS port_ec",
    "CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '3' WHEN 2 THEN '4-' WHEN 3 THEN '1-/ /' WHEN 4 THEN '2-A1/3' WHEN 5 THEN '3-5/B7/9' "
    "WHEN 6 THEN '4 - c11' WHEN 7 THEN '0-D3' ELSE '1-13' END AS patcheo",
    "CAST(o_custkey % 2 AS STRING) AS odf_calle", "CAST(o_custkey % 40 + 1 AS STRING) AS hilo",
    "'x_' || o_orderpriority AS anillo_origen",
    "CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'MEANILLO' || CAST(o_custkey % 30 AS STRING) END AS anillo",
    "o_orderkey AS seq",
]
RINGS = [
    "CAST(o_custkey % 50 + 1 AS STRING) AS fibra", "'EQ' || CAST(o_orderkey % 10 * 2 AS STRING) AS ec",
    "CAST(o_orderkey % 4 AS STRING) || '/' || CAST(o_orderkey % 3 % 2 AS STRING) || '/0' || CAST(o_orderkey % 8 AS STRING) AS port_ec",
    "CAST(o_orderkey % 5 AS STRING) AS odf_patcheo", "chr(CAST(97 + o_orderkey % 4 AS INT)) AS cassetera",
    "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '3+1+5' WHEN 2 THEN '7' ELSE '9+x+9' END AS port_pacheo",
    "CAST(o_custkey % 2 AS STRING) AS odf_troncal", "CAST(o_custkey % 40 + 1 AS STRING) AS hilo",
    "CASE o_orderkey % 6 WHEN 0 THEN NULL ELSE 'MEANILLO' || CAST(o_custkey % 30 AS STRING) END AS anillo",
    "o_orderkey AS seq",
]
CHANGES = [
    "CASE s_suppkey % 4 WHEN 0 THEN NULL ELSE CAST(s_suppkey % 50 + 1 AS STRING) END AS cable",
    "CASE s_suppkey % 5 WHEN 0 THEN '' ELSE 'MEANILLO' || CAST(s_suppkey % 30 AS STRING) END AS anillo",
    "CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE 'MEANILLO' || CAST(s_suppkey * 7 % 30 AS STRING) END AS anillo_actual",
    "'L' || CAST(s_nationkey AS STRING) AS iluminacion",
    "CASE s_suppkey % 6 WHEN 0 THEN 'pronto' ELSE '2024-01-1' || CAST(s_suppkey % 10 AS STRING) END AS fecha_cambio",
    "CASE s_suppkey % 2 WHEN 0 THEN ' si ' ELSE 'NO' END AS igualar", "s_suppkey AS seq",
]
REMARKS = [
    "CAST(c_custkey % 60 AS STRING) AS fibra",
    "CASE c_custkey % 4 WHEN 0 THEN 'Error grave' WHEN 1 THEN 'en BULK FILE' ELSE 'ok' END AS estado",
    "CASE c_custkey % 3 WHEN 0 THEN NULL ELSE 'obs' || CAST(c_custkey AS STRING) END AS observacion", "c_custkey AS seq",
]


def inventory(s, d):
    return shape(s, d, "part", INVENTORY)


def sheets(s, d):
    return M.match_sheets(shape(s, d, "customer", SHEETS), inventory(s, d))


def patches(s, d):
    return M.patch_rows(sheets(s, d), inventory(s, d))


#: Small parts, so that the lists of the given tables have several.
PART_BYTES = 6


def patches_in_parts(s, d):
    """List table of the patched rows, cut into short parts."""
    return M.patch_lists(sheets(s, d), inventory(s, d), part_bytes=PART_BYTES)


def _sides(s, d):
    return patches(s, d), shape(s, d, "part", TRUNK), inventory(s, d), shape(s, d, "supplier", CHANGES)


def cables(s, d):
    return M.match_cable_rows(shape(s, d, "orders", CABLES), *_sides(s, d))


def rings(s, d):
    return M.match_ring_rows(shape(s, d, "orders", RINGS), *_sides(s, d))


def ring_changes(s, d):
    rows = shape(s, d, "orders", CABLES).select("seq", "fibra", "anillo")
    return P.with_ring_change(rows, P.ring_changes(shape(s, d, "supplier", CHANGES)), "fibra", "anillo")


def filled(s, d):
    done = sheets(s, d).select("equipo", "puerto", "id_port_cabecera", "seq")
    rows = shape(s, d, "orders", CABLES).select(
        "seq", "ec", "port_ec", F.lit(None).cast("string").alias("id_port_cabecera"),
        F.when(F.col("seq") % 3 == 0, "F (x)").when(F.col("seq") % 3 == 1, "V").alias("sincroniza"),
    )
    return P.fill_from_sheets(rows, done, "ec", "port_ec", "id_port_cabecera", "sincroniza")


def remarked(s, d):
    rows = shape(s, d, "orders", CABLES).select("seq", "fibra", F.when(F.col("seq") % 2 == 0, "V").alias("sincroniza"))
    return P.append_remarks(rows, shape(s, d, "customer", REMARKS), "fibra", "sincroniza")


QUERIES = {
    "port_backbone": lambda s, d: sheets(s, d).select("seq", "archivo", "id_port_cabecera"),
    "port_patch_rows": patches,
    "port_patch_rows_parts": patches_in_parts,
    "port_match_cables": cables,
    "port_match_rings": rings,
    "ring_change": ring_changes,
    "fill_from_sheets": filled,
    "append_remarks": remarked,
}

_CLEAN = (
    "array_to_string(list_transform(string_split(regexp_replace(regexp_replace({0}, '[^0-9/-]', '', 'g'), '/$', ''), '/'), "
    "lambda s: CASE WHEN ltrim(s, '0') = '' THEN '0' ELSE ltrim(s, '0') END), '/')"
)
_INV = f"""v AS ({select('part', INVENTORY)}),
nb AS (SELECT desc3 AS eq, TRY_CAST(regexp_extract(desc2, 'Slot\\s*(\\d+)', 1) AS BIGINT) AS slot, regexp_extract(desc1, '^(XG|G)-(\\d+)$', 1) AS kind,
        TRY_CAST(regexp_extract(desc1, '^(XG|G)-(\\d+)$', 2) AS BIGINT) AS num, id, seq FROM v
      WHERE regexp_matches(desc2, 'Slot\\s*\\d+') AND regexp_matches(desc1, '^(XG|G)-\\d+$')),
nx AS (SELECT *, bool_or(kind = 'XG') OVER (PARTITION BY eq, slot) AS xg FROM nb),
pat AS (SELECT upper(regexp_extract(desc2, 'BANDEJA[^A-Za-z]*([A-Za-z])', 1)) AS tray, trim(desc3) AS k, trim(desc1) AS tok, arg_min(id, seq) AS pid
        FROM v WHERE regexp_matches(desc2, 'BANDEJA[^A-Za-z]*[A-Za-z]') AND contains(upper(desc3), 'OP') GROUP BY 1, 2, 3),
bay AS (SELECT trim(id) AS bid, arg_max(trim(id_bay), seq) AS b FROM v GROUP BY 1)"""
# First accepted candidate in row order, with the acceptance written as in the rule.
_PARTS = "string_split(trim(regexp_replace({0}, '^[A-Z]+[\\s-]?', '')), '/')"


def _backbone(rows: str, key: str, equipment: str, port: str, out: str) -> str:
    return f"""{out} AS (SELECT r.{key} AS bk, arg_min(n.id, n.seq) AS backbone FROM {rows} r JOIN nx n
  ON trim(r.{equipment}) = n.eq AND TRY_CAST({_PARTS.format('r.' + port)}[1] AS BIGINT) = n.slot AND TRY_CAST({_PARTS.format('r.' + port)}[3] AS BIGINT) = n.num
  AND len({_PARTS.format('r.' + port)}) = 3
  AND ((n.kind = 'XG' AND TRY_CAST({_PARTS.format('r.' + port)}[2] AS BIGINT) = 0)
    OR (n.kind = 'G' AND TRY_CAST({_PARTS.format('r.' + port)}[2] AS BIGINT) = CASE WHEN n.xg THEN 1 ELSE 0 END)) GROUP BY 1)"""


_SHEET = f"""{_INV}, c AS ({select('customer', SHEETS)}), {_backbone('c', 'seq', 'equipo', 'puerto', 'bb')},
cb AS (SELECT c.*, bb.backbone FROM c LEFT JOIN bb ON c.seq = bb.bk)"""
_TOKENS = "list_filter(list_transform(string_split(replace({0}, '.', ','), ','), lambda x: trim(x)), lambda x: x <> '')"
_PATCH_ROWS = f"""{_SHEET},
tk AS (SELECT *, list_concat(list_transform(coalesce({_TOKENS.format('pos')}, []), lambda x: {{'o': pos, 't': x}}),
         list_transform(coalesce({_TOKENS.format('pos2')}, []), lambda x: {{'o': pos2, 't': x}})) AS ts FROM cb),
ex AS (SELECT * EXCLUDE (ts), unnest(CASE WHEN len(ts) = 0 THEN [{{'o': NULL, 't': 'SIN_POS'}}] ELSE ts END) AS u,
         generate_subscripts(CASE WHEN len(ts) = 0 THEN [{{'o': NULL, 't': 'SIN_POS'}}] ELSE ts END, 1) AS tn FROM tk),
px AS (SELECT ex.*, u.o AS pos_original, u.t AS pos_token, pat.pid,
         CASE WHEN b1.b = b2.b THEN backbone END AS cab
       FROM ex LEFT JOIN pat ON upper(trim(ex.cassetera)) = pat.tray AND 'OP' || trim(ex.equipo) || '_' || trim(ex.odf) = pat.k
         AND u.t = pat.tok AND u.o IS NOT NULL
       LEFT JOIN bay b1 ON ex.backbone = b1.bid LEFT JOIN bay b2 ON pat.pid = b2.bid),
pr AS (SELECT archivo, trim(equipo) AS equipo, trim(odf) AS odf, upper(trim(cassetera)) AS cassetera, {_CLEAN.format('puerto')} AS puerto,
         pos_original, pos_token, pid, cab, seq, tn FROM px)"""


def _firsts(column: str, keys: str, source: str, sep: str, part: str = "0") -> str:
    """Values of a column joined once each in first-seen order, per group."""
    return f"(SELECT {keys}, {part} AS parte, string_agg(x, '{sep}' ORDER BY o) AS t FROM (SELECT {keys}, {column} AS x, min((seq, tn)) AS o FROM {source} WHERE {column} IS NOT NULL GROUP BY ALL) GROUP BY ALL)"


_K = ["archivo", "equipo", "odf", "cassetera", "puerto", "pos_original"]


def _same(a: str, b: str, keys=None) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in (keys or _K))


_KS = ", ".join(_K)
_PATCHED = f"""{_PATCH_ROWS},
op AS (SELECT {', '.join('g.' + k for k in _K)}, coalesce(a.t, '') AS pos_token, coalesce(b.t, '') AS id_port_pacheo, coalesce(e.t, '') AS id_port_cabecera,
         CAST(0 AS BIGINT) AS parte
       FROM (SELECT DISTINCT {_KS} FROM pr) g
       LEFT JOIN {_firsts('pos_token', _KS, 'pr', '+')} a ON {_same('g', 'a')}
       LEFT JOIN {_firsts('pid', _KS, 'pr', '°')} b ON {_same('g', 'b')}
       LEFT JOIN {_firsts('cab', _KS, 'pr', '°')} e ON {_same('g', 'e')})"""


def _parts_of(column: str, name: str, sep: str) -> str:
    """List table of the values of a column, each once in first-seen order, cut by bytes."""
    inner = f"SELECT {_KS}, {column} AS x, min((seq, tn)) AS o FROM pr WHERE {column} IS NOT NULL GROUP BY ALL"
    placed = f"""SELECT *, coalesce(sum(strlen(x) + {len(sep.encode())}) OVER (PARTITION BY {_KS} ORDER BY o, x
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // {PART_BYTES} AS part FROM ({inner})"""
    return f"""SELECT {_KS}, '{name}' AS lista, part, count(*) AS entries, string_agg(x, '{sep}' ORDER BY o, x) AS texto
FROM ({placed}) GROUP BY ALL"""


_CHANGE = f"""ch AS (SELECT coalesce(trim(cable), '') AS cable, coalesce(trim(anillo), '') AS anillo, coalesce(trim(anillo_actual), '') AS actual, iluminacion,
  CASE WHEN fecha_cambio = 'pronto' THEN '' ELSE fecha_cambio END AS fecha, upper(trim(igualar)) AS ig, seq FROM ({select('supplier', CHANGES)})),
cc AS (SELECT anillo AS code, seq * 2 AS o, * EXCLUDE (seq) FROM ch WHERE anillo <> '' UNION ALL SELECT actual, seq * 2 + 1, * EXCLUDE (seq) FROM ch WHERE actual <> ''),
cr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY o DESC) AS rn FROM cc) WHERE rn = 1)"""


def _changed(ring: str, fibre: str) -> str:
    return f"""CASE WHEN coalesce(trim({ring}), '') = '' THEN 'SIN ANILLO' WHEN cr.code IS NULL THEN 'SIN COINCIDENCIA'
    WHEN cr.cable <> '' AND {fibre} <> '' AND cr.cable <> {fibre} AND cr.ig <> 'SI' THEN 'SIN COINCIDENCIA'
    WHEN cr.actual = trim({ring}) THEN 'V|' || cr.actual || '|' || iluminacion || '|' || fecha
    WHEN cr.anillo = trim({ring}) THEN 'F|' || CASE WHEN cr.actual <> '' THEN cr.actual ELSE cr.anillo END || '|' || iluminacion || '|' || fecha
    ELSE 'SIN COINCIDENCIA' END"""


_TRUNK = f"""tr AS (SELECT id, desc1 AS dp, substr(desc_shelf, 3) AS rest, seq FROM ({select('part', TRUNK)}) WHERE starts_with(desc_shelf, 'OT')),
tp AS (SELECT id, dp, seq, string_split(rest, '_')[1] AS f, string_split(string_split(rest, '_')[2], ' ')[1] AS o, string_split(rest, ' ')[2] AS sh FROM tr),
tb AS (SELECT f, o, arg_min(TRY_CAST(regexp_extract(sh, '(\\d+)/', 1) AS BIGINT), seq) AS base FROM tp GROUP BY f, o),
tm AS (SELECT f, o, dp, arg_max(id, seq) AS tid, arg_max(sh, seq) AS tsh FROM tp GROUP BY f, o, dp)"""
_REG = """rg AS (SELECT equipo, puerto, bool_or(id_port_pacheo <> '') AS anyid FROM op WHERE equipo <> '' AND puerto <> '' GROUP BY ALL),
ri AS (SELECT DISTINCT equipo, puerto, trim(unnest(string_split(id_port_pacheo, '°'))) AS one FROM op)"""


def _status(missing: str) -> str:
    return f"""CASE WHEN tid IS NULL THEN 'F (sin ID_PORT_ODF-TRONCAL)' WHEN ec = '' OR port_ec = '' THEN 'F (equipo o interfaz vacío)'
    WHEN rg.equipo IS NULL THEN 'F (sin registro en OP)' WHEN NOT anyid THEN 'F (ID vacío en OP)' WHEN pid IS NULL THEN '{missing}'
    WHEN ri.one IS NULL THEN 'F (ID no coincide[93XX-C12])' ELSE 'V' END"""


def _matched(rows: str, missing: str) -> str:
    """Lookups of exploded rows ``xr`` (ec, port_ec, op, cassetera, bandeja, fibra, odf_calle, hilo, anillo, seq, tn)."""
    return f"""{rows}, {_TRUNK}, {_CHANGE}, {_REG},
{_backbone('rr', 'seq', 'ec', 'port_ec', 'bb2')},
m0 AS (SELECT xr.*, pat.pid, CASE WHEN b1.b = b2.b THEN bb2.backbone END AS cab, tm.tid, tm.dp, tm.tsh, {_changed('xr.anillo', 'xr.fibra')} AS cambio
  FROM xr LEFT JOIN bb2 ON xr.seq = bb2.bk
  LEFT JOIN pat ON xr.cassetera = pat.tray AND 'OP' || xr.ec || '_' || xr.op = pat.k AND xr.bandeja = pat.tok AND xr.ec <> ''
  LEFT JOIN bay b1 ON bb2.backbone = b1.bid LEFT JOIN bay b2 ON pat.pid = b2.bid
  LEFT JOIN tb ON xr.fibra = tb.f AND xr.odf_calle = tb.o
  LEFT JOIN tm ON xr.fibra = tm.f AND xr.odf_calle = tm.o AND CAST(TRY_CAST(xr.hilo AS BIGINT) - tb.base + 1 AS VARCHAR) = tm.dp
  LEFT JOIN cr ON trim(xr.anillo) = cr.code),
m1 AS (SELECT m0.*, {_status(missing)} AS st FROM m0 LEFT JOIN rg ON m0.ec = rg.equipo AND m0.port_ec = rg.puerto
  LEFT JOIN ri ON m0.ec = ri.equipo AND m0.port_ec = ri.puerto AND m0.pid = ri.one)"""


def _final(keys: list[str], source: str) -> str:
    ks = ", ".join(keys)
    lists = {"id_port_pacheo": "pid", "id_port_cabecera": "cab", "sincroniza": "st"}
    joins = " ".join(
        f"LEFT JOIN {_firsts(c, ks, source, '°')} {n} ON {_same('g', n, keys)}" for n, c in lists.items()
    )
    trays = f"""(SELECT {ks}, string_agg(CAST(CAST(bandeja AS BIGINT) AS VARCHAR), '+' ORDER BY CAST(bandeja AS BIGINT)) AS t
      FROM {source} WHERE regexp_matches(bandeja, '^\\d+$') GROUP BY ALL)"""
    return f"""SELECT {', '.join('g.' + k for k in keys)}, coalesce(tt.t, '') AS bandeja, {', '.join(f"coalesce({n}.t, '') AS {n}" for n in lists)}, CAST(0 AS BIGINT) AS parte
FROM (SELECT DISTINCT {ks} FROM {source}) g {joins} LEFT JOIN {trays} tt ON {_same('g', 'tt', keys)}"""


_MIXED = """mx AS (SELECT fibra AS mf, hilo AS mh FROM {0} WHERE anillo IS NOT NULL GROUP BY ALL HAVING count(DISTINCT anillo) > 1),
mk AS (SELECT {0}.* REPLACE (CASE WHEN mf IS NOT NULL THEN st || ' - ERROR: Hilos con diferentes anillos' ELSE st END AS st)
  FROM {0} LEFT JOIN mx ON fibra = mf AND hilo = mh)"""
_CABLE_ROWS = f"""{_PATCHED}, rr AS (SELECT * REPLACE (coalesce(ec, '') AS ec) FROM ({select('orders', CABLES)})),
c1 AS (SELECT *, trim(patcheo) AS pv, list_filter(list_transform(string_split(regexp_replace(trim(patcheo), '^[^-]*-', ''), '/'), lambda x: trim(x)), lambda x: x <> '') AS ts FROM rr),
c2 AS (SELECT *, CASE WHEN coalesce(pv, '') = '' THEN 'F (sin PATCHEO)' WHEN NOT contains(pv, '-') THEN 'F (formato PATCHEO sin guion)'
         WHEN len(ts) = 0 THEN 'F (PATCHEO sin bandejas)' END AS fault FROM c1),
c3 AS (SELECT *, unnest(CASE WHEN fault IS NULL THEN ts ELSE [NULL] END) AS tray, generate_subscripts(CASE WHEN fault IS NULL THEN ts ELSE [NULL] END, 1) AS tn FROM c2),
xr AS (SELECT fibra, ec, port_ec, patcheo, odf_calle, hilo, anillo_origen, anillo, seq, tn, fault, trim(string_split(pv, '-')[1]) AS op,
         CASE WHEN fault IS NULL THEN NULLIF(upper(regexp_extract(array_to_string(ts, '/'), '([A-Za-z])', 1)), '') END AS cassetera,
         CASE WHEN tray IS NOT NULL THEN regexp_extract(tray, '(\\d+)', 1) END AS bandeja FROM c3)"""
_RING_ROWS = f"""{_PATCHED}, r0 AS ({select('orders', RINGS)}),
rr AS (SELECT fibra, ec, {_CLEAN.format('port_ec')} AS port_ec, odf_patcheo AS op, upper(cassetera) AS cassetera, odf_troncal AS odf_calle, hilo,
         coalesce(anillo, '') AS anillo, seq, string_split(port_pacheo, '+') AS ts FROM r0),
xr AS (SELECT * EXCLUDE (ts), unnest(coalesce(ts, [NULL])) AS bandeja, generate_subscripts(coalesce(ts, [NULL]), 1) AS tn FROM rr)"""
_CABLE_KEYS = ["fibra", "ec", "port_ec", "patcheo", "odf_calle", "hilo", "anillo_origen", "anillo", "op", "cassetera", "id_port_troncal", "desc_port_ot", "desc_shelf_ot", "cambio"]
_RING_KEYS = ["fibra", "ec", "port_ec", "op", "cassetera", "odf_calle", "hilo", "anillo", "id_port_troncal", "desc_port_ot", "desc_shelf_ot", "cambio"]
_RENAMED = "* EXCLUDE (tid, dp, tsh){0}, tid AS id_port_troncal, dp AS desc_port_ot, tsh AS desc_shelf_ot"
_FAULT = """ REPLACE (CASE WHEN fault = 'F (sin PATCHEO)' THEN fault WHEN fault IS NOT NULL THEN CASE WHEN tid IS NULL THEN fault ELSE 'F' END ELSE st END AS st)"""

SQL = {
    "port_backbone": f"WITH {_SHEET} SELECT seq, archivo, backbone AS id_port_cabecera FROM cb",
    "port_patch_rows": f"WITH {_PATCHED} SELECT * FROM op",
    "port_patch_rows_parts": f"""WITH {_PATCH_ROWS} {_parts_of('pos_token', 'pos_token', '+')}
UNION ALL {_parts_of('pid', 'id_port_pacheo', '°')} UNION ALL {_parts_of('cab', 'id_port_cabecera', '°')}""",
    "port_match_cables": f"""WITH {_matched(_CABLE_ROWS, 'F (ID no coincide[93XX-C12])')},
m2 AS (SELECT {_RENAMED.format(_FAULT)} FROM m1),
{_MIXED.format('m2')} {_final(_CABLE_KEYS, 'mk')}""",
    "port_match_rings": f"""WITH {_matched(_RING_ROWS, 'F (sin ID_PORT_PACHEO en OP)')}, m2 AS (SELECT {_RENAMED.format('')} FROM m1),
{_MIXED.format('m2')} {_final(_RING_KEYS, 'mk')}""",
    "ring_change": f"""WITH {_CHANGE}, r AS ({select('orders', CABLES)})
SELECT r.seq, r.fibra, r.anillo, {_changed('r.anillo', 'r.fibra')} AS cambio FROM r LEFT JOIN cr ON trim(r.anillo) = cr.code""",
    "fill_from_sheets": f"""WITH {_SHEET}, k AS (SELECT trim(equipo) AS e, {_CLEAN.format("coalesce(puerto, '')")} AS p, arg_max(backbone, seq) AS b FROM cb WHERE backbone IS NOT NULL GROUP BY 1, 2),
r AS (SELECT seq, ec, port_ec, CASE WHEN seq % 3 = 0 THEN 'F (x)' WHEN seq % 3 = 1 THEN 'V' END AS s FROM ({select('orders', CABLES)}))
SELECT seq, ec, port_ec, b AS id_port_cabecera, CASE WHEN b IS NOT NULL AND (contains(coalesce(s, ''), 'F') OR NOT contains(coalesce(s, ''), 'V')) THEN 'V - usando EC (ID respaldo)' ELSE s END AS sincroniza,
  b IS NOT NULL AS rellenado FROM r LEFT JOIN k ON coalesce(r.ec, '') = k.e AND {_CLEAN.format('r.port_ec')} = k.p""",
    "append_remarks": f"""WITH q AS (SELECT *, CASE WHEN contains(lower(estado), 'error') THEN 'OM' WHEN contains(lower(estado), 'bulk file') THEN 'BULK' END AS tag FROM ({select('customer', REMARKS)})),
g AS (SELECT fibra, max(CASE WHEN tag = 'OM' THEN 'OM' END) AS om, max(CASE WHEN tag = 'BULK' THEN 'BULK' END) AS bk, string_agg(observacion, ' | ' ORDER BY seq) AS obs FROM q WHERE tag IS NOT NULL GROUP BY fibra),
r AS (SELECT seq, fibra, CASE WHEN seq % 2 = 0 THEN 'V' END AS s FROM ({select('orders', CABLES)}))
SELECT r.seq, r.fibra, CASE WHEN g.fibra IS NULL THEN s ELSE concat_ws(' | ', om, bk, s, obs) END AS sincroniza, CAST(0 AS BIGINT) AS parte FROM r LEFT JOIN g ON r.fibra = g.fibra""",
}
