"""Entity audits over exports built from orders, customers and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hilvan.catalog.base import select, shape, table
from hilvan.operators.prioritize import prioritise
from hilvan.plans import audit_buildings as AB
from hilvan.plans import audit_cables as AC
from hilvan.plans import audit_ports as AP
from hilvan.plans import audit_splices as AS
from hilvan.plans.audit import all_findings
from hilvan.plans.findings import building_owners, cable_owners

OWNER = "R7"
CABLES = [
    "'F' || CAST(o_orderkey AS STRING) AS id", "o_orderkey AS seq",
    "CASE o_orderkey % 6 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN CAST(o_custkey AS STRING) || '/A' WHEN 2 THEN CAST(o_custkey AS STRING) || '-SUB' "
    "WHEN 3 THEN CAST(o_custkey AS STRING) || '-' || CAST(o_orderkey % 7 AS STRING) WHEN 4 THEN CAST(o_custkey AS STRING) || '-1-2' ELSE 'P' || CAST(o_custkey AS STRING) END AS nombre",
    "CASE WHEN o_orderkey % 6 < 2 THEN 'Troncal-Acceso' WHEN o_custkey % 3 = 0 THEN 'Troncal-Transporte' ELSE 'Ultima Milla' END AS colocacion",
    "CASE o_orderkey % 5 WHEN 0 THEN 'Ductado 144 Hilos' WHEN 1 THEN 'Ductado 96 Hilos' ELSE 'Ductado 24 Hilos' END AS especificacion",
    "CASE o_orderkey % 3 WHEN 0 THEN 'R7' ELSE 'R8' END AS propietario",
    "CASE o_orderkey % 9 WHEN 0 THEN 'pa' WHEN 1 THEN '' WHEN 2 THEN 'x' ELSE 'is' END AS estado",
    "CASE o_orderkey % 4 WHEN 0 THEN '12' ELSE NULL END AS nombre_ant",
    "CAST(o_custkey % 7 AS STRING) AS nodo_a", "CASE o_orderkey % 5 WHEN 0 THEN '' ELSE CAST(o_custkey % 7 AS STRING) END AS nodo_b",
    "CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'M2' ELSE 'M1' END AS municipio_a", "CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE 'M1' END AS municipio_b",
]
SPLICES = [
    "'E' || CAST(o_orderkey AS STRING) AS id", "o_orderkey AS seq",
    "CASE o_orderkey % 7 WHEN 0 THEN 'ET' || CAST(o_custkey % 200 AS STRING) || '_' || CAST(o_orderkey % 300 AS STRING) "
    "WHEN 1 THEN 'NAP' || CAST(o_custkey % 200 AS STRING) || '_' || CAST(o_orderkey % 40 AS STRING) "
    "WHEN 2 THEN 'ET' || CAST(o_custkey % 200 AS STRING) || '-SUB_' || CAST(o_orderkey % 9 AS STRING) WHEN 3 THEN 'EA' || CAST(o_custkey AS STRING) "
    "WHEN 4 THEN 'OB' || CAST(o_orderkey AS STRING) WHEN 5 THEN 'ET' || CAST(o_custkey % 900 + 1000 AS STRING) || '_' || CAST(o_orderkey % 5000 AS STRING) "
    "ELSE 'ET' || CAST(o_orderkey AS STRING) END AS nombre",
    "CASE WHEN o_orderkey % 7 = 1 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'Tipo 2' ELSE 'Nap Sotano ' || CAST(o_orderkey % 3 * 12 AS STRING) END "
    "WHEN o_custkey % 2 = 0 THEN 'Tipo 2' WHEN o_orderkey % 4 = 0 THEN 'Tipo 0' WHEN o_orderkey % 4 = 1 THEN 'Otro' ELSE 'Tipo 1' END AS especificacion",
    "'R7' AS propietario", "'is' AS estado",
]
BUILDINGS = [
    "CAST(c_custkey AS STRING) AS id", "c_custkey AS seq",
    "CASE c_custkey % 8 WHEN 0 THEN 'ACME ' || CAST(c_custkey % 40 AS STRING) WHEN 1 THEN 'Acme ' || CAST(c_custkey % 40 AS STRING) || '.' WHEN 2 THEN c_mktsegment || '/' || CAST(c_custkey % 4 AS STRING) "
    "WHEN 3 THEN 'TORRE ' || CAST(c_custkey AS STRING) WHEN 4 THEN 'NODO ' || CAST(c_custkey AS STRING) WHEN 5 THEN c_mktsegment WHEN 6 THEN 'CASA S A S' ELSE '' END AS nombre",
    "CASE c_custkey % 5 WHEN 0 THEN 'Torre' WHEN 1 THEN '' ELSE 'Casa' END AS tipo", "CASE c_custkey % 3 WHEN 0 THEN 'AAA' ELSE 'B' END AS categoria",
    "'700' AS floor_len", "CASE c_custkey % 2 WHEN 0 THEN '700' ELSE '5' END AS floor_wid", "'3' AS rooms_len", "'0' AS rooms_wid", "'1' AS floors",
]
PORTS = [
    "CAST(o_orderkey AS STRING) AS id", "o_orderkey AS seq", "CAST(o_orderkey % 13 AS STRING) AS description", "'Rx - Tx' AS tipo_senal",
    "CASE o_orderstatus WHEN 'O' THEN 'IS' WHEN 'F' THEN 'Spare' ELSE 'In Service' END AS physical_status",
    "CASE WHEN o_orderkey % 5 = 0 THEN 'ODF' ELSE 'Equipo Cliente' END AS type", "'unknown' AS connector_type", "'Megabyte' AS unidad_ancho_banda", "'Fiber' AS service_level",
    "'ME1' AS proyecto_red", "'CAV12345' AS id_servicio", "'0' AS equipo_central", "'1/2' AS puerto_central",
    "CASE o_orderkey % 6 WHEN 0 THEN 'ACME ' || CAST(o_custkey % 40 AS STRING) || ' SAS' WHEN 1 THEN 'OTRO ' || CAST(o_custkey % 300 AS STRING) WHEN 2 THEN 'acme' WHEN 3 THEN '' "
    "WHEN 4 THEN 'BUILDING' ELSE 'ACME ' || CAST(o_custkey % 40 AS STRING) END AS nombre_cliente",
    "'CL1' AS direccion_cliente_id", "CASE o_orderkey % 11 WHEN 0 THEN 'adicion 1' ELSE NULL END AS comentarios", "'R' AS anillo", "'OC-12345' AS cambio_service_manager",
    "'' AS name_building", "CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey + 1000000000 AS STRING) ELSE CAST(o_custkey AS STRING) END AS building_id",
    "CASE o_orderkey % 17 WHEN 0 THEN '' ELSE 'S' || CAST(o_custkey % 400 AS STRING) END AS shelf_id",
    "CASE o_custkey % 20 WHEN 0 THEN 'OT12' WHEN 1 THEN 'pp1' WHEN 2 THEN 'X' ELSE 'DEMARCADOR CLIENTE' END AS shelf_description", "'is' AS construction_status",
    "CASE o_custkey % 3 WHEN 0 THEN 'ODF Troncal' ELSE 'x' END AS shelf_tipo", "'G' AS shelf_tecnologia", "'' AS shelf_ip", "'1' AS shelf_nivel", "'CO' AS contratista", "'no' AS shelf_migracion",
    "'B' || CAST(o_custkey % 50 AS STRING) AS bay_id", "'1' AS bay_number", "'BASTIDOR CLIENTE' AS bay_description", "'OF 1' AS bay_salon", "CASE o_custkey % 4 WHEN 0 THEN '2' ELSE '1' END AS bay_fila",
]
OWNERS = [
    "CAST(s_suppkey AS STRING) || '/x' AS cable_acceso", "CAST(s_suppkey * 3 AS STRING) AS id_edificio",
    "'resp' || CAST(s_nationkey AS STRING) AS responsable", "s_suppkey AS seq",
]
NODES = [
    "CASE p_partkey % 3 WHEN 0 THEN 'ok ' ELSE 'NO' END AS validacion",
    "CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey % 700 AS STRING) ELSE CAST(p_partkey % 700 AS STRING) || '-' || CAST(p_size % 7 AS STRING) END AS troncal",
    "CASE p_partkey % 4 WHEN 0 THEN CAST(p_size % 7 AS STRING) ELSE '\"' || CAST(p_size % 7 AS STRING) || '\" | ' || CAST(p_partkey % 7 AS STRING) END AS ids_distribucion",
    "p_partkey AS seq",
]
SHORT = ["id", "value", "owner", "message"]


def cables(s, d):
    return AC.prepare(shape(s, d, "orders", CABLES))


def splices(s, d):
    return AS.prepare(shape(s, d, "orders", SPLICES))


def by_cable(s, d):
    return cable_owners(shape(s, d, "supplier", OWNERS))


def trunks(s, d):
    return AC.trunk_findings(cables(s, d), by_cable(s, d)).select(*SHORT)


def municipalities(s, d):
    return AC.municipality_findings(cables(s, d), by_cable(s, d)).select(*SHORT)


def nodes(s, d):
    return AC.node_findings(cables(s, d), AC.node_rules(shape(s, d, "part", NODES))).select(*SHORT)


def repeats(s, d):
    return AS.repeat_findings(splices(s, d), by_cable(s, d)).select(*SHORT)


def groups(s, d):
    return AS.group_findings(splices(s, d), by_cable(s, d)).select(*SHORT)


def sequences(s, d):
    return AS.sequence_findings(splices(s, d), by_cable(s, d)).select(*SHORT)


def cable_types(s, d):
    return AS.cable_findings(splices(s, d), by_cable(s, d)).select(*SHORT)


def merged(s, d):
    base = cables(s, d)
    return AS.merge_findings(splices(s, d), AC.specifications(base), base, by_cable(s, d)).select(*SHORT)


def buildings(s, d):
    out = AB.building_findings(shape(s, d, "customer", BUILDINGS), building_owners(shape(s, d, "supplier", OWNERS)))
    return out.select(*SHORT)


def structures(s, d):
    out = AB.structure_findings(shape(s, d, "customer", BUILDINGS), building_owners(shape(s, d, "supplier", OWNERS)))
    return out.select(*SHORT)


def ports(s, d):
    return AP.audit_ports(shape(s, d, "orders", PORTS), shape(s, d, "customer", BUILDINGS)).select("entity", *SHORT)


def excluded(s, d):
    """Port audit without the ids named by the excluded list (every part key)."""
    ids = table(s, d, "part").select(F.col("p_partkey").cast("string").alias("id"))
    return AP.audit_ports(shape(s, d, "orders", PORTS), shape(s, d, "customer", BUILDINGS), ids).select("entity", *SHORT)


def report(s, d):
    """All entities together, the most important findings of each element."""
    tables = {
        "cables": shape(s, d, "orders", CABLES), "splices": shape(s, d, "orders", SPLICES),
        "buildings": shape(s, d, "customer", BUILDINGS), "ports": shape(s, d, "orders", PORTS),
    }
    found = all_findings(tables, shape(s, d, "supplier", OWNERS), OWNER, nodes=shape(s, d, "part", NODES))
    return prioritise(found, OWNER).select("entity", *SHORT, "priority", "field", "part")


QUERIES = {
    "audit_cable_trunks": trunks,
    "audit_cable_municipalities": municipalities,
    "audit_cable_nodes": nodes,
    "audit_splice_repeats": repeats,
    "audit_splice_groups": groups,
    "audit_splice_sequences": sequences,
    "audit_splice_cables": cable_types,
    "audit_merge": merged,
    "audit_buildings": buildings,
    "audit_structures": structures,
    "audit_ports": ports,
    "audit_ports_excluded": excluded,
    "audit_report": report,
}

_BASE = r"""CASE WHEN NOT contains({0}, '-') OR regexp_matches({0}, '^[^-]*-\d+$') THEN {0}
  WHEN regexp_matches({0}, '^[^-]*-\d+-\d+$') THEN string_split({0}, '-')[1] || '-' || string_split({0}, '-')[2]
  ELSE coalesce(NULLIF(regexp_extract({0}, '^(\d+(?:-\d+)?)', 1), ''), {0}) END"""
_OWN = f"""ow AS (SELECT string_split(cable_acceso, '/')[1] AS k, arg_max(responsable, seq) AS o FROM ({select('supplier', OWNERS)}) GROUP BY 1)"""
_CAB = f"""c0 AS (SELECT *, string_split(nombre, '/')[1] AS base_raw, lower(especificacion) AS esp,
  CASE estado WHEN 'pa' THEN 'Plan Abandono' WHEN 'is' THEN 'En servicio' ELSE estado END AS est FROM ({select('orders', CABLES)}) WHERE estado <> ''),
c AS (SELECT *, {_BASE.format('base_raw')} AS base, NULLIF(regexp_extract(nombre, '^(\\d+)', 1), '') AS num FROM c0), {_OWN}"""
_SPL = f"""s AS (SELECT *, CASE WHEN nombre LIKE 'NAP%' THEN substr(nombre, 4) ELSE substr(nombre, 3) END AS corto,
  regexp_matches(nombre, '^(ET|NAP)') AND contains(nombre, '_') AS chained FROM ({select('orders', SPLICES)})),
g AS (SELECT *, CASE WHEN chained AND contains(nombre, '-SUB') THEN regexp_extract(nombre, '^((ET|NAP)\\d+-SUB)', 1) WHEN chained THEN string_split(nombre, '_')[1] ELSE '' END AS grupo,
  CASE WHEN nombre LIKE 'NAP%' AND especificacion LIKE 'Nap Sotano%' THEN 'Nap Sotano' ELSE especificacion END AS kind FROM s), {_OWN}"""


def _owned(key: str) -> str:
    return f"coalesce((SELECT o FROM ow WHERE ow.k = {key}), '-')"


def _major(source: str, key: str, value: str, where: str = "true") -> str:
    """Majority per key, ties by first row: (k, v, kinds)."""
    return f"""(SELECT k, v, kinds FROM (SELECT {key} AS k, {value} AS v, count(*) OVER (PARTITION BY {key}) AS kinds,
  row_number() OVER (PARTITION BY {key} ORDER BY n DESC, f) AS rn FROM (SELECT {key}, {value}, count(*) AS n, min(seq) AS f FROM {source} WHERE {where} GROUP BY ALL)) WHERE rn = 1)"""


_TRUNK = "NOT contains(nombre, '-') AND colocacion IN ('Troncal-Acceso', 'Troncal-Transporte') AND base <> ''"
_NODES = f"""n0 AS (SELECT trim(troncal) AS t, trim(unnest(string_split(replace(ids_distribucion, '"', ''), '|'))) AS node, seq FROM ({select('part', NODES)}) WHERE upper(trim(validacion)) = 'OK'),
nr AS (SELECT t, node, min(seq) AS seq FROM n0 WHERE node <> '' GROUP BY ALL),
nt AS (SELECT t, count(*) AS n, min(node) AS lone, min(seq) AS seq FROM nr GROUP BY t),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn, NULLIF(regexp_extract(nombre, '^(\\d+(?:-\\d+)?)', 1), '') AS b FROM c) WHERE rn = 1 AND b IS NOT NULL),
bs AS (SELECT DISTINCT b, string_split(b, '-')[1] AS hd FROM f),
ru AS (SELECT b, coalesce((SELECT t FROM nt WHERE t = b), CASE WHEN contains(b, '-') THEN (SELECT t FROM nt WHERE t = hd) END,
  (SELECT arg_min(t, (seq, t)) FROM nt WHERE starts_with(b, t) OR starts_with(t, hd))) AS t FROM bs),
ck AS (SELECT f.*, ru.t, nt.n, nt.lone, coalesce(nodo_a, '') AS na, coalesce(nodo_b, '') AS nb FROM f JOIN ru ON f.b = ru.b JOIN nt ON ru.t = nt.t)"""
_COMPANY = "trim(regexp_replace(regexp_replace(regexp_replace({0}, '\\s+S\\.?A\\.?S\\.?', '', 'g'), '[.,]', '', 'g'), '\\s+', ' ', 'g'))"
_BUILD = f"""b AS (SELECT *, string_split(nombre, '/')[1] AS base, regexp_matches(nombre, '\\s+S\\s+A\\s+S?$') AS spaced FROM ({select('customer', BUILDINGS)})),
u AS {_major('b', 'base', 'tipo', "base <> ''")}, ow AS (SELECT id_edificio AS k, arg_max(responsable, seq) AS o FROM ({select('supplier', OWNERS)}) GROUP BY 1)"""


def _ports_sql(where: str = "") -> str:
    """The port audit; only rules that can fire on the shape above are spelled out."""
    return f"""WITH bn AS (SELECT id, upper(trim(nombre)) AS nm FROM ({select('customer', BUILDINGS)}) WHERE trim(nombre) <> ''),
bx AS (SELECT {_COMPANY.format('nm')} AS k, arg_min(nm, id) AS nm FROM bn GROUP BY 1),
p0 AS (SELECT *, CASE WHEN physical_status = 'IS' THEN 'IN SERVICE' ELSE physical_status END AS ps, upper(shelf_description) AS sd FROM ({select('orders', PORTS)}) {where}),
p1 AS (SELECT *, CASE WHEN contains(sd, 'OT') THEN 'OT' WHEN contains(sd, 'OI') THEN 'OI' WHEN contains(sd, 'PP') THEN 'PP' END AS central, upper(nombre_cliente) AS cu FROM p0),
sp AS (SELECT cu, count(DISTINCT building_id) AS nb FROM p1 WHERE cu <> '' GROUP BY cu),
p2 AS (SELECT p1.*, nb, coalesce(bn.nm, CASE WHEN bn.id IS NULL THEN bx.nm END) AS site, {_COMPANY.format('p1.cu')} AS cn FROM p1 LEFT JOIN sp ON p1.cu = sp.cu
  LEFT JOIN bn ON p1.building_id = bn.id LEFT JOIN bx ON {_COMPANY.format('p1.cu')} = bx.k),
p3 AS (SELECT *, {_COMPANY.format('site')} AS sn FROM p2),
p4 AS (SELECT *, CASE WHEN NOT (upper(ps) = 'IN SERVICE' OR coalesce(contains(upper(comentarios), 'ADICION'), false)) THEN NULL
   WHEN nombre_cliente = '' THEN 'NOMBRE CLIENTE VACIO' WHEN nombre_cliente <> cu THEN 'NOMBRE CLIENTE: ' || cu
   WHEN site <> '' AND NOT regexp_matches(sn, '^(C\\.C|ANT|\\(SED\\)|\\(REDP\\)|COLEGIO|TM|EDIFICIO|IED|TORRE|NODO)') AND coalesce(nb, 0) <= 5
     AND NOT (contains(sn, cn) OR contains(cn, sn)) THEN 'NOMBRE CLIENTE | Posible esperado: ''' || site || '''' END AS fault FROM p3),
cl AS (SELECT * FROM p4 WHERE central IS NULL), ok AS (SELECT * FROM cl WHERE fault IS NULL),
sq0 AS (SELECT *, CAST(description AS BIGINT) AS num FROM cl WHERE shelf_id <> '' AND shelf_id NOT IN (SELECT shelf_id FROM p4 WHERE central IS NOT NULL AND shelf_id <> '')),
sq AS (SELECT *, row_number() OVER (PARTITION BY shelf_id ORDER BY num, seq) AS pos FROM sq0),
sr AS (SELECT *, max(CASE WHEN upper(ps) = 'IN SERVICE' THEN pos END) OVER (PARTITION BY shelf_id) AS lp, max(CASE WHEN upper(ps) = 'IN SERVICE' THEN num END) OVER (PARTITION BY shelf_id) AS ln FROM sq),
raw AS (SELECT id, '' AS shelf_id, description AS shown, seq, 40 AS stage, 'TYPE INVALIDO. Debe ser ''ODF'' para central (actual: ''' || type || ''')' AS message FROM p4 WHERE central IS NOT NULL AND type <> 'ODF'
  UNION ALL SELECT id, shelf_id, nombre_cliente, seq, 41, fault FROM cl WHERE fault IS NOT NULL
  UNION ALL SELECT id, shelf_id, description, seq, 41, 'TYPE (solo Equipo Cliente) (actual: ''ODF'')' FROM ok WHERE type = 'ODF'
  UNION ALL SELECT id, shelf_id, description, seq, 42, CASE WHEN lp IS NULL THEN 'SECUENCIA: SIN_IN_SERVICE'
    ELSE 'SECUENCIA: SPARE_ANTES_DE_IN_SERVICE (puerto ' || num || ', último ' || ln || ')' END FROM sr WHERE upper(ps) <> 'IN SERVICE' AND CASE WHEN lp IS NULL THEN pos = 1 ELSE pos < lp END)
SELECT 'PORT' AS entity, string_agg(id, ' , ' ORDER BY stage, seq) AS id, arg_min(shown, (stage, seq)) AS value, '' AS owner, message FROM raw
  GROUP BY CASE WHEN shelf_id = '' THEN '#' || id ELSE shelf_id END, message
UNION ALL SELECT 'SHELF', shelf_id, 'SHELF: ' || shelf_description, '', 'DESCRIPTION INVALIDA. ACTUAL:''X''' FROM ok WHERE shelf_id <> '' AND shelf_description = 'X' {{ex_shelf}}
UNION ALL SELECT 'SHELF', CASE WHEN shelf_id = '' THEN id ELSE shelf_id END, 'SHELF: ' || shelf_description, '', 'TIPO INVALIDO. Esperado: ''' ||
  CASE central WHEN 'OT' THEN 'ODF Troncal' ELSE 'ODF Pacheo' END || ''', actual: ''' || shelf_tipo || '''' FROM p4
  WHERE central IS NOT NULL AND upper(shelf_tipo) <> CASE central WHEN 'OT' THEN 'ODF TRONCAL' ELSE 'ODF PACHEO' END
UNION ALL SELECT 'BAY', bay_id, 'BAY: BASTIDOR CLIENTE', '', 'NUMERO FILA INVALIDO. ACTUAL: 2' FROM ok WHERE bay_fila = '2'""".replace("{ex_shelf}", "")


SQL = {
    "audit_cable_trunks": f"""WITH {_CAB}, t AS (SELECT * FROM c WHERE {_TRUNK}), a AS {_major('t', 'base', 'esp')}, e AS {_major('t', 'base', 'est')}
SELECT id, nombre AS value, {_owned('base')} AS owner, 'MERGE | Cable ''' || base || ''' tiene mayoría ''' || v || ''' | MAYORÍA: ''' || v || ''' , ACTUAL: ''' || esp || '''' AS message FROM t JOIN a ON base = k WHERE kinds > 1 AND esp <> v
UNION ALL SELECT id, nombre, {_owned('base')}, 'STATUS ADMITIDOS (En servicio/Plan Abandono/Futuro) | MAYORÍA: ''' || v || ''' , ACTUAL: ''' || est || '''' FROM t JOIN e ON base = k WHERE kinds > 1 AND est <> v""",
    "audit_cable_municipalities": f"""WITH {_CAB}, x AS (SELECT *, coalesce(municipio_a, '') AS ma, coalesce(municipio_b, '') AS mb FROM c WHERE num IS NOT NULL
  AND num NOT IN (SELECT num FROM c WHERE num IS NOT NULL AND colocacion IN ('Troncal-Acceso', 'Troncal-Transporte'))),
v AS (SELECT num, seq * 2 AS o, ma AS m FROM x UNION ALL SELECT num, seq * 2 + 1, mb FROM x),
w AS (SELECT num, m, count(*) AS n, min(o) AS f FROM v WHERE m <> '' GROUP BY ALL),
u AS (SELECT num, m, printf('%.1f', round_even(n * 100.0 / tot, 1)) AS pct FROM (SELECT *, sum(n) OVER (PARTITION BY num) AS tot, row_number() OVER (PARTITION BY num ORDER BY n DESC, f) AS rn FROM w) WHERE rn = 1),
r AS (SELECT x.*, u.m, u.pct FROM x JOIN u ON x.num = u.num)
SELECT id, nombre AS value, {_owned('num')} AS owner, 'MUNICIPIO (Vacío) | SUGERIDO: ''' || m || ''' (' || pct || '%)' AS message FROM r WHERE ma = ''
UNION ALL SELECT id, nombre, {_owned('num')}, 'MUNICIPIO A INCONSISTENTE | Municipio A ''' || ma || ''' no coincide con predominante ''' || m || ''' (' || pct || '%)' FROM r WHERE ma NOT IN ('', m)
UNION ALL SELECT id, nombre, {_owned('num')}, 'MUNICIPIO (Vacío) | SUGERIDO: ''' || m || ''' (' || pct || '%)' FROM r WHERE mb = ''
UNION ALL SELECT id, nombre, {_owned('num')}, 'MUNICIPIO B INCONSISTENTE | Municipio B ''' || mb || ''' no coincide con predominante ''' || m || ''' (' || pct || '%)' FROM r WHERE mb NOT IN ('', m)""",
    "audit_cable_nodes": f"""WITH {_CAB}, {_NODES}
SELECT id, nombre AS value, propietario AS owner, 'NODO INVÁLIDO | CORREGIR SEGÚN ODFS: A=''' || lone || ''', B=''' || lone || ''' | ACTUAL A=''' || na || ''' B=''' || nb || '''' AS message FROM ck WHERE n = 1 AND (na <> lone OR nb <> lone)
UNION ALL SELECT id, nombre, propietario, 'NODO A Y B | Nodos no coinciden con ODFS' FROM ck WHERE n > 1 AND ((na <> '' AND NOT EXISTS (SELECT 1 FROM nr WHERE nr.t = ck.t AND node = na)) OR (nb <> '' AND NOT EXISTS (SELECT 1 FROM nr WHERE nr.t = ck.t AND node = nb)))""",
    "audit_splice_repeats": f"""WITH {_SPL} SELECT string_agg(id, ' , ' ORDER BY seq) AS id, nombre AS value, {_owned('any_value(corto)')} AS owner, 'DUPLICADO)' AS message
FROM s WHERE NOT chained GROUP BY nombre HAVING count(*) > 1""",
    "audit_splice_groups": f"""WITH {_SPL}, m AS {_major('g', 'grupo', 'kind', "grupo <> '' AND kind IN ('Tipo 0', 'Tipo 1', 'Tipo 2', 'Empalme Cliente', 'Nap Sotano')")},
r AS (SELECT g.*, v FROM g JOIN m ON grupo = k WHERE grupo <> '')
SELECT id, nombre AS value, {_owned('corto')} AS owner, 'TIPO DE GRUPO (' || CASE WHEN grupo LIKE 'NAP%' THEN 'para ' || grupo || ', ' ELSE '' END || 'esperado: ''' || v || ''', actual: ''' || especificacion || ''')' AS message
FROM r WHERE CASE WHEN grupo LIKE 'NAP%' THEN (especificacion LIKE 'Nap Sotano%') <> (v = 'Nap Sotano') ELSE especificacion IN ('Tipo 0', 'Tipo 1', 'Tipo 2', 'Empalme Cliente') AND especificacion <> v END""",
    "audit_splice_sequences": f"""WITH {_SPL}, n AS (SELECT *, regexp_extract(nombre, '^((ET|NAP)\\d+)_\\d+$', 1) AS px, CAST(regexp_extract(nombre, '_(\\d+)$', 1) AS BIGINT) AS num FROM s WHERE regexp_matches(nombre, '^(ET|NAP)\\d+_\\d+$')),
o AS (SELECT *, row_number() OVER (PARTITION BY px, num ORDER BY seq) AS rn, count(*) OVER (PARTITION BY px, num) AS c FROM n),
d AS (SELECT *, lead(num) OVER (PARTITION BY px ORDER BY num) AS nx, max(c) OVER (PARTITION BY px) AS mc FROM o WHERE rn = 1)
SELECT a.id || ' , ' || b.id AS id, a.nombre AS value, {_owned('b.corto')} AS owner, 'DUPLICADO)' AS message FROM o a JOIN o b ON a.px = b.px AND a.num = b.num AND a.rn = 1 AND b.rn = 2
UNION ALL SELECT id, nombre, {_owned('corto')}, CASE WHEN nx - num = 2 THEN 'CONSECUTIVO _' || (num + 1) || ' después del _' || num || ')'
  ELSE 'CONSECUTIVO _' || num || ' y el _' || nx || '. Faltan: ' || CASE WHEN nx - num <= 4 THEN array_to_string(list_transform(range(num + 1, nx), lambda x: '_' || x), ', ') ELSE '_' || (num + 1) || ' al _' || (nx - 1) END || ')' END
FROM d WHERE mc = 1 AND nx - num >= 2""",
    "audit_splice_cables": f"""WITH {_SPL}, n AS (SELECT *, CASE WHEN contains(nombre, '-SUB') THEN regexp_extract(nombre, '^((ET|NAP)\\d+)-SUB', 1) || '-SUB' ELSE regexp_extract(nombre, '^((ET|NAP)\\d+)', 1) END AS cable,
  regexp_extract(nombre, '^(ET|NAP)(\\d+)', 2) AS numero FROM g WHERE regexp_matches(nombre, '^(ET|NAP)\\d+') AND (especificacion LIKE 'Nap Sotano %' OR especificacion IN ('Tipo 0', 'Tipo 1', 'Tipo 2', 'Empalme Cliente'))),
m AS {_major('n', 'cable', 'kind')}
SELECT id, nombre AS value, {_owned('numero')} AS owner, 'TIPO DE CABLE INCONSISTENTE | Cable ' || cable || ' tiene mayoría ''' || v || ''' | MAYORÍA: ''' || v || ''' , ACTUAL: ''' || especificacion || '''' AS message
FROM n JOIN m ON cable = k WHERE kinds > 1 AND kind <> v AND (cable NOT LIKE '%NAP%' OR (kind = 'Nap Sotano') <> (v = 'Nap Sotano'))""",
    "audit_merge": f"""WITH {_CAB}, {_SPL.rsplit(', ow AS', 1)[0]},
ch AS (SELECT regexp_extract(nombre, '^(ET|NAP)', 1) AS kd, regexp_extract(nombre, '^(ET|NAP)(\\d+)', 2) AS code, contains(nombre, '-SUB') AS sub, min(kind) AS ty, count(*) AS n, arg_min(id, seq) AS fid
  FROM g WHERE chained GROUP BY 1, 2, 3 HAVING min(kind) = max(kind)),
sm AS (SELECT base AS name, arg_max(esp, seq) AS spec, 'principal' AS src FROM c WHERE base <> '' GROUP BY base),
sr AS (SELECT base_raw AS name, arg_max(esp, seq) AS spec, 'respaldo' AS src FROM c WHERE base_raw <> '' AND base_raw NOT IN (SELECT name FROM sm) GROUP BY base_raw),
sp AS (SELECT *, regexp_extract(name, '^(\\d+)', 1) AS code, name LIKE '%-SUB' AS sub, CASE WHEN spec LIKE 'ductado 144%' THEN 'Tipo 0' WHEN spec LIKE 'ductado 96%' THEN 'Tipo 1' ELSE 'Tipo 2' END AS ex
  FROM (SELECT * FROM sm UNION ALL SELECT * FROM sr) WHERE regexp_matches(name, '^\\d+(-SUB)?$')),
fc AS (SELECT base, arg_min(id, seq) AS cid FROM c WHERE base <> '' GROUP BY base)
SELECT coalesce(cid, fid) AS id, 'FI:' || name || CASE WHEN ch.sub THEN ' (sub-anillo ''' ELSE ' (cable principal ''' END || ch.code || ''')' AS value, {_owned('ch.code')} AS owner,
  'MERGE (' || CASE WHEN ch.sub THEN CASE kd WHEN 'ET' THEN 'SUB-ANILLO' ELSE 'NAP SUB-ANILLO' END ELSE CASE kd WHEN 'ET' THEN 'CABLE PRINCIPAL' ELSE 'NAP PRINCIPAL' END END
  || ') | FI:''' || name || ''' (' || spec || ' → actual: ''' || ex || ''' | Todos los empalmes (' || n || ') tienen: ''' || ty || ''' | ' ||
  CASE WHEN ch.sub THEN 'PROBLEMA EN SUB-ANILLO' ELSE 'PROBLEMA EN FIBRA PRINCIPAL' END || ': Todos los empalmes concuerdan entre sí pero no con la fibra | RECOMENDACIÓN: Corregir especificación de fibra a ''' || ty || ''''
  || CASE WHEN src = 'respaldo' THEN ' [FI de archivo respaldo]' ELSE '' END AS message
FROM ch JOIN sp ON ch.code = sp.code AND ch.sub = sp.sub LEFT JOIN fc ON name = base WHERE ty <> ex""",
    "audit_buildings": f"""WITH {_BUILD}
SELECT id, nombre AS value, coalesce((SELECT o FROM ow WHERE k = id), 'RESPONSABLE NO ENCONTRADO') AS owner, 'NOMBRE (Sufijo con espacios)''' AS message FROM b WHERE spaced
UNION ALL SELECT id, nombre, '...', concat_ws(' | ', CASE WHEN categoria <> 'AAA' THEN 'CATEGORIA (AAA) (actual: ' || categoria || ')' END,
  CASE WHEN base <> '' AND tipo <> '' AND tipo <> v THEN 'TIPO DE GRUPO (esperado: ''' || v || ''', actual: ''' || tipo || ''')' END,
  CASE WHEN nombre <> '' AND nombre NOT LIKE 'NODO%' AND contains(nombre, '/') THEN 'NOMBRE (Valor Inválido): ''/''' END,
  CASE WHEN nombre <> '' AND nombre NOT LIKE 'NODO%' AND nombre <> upper(nombre) THEN 'NOMBRE (usar: ' || upper(nombre) || ')' END) AS message
FROM b LEFT JOIN u ON base = u.k WHERE message <> ''""",
    "audit_structures": f"""WITH {_BUILD} SELECT id, nombre AS value, coalesce((SELECT o FROM ow WHERE k = id), 'RESPONSABLE NO ENCONTRADO') AS owner, 'ESTRUCTURA_FLOOR_DIMENSION (actual: 5)' AS message
FROM b WHERE floor_wid = '5' AND nombre NOT LIKE 'NODO%'""",
    "audit_ports": _ports_sql(),
    "audit_ports_excluded": _ports_sql("WHERE id NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)"),
}
