"""Audit rules over texts built from whole tables, and the choice of the main finding."""

from __future__ import annotations

from pyspark.sql import functions as F

from hilvan.catalog.base import select, shape
from hilvan.functions import rules as R
from hilvan.operators.prioritize import prioritise, run_counters

OWNER = "R7"

CABLES = [
    "o_orderkey", "o_custkey",
    "CASE o_orderkey % 12 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN CAST(o_custkey AS STRING) || 'P/' || CAST(o_orderkey AS STRING) "
    "WHEN 2 THEN CAST(o_custkey AS STRING) || '-SUB' WHEN 3 THEN CAST(o_custkey AS STRING) || '-' || CAST(o_orderkey % 9 AS STRING) "
    "WHEN 4 THEN CAST(o_custkey AS STRING) || 'x' WHEN 5 THEN 'P-' || CAST(o_custkey AS STRING) || ' b' WHEN 6 THEN '//' WHEN 7 THEN 'a  b' "
    "WHEN 8 THEN CAST(o_custkey AS STRING) || '-A-SUB' WHEN 9 THEN CAST(o_custkey AS STRING) || 'Pz' WHEN 10 THEN '' ELSE CAST(o_custkey AS STRING) || '-3p' END AS nombre",
    "CASE o_orderkey % 5 WHEN 0 THEN 'Troncal-Acceso' WHEN 1 THEN 'Troncal-Transporte' WHEN 2 THEN 'Ultima Milla' WHEN 3 THEN 'Ultima milla' ELSE 'Otra' END AS tipo",
    "CASE o_orderkey % 4 WHEN 0 THEN 'ductado doble 48 hilos' WHEN 1 THEN 'Ductado 96 hilos' ELSE 'ductado 24 hilos' END AS esp",
    "CASE o_orderkey % 3 WHEN 0 THEN 'R7' ELSE 'R8' END AS prop",
    "CASE o_orderkey % 7 WHEN 0 THEN 'En servicio' WHEN 1 THEN 'Plan Abandono' WHEN 2 THEN 'x' ELSE 'Plan Uso Futuro' END AS est",
    "CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '12#3' WHEN 3 THEN 'sub' WHEN 4 THEN '1-2/3' WHEN 5 THEN 'x9' ELSE '45' END AS viejo",
    "CASE o_orderkey % 4 WHEN 1 THEN 96 ELSE 24 END AS hilos",
]
SPLICES = [
    "o_orderkey",
    "CASE o_orderkey % 11 WHEN 0 THEN 'ET' || CAST(o_custkey AS STRING) || '_' || CAST(o_orderkey % 9 AS STRING) WHEN 1 THEN 'NAP' || CAST(o_custkey AS STRING) || '_1' "
    "WHEN 2 THEN 'ET' || CAST(o_custkey AS STRING) || '-SUB_2' WHEN 3 THEN 'ET' || CAST(o_custkey AS STRING) || '-SUBX' WHEN 4 THEN 'EA' || CAST(o_custkey AS STRING) || '-P' "
    "WHEN 5 THEN 'ET' || CAST(o_custkey AS STRING) || '-3' WHEN 6 THEN 'ob ' || CAST(o_custkey AS STRING) || 'zz' WHEN 7 THEN 'NAPP' || CAST(o_custkey AS STRING) "
    "WHEN 8 THEN 'EA' || CAST(o_custkey AS STRING) || 'bb' WHEN 9 THEN 'xx  yy' ELSE 'et' || CAST(o_custkey AS STRING) END AS nombre",
    "CASE o_orderkey % 7 WHEN 0 THEN 'Tipo 0' WHEN 1 THEN 'Tipo 2' WHEN 2 THEN 'Nap Sotano 24' WHEN 3 THEN 'Nap Sotano 7' WHEN 4 THEN 'Nap Sotano x' "
    "WHEN 5 THEN 'Empalme Cliente' ELSE 'Otro' END AS esp",
]
SITES = [
    "c_custkey",
    "CASE c_custkey % 9 WHEN 0 THEN 'TORRE ' || c_mktsegment WHEN 1 THEN 'Edificio ' || c_mktsegment WHEN 2 THEN 'C.C plaza #' || CAST(c_custkey AS STRING) "
    "WHEN 3 THEN c_mktsegment || ' S A S' WHEN 4 THEN 'NODO x!' WHEN 5 THEN 'ACME @é ' || CAST(c_custkey AS STRING) WHEN 6 THEN '' "
    "WHEN 7 THEN c_mktsegment || ' n i t 900' ELSE 'A\tB  C' END AS nombre",
    "CASE c_custkey % 4 WHEN 0 THEN 'AAA' WHEN 1 THEN 'BBB' ELSE '' END AS categoria",
    "CASE c_custkey % 5 WHEN 0 THEN 'Casa' WHEN 1 THEN 'Torre' WHEN 2 THEN '' ELSE 'Local' END AS tipo",
    "CASE c_custkey % 3 WHEN 0 THEN 'Casa' ELSE 'Torre' END AS usual",
    "CASE c_custkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '700' WHEN 2 THEN '12' ELSE '' END AS fl",
    "CASE c_custkey % 8 WHEN 0 THEN '0' WHEN 1 THEN '40000' ELSE '5' END AS fw",
    "CASE c_custkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '3' ELSE '9' END AS rl",
    "CASE c_custkey % 8 WHEN 0 THEN '0' WHEN 1 THEN '' ELSE '1' END AS rw",
    "CASE c_custkey % 2 WHEN 0 THEN '0' ELSE '4' END AS pisos",
]
VALUES = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    "CASE l_linenumber WHEN 1 THEN 'BOGOTA' || CAST(l_partkey AS STRING) WHEN 2 THEN 'XXBOGO' || CAST(l_partkey + 1000 AS STRING) WHEN 3 THEN 'BO-1' "
    "WHEN 4 THEN 'BO1' WHEN 5 THEN 'BO1234' WHEN 6 THEN '0' ELSE NULL END AS equipo",
    "CASE l_linenumber WHEN 1 THEN CAST(l_suppkey AS STRING) || '/1/2' WHEN 2 THEN CAST(l_suppkey AS STRING) WHEN 3 THEN '1/2/3/4' WHEN 4 THEN '/1' "
    "WHEN 5 THEN 'a/1' WHEN 6 THEN '' ELSE ' 1-2 ' END AS puerto",
    "CASE l_linenumber WHEN 1 THEN CAST(l_partkey % 400 AS STRING) || '.1.2.3' WHEN 2 THEN '10.0.0.' || CAST(l_suppkey % 300 AS STRING) || '/' || CAST(l_suppkey % 60 AS STRING) "
    "WHEN 3 THEN '1.2.3' WHEN 4 THEN ' 8.8.8.8 ' WHEN 5 THEN '' ELSE NULL END AS ip",
    "CASE l_linenumber WHEN 1 THEN 'Megabyte' WHEN 2 THEN 'Mbps' WHEN 3 THEN ' KB' WHEN 4 THEN 'giga' WHEN 5 THEN ' ' WHEN 6 THEN 'kilobyte ' ELSE NULL END AS unidad",
    "CASE l_linenumber WHEN 1 THEN 'In Service' WHEN 2 THEN 'spare' WHEN 3 THEN 'roto' WHEN 4 THEN '' ELSE NULL END AS estado",
    "CASE l_linenumber WHEN 1 THEN 'Fiber' WHEN 2 THEN 'cobre' ELSE ' ' END AS nivel",
    "CASE l_linenumber WHEN 1 THEN 'Equipo Cliente' WHEN 2 THEN 'ODF' ELSE '' END AS tipo",
    "CASE l_linenumber WHEN 1 THEN 'Biconic' WHEN 2 THEN 'unknown' WHEN 3 THEN 'LC' ELSE NULL END AS conector",
    "CASE l_linenumber WHEN 1 THEN 'Rx - Tx' WHEN 2 THEN 'Rx' ELSE '' END AS senal",
    "CASE l_linenumber % 4 WHEN 0 THEN '0' WHEN 1 THEN '0.0' WHEN 2 THEN 'CL 1' ELSE NULL END AS direccion",
    "CASE l_linenumber WHEN 1 THEN 'ME' || CAST(l_partkey AS STRING) WHEN 2 THEN 'XX1' WHEN 3 THEN 'me 1' WHEN 4 THEN '0' WHEN 5 THEN '' ELSE 'HU' || chr(9) || '1' END AS proyecto",
    "CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN 'R' ELSE NULL END AS anillo",
    "CASE l_linenumber WHEN 1 THEN 'OC-' || CAST(l_partkey + 1000 AS STRING) WHEN 2 THEN 'WO1' WHEN 3 THEN 'ZZ123456' WHEN 4 THEN 'c 1234567' WHEN 5 THEN '' ELSE NULL END AS cambio",
    "CASE l_linenumber WHEN 1 THEN 'CAV' || CAST(l_partkey + 10000 AS STRING) WHEN 2 THEN 'ID1' WHEN 3 THEN 'ID 123456' WHEN 4 THEN 'XY123456' WHEN 5 THEN '0' ELSE 'id123456' END AS servicio",
]
RACKS = [
    "p_partkey",
    "CASE p_partkey % 6 WHEN 0 THEN 'DEMARCADOR CLIENTE' WHEN 1 THEN 'DEMARCADOR CLIENTE ' || CAST(p_size AS STRING) WHEN 2 THEN 'demarcador cliente 3' "
    "WHEN 3 THEN 'OTRO' WHEN 4 THEN '' ELSE 'BASTIDOR  CLIENTE 1' END AS d",
    "CASE p_partkey % 5 WHEN 0 THEN 'IS' WHEN 1 THEN 'spare' WHEN 2 THEN '' ELSE 'roto' END AS e",
    "CASE p_partkey % 3 WHEN 0 THEN '' ELSE 'CO' END AS c",
    "CASE p_partkey % 4 WHEN 0 THEN '' ELSE 'GPON' END AS t",
    "CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '1.2.3.4' WHEN 2 THEN '1.2.3.400' ELSE 'x' END AS ip",
    "CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE CAST(p_size + 20 AS STRING) END AS n",
    "CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'Yes' WHEN 2 THEN 'Sí' ELSE 'tal vez' END AS m",
    "CASE p_partkey % 2 WHEN 0 THEN '' ELSE 'B1' END AS b",
    "CASE p_partkey % 6 WHEN 0 THEN 'BASTIDOR CLIENTE' WHEN 1 THEN 'BASTIDOR CLIENTE ' || CAST(p_size AS STRING) WHEN 2 THEN '' ELSE 'RACK' END AS bd",
    "CASE p_partkey % 4 WHEN 0 THEN 'OF ' || CAST(p_size AS STRING) WHEN 1 THEN 'OF' WHEN 2 THEN '' ELSE 'of 1' END AS s",
    "CASE p_partkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '2' ELSE '' END AS f",
]


def _joined(messages):
    return F.array_join(messages, " ~ ")


def cables(spark, d):
    c = F.col
    return shape(spark, d, "orders", CABLES).select(
        "o_orderkey", _joined(R.cable_name("nombre", "tipo")).alias("nombre"),
        _joined(
            R.cable_attributes(c("nombre"), c("tipo"), c("esp"), c("prop"), c("est"), c("viejo"), c("hilos"), OWNER)
        ).alias("atributos"),
        R.old_cable_name_ok("viejo", "tipo").alias("viejo_ok"),
    )


def splices(spark, d):
    return shape(spark, d, "orders", SPLICES).select(
        "o_orderkey", _joined(R.splice_name("nombre")).alias("nombre"),
        _joined(R.splice_spec("nombre", "esp")).alias("esp"),
        _joined(R.splice_name_suggestion("nombre")).alias("usar"),
    )


def sites(spark, d):
    c = F.col
    return shape(spark, d, "customer", SITES).select(
        "c_custkey", R.spaced_legal_form("nombre").alias("sufijo"),
        _joined(
            R.building_attributes(c("nombre"), c("categoria"), c("tipo"), c("usual"), c("nombre"), F.lit(False))
        ).alias("edificio"),
        _joined(R.structure_sizes(c("pisos"), c("fl"), c("fw"), c("rl"), c("rw"))).alias("estructura"),
    )


def values(spark, d):
    c = F.col
    unit = R.bandwidth_unit("unidad")
    return shape(spark, d, "lineitem", VALUES).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        R.central_equipment("equipo").alias("equipo"), R.central_port("puerto").alias("puerto"),
        R.ipv4("ip").alias("ip"), unit["status"].alias("unidad"), unit["suggestion"].alias("sugerencia"),
        _joined(
            R.closed_vocabularies(c("senal"), c("tipo"), c("conector"), c("nivel"), c("estado"), c("unidad"))
        ).alias("vocabulario"),
        _joined(
            R.in_service_port(c("direccion"), c("proyecto"), c("anillo"), c("cambio"), c("servicio"))
        ).alias("en_servicio"),
    )


def racks(spark, d):
    c = F.col
    return shape(spark, d, "part", RACKS).select(
        "p_partkey", _joined(R.shelf(c("d"), c("e"), c("c"), c("t"), c("ip"), c("n"), c("m"), c("b"))).alias("shelf"),
        _joined(R.bay(c("bd"), c("t"), c("e"), c("s"), c("f"), c("c"), c("b"))).alias("bay"),
    )


# Findings of customers and suppliers with messages of every kind.
FINDINGS = [
    "CASE c_custkey % 8 WHEN 0 THEN 'FIBRA' WHEN 1 THEN 'EMPALME' WHEN 2 THEN 'EDIFICIO' WHEN 3 THEN 'PORT' WHEN 4 THEN 'SHELF' "
    "WHEN 5 THEN 'BAY' WHEN 6 THEN 'MERGE FI-EM' ELSE 'ESTRUCTURA' END AS entity",
    "CAST(c_nationkey AS STRING) || c_mktsegment AS id", "c_name AS value", "'R' || CAST(c_nationkey AS STRING) AS owner",
    "CASE c_custkey % 13 WHEN 0 THEN 'NOMBRE: TABS - valor: x' WHEN 1 THEN 'Duplicado)' WHEN 2 THEN 'PROPIETARIO (R7) (actual: R8)' "
    "WHEN 3 THEN 'TYPE VACIO' WHEN 4 THEN 'TIPO DE GRUPO (esperado: a)' WHEN 5 THEN 'DESCRIPTION VACIO' WHEN 6 THEN 'MERGE (NAP) fuera' "
    "WHEN 7 THEN 'STATUS malo' WHEN 8 THEN 'ID SERVICIO: 1' WHEN 9 THEN 'NUMERO SALON INVALIDO' WHEN 10 THEN 'ESTRUCTURA_FLOOR_DIMENSION' "
    "WHEN 11 THEN 'sin regla ' || CAST(c_custkey % 3 AS STRING) ELSE 'NOMBRE_ANT: ' || c_mktsegment END AS message",
    "1 AS stage", "c_custkey AS seq", "0 AS pos",
]
SUPPLIERS = [
    "CASE s_suppkey % 3 WHEN 0 THEN 'FIBRA' WHEN 1 THEN 'PORT' ELSE 'DESCONOCIDA' END AS entity",
    "CAST(s_nationkey AS STRING) || 'BUILDING' AS id", "s_name AS value", "'S' AS owner",
    "CASE WHEN s_acctbal < 0 THEN 'COLOCACION (Troncal)' ELSE 'MUNICIPIO (Vacío) | SUGERIDO' END AS message",
    "0 AS stage", "s_suppkey AS seq", "0 AS pos",
]


def found(spark, d):
    return shape(spark, d, "customer", FINDINGS).unionByName(shape(spark, d, "supplier", SUPPLIERS))


QUERIES = {
    "rules_cables": cables,
    "rules_splices": splices,
    "rules_buildings": sites,
    "rules_port_values": values,
    "rules_racks": racks,
    "error_priority": lambda s, d: prioritise(found(s, d), OWNER),
    "run_counters": lambda s, d: run_counters(found(s, d)),
}


def _ws(value: str, field: str) -> list[str]:
    tail = f"' - valor: ''' || {value} || ''''"
    edge = f"contains({value}, '  ') OR starts_with({value}, ' ') OR ends_with({value}, ' ')"
    return [
        f"CASE WHEN contains({value}, chr(9)) THEN '{field}: TABS' || {tail} END",
        f"CASE WHEN {edge} THEN '{field}: ESPACIOS_DOBLES' || {tail} END",
    ]


def _msgs(*checks: str) -> str:
    return f"concat_ws(' ~ ', {', '.join(checks)})"


def _case(cond: str, text: str) -> str:
    return f"CASE WHEN {cond} THEN {text} END"


_TRUNK = "tipo IN ('Troncal-Acceso', 'Troncal-Transporte')"
_U = "upper(trim(nombre))"
_CHARS = r"[A-Za-z0-9 ñÑ()&.,\-]"


def _odd(value: str, allowed: str = _CHARS) -> str:
    return (
        f"array_to_string(list_sort(list_distinct(regexp_extract_all(regexp_replace({value}, '{allowed}', '', 'g'), '(?s).'))), '')"
    )


_UNIT = """CASE WHEN trim(coalesce(unidad, '')) = '' THEN 'VACÍO' WHEN lower(trim(unidad)) IN ('megabyte', 'kilobyte') THEN 'VÁLIDO'
  WHEN contains(lower(unidad), 'mb') OR contains(lower(unidad), 'kb') THEN 'UNIDAD_INCORRECTA' ELSE 'INVÁLIDO' END"""


def _vocab(value: str, words: str, empty: str, wrong: str, null_ok: bool = False) -> list[str]:
    is_empty = f"trim(coalesce({value}, '')) = ''"
    guard = f"{value} IS NOT NULL AND " if null_ok else ""
    return [
        _case(f"{guard}{is_empty}", f"'{empty}'"),
        _case(f"NOT ({is_empty}) AND lower(trim({value})) NOT IN ({words})", f"'{wrong} (actual: ''' || {value} || ''')'"),
    ]


def _described(value: str, word: str) -> str:
    number = f"TRY_CAST(NULLIF(regexp_extract(upper({value}), '^{word} (\\d+)$', 1), '') AS BIGINT)"
    return (
        f"CASE WHEN {value} = '' THEN 'DESCRIPTION VACIO' WHEN upper({value}) = '{word}' OR coalesce({number} >= 2, false) THEN NULL "
        f"ELSE 'DESCRIPTION INVALIDA. ACTUAL:''' || {value} || '''' END"
    )


_SHELF = [
    *_ws("d", "DESCRIPTION SHELF"), *_ws("e", "ESTADO SHELF"), *_ws("t", "TECNOLOGIA"), *_ws("c", "CONTRATISTA SHELF"),
    *_ws("ip", "DIRECCION IP"), *_ws("n", "NIVEL BASTIDOR"), *_ws("m", "MIGRACION OLT"), *_ws("b", "ID BAY"),
    _case("d <> upper(d)", "'DESCRIPTION CON ESPACIOS'"), _described("d", "DEMARCADOR CLIENTE"),
    _case("c = ''", "'CONTRATISTA VACIO'"), _case("e = ''", "'CONSTRUCTION STATUS INVALIDO'"),
    _case("e <> '' AND lower(e) NOT IN ('is', 'spare', 'under construction', 'retired')", "'CONSTRUCTION STATUS INVALIDO (actual: ''' || e || ''')'"),
    _case("t = ''", "'TECNOLOGIA VACIO'"), _case("ip NOT IN ('', '1.2.3.4')", "'DIRECCION IP INVALIDA (actual: ''' || ip || ''')'"),
    _case("n <> '' AND NOT coalesce(TRY_CAST(n AS BIGINT) BETWEEN 0 AND 50, false)", "'NIVEL BASTIDOR INVALIDO (actual: ''' || n || ''')'"),
    _case("m <> '' AND lower(m) NOT IN ('yes', 'no', 'sí', 'true', 'false')", "'MIGRACION OLT INVALIDA (actual: ''' || m || ''')'"),
    _case("b = ''", "'BAY ID VACIO'"),
]
_BAY = [
    *_ws("bd", "DESCRIPTION BAY"), *_ws("e", "ESTADO BAY"), *_ws("c", "CONTRATISTA BAY"), *_ws("b", "ID EDIFICIO"),
    _described("bd", "BASTIDOR CLIENTE"), _case("t = ''", "'NUMBER INVALIDO'"), _case("e = ''", "'CONSTRUCTION STATUS INVALIDO'"),
    _case("s = ''", "'NUMERO SALON INVALIDO'"),
    _case(r"s <> '' AND NOT regexp_matches(s, '^OF \d+$')", "'NUMERO SALON INVALIDO (actual: ''' || s || ''')'"),
    _case("f = ''", "'NUMERO FILA INVALIDO'"), _case("f NOT IN ('', '1')", "'NUMERO FILA INVALIDO. ACTUAL: ' || f"),
    _case("c = ''", "'CONTRATISTA VACIO'"), _case("b = ''", "'BUILDING ID VACIO'"),
]


def _levels() -> str:
    from hilvan.functions.hierarchy import WHITESPACE_MARKS, hierarchies

    rows = []
    for entity, levels in hierarchies(OWNER).items():
        for priority, field, patterns in levels:
            for pattern in (*patterns, *WHITESPACE_MARKS):
                rows.append(f"('{entity}', {priority}, '{field}', '{pattern.upper().replace(chr(39), chr(39) * 2)}')")
    return ", ".join(rows)


def _priority_sql() -> str:
    return f"""WITH h(entity, priority, field, pattern) AS (VALUES {_levels()}),
f AS ({select('customer', FINDINGS)} UNION ALL {select('supplier', SUPPLIERS)}),
x AS (SELECT *, CASE WHEN entity = 'MERGE FI-EM' THEN CASE WHEN contains(message, 'MERGE') THEN 'FIBRA' ELSE 'EMPALME' END ELSE entity END AS tbl FROM f),
p AS (SELECT x.entity, id, value, owner, message, stage, seq, pos, coalesce(min(h.priority), 999) AS priority,
        coalesce(arg_min(h.field, h.priority), 'Otros') AS field
      FROM x LEFT JOIN h ON h.entity = x.tbl AND contains(upper(x.message), h.pattern) GROUP BY ALL),
b AS (SELECT *, min(priority) OVER (PARTITION BY id) AS best FROM p)
SELECT entity, id, arg_min(value, (stage, seq, pos)) AS value, arg_min(owner, (stage, seq, pos)) AS owner,
  array_to_string(list_sort(list_distinct(list(message))), ' | ') AS message, priority, field, CAST(0 AS BIGINT) AS part
FROM b WHERE priority = best GROUP BY entity, id, priority, field"""


SQL = {
    "rules_cables": rf"""WITH r AS (SELECT *, {_U} AS u, contains({_U}, 'P') AS p, contains({_U}, '-') AS g, {_TRUNK} AS tr,
  upper(nombre) LIKE '%-SUB' AS sub, tipo = 'Ultima Milla' AS um, upper(trim(viejo)) AS v FROM ({select('orders', CABLES)})),
k AS (SELECT *, coalesce(trim(viejo), '') = '' OR CASE WHEN um THEN regexp_matches(v, '^[\d\-P\#/]+$|^SUB$') ELSE regexp_matches(v, '^[\d\-P\#]+$|^SUB$') END AS viejo_ok FROM r)
SELECT o_orderkey, {_msgs(
        *_ws('nombre', 'NOMBRE'),
        _case("tr AND g AND NOT contains(u, 'SUB')", "'NOMBRE (Valor Inválido) (en ' || tipo || ' el guion solo se permite con ''SUB'')'"),
        _case(r"tr AND g AND contains(u, 'SUB') AND NOT regexp_matches(replace(u, '-SUB', ''), '^[\dP/]+$')", "'NOMBRE (Valor Inválido) (formato inválido con SUB en ' || tipo || ')'"),
        _case(r"tr AND NOT g AND p AND NOT regexp_matches(u, '^[\dP/]+$')", "'NOMBRE (Valor Inválido) (en ' || tipo || ' debe contener solo números, P y / cuando hay P)'"),
        _case("tr AND NOT g AND p AND replace(u, '/', '') = ''", "'nombre no puede ser solo (en ' || tipo || ')'"),
        _case(r"tr AND NOT g AND NOT p AND NOT regexp_matches(u, '^\d+$')", "'NOMBRE (Valor Inválido) (en ' || tipo || ' debe contener solo números cuando no hay P)'"),
        _case(r"NOT tr AND p AND NOT regexp_matches(u, '^[\d\-P/]+$')", "'CARACTER INVALIDO (nombre con P)'"),
        _case("NOT tr AND p AND replace(replace(u, '/', ''), '-', '') = ''", "'nombre no puede ser solo'"),
        _case(r"NOT tr AND NOT p AND NOT regexp_matches(u, '^[\d\-]+$')", "'CARACTER INVALIDO (nombre sin P)'"),
    )} AS nombre, {_msgs(
        _case("g AND NOT um AND NOT sub", "'DE (actual: ' || tipo || ')'"),
        _case("NOT g AND replace(lower(tipo), ' ', '-') NOT IN ('troncal-acceso', 'troncal-transporte', 'ultima-milla')", "'COLOCACION (Ultima Milla) (actual: ' || tipo || ')'"),
        _case("contains(lower(esp), 'doble')", "'ESPECI (senc) (actual: ' || lower(esp) || ')'"),
        _case("prop <> 'R7'", "'PROPIETARIO (R7) (actual: ' || prop || ')'"),
        _case("est NOT IN ('En servicio', 'Plan Abandono', 'Plan Uso Futuro')", "'STATUS ADMITIDOS (En servicio/Plan Abandono/Futuro) (actual: ' || est || ')'"),
        _case("um AND hilos > 48", "'ESPECI (''revisar''Ultima Milla cantidad de Hilos) (actual: ' || hilos || ' Hilos)'"),
        _case("um AND viejo <> '' AND NOT viejo_ok", "'NOMBRE_ANT (actual: ' || viejo || ')'"),
        _case("um AND viejo <> '' AND g AND NOT contains(viejo, '-') AND NOT sub", "'NOMBRE_ANT (Falta guion cuando NOMBRE tiene guion) (NOMBRE: ' || nombre || ', NOMBRE_ANT: ' || viejo || ')'"),
    )} AS atributos, viejo_ok FROM k""",
    "rules_splices": rf"""WITH r AS (SELECT *, {_U} AS u, contains({_U}, '-SUB') AS sub, regexp_matches({_U}, '^(ET|NAP|EA|OB)[0-9_\-P]+$') AS fine,
  {_odd(_U, '(ET|NAP|EA|OB)[0-9_\\-P]')} AS odd,
  list_sort(list_distinct(regexp_extract_all({_U}, 'AA|BB|CC|DD|EE|FF|GG|HH|II|JJ|KK|LL|MM|NN|OO|PP|QQ|RR|SS|TT|UU|VV|WW|XX|YY|ZZ'))) AS dd,
  regexp_extract({_U}, '^(ET|NAP|EA|OB)[0-9\-_P]*') AS fx, starts_with(esp, 'Nap Sotano') AS nap FROM ({select('orders', SPLICES)}))
SELECT o_orderkey, {_msgs(
        *_ws('nombre', 'NOMBRE'), _case("contains(u, ' ')", "'NOMBRE(CONTIENE ESPACIOS)'"),
        _case(r"sub AND NOT regexp_matches(u, '^(ET|NAP)\d+\-SUB_\d+$')", "'NOMBRE(CARACTERES ERRONEOS): Formato inválido para empalme con SUB'"),
        _case("NOT sub AND NOT fine AND odd <> ''", "'NOMBRE(CARACTERES ERRONEOS): ''' || odd || ''''"),
        _case("len(dd) > 0", "'NOMBRE(LETRA CONSECUTIVA): ' || array_to_string(dd, ', ')"),
        _case("starts_with(u, 'ET') AND contains(u, '-') AND NOT sub", "'NOMBRE(ERRONEO)'"),
    )} AS nombre, {_msgs(
        _case(r"esp NOT IN ('Tipo 0', 'Tipo 1', 'Tipo 2', 'Empalme Cliente') AND NOT regexp_matches(esp, '^Nap Sotano \d+$')", "'ESPECIFICACION (NO acorde a lo establecido) (actual: ' || esp || ')'"),
        _case("starts_with(u, 'ET') AND esp NOT IN ('Tipo 0', 'Tipo 1', 'Tipo 2', 'Empalme Cliente') AND NOT nap", "'ESPECIFICACION ET ERRONEA (actual: ' || esp || ')'"),
        _case("starts_with(u, 'NAP') AND NOT nap", "'ESPECIFICACION NAP ERRONEA (actual: ' || esp || ', esperado: ''Nap Sotano X'')'"),
        _case("starts_with(u, 'EA') AND esp <> 'Tipo 2'", "'ESPECIFICACION (NO acorde a lo establecido) (actual: ' || esp || ')'"),
    )} AS esp, {_msgs(_case("NOT sub AND NOT fine AND fx <> '' AND fx <> u", "'usar: (usar: ' || fx || ')'"))} AS usar FROM r""",
    "rules_buildings": rf"""WITH r AS (SELECT *, {_odd('nombre')} AS odd, nombre <> '' AND NOT regexp_matches(upper(nombre), '^(C\.C|NODO)') AS plano FROM ({select('customer', SITES)}))
SELECT c_custkey,
  regexp_matches(upper(trim(nombre)), '(\s+S\s+A\s+S?|\s+L\s+T\s+D\s+A|\s+L\s+T\s+D|\s+I\s+N\s+C|\s+C\s+O\s+R\s+P|\s+C\s+I\s+E|\s+E\s+U|\s+N\s+I\s+T\s*\d*)$') AS sufijo,
  {_msgs(
        _case("categoria NOT IN ('', 'AAA')", "'CATEGORIA (AAA) (actual: ' || categoria || ')'"),
        _case("nombre <> '' AND tipo <> '' AND tipo <> usual", "'TIPO DE GRUPO (esperado: ''' || usual || ''', actual: ''' || tipo || ''')'"),
        _case("plano AND odd <> ''", "'NOMBRE (Valor Inválido): ''' || odd || ''''"),
        _case("plano AND nombre <> upper(nombre)", "'NOMBRE (usar: ' || upper(nombre) || ')'"),
    )} AS edificio,
  CASE WHEN pisos = '0' AND fl = '0' AND fw = '0' AND rl = '0' AND rw = '0' THEN 'ESTRUCTURA (NUMBER_OF + FLOOR + ROOMS = 0) (NUM_OF:0|FLOOR:0,0|ROOMS:0,0)'
    ELSE concat_ws('; ', {', '.join(_case(f"{v} NOT IN ('', '700', '40000', '10000', '20000')", f"'ESTRUCTURA_FLOOR_DIMENSION (actual: ' || {v} || ')'") for v in ('fl', 'fw'))},
      {', '.join(_case(f"{v} NOT IN ('', '3', '0')", f"'ESTRUCTURA_NUMBER_OF_ROOMS (actual: ' || {v} || ')'") for v in ('rl', 'rw'))}) END AS estructura
FROM r""",
    "rules_port_values": rf"""WITH r AS (SELECT *, trim(equipo) AS eq, trim(puerto) AS pu, regexp_extract(trim(ip), '^(\d{{1,3}})\.(\d{{1,3}})\.(\d{{1,3}})\.(\d{{1,3}})(?:/(\d{{1,2}}))?$', ['a', 'b', 'c', 'd', 'm']) AS o,
  {_UNIT} AS us, TRY_CAST(trim(proyecto) AS DOUBLE) = 0 AS pz, trim(proyecto) AS py, trim(regexp_replace(trim(proyecto), '[\x00-\x1f\x7f]', '', 'g')) AS pc,
  upper(trim(cambio)) AS cu, trim(servicio) AS sv FROM ({select('lineitem', VALUES)}))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  CASE WHEN coalesce(eq, '') IN ('', '0') THEN 'VÁLIDO' WHEN NOT regexp_matches(eq, '^[A-Z0-9]+$') THEN 'CARACTERES_INVALIDOS' WHEN length(eq) < 6 THEN 'LONGITUD_INSUFICIENTE'
    WHEN NOT regexp_matches(eq, '^[A-Z]{{6}}') THEN 'PRIMEROS_6_NO_LETRAS' WHEN substr(eq, 1, 2) NOT IN ('BO', 'VI', 'PA') THEN 'PREFIJO_INVALIDO'
    WHEN length(regexp_replace(eq, '[^0-9]', '', 'g')) < 4 THEN 'NUMEROS_INSUFICIENTES' ELSE 'VÁLIDO' END AS equipo,
  CASE WHEN coalesce(pu, '') IN ('', '0') THEN 'VÁLIDO' WHEN NOT regexp_matches(pu, '^[0-9/-]+$') THEN 'CARACTERES_INVALIDOS'
    WHEN length(regexp_replace(pu, '[^/-]', '', 'g')) = 0 THEN 'SIN_SEPARADOR' WHEN length(regexp_replace(pu, '[^/-]', '', 'g')) > 2 THEN 'DEMASIADOS_SEPARADORES'
    WHEN NOT regexp_matches(pu, '^[0-9]') THEN 'INICIO_INVALIDO' ELSE 'VÁLIDO' END AS puerto,
  CASE WHEN trim(coalesce(ip, '')) = '' THEN 'VACÍO' WHEN o.a <> '' AND TRY_CAST(o.a AS INT) <= 255 AND TRY_CAST(o.b AS INT) <= 255 AND TRY_CAST(o.c AS INT) <= 255
    AND TRY_CAST(o.d AS INT) <= 255 AND (o.m = '' OR TRY_CAST(o.m AS INT) <= 32) THEN 'VÁLIDO' ELSE 'INVÁLIDO' END AS ip,
  us AS unidad, CASE us WHEN 'VACÍO' THEN '' WHEN 'VÁLIDO' THEN trim(unidad) ELSE CASE WHEN contains(lower(unidad), 'mb') THEN 'Megabyte'
    WHEN contains(lower(unidad), 'kb') THEN 'Kilobyte' ELSE 'Megabyte o Kilobyte' END END AS sugerencia,
  {_msgs(
        "CASE WHEN senal = '' THEN 'TIPO SEÑAL INVALIDO ((VACÍO))' WHEN senal <> 'Rx - Tx' THEN 'TIPO SEÑAL INVALIDO ((actual: ''' || senal || '''))' END",
        *_vocab('tipo', "'equipo cliente'", 'TYPE VACIO', 'TYPE (solo Equipo Cliente)'),
        *_vocab('conector', "'unknown', 'biconic'", 'CONNECTOR TYPE VACIO', 'CONNECTOR TYPE (solo Unknown o Biconic)'),
        *_vocab('nivel', "'fiber'", 'SERVICE LEVEL VACIO', 'SERVICE LEVEL (solo Fiber)'),
        *_vocab('estado', "'in service', 'spare'", 'PHYSICAL STATUS VACIO', 'PHYSICAL STATUS INVALIDO', True),
        _case("us = 'VACÍO'", "'UNIDAD ANCHO DE BANDA VACIA'"),
        _case("us IN ('INVÁLIDO', 'UNIDAD_INCORRECTA')", "'UNIDAD ANCHO DE BANDA INVALIDA (actual: ''' || unidad || ''')'"),
    )} AS vocabulario,
  {_msgs(
        _case("TRY_CAST(trim(direccion) AS DOUBLE) = 0", "'DIRECCION CLIENTE = 0'"), _case("pz", "'PROYECTO DE RED VACIO = 0'"),
        _case("NOT coalesce(pz, false) AND py <> '' AND NOT regexp_matches(pc, '^[A-Z0-9]+$')", "'PROYECTO DE RED VACIO''' || py || ''''"),
        _case("NOT coalesce(pz, false) AND py <> '' AND regexp_matches(pc, '^[A-Z0-9]+$') AND NOT regexp_matches(pc, '^(ME|HU|SD)')", "'PROYECTO DE RED VACIO: ''' || py || ''''"),
        _case("trim(anillo) = ''", "'ANILLO VACIO'"),
        _case("cu <> '' AND (length(cu) < 7 OR NOT regexp_matches(cu, '^(OC-|C|WO|APR)') OR NOT regexp_matches(replace(cu, '-', ''), '^[A-Z0-9]+$'))", "'SERVICE MANAGER: ''' || trim(cambio) || ''''"),
        _case("sv NOT IN ('', '0') AND (NOT regexp_matches(sv, '^[A-Z0-9]+$') OR length(sv) < 8 OR NOT regexp_matches(sv, '^(CAV|ID|IP|PI|SEG|TI)'))", "'ID SERVICIO: ''' || sv || ''''"),
    )} AS en_servicio FROM r""",
    "rules_racks": f"""WITH r AS ({select('part', RACKS)})
SELECT p_partkey, {_msgs(*_SHELF)} AS shelf, {_msgs(*_BAY)} AS bay FROM r""",
    "error_priority": _priority_sql(),
    "run_counters": f"""SELECT entity, count(*) AS findings FROM ({select('customer', FINDINGS)} UNION ALL {select('supplier', SUPPLIERS)}) GROUP BY entity""",
}
