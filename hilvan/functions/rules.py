"""Audit rules: Columns in, an array of message texts (or a status text) out.

A rule never returns null; an attribute without fault gives an empty array.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hilvan.functions.text import (
    as_column,
    blank,
    extract,
    is_zero,
    odd_characters,
    once,
    starts_with_any,
    strip,
    text_or_empty,
    without_control,
)

# Placement types and allowed specifications.
TRUNK_TYPES = ("Troncal-Acceso", "Troncal-Transporte")
LAST_MILE = "Ultima Milla"
ACCEPTED_STATUS = ("En servicio", "Plan Abandono", "Plan Uso Futuro")
SPLICE_TYPES = ("Tipo 0", "Tipo 1", "Tipo 2", "Empalme Cliente")
SPLICE_SPECS = SPLICE_TYPES + (
    "Nap Sotano 12", "Nap Sotano 24", "Nap Sotano 36", "Nap Sotano 48", "Nap Sotano 96", "Nap Sotano 144",
)
# Prefixes of names and identifiers.
BUILDING_PREFIXES = (
    "C.C", "ANT", "(SED)", "(REDP)", "COLEGIO", "TM", "EDIFICIO", "IED", "TORRE", "NODO",
)
SERVICE_ID_PREFIXES = ("CAV", "ID", "IP", "PI", "SEG", "TI", "CAV30-C")
SERVICE_CHANGE_PREFIXES = ("OC-", "C", "WO", "APR")
PROJECT_PREFIXES = ("ME", "HU", "SD")
# Only two-letter entries of the list can match, since two letters are compared.
EQUIPMENT_PREFIXES = (
    "BO", "VI", "PA", "BOBSH930601", "BOCHHU930601", "CHCHHU930601", "CUZPHU930601", "SOPOHU930301",
)
# Accepted characters and numbers.
NAME_CHARACTERS = r"[A-Za-z0-9 ñÑ()&.,\-]"
FLOOR_SIZES = ("700", "40000", "10000", "20000")
ROOM_COUNTS = ("3", "0")
CLIENT_BUILDINGS_LIMIT = 5

VALID, EMPTY, INVALID = "VÁLIDO", "VACÍO", "INVÁLIDO"


def no_messages() -> Column:
    return F.array().cast("array<string>")


def messages(*checks: tuple[Column, Column | str]) -> Column:
    """Array of the texts whose condition is true (null counts as false).

    Concatenated one-element arrays stay inside generated code; filtering nulls out of
    one array would evaluate every rule row by row in the interpreter.
    """
    nothing = no_messages()
    return F.concat(
        *[F.when(cond, F.array(F.lit(text) if isinstance(text, str) else text)).otherwise(nothing) for cond, text in checks]
    )


def all_of(*arrays: Column) -> Column:
    return F.concat(*arrays)


def text(*pieces: Column | str) -> Column:
    """Concatenation in which a null piece reads as ''."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in pieces])


def actual(message: str, value: Column, quote: str = "") -> Column:
    return text(f"{message} (actual: {quote}", value, f"{quote})")


def whitespace(value: Column | str, field: str) -> Column:
    """Tabs, and repeated or edge spaces, each reported once with the value."""
    value = as_column(value)
    tail = text(" - valor: '", value, "'")
    edge = value.contains("  ") | value.startswith(" ") | value.endswith(" ")
    return messages(
        (value.contains("\t"), text(f"{field}: TABS", tail)),
        (edge, text(f"{field}: ESPACIOS_DOBLES", tail)),
    )


def whitespace_kinds(value: Column | str, tail: Column | str = "") -> Column:
    value = as_column(value)
    return messages(
        (value.contains("\t"), text("TABS", tail)),
        (value.contains("  ") | value.startswith(" ") | value.endswith(" "), text("ESPACIOS_DOBLES", tail)),
    )


# --- cables --------------------------------------------------------------------------

def cable_name(name: Column | str, placement: Column | str) -> Column:
    raw = as_column(name)
    upper, kind = F.upper(strip(name)), strip(placement)
    trunk, dash, p = kind.isin(*TRUNK_TYPES), upper.contains("-"), upper.contains("P")
    only_slash = F.regexp_replace(upper, "/", "") == ""
    only_marks = F.regexp_replace(upper, "[/-]", "") == ""
    bad = "NOMBRE (Valor Inválido)"
    with_dash = trunk & dash
    without_dash = trunk & ~dash
    return all_of(
        whitespace(raw, "NOMBRE"),
        messages(
            (with_dash & ~upper.contains("SUB"),
             text(f"{bad} (en ", kind, " el guion solo se permite con 'SUB')")),
            (with_dash & upper.contains("SUB") & ~F.regexp_replace(upper, "-SUB", "").rlike(r"^[\dP/]+$"),
             text(f"{bad} (formato inválido con SUB en ", kind, ")")),
            (without_dash & p & ~upper.rlike(r"^[\dP/]+$"),
             text(f"{bad} (en ", kind, " debe contener solo números, P y / cuando hay P)")),
            (without_dash & p & only_slash,
             text("nombre no puede ser solo (en ", kind, ")")),
            (without_dash & ~p & ~upper.rlike(r"^\d+$"),
             text(f"{bad} (en ", kind, " debe contener solo números cuando no hay P)")),
            (~trunk & p & ~upper.rlike(r"^[\d\-P/]+$"), "CARACTER INVALIDO (nombre con P)"),
            (~trunk & p & only_marks, "nombre no puede ser solo"),
            (~trunk & ~p & ~upper.rlike(r"^[\d\-]+$"), "CARACTER INVALIDO (nombre sin P)"),
        ),
    )


def old_cable_name_ok(old_name: Column | str, placement: Column | str) -> Column:
    upper = F.upper(strip(old_name))
    last_mile = upper.rlike(r"^[\d\-P\#/]+$|^SUB$")
    other = upper.rlike(r"^[\d\-P\#]+$|^SUB$")
    return blank(old_name) | F.when(as_column(placement) == LAST_MILE, last_mile).otherwise(other)


def cable_attributes(
    name: Column, placement: Column, spec: Column, owner: Column, status: Column, old_name: Column,
    strands: Column, valid_owner: str,
) -> Column:
    """Placement, specification, owner, status and old-name rules; inputs are trimmed."""
    dash = name.contains("-")
    sub = F.upper(name).endswith("-SUB")
    slug = F.replace(F.lower(placement), F.lit(" "), F.lit("-"))
    last_mile = placement == LAST_MILE
    has_old = F.coalesce(old_name != "", F.lit(False))
    return messages(
        (dash & ~last_mile & ~sub, actual("DE", placement)),
        (~dash & ~slug.isin("troncal-acceso", "troncal-transporte", "ultima-milla"),
         actual("COLOCACION (Ultima Milla)", placement)),
        (F.lower(spec).contains("doble"), actual("ESPECI (senc)", F.lower(spec))),
        (owner != valid_owner, actual(f"PROPIETARIO ({valid_owner})", owner)),
        (~status.isin(*ACCEPTED_STATUS),
         actual("STATUS ADMITIDOS (En servicio/Plan Abandono/Futuro)", status)),
        (last_mile & (strands > 48),
         text("ESPECI ('revisar'Ultima Milla cantidad de Hilos) (actual: ", strands, " Hilos)")),
        (last_mile & has_old & ~old_cable_name_ok(old_name, placement), actual("NOMBRE_ANT", old_name)),
        (last_mile & has_old & dash & ~old_name.contains("-") & ~sub,
         text("NOMBRE_ANT (Falta guion cuando NOMBRE tiene guion) (NOMBRE: ", name,
              ", NOMBRE_ANT: ", old_name, ")")),
    )


# --- splices -------------------------------------------------------------------------

# Fixed value: shape of a splice name.
SPLICE_NAME = r"^(ET|NAP|EA|OB)[0-9_\-P]+$"


def splice_name(name: Column | str) -> Column:
    raw = as_column(name)
    upper = F.upper(strip(name))
    sub = upper.contains("-SUB")
    odd = odd_characters(upper, r"(ET|NAP|EA|OB)[0-9_\-P]")
    doubled = F.sort_array(F.array_distinct(F.regexp_extract_all(upper, F.lit(r"(([A-Z])\2)"), F.lit(1))))
    return all_of(
        whitespace(raw, "NOMBRE"),
        messages(
            (upper.contains(" "), "NOMBRE(CONTIENE ESPACIOS)"),
            (sub & ~upper.rlike(r"^(ET|NAP)\d+\-SUB_\d+$"),
             "NOMBRE(CARACTERES ERRONEOS): Formato inválido para empalme con SUB"),
            (~sub & ~upper.rlike(SPLICE_NAME) & (odd != ""), text("NOMBRE(CARACTERES ERRONEOS): '", odd, "'")),
            (F.size(doubled) > 0, text("NOMBRE(LETRA CONSECUTIVA): ", F.array_join(doubled, ", "))),
            (upper.startswith("ET") & upper.contains("-") & ~sub, "NOMBRE(ERRONEO)"),
        ),
    )


def splice_name_suggestion(name: Column | str) -> Column:
    upper = F.upper(as_column(name))
    fixed = F.regexp_extract(upper, r"^(ET|NAP|EA|OB)[0-9\-_P]*", 0)
    return messages(
        (~upper.contains("-SUB") & ~upper.rlike(SPLICE_NAME) & (fixed != "") & (fixed != upper),
         text("usar: (usar: ", fixed, ")")),
    )


def splice_spec(name: Column | str, spec: Column | str) -> Column:
    upper, spec = F.upper(as_column(name)), strip(spec)
    nap_number = spec.rlike(r"^Nap Sotano \d+$")
    nap = spec.startswith("Nap Sotano")
    wrong = actual("ESPECIFICACION (NO acorde a lo establecido)", spec)
    et = upper.startswith("ET")
    is_nap = ~et & upper.startswith("NAP")
    return all_of(
        whitespace(spec, "ESPECIFICACION"),
        messages(
            (~spec.isin(*SPLICE_SPECS) & ~nap_number, wrong),
            (et & ~spec.isin(*SPLICE_TYPES) & ~nap, actual("ESPECIFICACION ET ERRONEA", spec)),
            (is_nap & ~nap,
             text("ESPECIFICACION NAP ERRONEA (actual: ", spec, ", esperado: 'Nap Sotano X')")),
            (~et & ~is_nap & upper.startswith("EA") & (spec != "Tipo 2"), wrong),
        ),
    )


# --- buildings and structures --------------------------------------------------------

# Legal forms written with spaces between the letters.
SPACED_FORMS = (
    r"\s+S\s+A\s+S?$", r"\s+L\s+T\s+D\s+A$", r"\s+L\s+T\s+D$", r"\s+I\s+N\s+C$",
    r"\s+C\s+O\s+R\s+P$", r"\s+C\s+I\s+E$", r"\s+E\s+U$", r"\s+N\s+I\s+T\s*\d*$",
)
SPACED_FORM_MESSAGE = "NOMBRE (Sufijo con espacios)'"


def spaced_legal_form(name: Column | str) -> Column:
    """True when the legal form at the end is spelled with spaces."""
    upper = F.upper(strip(name))
    return F.coalesce(upper.rlike("|".join(SPACED_FORMS)), F.lit(False))


def building_attributes(
    name: Column, category: Column, kind: Column, usual_kind: Column, base: Column, exempt: Column
) -> Column:
    upper = F.upper(name)
    plain = (name != "") & ~starts_with_any(upper, ("C.C", "NODO"))
    odd = odd_characters(name, NAME_CHARACTERS)
    return messages(
        ((category != "") & (category != "AAA"), actual("CATEGORIA (AAA)", category)),
        ((base != "") & (kind != "") & (kind != usual_kind) & ~F.coalesce(exempt, F.lit(False)),
         text("TIPO DE GRUPO (esperado: '", usual_kind, "', actual: '", kind, "')")),
        (plain & (odd != ""), text("NOMBRE (Valor Inválido): '", odd, "'")),
        (plain & (name != upper), text("NOMBRE (usar: ", upper, ")")),
    )


def structure_sizes(floors: Column, floor_len: Column, floor_wid: Column, rooms_len: Column, rooms_wid: Column) -> Column:
    """All five zero, else each size against the accepted values, joined by '; '."""
    zero = (floors == "0") & (floor_len == "0") & (floor_wid == "0") & (rooms_len == "0") & (rooms_wid == "0")
    sizes = F.array_join(
        messages(
            *[((v != "") & ~v.isin(*FLOOR_SIZES), actual("ESTRUCTURA_FLOOR_DIMENSION", v))
              for v in (floor_len, floor_wid)],
            *[((v != "") & ~v.isin(*ROOM_COUNTS), actual("ESTRUCTURA_NUMBER_OF_ROOMS", v))
              for v in (rooms_len, rooms_wid)],
        ),
        "; ",
    )
    detail = text(
        "ESTRUCTURA (NUMBER_OF + FLOOR + ROOMS = 0) (NUM_OF:", floors, "|FLOOR:", floor_len, ",",
        floor_wid, "|ROOMS:", rooms_len, ",", rooms_wid, ")",
    )
    return messages((zero, detail), (~zero & (sizes != ""), sizes))


# --- ports ---------------------------------------------------------------------------

def odd_client_name(name: Column) -> Column:
    return ~name.rlike(f"^{NAME_CHARACTERS}*$") | (name != F.upper(name))


def client_name_format(name: Column) -> Column:
    """Message about odd characters and case of a client name."""
    odd, upper = odd_characters(name, NAME_CHARACTERS), F.upper(name)
    faults = messages(
        (odd != "", text("CARACTER INVALIDO: '", odd, "'")), (name != upper, upper)
    )
    return text("NOMBRE CLIENTE: ", F.array_join(faults, " | "))


def client_name(
    name: Column | str, status: Column | str, comments: Column | str, building: Column,
    client_buildings: Column, client: Column, site: Column,
) -> Column:
    """First fault of a client name, null when it passes or is not checked.

    ``building`` is the name of the port's building in upper case (null when unknown),
    ``client_buildings`` the number of buildings the client is in; ``client`` and
    ``site`` are both names after ``company_name``.
    """
    checked = F.upper(strip(status)).isin("IN SERVICE", "IS") | F.upper(strip(comments)).contains("ADICION")
    own = strip(name)
    marks = F.array_join(whitespace_kinds(own, text(" - valor: '", own, "'")), " | ")
    exempt = starts_with_any(site, BUILDING_PREFIXES) | starts_with_any(F.upper(building), BUILDING_PREFIXES)
    differs = ~(site.contains(client) | client.contains(site))
    few = F.coalesce(client_buildings, F.lit(0)) <= CLIENT_BUILDINGS_LIMIT
    fault = (
        F.when(blank(name), F.lit("NOMBRE CLIENTE VACIO"))
        .when(marks != "", text("NOMBRE CLIENTE: ", marks))
        .when(spaced_legal_form(own), SPACED_FORM_MESSAGE)
        .when(odd_client_name(own), client_name_format(own))
        .when(
            F.coalesce((building != "") & ~exempt & few & differs, F.lit(False)),
            text("NOMBRE CLIENTE | Posible esperado: '", building, "'"),
        )
    )
    return F.when(F.coalesce(checked, F.lit(False)), fault)


def central_kind(shelf_description: Column | str) -> Column:
    """'OT', 'OI' or 'PP' for a shelf of a central, else null; looked for in that order."""
    upper = F.upper(text_or_empty(shelf_description))
    return (
        F.when(upper.contains("OT"), F.lit("OT")).when(upper.contains("OI"), "OI").when(upper.contains("PP"), "PP")
    )


def central_port_type(port_type: Column | str) -> Column:
    kind = text_or_empty(port_type)
    return messages(
        (F.upper(kind) != "ODF", text("TYPE INVALIDO. Debe ser 'ODF' para central (actual: '", kind, "')"))
    )


def central_shelf_type(central: Column, shelf_type: Column | str) -> Column:
    # Shelf type that belongs to each kind of central shelf.
    wanted = (
        F.when(central == "OT", F.lit("ODF Troncal"))
        .when(central == "OI", "ODF Interconexión")
        .when(central == "PP", "ODF Pacheo")
    )
    kind = text_or_empty(shelf_type)
    return messages(
        (F.upper(kind) != F.upper(wanted),
         text("TIPO INVALIDO. Esperado: '", wanted, "', actual: '", kind, "'"))
    )


def central_equipment(value: Column | str) -> Column:
    """Status of a central equipment name."""

    def status(v: Column) -> Column:
        digits = F.length(F.regexp_replace(v, r"[^0-9]", ""))
        return (
            F.when(v.isNull() | v.isin("", "0"), F.lit(VALID))
            .when(~v.rlike(r"^[A-Z0-9]+$"), "CARACTERES_INVALIDOS")
            .when(F.length(v) < 6, "LONGITUD_INSUFICIENTE")
            .when(~v.rlike(r"^[A-Z]{6}"), "PRIMEROS_6_NO_LETRAS")
            .when(~F.substring(v, 1, 2).isin(*EQUIPMENT_PREFIXES), "PREFIJO_INVALIDO")
            .when(digits < 4, "NUMEROS_INSUFICIENTES")
            .otherwise(VALID)
        )

    return once(strip(value), status)


def central_port(value: Column | str) -> Column:
    """Status of a central port such as '1/0/12'."""

    def status(v: Column) -> Column:
        separators = F.length(F.regexp_replace(v, r"[^/-]", ""))
        return (
            F.when(v.isNull() | v.isin("", "0"), F.lit(VALID))
            .when(~v.rlike(r"^[0-9/-]+$"), "CARACTERES_INVALIDOS")
            .when(separators == 0, "SIN_SEPARADOR")
            .when(separators > 2, "DEMASIADOS_SEPARADORES")
            .when(~v.rlike(r"^[0-9]"), "INICIO_INVALIDO")
            .otherwise(VALID)
        )

    return once(strip(value), status)


def vocabulary(value: Column | str, words: Iterable[str]) -> Column:
    """VACÍO, VÁLIDO or INVÁLIDO against a closed list, whatever the case."""
    return (
        F.when(blank(value), F.lit(EMPTY))
        .when(F.lower(strip(value)).isin(*words), VALID)
        .otherwise(INVALID)
    )


# Closed word lists.
PHYSICAL_STATUS = ("in service", "spare")
SERVICE_LEVEL = ("fiber",)
CLIENT_EQUIPMENT = ("equipo cliente",)
CONNECTOR = ("unknown", "biconic")
BANDWIDTH_UNIT = ("megabyte", "kilobyte")
SHELF_STATUS = ("is", "spare", "under construction", "retired")
YES_NO = ("yes", "no", "sí", "true", "false")


def bandwidth_unit(value: Column | str) -> Column:
    """struct(status, suggestion)."""
    low = F.lower(strip(value))
    state = vocabulary(value, BANDWIDTH_UNIT)
    # Abbreviations; every longer one contains 'mb' or 'kb'.
    mega, kilo = low.contains("mb"), low.contains("kb")
    return F.struct(
        F.when((state == INVALID) & (mega | kilo), "UNIDAD_INCORRECTA").otherwise(state).alias("status"),
        F.when(state == EMPTY, "").when(state == VALID, strip(value))
        .when(mega, "Megabyte").when(kilo, "Kilobyte").otherwise("Megabyte o Kilobyte").alias("suggestion"),
    )


def ipv4(value: Column | str) -> Column:
    """VACÍO, VÁLIDO or INVÁLIDO for an address with optional mask up to 32."""
    octet = r"(?:25[0-5]|2[0-4]\d|[01]?\d?\d)"
    address = rf"^{octet}(?:\.{octet}){{3}}(?:/(?:3[0-2]|[0-2]?\d))?$"
    return (
        F.when(blank(value), F.lit(EMPTY)).when(strip(value).rlike(address), VALID).otherwise(INVALID)
    )


def in_service_port(
    address: Column | str, project: Column | str, ring: Column | str, service_change: Column | str,
    service_id: Column | str,
) -> Column:
    """Rules for a port that is in service. Raw text in, nulls allowed."""
    proj = text_or_empty(project)
    proj_clean = strip(without_control(proj))
    change = text_or_empty(service_change)
    change_upper = F.upper(change)
    sid = text_or_empty(service_id)
    sid_clean = strip(without_control(sid))
    project_zero = is_zero(project)
    bad_change = (
        (F.length(change_upper) < 7)
        | ~starts_with_any(change_upper, SERVICE_CHANGE_PREFIXES)
        | ~F.replace(change_upper, F.lit("-"), F.lit("")).rlike(r"^[\p{L}\p{N}]+$")
    )
    bad_id = (
        ~sid_clean.rlike(r"^[A-Z0-9]+$")
        | (F.length(sid_clean) < 8)
        | ~starts_with_any(sid_clean, SERVICE_ID_PREFIXES)
    )
    return messages(
        (is_zero(address), "DIRECCION CLIENTE = 0"),
        (project_zero, "PROYECTO DE RED VACIO = 0"),
        (~project_zero & (proj != "") & ~proj_clean.rlike(r"^[A-Z0-9]+$"),
         text("PROYECTO DE RED VACIO'", proj, "'")),
        (~project_zero & (proj != "") & proj_clean.rlike(r"^[A-Z0-9]+$")
         & ~starts_with_any(proj_clean, PROJECT_PREFIXES),
         text("PROYECTO DE RED VACIO: '", proj, "'")),
        # A missing ring reads as the word None in the studied code and passes.
        (as_column(ring).isNotNull() & (strip(ring) == ""), "ANILLO VACIO"),
        ((change != "") & bad_change, text("SERVICE MANAGER: '", change, "'")),
        ((sid != "") & (sid != "0") & bad_id, text("ID SERVICIO: '", sid, "'")),
    )


def closed_vocabularies(
    signal: Column, port_type: Column | str, connector: Column | str, level: Column | str,
    status: Column | str, unit: Column | str,
) -> Column:
    """Signal, type, connector, service level, physical status and bandwidth unit.

    ``signal`` is trimmed; a null status is not reported.
    """
    nothing = no_messages()

    def of(value: Column | str, words, empty: str, wrong: str, known: Column | None = None) -> Column:
        missing = blank(value) if known is None else known & blank(value)
        return (
            F.when(missing, F.array(F.lit(empty)))
            .when(~F.lower(strip(value)).isin(*words), F.array(actual(wrong, as_column(value), "'")))
            .otherwise(nothing)
        )

    return all_of(
        F.when(signal == "", F.array(F.lit("TIPO SEÑAL INVALIDO ((VACÍO))")))
        .when(signal != "Rx - Tx", F.array(text("TIPO SEÑAL INVALIDO ((actual: '", signal, "'))")))
        .otherwise(nothing),
        of(port_type, CLIENT_EQUIPMENT, "TYPE VACIO", "TYPE (solo Equipo Cliente)"),
        of(connector, CONNECTOR, "CONNECTOR TYPE VACIO", "CONNECTOR TYPE (solo Unknown o Biconic)"),
        of(level, SERVICE_LEVEL, "SERVICE LEVEL VACIO", "SERVICE LEVEL (solo Fiber)"),
        of(status, PHYSICAL_STATUS, "PHYSICAL STATUS VACIO", "PHYSICAL STATUS INVALIDO", as_column(status).isNotNull()),
        of(unit, BANDWIDTH_UNIT, "UNIDAD ANCHO DE BANDA VACIA", "UNIDAD ANCHO DE BANDA INVALIDA"),
    )


# --- shelves and bays ----------------------------------------------------------------

def numbered_description(value: Column, word: str) -> Column:
    """Exactly ``word``, or ``word n`` with n of 2 or more."""
    upper = F.upper(strip(value))
    number = extract(upper, f"^{word} (\\d+)$").try_cast("bigint")
    good = (upper == word) | F.coalesce(number >= 2, F.lit(False))
    return messages(
        (blank(value), "DESCRIPTION VACIO"),
        (~blank(value) & ~good, text("DESCRIPTION INVALIDA. ACTUAL:'", strip(value), "'")),
    )


def shelf(
    description: Column, status: Column, contractor: Column, technology: Column, address: Column,
    level: Column, migration: Column, bay: Column,
) -> Column:
    """Shelf rules on trimmed, non-null text; repeated messages appear once."""
    number = level.try_cast("bigint")
    fields = (
        (description, "DESCRIPTION SHELF"), (status, "ESTADO SHELF"), (technology, "TECNOLOGIA"),
        (contractor, "CONTRATISTA SHELF"), (address, "DIRECCION IP"), (level, "NIVEL BASTIDOR"),
        (migration, "MIGRACION OLT"), (bay, "ID BAY"),
    )
    return F.array_distinct(
        all_of(
            *[whitespace(value, name) for value, name in fields],
            messages((description != F.upper(description), "DESCRIPTION CON ESPACIOS")),
            numbered_description(description, "DEMARCADOR CLIENTE"),
            messages(
                (contractor == "", "CONTRATISTA VACIO"),
                (status == "", "CONSTRUCTION STATUS INVALIDO"),
                ((status != "") & ~F.lower(status).isin(*SHELF_STATUS),
                 actual("CONSTRUCTION STATUS INVALIDO", status, "'")),
                (technology == "", "TECNOLOGIA VACIO"),
                (ipv4(address) == INVALID, actual("DIRECCION IP INVALIDA", address, "'")),
                ((level != "") & ~F.coalesce(number.between(0, 50), F.lit(False)),
                 actual("NIVEL BASTIDOR INVALIDO", level, "'")),
                ((migration != "") & ~F.lower(migration).isin(*YES_NO),
                 actual("MIGRACION OLT INVALIDA", migration, "'")),
                (bay == "", "BAY ID VACIO"),
            ),
        )
    )


def bay(
    description: Column, number: Column, status: Column, room: Column, row: Column,
    contractor: Column, building: Column,
) -> Column:
    """Bay rules on trimmed, non-null text; repeated messages appear once."""
    fields = (
        (description, "DESCRIPTION BAY"), (status, "ESTADO BAY"), (contractor, "CONTRATISTA BAY"),
        (building, "ID EDIFICIO"),
    )
    return F.array_distinct(
        all_of(
            *[whitespace(value, name) for value, name in fields],
            numbered_description(description, "BASTIDOR CLIENTE"),
            messages(
                (number == "", "NUMBER INVALIDO"),
                (status == "", "CONSTRUCTION STATUS INVALIDO"),
                (room == "", "NUMERO SALON INVALIDO"),
                ((room != "") & ~room.rlike(r"^OF \d+$"), actual("NUMERO SALON INVALIDO", room, "'")),
                (row == "", "NUMERO FILA INVALIDO"),
                ((row != "") & (row != "1"), text("NUMERO FILA INVALIDO. ACTUAL: ", row)),
                (contractor == "", "CONTRATISTA VACIO"),
                (building == "", "BUILDING ID VACIO"),
            ),
        )
    )


# --- nodes ---------------------------------------------------------------------------

def node_rule(
    node_a: Column, node_b: Column, allowed: Column, only: Column, a_known: Column, b_known: Column
) -> Column:
    """One allowed id (``only``): both ends must equal it. Several: each end is one of them."""
    outside = ((node_a != "") & ~a_known) | ((node_b != "") & ~b_known)
    return messages(
        ((allowed == 1) & ((node_a != only) | (node_b != only)),
         text("NODO INVÁLIDO | CORREGIR SEGÚN ODFS: A='", only, "', B='", only, "' | ACTUAL A='",
              node_a, "' B='", node_b, "'")),
        ((allowed > 1) & outside, "NODO A Y B | Nodos no coinciden con ODFS"),
    )
