"""Order of importance of findings, per entity."""

from __future__ import annotations

# White-space marks belong to every level, so they always take the first.
WHITESPACE_MARKS = ("ESPACIOS_DOBLES", "TABS")


def hierarchies(owner: str) -> dict[str, list[tuple[int, str, tuple[str, ...]]]]:
    """Entity -> levels ``(priority, field, patterns)``; ``owner`` is the valid owner.

    A message belongs to the first level with a pattern that it contains, whatever the
    case. Levels without patterns of their own can never be reached and are left out;
    level 1 stays because of the white-space marks.
    """
    # Priority, field and patterns of each entity.
    cable = [
        (1, "Id", ("DUPLICADO", "CONSECUTIVO")),
        (3, "Nombre", (
            "NOMBRE (Valor Inválido)", "NOMBRE (Debe estar en MAYÚSCULAS)", "NOMBRE (Corregir a",
            "NOMBRE (en", "COLOCACION (Troncal)", "COLOCACION (Ultima Milla)", "DE",
            "CARACTER INVALIDO", "el símbolo / solo se permite", "nombre no puede ser solo", "NOMBRE",
        )),
        (4, "Nombre Antiguo", ("NOMBRE_ANT", "NOMBRE_ANT (Falta guion cuando NOMBRE tiene guion)")),
        (5, "Municipio A", ("MUNICIPIO (Vacío)", "MUNICIPIO A INCONSISTENTE", "MUNICIPIO")),
        (6, "Municipio B", ("MUNICIPIO (Vacío)", "MUNICIPIO B INCONSISTENTE", "MUNICIPIO")),
        (7, "Nodo A", ("NODO INVÁLIDO", "NODO A Y B")),
        (8, "Nodo B", ("NODO INVÁLIDO", "NODO A Y B")),
        (9, "Especificación", (
            "ESPECI (senc)", "ESPECI (Tipo 2)", "ESPECI ('revisar'Ultima Milla cantidad de Hilos)",
            "ESPECI (NO acorde a lo establecido)", "ESPECI EA (revisar Tipo)",
            "ESPECI INCONSISTENTE EN CABLE TRONCAL", "ESPECI INCONSISTENTE",
        )),
        (10, "Estado de Construcción", (
            "STATUS ADMITIDOS (En servicio/Plan Abandono/Futuro)", "C.STATUS", "STATUS",
        )),
        (11, "Propietario", (f"PROPIETARIO ({owner})",)),
        (12, "Tipo de Colocacion", ("TIPO DE COLOCACION", "COLOCACION")),
        (999, "MERGE", (
            "TIPO DE CABLE INCONSISTENTE", "MERGE", "PROBLEMA EN FIBRA", "PROBLEMA EN SUB-ANILLO",
            "RECOMENDACIÓN",
        )),
    ]
    splice = [
        (1, "Id", ("CONSECUTIVO", "DUPLICADO")),
        (3, "Nombre", (
            "NOMBRE(ERRONEO)", "NOMBRE(CONTIENE ESPACIOS)", "NOMBRE(LETRA CONSECUTIVA)",
            "NOMBRE(CARACTERES ERRONEOS)", "usar:",
        )),
        (4, "Propietario", (f"PROPIETARIO ({owner})",)),
        (6, "Estado de Construcción", ("STATUS (En servicio/Plan Abandono/Futuro)",)),
        (8, "Especificación", (
            "ESPECIFICACION ET ERRONEA", "ESPECIFICACION (NO acorde a lo establecido)",
            "TIPO DE GRUPO", "esperado:", "actual:",
        )),
        (999, "MERGE", ("TIPO DE CABLE INCONSISTENTE", "INCONSISTENCIA MERGE")),
    ]
    building = [
        (1, "Id", ()),
        (2, "Nombre", (
            "NOMBRE (Corregir a", "NOMBRE", "NOMBRE (Valor Inválido)", "NOMBRE (Sufijo con espacios)",
        )),
        (3, "Tipo", ("TIPO DE GRUPO",)),
        (4, "Estado de Construcción", ("ESTADO",)),
        (5, "Categoria", ("CATEGORIA (AAA)",)),
    ]
    structure = [
        (1, "ESTRUCTURA", (
            "ESTRUCTURA (NUMBER_OF + FLOOR + ROOMS = 0)", "ESTRUCTURA_FLOOR_DIMENSION",
            "ESTRUCTURA_NUMBER_OF_ROOMS", "NUM_OF:", "FLOOR:", "ROOMS:",
        )),
    ]
    port = [
        (1, "Id", ("DUPLICADO", "CONSECUTIVO")),
        (2, "Tipo Señal", ("TIPO SEÑAL INVALIDO", "PUERTO RX/TX IDENTIFICADO")),
        (3, "Description", ("DESCRIPTION VACIO",)),
        (4, "Physical Status", ("PHYSICAL STATUS INVALIDO", "PHYSICAL STATUS VACIO")),
        (5, "Type", ("TYPE INVALIDO", "TYPE VACIO", "TYPE (solo Equipo Cliente)")),
        (6, "Connector Type", (
            "CONNECTOR TYPE INVALIDO", "CONNECTOR TYPE VACIO", "CONNECTOR TYPE (solo Unknown o Biconic)",
        )),
        (7, "Ancho De Banda", ("ANCHO DE BANDA INVALIDO",)),
        (8, "Unidad Ancho De Banda", ("UNIDAD ANCHO DE BANDA INVALIDA", "UNIDAD ANCHO DE BANDA VACIA")),
        (9, "Service Level", ("SERVICE LEVEL INVALIDO", "SERVICE LEVEL VACIO", "SERVICE LEVEL (solo Fiber)")),
        (10, "Proyecto De Red", ("PROYECTO DE RED VACIO",)),
        (11, "Contratista", ("CONTRATISTA VACIO",)),
        (12, "Id Servicio", ("ID SERVICIO FORMATO INVÁLIDO",)),
        (13, "Equipo Central", (
            "EQUIPO CENTRAL INVALIDO", "EQUIPO CENTRAL VACIO", "PREFIJO EQUIPO CENTRAL (BO,VI,PA)",
            "MINIMO 4 NUMEROS", "PRIMEROS 6 CARACTERES DEBEN SER LETRAS",
        )),
        (14, "Puerto Central", ("PUERTO CENTRAL INVALIDO", "PUERTO CENTRAL VACIO")),
        (15, "Tipo Servicio", ("TIPO SERVICIO VACIO",)),
        (16, "Nombre Cliente", (
            "NOMBRE CLIENTE (Valor Inválido)", "NOMBRE CLIENTE (Debe estar en MAYÚSCULAS)",
            "NOMBRE (Corregir a", "NOMBRE CLIENTE VACIO", "NOMBRE CLIENTE", "NOMBRE CLIENTE (Sufijo)",
        )),
        (17, "Direccion Cliente Id", ("DIRECCION CLIENTE",)),
        (19, "Connected?", ("CONNECTED INVALIDO",)),
        (20, "Anillo", ("ANILLO VACIO",)),
        (21, "Mit Card", ("MIT CARD VACIO",)),
        (22, "Direccion Puerto", ("DIRECCION PUERTO VACIO",)),
        (23, "Numero De Factibilidad-Cable", ("NUMERO FACTIBILIDAD VACIO",)),
        (24, "Id shelf", ("ID SHELF VACIO", "ID SHELF INVALIDO")),
        (25, "Cambio Service Manager", ("SERVICE MANAGER",)),
        (26, "Id Servicio", ("ID SERVICIO",)),
    ]
    shelf = [
        (1, "Id", ("DUPLICADO", "CONSECUTIVO")),
        (2, "Description", ("DESCRIPTION VACIO", "DESCRIPTION INVALIDA", "DESCRIPTION CON ESPACIOS")),
        (3, "Construction Status", ("CONSTRUCTION STATUS INVALIDO",)),
        (4, "Tipo", ("TIPO INVALIDO",)),
        (6, "Tecnologia", ("TECNOLOGIA VACIO",)),
        (7, "Direccion Ip", ("DIRECCION IP INVALIDA",)),
        (8, "Nivel En Bastidor", ("NIVEL BASTIDOR INVALIDO",)),
        (9, "Contratista", ("CONTRATISTA VACIO",)),
        (12, "Migracion Olt", ("MIGRACION OLT INVALIDA",)),
        (13, "Bay.id", ("BAY ID VACIO", "BAY ID INVALIDO")),
    ]
    bay = [
        (1, "Id", ("DUPLICADO", "CONSECUTIVO")),
        (2, "Number", ("NUMBER INVALIDO",)),
        (3, "Description", ("DESCRIPTION VACIO", "DESCRIPTION CON ESPACIADO", "DESCRIPTION INVÁLIDA")),
        (4, "Construction Status", ("CONSTRUCTION STATUS INVALIDO",)),
        (5, "Numero De Salon", ("NUMERO SALON INVALIDO",)),
        (6, "Numero De Fila", ("NUMERO FILA INVALIDO",)),
        (7, "Contratista", ("CONTRATISTA VACIO",)),
        (9, "Building.id", ("BUILDING ID VACIO", "BUILDING ID INVALIDO")),
    ]
    return {
        "FIBRA": cable, "EMPALME": splice, "EDIFICIO": building, "ESTRUCTURA": structure,
        "PORT": port, "SHELF": shelf, "BAY": bay,
    }
