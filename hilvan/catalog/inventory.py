"""Inventory summaries: documents as files of a folder, events as files with a time."""

from __future__ import annotations

from hilvan.catalog.base import select, shape
from hilvan.operators import inventory as I
from hilvan.sources.tables import distinct_files, inventory_columns

DOCS = [
    "source AS carpeta_padre", "CAST(n_chars AS DOUBLE) / 1000 AS tamano_mb", "doc_id",
    "lang || '_' || CAST(doc_id AS STRING) AS archivo",
]
EVENTS = ["event_type AS carpeta_padre", "value AS tamano_mb", "ts AS fecha_modificacion", "event_id"]
FILES = [
    "'file:///base/' || source || '/' || lang || '/' || CAST(doc_id AS STRING) || "
    "CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN '.tar.gz' ELSE '.dwg' END AS path",
    "n_chars AS length", "TIMESTAMP '2024-01-01 00:00:00' AS modificationTime",
]


def folders(spark, d):
    return I.folder_summary(shape(spark, d, "documents", DOCS), "carpeta_padre", "tamano_mb")


def inventory(spark, d):
    files = shape(spark, d, "documents", FILES)
    return distinct_files(inventory_columns(files.unionAll(files), "/base")).drop("fecha_modificacion")


QUERIES = {
    "inventory_folders": folders,
    "inventory_top_folders": lambda s, d: I.top_folders(folders(s, d), "carpeta_padre"),
    "inventory_stats": lambda s, d: I.global_stats(
        shape(s, d, "events", EVENTS), "carpeta_padre", "tamano_mb", "fecha_modificacion"
    ),
    "inventory_hist": lambda s, d: I.size_histogram(shape(s, d, "documents", DOCS), "tamano_mb"),
    "inventory_topk": lambda s, d: I.largest_files(shape(s, d, "documents", DOCS), "tamano_mb", ["doc_id"]).select(
        "archivo", "carpeta_padre", "tamano_mb"
    ),
    "inventory_files": inventory,
}

_FOLDERS = """SELECT source AS carpeta_padre, count(*) AS cantidad_archivos,
CAST((sum(n_chars) + 5) // 10 AS DOUBLE) / 100 AS tamano_total FROM documents GROUP BY source"""

SQL = {
    "inventory_folders": _FOLDERS,
    "inventory_top_folders": f"SELECT * FROM ({_FOLDERS}) ORDER BY cantidad_archivos DESC, carpeta_padre LIMIT 5",
    "inventory_stats": """WITH a AS (SELECT count(*) AS n, count(DISTINCT event_type) AS f, sum(CAST(value AS DECIMAL(28,6))) AS s,
  max(value) AS mx, min(value) AS mn, max(ts) AS t1, min(ts) AS t0 FROM events)
SELECT 'Total archivos' AS metrica, CAST(n AS VARCHAR) AS valor FROM a
UNION ALL SELECT 'Total carpetas', CAST(f AS VARCHAR) FROM a
UNION ALL SELECT 'Tamano total', printf('%.2f', CAST(s AS DOUBLE)) FROM a
UNION ALL SELECT 'Tamano promedio', printf('%.2f', CAST(s AS DOUBLE) / n) FROM a
UNION ALL SELECT 'Archivo mas grande', printf('%.2f', mx) FROM a
UNION ALL SELECT 'Archivo mas pequeno', printf('%.2f', mn) FROM a
UNION ALL SELECT 'Fecha mas reciente', strftime(t1, '%Y-%m-%d %H:%M:%S') FROM a
UNION ALL SELECT 'Fecha mas antigua', strftime(t0, '%Y-%m-%d %H:%M:%S') FROM a""",
    "inventory_hist": """WITH l(orden, rango, lo, hi) AS (VALUES (0, '<0.1', 0, 0.1), (1, '0.1-1', 0.1, 1), (2, '1-5', 1, 5), (3, '5-10', 5, 10),
  (4, '10-20', 10, 20), (5, '20-50', 20, 50), (6, '50-100', 50, 100), (7, '100-500', 100, 500), (8, '500-1000', 500, 1000), (9, '>1000', 1000, 1e300)),
f AS (SELECT CAST(n_chars AS DOUBLE) / 1000 AS mb FROM documents)
SELECT orden, rango, (SELECT count(*) FROM f WHERE mb >= lo AND mb < hi) AS cantidad,
  round((SELECT count(*) FROM f WHERE mb >= lo AND mb < hi) * 100.0 / (SELECT count(*) FROM f), 1) AS porcentaje FROM l""",
    "inventory_topk": """SELECT lang || '_' || doc_id AS archivo, source AS carpeta_padre, CAST(n_chars AS DOUBLE) / 1000 AS tamano_mb
FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100""",
    "inventory_files": f"""WITH f AS (SELECT DISTINCT substr(path, 8) AS p, length FROM ({select('documents', FILES)}))
SELECT string_split(p, '/')[-1] AS archivo, upper(regexp_extract(string_split(p, '/')[-1], '[^.](\\.[^.]*)$', 1)) AS extension,
  p AS ruta_completa, regexp_replace(p, '/[^/]*$', '') AS carpeta, string_split(p, '/')[-2] AS carpeta_padre,
  length AS tamano_bytes, round(length / (1024 * 1024), 3) AS tamano_mb, 2 AS nivel_profundidad FROM f""",
}
