"""Functions written in SQL, for use from ``spark.sql``.

Their bodies are expressions and queries, so the optimizer sees through a call as if the body
stood there. The two searches follow the same assumed shapes as :mod:`hilvan.functions.text`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Name, parameters, result and body.
FUNCTIONS = (
    ("extraer_equipo_central", "texto STRING", "STRING",
     "get(filter(regexp_extract_all(texto, r'[A-Z]{6}[A-Z0-9]*', 0), "
     "t -> length(regexp_replace(t, '[^0-9]', '')) >= 4), 0)"),
    ("extraer_port_ec", "texto STRING", "STRING", r"nullif(regexp_extract(texto, r'(\d+/\d+(?:/\d+)?)', 1), '')"),
    ("sin_blancos", "texto STRING", "STRING", "nullif(trim(texto), '')"),
    ("sin_cero", "texto STRING", "STRING", "nullif(nullif(trim(texto), '0'), '')"),
    ("cables_en_lista", "lista STRING", "TABLE (cable STRING)",
     r"SELECT cable FROM (SELECT explode(split(lista, '\n')) AS cable) WHERE cable <> ''"),
)


def register_functions(spark: SparkSession, schema: str | None = None) -> None:
    """Defines the functions for the session, or in a schema of the catalog for everyone.

    Spark takes no schema before the name of a table function, so those of a schema are called
    with that schema as the current one.
    """
    for name, parameters, result, body in FUNCTIONS:
        kind, full = ("TEMPORARY FUNCTION", name) if schema is None else ("FUNCTION", f"{schema}.{name}")
        spark.sql(f"CREATE OR REPLACE {kind} {full}({parameters}) RETURNS {result} RETURN {body}")
