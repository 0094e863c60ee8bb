"""Who is responsible for an object: from its version to the design that last touched it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hilvan.operators.groups import first_wins
from hilvan.operators.ordered import as_of

DATASET = "gis"
# Steps at which a look-up can end.
NO_ALTERNATIVE, NO_SCHEME, NO_PROJECT, COMPLETE = "SIN ALTERNATIVA", "SIN SCHEME", "SIN PROYECTO", "COMPLETO"


def _one_per_id(rows: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """One row per id, the smallest where an id repeats, under the names of the result."""
    known = rows.filter(F.col(key).isNotNull()).select(key, *columns)
    return first_wins(known, [key], list(columns), list(columns)).select(
        F.col(key).alias(f"_{key}"), *[F.col(c).alias(n) for c, n in columns.items()]
    )


def responsible(
    objects: DataFrame, alternatives: DataFrame, schemes: DataFrame, projects: DataFrame, dataset: str = DATASET
) -> DataFrame:
    """Every object with the alternative, scheme and project behind its version.

    ``objects``: id, version. ``alternatives``: dataset_name, version, scheme_id,
    alternative_name, seq. ``schemes``: scheme_id, name, owner, modified_by, modified_at,
    status, project_id. ``projects``: project_id, name, job_title, owning_group, modified_by,
    modified_at.

    The alternative is the one of the greatest version from nought up to the object's, the
    first row of equal versions. ``estado`` names the step at which the look-up ended, and
    ``mensaje`` says what was not found; a missing project has no text. What was found before
    a step that failed stays, later columns are null. Each table is reduced to one row per id
    or version before it is joined.
    """
    known = alternatives.filter((F.col("dataset_name") == dataset) & (F.col("version") >= 0)).select(
        "version", "scheme_id", "alternative_name", "seq", F.lit(True).alias("_alternative")
    )
    used = first_wins(known, ["version"], ["seq"], ["scheme_id", "alternative_name", "_alternative"])
    named = _one_per_id(schemes, "scheme_id", {
        "name": "diseno", "owner": "owner", "modified_by": "modificado_por", "modified_at": "fecha_modif",
        "status": "status", "project_id": "project_id",
    })
    owned = _one_per_id(projects, "project_id", {
        "name": "proyecto", "job_title": "proyecto_job", "owning_group": "grupo_dueno",
        "modified_by": "proyecto_mod_por", "modified_at": "fecha_mod_proy",
    })
    # Schemes and projects join the versions, one row each: joined with the objects, the scheme of
    # the last version would be the key of nearly all rows.
    versions = used.join(named, F.col("scheme_id") == F.col("_scheme_id"), "left").join(
        owned, F.col("project_id") == F.col("_project_id"), "left"
    )
    rows = as_of(objects.select("id", "version"), versions, [], "version", [c for c in versions.columns if c != "version"])
    state = (
        F.when(F.col("_alternative").isNull(), NO_ALTERNATIVE).when(F.col("_scheme_id").isNull(), NO_SCHEME)
        .when(F.col("_project_id").isNull(), NO_PROJECT).otherwise(COMPLETE)
    )
    return rows.select(
        "id", "version", state.alias("estado"), miss_text(state).alias("mensaje"), "alternative_name", "diseno", "owner",
        "modificado_por", "fecha_modif", "status", "proyecto", "proyecto_job", "grupo_dueno", "proyecto_mod_por",
        "fecha_mod_proy",
    )


def miss_text(state: Column) -> Column:
    """What was looked for in vain, with the value it was looked for by."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unset"))
    return F.when(
        state == NO_ALTERNATIVE, F.concat(F.lit("No se encontro alternativa para ds!version: "), shown("version"))
    ).when(state == NO_SCHEME, F.concat(F.lit("Scheme no encontrado para id: "), shown("scheme_id")))
