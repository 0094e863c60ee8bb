"""The whole audit: every entity's findings, prioritised and written with counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hilvan.functions.text import report_text
from hilvan.operators.prioritize import prioritise, run_counters
from hilvan.plans import audit_buildings, audit_cables, audit_ports, audit_splices
from hilvan.plans.findings import building_owners, cable_owners, exclusions, exempt_names, lookup
from hilvan.session import stored
from hilvan.sources.columns import select_aliases
from hilvan.sources.tables import write_report

ENTITIES = {
    "cables": audit_cables.COLUMNS,
    "splices": audit_splices.COLUMNS,
    "buildings": audit_buildings.COLUMNS,
    "ports": audit_ports.COLUMNS,
}


def logical(exports: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Exports with their logical columns; each export must carry a ``seq`` column."""
    return {
        name: select_aliases(exports[name], aliases, keep=["seq"], required=["id"])
        for name, aliases in ENTITIES.items()
    }


def all_findings(
    tables: dict[str, DataFrame], owner_sheet: DataFrame, valid_owner: str,
    exclusion_sheet: DataFrame | None = None, nodes: DataFrame | None = None, decode: bool = True,
) -> DataFrame:
    """Findings of cables, splices, buildings, ports and of cables against splices."""
    excluded = exempt = None
    if exclusion_sheet is not None:
        excluded, exempt = exclusions(exclusion_sheet), exempt_names(exclusion_sheet)
    by_cable, by_building = lookup(cable_owners(owner_sheet)), lookup(building_owners(owner_sheet))
    # Written once: each is read by a dozen branches.
    cables = stored(audit_cables.prepare(tables["cables"], excluded, decode))
    splices = stored(audit_splices.prepare(tables["splices"], excluded, decode))
    return reduce(
        DataFrame.unionByName,
        [
            audit_cables.prepared_findings(cables, by_cable, valid_owner, nodes),
            audit_splices.prepared_findings(splices, by_cable, valid_owner),
            audit_buildings.audit_buildings(tables["buildings"], by_building, excluded, exempt),
            audit_ports.audit_ports(tables["ports"], tables["buildings"], excluded),
            audit_splices.merge_findings(splices, audit_cables.specifications(cables), cables, by_cable),
        ],
    )


def run_audit(
    spark: SparkSession, tables: dict[str, DataFrame], owner_sheet: DataFrame, valid_owner: str, path: str,
    exclusion_sheet: DataFrame | None = None, nodes: DataFrame | None = None,
) -> DataFrame:
    """Writes findings, report and counters under ``path``; returns the report.

    The findings are written once and read back, so report and counters do not run the
    audit twice. A failing part fails the run: no findings are never mistaken for none.
    """
    all_findings(tables, owner_sheet, valid_owner, exclusion_sheet, nodes).write.mode("overwrite").parquet(
        f"{path}/findings"
    )
    found = spark.read.parquet(f"{path}/findings")
    report = prioritise(found, valid_owner).select(
        F.col("entity").alias("element"), "id", report_text("value").alias("value"), "owner",
        F.col("message").alias("error"), "part",
    )
    write_report({"report": report, "counters": run_counters(found)}, path)
    return spark.read.parquet(f"{path}/report")
