"""Auditing, reconciling and bulk-editing of network-inventory tables on Spark."""

from hilvan.session import build_session, cut_lineage

__all__ = ["build_session", "cut_lineage"]
