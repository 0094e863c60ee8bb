"""Incremental versions of the loads and keyed edits."""
