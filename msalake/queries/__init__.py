"""Registered queries: every operator on the driver tables, next to the SQL that states its result.

The driver tables hold no proteins, so each operator runs on whole stand-in tables of the same shape.
"""

from __future__ import annotations

from . import alignment, catalogue, identifiers, mapping, runs, scans, selection

MODULES = (identifiers, mapping, scans, alignment, selection, catalogue, runs)


def queries():
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def oracles():
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
