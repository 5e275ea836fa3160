"""Queries over the driver tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

MODULES = ("scans", "cleaning", "joining", "aggregating", "evaluating", "ordering", "scalars", "ruling", "streams", "extending")


def load():
    """Import every query module once and return the registry."""
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return importlib.import_module(f"{__name__}.registry")
