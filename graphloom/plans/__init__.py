"""Registered queries with their SQL counterparts."""

import importlib
import pkgutil


def load_all():
    """Import every query module and hand back (queries, oracles)."""
    for found in pkgutil.iter_modules(__path__):
        if found.name.endswith("_queries"):
            importlib.import_module(f"{__name__}.{found.name}")
    from graphloom.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
