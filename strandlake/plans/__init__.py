"""Whole analyses, and the queries registered with the driver."""

from __future__ import annotations

import importlib
import pkgutil


def load_queries():
    """(name -> query, name -> SQL) of every ``queries_*`` module."""
    for m in sorted(x.name for x in pkgutil.iter_modules(__path__) if x.name.startswith("queries_")):
        importlib.import_module(f"{__name__}.{m}")
    from .registry import ORACLE, QUERIES

    return QUERIES, ORACLE
