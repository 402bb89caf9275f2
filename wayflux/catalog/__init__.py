"""Registered queries: each runs over the whole supplied tables and, where SQL can say the
same, carries the equivalent SQL text."""

from __future__ import annotations

import importlib

MODULES = ["scans", "reshaping", "joining", "spatial", "aggregating", "windowing", "graphs", "epidemic", "forecasting", "reporting", "streams", "locations"]


def load() -> dict:
    for m in MODULES:
        importlib.import_module(f"wayflux.catalog.{m}")
    from wayflux.catalog.base import QUERIES

    return QUERIES
