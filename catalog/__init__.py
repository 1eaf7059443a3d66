"""Registered queries: one per operator, with SQL where SQL can say it."""

from __future__ import annotations

import importlib

MODULES = ["filters", "joins", "aggregates", "windows", "scalars", "scans", "scoring", "clusters", "periods", "reports", "normalisers", "streams"]


def load():
    from catalog import base

    for name in MODULES:
        importlib.import_module(f"catalog.{name}")
    return base
