"""Operators, each module registering the queries that apply them."""

from __future__ import annotations

import importlib

MODULES = ("text", "relational", "aggregates", "windows", "sparse", "vectors", "layout", "audit", "constraints", "documents", "links", "contracts", "reviews", "excerpts", "streams")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"weftline.operators.{name}")
