"""The registry of named queries and their SQL twins."""

from __future__ import annotations


def queries() -> dict:
    from weftline import operators
    from weftline.plans import registry

    operators.load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    from weftline.plans import registry

    queries()
    return dict(registry.ORACLES)
