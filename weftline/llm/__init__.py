"""Operations for large training-data pipelines. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from weftline.llm import chunks, langid, lattice, licenses, mainhtml, middles, packing, periods, pieces, secrets, shards, simhash, toxicity

_MODULES = (chunks, langid, lattice, licenses, mainhtml, middles, packing, periods, pieces, secrets, shards, simhash, toxicity)


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in getattr(m, "ORACLE", {}).items()}
