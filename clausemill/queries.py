"""Registry of the engine's own queries: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from clausemill.registry import clauses, qa, text, units

_AREAS = (text, clauses, units, qa)
QUERIES: dict = {k: q for area in _AREAS for k, q in area.QUERIES.items()}
ORACLES: dict = {k: q for area in _AREAS for k, q in area.ORACLES.items()}
