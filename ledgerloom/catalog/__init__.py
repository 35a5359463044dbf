"""Registered queries by area, each with an equivalent SQL text."""

from ledgerloom.catalog import checks, loads, marts

_AREAS = (marts, loads, checks)
QUERIES = {name: q for area in _AREAS for name, q in area.QUERIES.items()}
ORACLE = {name: sql for area in _AREAS for name, sql in area.ORACLE.items()}
