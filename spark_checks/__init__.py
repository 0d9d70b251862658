"""Queries over the given tables with the SQL that must give the same rows."""

from . import analyses, checks, marts, runs, transforms

MODULES = (transforms, checks, marts, runs, analyses)

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
