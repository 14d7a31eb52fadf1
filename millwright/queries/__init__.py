"""Registered queries over the given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from millwright.queries import features, fusion, jobs, metrics, models, profile, splits, timeline

MODULES = (fusion, timeline, profile, features, splits, metrics, models, jobs)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
