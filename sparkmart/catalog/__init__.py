"""The registered queries and the SQL each is checked against."""

from __future__ import annotations

from sparkmart.catalog import casts, checks, incremental, landing, models, reports, streams, tagging

GROUPS = (casts, landing, incremental, models, checks, tagging, reports, streams)

QUERIES = {name: query for group in GROUPS for name, query in group.QUERIES.items()}
ORACLES = {name: sql for group in GROUPS for name, sql in group.ORACLES.items()}
