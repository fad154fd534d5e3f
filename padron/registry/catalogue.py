"""All registered queries and their checking SQL."""

from __future__ import annotations

from padron.registry import cells, enrichment, jobs, quality, runs, shaping, sheets
from padron.registry.common import Query

REGISTRIES = [m.query for m in (enrichment, shaping, cells, quality, sheets, jobs, runs)]


def queries() -> dict[str, Query]:
    return {name: fn for r in REGISTRIES for name, fn in r.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for r in REGISTRIES for name, sql in r.oracle.items()}
