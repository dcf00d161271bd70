"""All queries of the catalogue operators, with SQL where SQL can express them."""

from __future__ import annotations

from lakeshed.plans import decisions, entities, listings, matching, records, relational, resolving, snapshots, terms, texts
from lakeshed.plans.base import Query

FLAGSHIP = "snapshot_diff"
_MODULES = (relational, texts, matching, terms, entities, decisions, listings, resolving, records, snapshots)


def queries() -> dict[str, Query]:
    return {name: f for m in _MODULES for name, f in m.plans.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.plans.sql.items()}
