"""All queries of the core, gathered from the plan modules."""

from __future__ import annotations

from corpusloom.plans import assembly, connected, connectors, further, maintenance, problems, records, scalars

MODULES = (problems, scalars, assembly, maintenance, connectors, records, further, connected)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.oracle_sql().items()}
