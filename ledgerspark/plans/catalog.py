"""All registered queries; importing the modules fills the registry."""

from __future__ import annotations

from ledgerspark.plans import checks, layouts, registry, relational, reports, stateful, streams, writes  # noqa: F401


def queries():
    return registry.callables()


def oracle_sql():
    return dict(registry.ORACLES)
