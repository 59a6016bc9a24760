"""Queries over the driver tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable


def _modules():
    from skuweave.workloads import crm, feeds, matching, products, sync

    return (products, sync, matching, feeds, crm)


def all_queries() -> dict[str, Callable]:
    return {name: function for m in _modules() for name, function in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
