"""Queries over the supplied tables, each with the SQL it must agree with."""

from __future__ import annotations

import importlib

_MODULES = ("ranking", "counts", "checks", "reconcile", "pages", "text", "backfill", "state", "audits", "sinks", "landed")


def _load():
    for name in _MODULES:
        importlib.import_module(f"dayfolio.workload.{name}")
    from dayfolio.workload import registry
    return registry


def all_queries():
    return dict(_load().QUERIES)


def all_sql():
    return dict(_load().SQL)
