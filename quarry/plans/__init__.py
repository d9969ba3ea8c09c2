"""Named queries, one per operator of the inventory, with oracle SQL."""

from __future__ import annotations

import importlib

_MODULES = ("documents", "analytics", "streams", "learning")


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"quarry.plans.{m}")


def all_queries():
    from quarry.plans.registry import QUERIES
    _load()
    return dict(QUERIES)


def all_oracles():
    from quarry.plans.registry import ORACLES
    _load()
    return dict(ORACLES)
