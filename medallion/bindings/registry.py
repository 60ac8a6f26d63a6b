"""All bindings in one place."""

from __future__ import annotations

import importlib

MODULES = ["tiers", "pages", "reshape", "scalars", "checks", "history", "growing", "sqltext"]


def _mods():
    return [importlib.import_module(f"medallion.bindings.{m}") for m in MODULES]


def queries() -> dict:
    out: dict = {}
    for m in _mods():
        dup = set(out) & set(m.QUERIES)
        if dup:
            raise ValueError(f"duplicate query names: {sorted(dup)}")
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for m in _mods():
        out.update(getattr(m, "ORACLE", {}))
    return out
