"""Name -> job and name -> oracle SQL, gathered from every family module."""

from __future__ import annotations

import importlib

FAMILIES = ["retail", "exploration", "climate", "combat", "metrics", "combat_ops", "corpus", "payloads", "reviews", "scoring", "reference", "streaming", "quality_jobs", "sql_marts"]


def _load(attr: str) -> dict:
    out = {}
    for fam in FAMILIES:
        mod = importlib.import_module(f"lakeweave.plans.{fam}")
        out.update(getattr(mod, attr, {}))
        try:
            omod = importlib.import_module(f"lakeweave.plans.oracle_{fam}")
        except ModuleNotFoundError:
            continue
        if attr == "ORACLES":
            out.update(getattr(omod, "ORACLES", {}))
    return out


def queries() -> dict:
    return _load("QUERIES")


def oracles() -> dict:
    return _load("ORACLES")


def family_queries(family: str) -> dict:
    mod = importlib.import_module(f"lakeweave.plans.{family}")
    return dict(getattr(mod, "QUERIES", {}))
