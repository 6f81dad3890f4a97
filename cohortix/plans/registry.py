"""Imports every query module so that the catalog is complete."""

from __future__ import annotations

import importlib

MODULES = ("q_profile", "q_clean", "q_stats", "q_metrics", "q_models", "q_verdict")


def load():
    from cohortix.plans import catalog

    for m in MODULES:
        try:
            importlib.import_module(f"cohortix.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"cohortix.plans.{m}":
                raise
    return catalog.QUERIES, catalog.ORACLE
