"""Registered queries over the given tables, and their SQL checks."""

import importlib

MODULES = ["text_queries", "hub_queries", "registry_queries", "matching_queries", "discovery_queries", "lines_queries", "pages_queries", "answers_queries"]


def _load():
    for module in MODULES:
        importlib.import_module(f"ledgerloom.plans.{module}")
    from ledgerloom.plans import catalog

    return catalog


def all_queries():
    return dict(_load().QUERIES)


def all_checks():
    return dict(_load().CHECKS)
