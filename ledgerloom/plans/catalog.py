"""Collects the registered queries and their checking SQL."""

from ledgerloom.plans.adapters import Tables, with_adapters

QUERIES = {}
CHECKS = {}


def query(name, check=None):
    """Register ``f(tables) -> DataFrame``; ``check`` is SQL over the same tables."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if check is not None:
            CHECKS[name] = with_adapters(check)
        return function

    return register
