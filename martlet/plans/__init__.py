"""Named queries over the layers, and the models they read."""

import importlib

QUERY_MODULES = ("relational", "windows", "events", "history", "changes", "serving", "text")


def load_catalogue():
    """All named queries, importing the modules that register them on first use."""
    for module in QUERY_MODULES:
        importlib.import_module(f"martlet.plans.{module}")
    from martlet.plans.registry import CATALOGUE

    return CATALOGUE
