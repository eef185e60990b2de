"""Registered queries, each next to the SQL that gives the same result."""

import importlib

_MODULES = ("rows", "text", "chat", "scoring", "store", "streams")


def load_all():
    """Import every query module and return the registry."""
    for name in _MODULES:
        importlib.import_module(f"millrace.catalog.{name}")
    return importlib.import_module("millrace.catalog.base")
