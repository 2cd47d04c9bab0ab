"""Registered queries over the driver tables."""

import importlib

MODULES = ["texts", "ladders", "choosing", "planning", "quality", "analytics", "changes", "files", "streams"]


def all_queries():
    from .registry import QUERIES
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
    return dict(QUERIES)
