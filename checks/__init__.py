"""Reference SQL for the registered queries, written for DuckDB."""

import importlib

MODULES = ["sql_texts", "sql_ladders", "sql_choosing", "sql_planning", "sql_quality", "sql_analytics", "sql_changes", "sql_files", "sql_streams"]


def all_sql():
    out = {}
    for m in MODULES:
        out.update(importlib.import_module(f"{__name__}.{m}").SQL)
    return out
