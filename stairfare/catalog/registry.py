"""Registry of named queries: ``fn(spark, sf_dir) -> DataFrame``."""

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn
