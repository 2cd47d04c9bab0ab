"""Registry of source adapters: each says how its rows reach the common shape.

An adapter has a name, a priority (the lower number is preferred when sources are compared), the carriers it can
serve, and a function that gives the columns it changes.  All adapters work in one pass over the rows: a row takes the
columns of its own source's adapter.  No row is lost; one that its adapter cannot serve is marked.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

REGISTRY: dict[str, tuple[int, list[str] | None, Callable[[], dict[str, Column]]]] = {}


def adapter(name: str, priority: int, carriers=None):
    """Register a normaliser; ``carriers`` limits the carriers it can serve."""
    def add(fn):
        REGISTRY[name] = (priority, carriers, fn)
        return fn
    return add


@adapter("direct", 1, carriers=["TK", "LH", "AC"])
def direct() -> dict[str, Column]:
    return {}


@adapter("market", 2)
def market() -> dict[str, Column]:
    """Marketplace prices come in lira; they convert at the record's own rate."""
    rate = F.lit("0.0243").cast("decimal(5,4)")
    usd = F.round(F.col("price_value") * rate, 2).cast("decimal(14,2)")
    return {"price_value": F.when(F.col("currency") == "TRY", usd).otherwise(F.col("price_value")), "currency": F.lit("USD")}


@adapter("search", 3)
def search() -> dict[str, Column]:
    """A box without a price is shown, but offers nothing to buy."""
    return {"served": F.col("price_value").isNotNull()}


def normalized(df: DataFrame) -> DataFrame:
    """All rows in one shape, with the source's ``priority`` and whether its adapter can serve the row (``served``).

    A source without an adapter is not served and has no priority.
    """
    source, changed = F.coalesce("source", F.lit("")), {"priority": F.lit(None).cast("int"), "served": F.lit(False)}
    for name, (priority, carriers, fn) in REGISTRY.items():
        columns = fn()
        allowed = F.col("carrier").isin(carriers) if carriers else F.lit(True)
        own = columns | {"priority": F.lit(priority), "served": F.coalesce(allowed & columns.get("served", F.lit(True)), F.lit(False))}
        for column, value in own.items():
            changed[column] = F.when(source == name, value).otherwise(changed.get(column, F.col(column)))
    return df.withColumns(changed)
