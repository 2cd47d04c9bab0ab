"""Job lists: header roles, route texts, pass-through columns, first row per request."""

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import ladder
from ..rules.places import HEADER_ALIASES


def header_roles(columns) -> dict:
    """Which column plays which role; unnamed columns play none."""
    roles = {}
    for c in columns:
        word = c.strip().lstrip("﻿").lower().replace(" ", "")
        if not word or word == "none" or re.fullmatch(r"_c\d+", word):
            continue
        for role, aliases in HEADER_ALIASES.items():
            if role not in roles and word in aliases:
                roles[role] = c
                break
    return roles


def split_route(text: Column):
    """(origin, destination) of ``LHR-SIN``; nulls unless there are two codes of 2-4 letters."""
    parts = F.filter(F.split(F.upper(F.trim(F.coalesce(text, F.lit("")))), "[-/_>]"), lambda p: p != "")
    ok = (F.size(parts) == 2) & F.forall(parts, lambda p: F.length(p).between(2, 4))
    return F.when(ok, F.get(parts, F.lit(0))), F.when(ok, F.get(parts, F.lit(1)))


def to_jobs(df: DataFrame, pos: str) -> DataFrame:
    """carrier, origin, destination, raw_row, pos of every usable row (repeats included)."""
    roles = header_roles(df.columns)
    if "carrier" not in roles:
        raise ValueError(f"a carrier column is missing; headers seen: {df.columns}")
    has_od = "origin" in roles and "destination" in roles
    if not has_od and "ond" not in roles:
        raise ValueError(f"origin and destination or a route column are needed: {df.columns}")
    cell = lambda role: F.trim(F.coalesce(F.col(f"`{roles[role]}`").cast("string"), F.lit(""))) \
        if role in roles else F.lit("")
    named = [c for c in df.columns if c.strip() and not re.fullmatch(r"_c\d+", c)]
    raw = F.map_from_arrays(F.array(*[F.lit(c) for c in named]),
                            F.array(*[F.col(f"`{c}`").cast("string") for c in named]))
    o, d = split_route(cell("ond"))
    od = (cell("origin") != "") & (cell("destination") != "")
    out = df.select(cell("carrier").alias("carrier"),
                    F.when(od, F.upper(cell("origin"))).otherwise(o).alias("origin"),
                    F.when(od, F.upper(cell("destination"))).otherwise(d).alias("destination"),
                    raw.alias("raw_row"), F.col(f"`{pos}`").cast("bigint").alias("pos"))
    return out.where("carrier <> '' and origin is not null and destination is not null")


def first_request(jobs: DataFrame) -> DataFrame:
    """The first row of each (carrier, route)."""
    keyed = jobs.withColumn("_c", F.upper("carrier"))
    return ladder.first_rows(keyed, ["_c", "origin", "destination"], ["pos"]).drop("_c")


def read_jobs(spark: SparkSession, path: str, pos: str | None = None) -> DataFrame:
    """Job list from CSV.  Without a position column the order inside the file decides."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    if pos is None:
        df, pos = df.withColumn("_row", F.monotonically_increasing_id()), "_row"
    return first_request(to_jobs(df, pos))


def valid_and_invalid(df: DataFrame, carrier="carrier", route="ond"):
    """Rows a job list can use, and the rest."""
    o, _ = split_route(F.col(route))
    ok = (F.trim(F.coalesce(F.col(carrier), F.lit(""))) != "") & o.isNotNull()
    return df.where(ok), df.where(~ok)
