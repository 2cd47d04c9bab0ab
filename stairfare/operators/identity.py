"""Whose flight it is: airline names, marketing and operating carriers."""

import re

from pyspark.sql import Column, functions as F

from ..functions.names import let, literal_map, norm_airline, detect_cabin, cabin_base
from ..rules import places


def _spellings() -> Column:
    rows, seen = [], set()
    for code, name, more in places.CARRIERS:
        for s in [name] + [m for m in more.split(",") if m]:
            n = re.sub(r"\s+", " ", re.sub("[^a-z0-9 ]", " ", s.lower())).strip()
            if (code, n) not in seen:
                seen.add((code, n))
                rows.append(F.struct(F.lit(code).alias("code"), F.lit(n).alias("norm")))
    return F.array(*rows)


def resolve_airline(name: Column) -> Column:
    """Code of an airline name: an exact spelling (first listed), else a unique containment."""
    known = _spellings()

    def look(n):
        exact = F.filter(known, lambda s: s.norm == n)
        near = F.array_distinct(F.transform(
            F.filter(known, lambda s: n.contains(s.norm) | s.norm.contains(n)), lambda s: s.code))
        return F.when(n == "", F.lit(None).cast("string")) \
            .when(F.size(exact) > 0, F.get(exact, F.lit(0)).code) \
            .when(F.size(near) == 1, F.get(near, F.lit(0)))
    return let(norm_airline(name), look)


def published_name(code: Column) -> Column:
    return F.element_at(literal_map((c, n) for c, n, _ in places.CARRIERS), F.upper(code))


def operator_matches(operating: Column, target: Column) -> Column:
    """False when another carrier operates; a row nobody can judge stays."""
    op = F.trim(F.coalesce(operating, F.lit("")))
    shown = norm_airline(published_name(target))
    return F.when(op == "", True).otherwise(let(resolve_airline(op), lambda code: F.when(
        code.isNotNull(), code == F.upper(target))
        .when(shown == "", True).otherwise(norm_airline(op).contains(shown))))


def belongs_to(row_carrier: Column, fare_carrier: Column, operating: Column, target: Column) -> Column:
    """No identity signal contradicts the target and at least one names it."""
    r, f = F.upper(F.coalesce(row_carrier, F.lit(""))), F.upper(F.coalesce(fare_carrier, F.lit("")))
    named = r.isin("", F.upper(target)) & f.isin("", F.upper(target)) & ((r != "") | (f != ""))
    return named & operator_matches(operating, target)


def markets_every_segment(segments: Column, target: Column) -> Column:
    return (F.size(segments) > 0) & F.forall(segments, lambda s: F.upper(s.marketing_airline) == target)


def markets_first_segment(segments: Column, target: Column) -> Column:
    return F.coalesce(F.upper(F.get(segments, F.lit(0)).marketing_airline) == target, F.lit(False))


def codeshare_and_interline(segments: Column, virtual: Column):
    """What the segments state: (codeshare, interline)."""
    named = lambda field: F.array_distinct(F.filter(F.transform(
        segments, lambda s: F.upper(F.coalesce(s[field], F.lit("")))), lambda x: x != ""))
    marketing, operating = named("marketing_airline"), named("operating_airline")
    shared = F.exists(segments, lambda s: F.coalesce(s.is_code_shared, F.lit(False)))
    codeshare = shared | (F.size(F.array_except(operating, marketing)) > 0)
    return codeshare, F.coalesce(virtual, F.lit(False)) | (F.size(marketing) > 1)


def contradicts_itself(name: Column, tag: Column, requested: Column) -> Column:
    """Name and tag name different cabins, none Premium Economy and none above the search."""
    def judge(word):
        top = F.greatest(cabin_base(word), cabin_base(tag))
        return F.coalesce((word != tag) & (word != "Premium Economy") & (tag != "Premium Economy")
                          & (top <= cabin_base(requested)), F.lit(False))
    return let(detect_cabin(name), judge)
