"""Column expressions on brand names, cabins, fare codes and airline names.

All of them are built-in expressions, so a scan that uses them stays inside one
code-generated stage; no lookup here shuffles.
"""

import re
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from ..rules import places, vocab


def case_contains(text: Column, rules, default=None) -> Column:
    """First rule ``(token, value)`` whose token occurs in ``text``."""
    out = None
    for token, value in rules:
        hit = text.contains(token)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out if default is None else out.otherwise(default)


def literal_map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def whole_number(digits: Column) -> Column:
    """Integer of a digit string; the empty string is null without a failed cast, which is slow."""
    return F.when(digits != "", digits.try_cast("int"))


def words_pattern(words) -> str:
    """One alternation instead of a ``contains`` per word."""
    return "|".join(re.escape(w) for w in words)


def match_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]", "")


def _padded(text: Column) -> Column:
    return F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" "))


def detect_subtier(name: Column) -> Column:
    return let(_padded(name), lambda t: case_contains(t, vocab.SUBTIER_TOKENS))


def detect_cabin(text: Column) -> Column:
    return let(_padded(text), lambda t: case_contains(t, vocab.CABIN_TOKENS))


def cabin_base(cabin: Column) -> Column:
    out = F.when(cabin == "Premium Economy", 1000)
    return out.when(cabin == "Business", 2000).when(cabin == "First", 3000).otherwise(0)


def subtier_rank(subtier: Column) -> Column:
    out = None
    for key, rank, _ in vocab.SUBTIERS:
        out = F.when(subtier == key, rank) if out is None else out.when(subtier == key, rank)
    return out.otherwise(vocab.UNKNOWN_SUBTIER_RANK)


def name_rank(name: Column, cabin: Column) -> Column:
    """Position of a family inside its cabin, judged by its name alone."""
    return cabin_base(cabin) + let(detect_subtier(name), subtier_rank)


def canonical_name(name: Column, cabin: Column) -> Column:
    """``<Cabin> <Sub-tier>``, or the cleaned name when no sub-tier is recognised."""
    label = literal_map((k, lbl) for k, _, lbl in vocab.SUBTIERS)
    bare = F.regexp_replace(F.coalesce(name, F.lit("")),
                            r"(?i)\b(class|fare|package|brand)\b", " ")
    bare = F.trim(F.regexp_replace(bare, r"\s+", " "))
    bare = F.when(bare == "", cabin).otherwise(bare)
    return let(detect_subtier(name), lambda sub: F.when(
        sub.isNotNull(), F.concat_ws(" ", cabin, F.element_at(label, sub)))
        .otherwise(F.concat(cabin, F.lit(" — "), bare)))


def tier_code(cabin: Column, order: Column) -> Column:
    prefix = F.when(cabin == "Premium Economy", "PEco").when(cabin == "Business", "Bus") \
        .when(cabin == "First", "Fir").otherwise("Eco")
    return F.concat_ws("-", prefix, (order + 1).cast("string"))


def code_tokens(code: Column) -> Column:
    return F.filter(F.split(F.upper(F.coalesce(code, F.lit(""))), "[-_/ ]"), lambda t: t != "")


def _first_tabled(carrier: Column, code: Column, tabled: Column) -> Column:
    keys = F.transform(code_tokens(code),
                       lambda t: F.concat(F.upper(F.coalesce(carrier, F.lit(""))), F.lit("|"), t))
    return F.get(F.filter(keys, lambda k: F.map_contains_key(tabled, k)), F.lit(0))


def family_override(carrier: Column, code: Column, name: Column):
    """(display name, cabin) a carrier's own fare-family code decides, else nulls."""
    names = literal_map((f"{c}|{k}", n) for c, k, n, _ in vocab.FAMILY_CODES)
    cabins = literal_map((f"{c}|{k}", cab) for c, k, _, cab in vocab.FAMILY_CODES)
    tabled_carriers = sorted({c for c, *_ in vocab.FAMILY_CODES})
    hit = F.when(F.upper(carrier).isin(tabled_carriers),
                 F.coalesce(_first_tabled(carrier, code, names),
                            _first_tabled(carrier, name, names)))
    return F.element_at(names, hit), F.element_at(cabins, hit)


def looks_pe_code(token: Column) -> Column:
    return F.upper(F.trim(F.coalesce(token, F.lit("")))).rlike(vocab.PE_CODE_PATTERN)


def effective_cabin(name: Column, code: Column, hint: Column, fallback: Column,
                    carrier: Column) -> Column:
    """A brand's own cabin: tabled code, carrier code, word, code pattern, hint, fallback."""
    _, tabled = family_override(carrier, code, name)
    short_code = None
    for c, codes in vocab.PE_CODES_BY_CARRIER.items():
        hit = (F.upper(carrier) == c) & F.arrays_overlap(
            F.concat(code_tokens(code), code_tokens(name)), F.array(*[F.lit(x) for x in codes]))
        short_code = hit if short_code is None else short_code | hit
    return F.coalesce(
        tabled,
        F.when(short_code, "Premium Economy"),
        detect_cabin(name),
        F.when(looks_pe_code(name) | looks_pe_code(code), "Premium Economy"),
        hint, fallback)


def keeps_cabin(effective: Column, group: Column, keep_higher: Column) -> Column:
    """Same cabin stays; a higher one only where upgrades may leak in; lower never."""
    return (effective == group) | (keep_higher & (cabin_base(effective) > cabin_base(group)))


def is_upper(text: Column) -> Column:
    return (text == F.upper(text)) & (text != F.lower(text))


def capitalize(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2))))


def is_bare_code(name: Column) -> Column:
    return name.rlike(vocab.BARE_CODE_PATTERN)


def spelled_name(name: Column, spelling: Column) -> Column:
    """Display form of ``name``; ``spelling`` is the carrier's own wording or null."""
    def styled(s):
        words = F.array_join(F.transform(F.split(s, r"\s+"), lambda w: capitalize(w)), " ")
        return F.when(is_bare_code(s), s) \
            .when(is_upper(s) & s.contains(" "), words) \
            .when(is_upper(s) & F.lower(s).isin(vocab.FARE_WORDS), capitalize(s)) \
            .otherwise(s)
    return F.coalesce(spelling, let(F.trim(F.coalesce(name, F.lit(""))), styled))


def spelling_dim(spark) -> DataFrame:
    return spark.createDataFrame(vocab.SPELLINGS, "sp_carrier string, sp_key string, spelling string")


def with_pretty_name(df: DataFrame, name="raw_brand_name", carrier="carrier",
                     out="pretty_name") -> DataFrame:
    """Add the display name.  The spelling table is a fixed list, so it is broadcast."""
    dim = spelling_dim(df.sparkSession)
    joined = df.join(F.broadcast(dim), (F.upper(df[carrier]) == dim.sp_carrier)
                     & (match_key(F.trim(df[name])) == dim.sp_key), "left")
    return joined.withColumn(out, spelled_name(F.col(name), F.col("spelling"))) \
        .drop("sp_carrier", "sp_key", "spelling")


def is_suspicious(name: Column, code: Column) -> Column:
    """The name looks like a raw code rather than a brand."""
    s = F.trim(F.coalesce(name, F.lit("")))
    first = F.get(code_tokens(code), F.lit(0))
    opaque = is_upper(s) & ~s.contains(" ") & ~F.lower(s).isin(vocab.FARE_WORDS)
    return (s == "") | is_bare_code(s) \
        | F.coalesce(opaque & (match_key(s) == match_key(first)) & first.isNotNull(), F.lit(False))


def clean_fare_code(code: Column) -> Column:
    """Fare code without long hexadecimal ids; identical parts collapse to one."""
    toks = F.filter(F.split(F.trim(F.coalesce(code, F.lit(""))), "[-_/ ]"), lambda t: t != "")
    toks = F.filter(toks, lambda t: ~t.rlike(vocab.HEX_ID_PATTERN))
    one = F.array_distinct(toks)
    return F.array_join(F.when(F.size(one) == 1, one).otherwise(toks), "-")


def unit_key(*parts: Column) -> Column:
    return F.upper(F.concat_ws("|", *parts))


def norm_airline(name: Column) -> Column:
    s = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9 ]", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def names_carrier(text: Column, code: Column, airline: Column) -> Column:
    """The row text names the airline, or shows a flight number of its code."""
    by_name = (norm_airline(airline) != "") & norm_airline(text).contains(norm_airline(airline))
    padded = F.concat(F.lit(" "), F.upper(F.coalesce(text, F.lit(""))), F.lit(" "))
    number = F.concat(F.lit(r"\b"), F.upper(code), F.lit(r"\s?-?\s?[0-9]{1,4}\b"))
    return F.coalesce(by_name, F.lit(False)) | F.regexp_like(padded, number)


def is_low_cost(carrier: Column) -> Column:
    return F.upper(carrier).isin(vocab.LOW_COST)


def carrier_title(code: Column, airline: Column) -> Column:
    return F.when(airline.isNull(), F.upper(code)) \
        .otherwise(F.concat(airline, F.lit(" ("), F.upper(code), F.lit(")")))


def carrier_dim(spark) -> DataFrame:
    return spark.createDataFrame([(c, n) for c, n, _ in places.CARRIERS],
                                 "dim_carrier string, airline_name string")


def airport_dim(spark) -> DataFrame:
    return spark.createDataFrame(
        places.AIRPORTS, "ap_code string, city_code string, city_name string,"
                         " country_code string, country_name string, region string")
