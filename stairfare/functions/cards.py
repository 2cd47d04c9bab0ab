"""Fare cards: the text of one offer panel, parsed line by line on the whole text."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .money import plain_number
from .names import detect_cabin, let, whole_number, words_pattern

# FIXED VALUES: words of fare cards (English and Turkish).
CABIN_LINE = r"(?i)^(economy|premium economy|business|first)( class)?$|^(ekonomi|premium ekonomi|business|first)( sınıfı)?$"
EXCLUDED_CARD = ["get benefits worth", "easycancel", "only for ages", "student"]
NOT_A_NAME = ["baggage", "bagaj", "flexibility", "other benefits", "recommended", "cheapest",
              "economy", "business", "first", "flexible"]
CABIN_BAG, HOLD_BAG = ["carry-on", "kabin bagaj"], ["checked baggage", "check-in bagaj"]
KEY_WORDS = [("refund", ["non-refundable", "cancellation", "iptal", "i\u0307ptal", "iade"]), ("change", ["change", "değişiklik"]),
             ("seat_selection", ["seat selection", "koltuk"]), ("meal", ["meals", "yemek"]), ("lounge_access", ["lounge", "salon"])]
NEGATIVE = ["not included", "non-refundable", "not permitted", "dahil değil", "yapılamaz"]
MILES = ["miles", "milleri"]
LBS_SNAP = [(15, 18, 8), (22, 23, 10), (50, 50, 23), (70, 70, 32)]


def lbs_to_kg(lbs: Column) -> Column:
    """Pounds to kilos; the usual allowances snap to the airline's own figure."""
    out = None
    for lo, hi, kg in LBS_SNAP:
        hit = lbs.between(lo, hi)
        out = F.when(hit, kg) if out is None else out.when(hit, kg)
    return out.otherwise(F.floor(lbs * 0.4536 + 0.5).cast("int"))


def card_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s: F.trim(s)),
                    lambda s: s != "")


def is_excluded_card(text: Column) -> Column:
    """Upsells and age- or status-limited fares are not families."""
    return F.lower(F.coalesce(text, F.lit(""))).rlike(words_pattern(EXCLUDED_CARD))


def has_any(text: Column, words) -> Column:
    return reduce(or_, [text.contains(w) for w in words])


def starts_with(text: Column, words) -> Column:
    return reduce(or_, [text.startswith(w) for w in words])


def is_cabin_line(line: Column) -> Column:
    """No cabin line is longer than 22 characters and a line end; only such are matched."""
    return (F.length(line) <= 24) & line.rlike(CABIN_LINE)


def says_something(low: Column) -> Column:
    """Whether a lower-cased line may hold a right or miles."""
    return starts_with(low, CABIN_BAG + HOLD_BAG) | has_any(low, [w for _, words in KEY_WORDS for w in words] + MILES)


def is_price_line(line: Column) -> Column:
    return starts_with(line, "$€₺£") & line.rlike(r"^[$€₺£]\s*\d[\d.,]*$")


def card_name(lines: Column) -> Column:
    """The line under the cabin line, unless it is a heading, a badge or money."""
    at = F.array_position(F.transform(lines, is_cabin_line), True).cast("int")
    under = let(at, lambda i: F.when(i > 0, F.get(lines, i)))
    return let(under, lambda s: F.when(
        ~(F.lower(s).isin(NOT_A_NAME) | s.rlike(":|[$€₺£]")), s))


def card_price(lines: Column) -> Column:
    """The card's own price: its last line that is nothing but money."""
    last = let(F.filter(lines, is_price_line), lambda m: F.get(m, F.size(m) - 1))
    return let(F.regexp_extract(last, r"(\d[\d.,]*)", 1), plain_number).try_cast("decimal(14,2)")


def card_right(line: Column) -> Column:
    """struct(key, status, value, miles) of one card line; nulls when it says nothing."""
    after = F.trim(F.regexp_replace(line, r"^[^:]*:", ""))
    size = r"(\d+)\s*[x×]\s*(\d+)\s*(lbs|kg)"
    n, w = (whole_number(F.regexp_extract(line, size, i)) for i in (1, 2))
    kilos = F.when(F.regexp_extract(line, size, 3) == "lbs", lbs_to_kg(w)).otherwise(w)
    fee = F.when(has_any(line, "$€₺£"), F.regexp_extract(line, r"([$€₺£]\s*\d[\d.,]*)", 1)).otherwise("")

    def judge(low):
        cabin_bag, hold_bag = starts_with(low, CABIN_BAG), starts_with(low, HOLD_BAG)
        bag = cabin_bag | hold_bag
        key = F.when(cabin_bag, "cabin_baggage").when(hold_bag, "checked_baggage")
        for k, words in KEY_WORDS:
            key = key.when(has_any(low, words), k)
        negative = has_any(low, NEGATIVE)
        status = F.when(negative, "Not Included").when(~bag & (fee != ""), "Paid").otherwise("Included")
        value = F.when(bag & n.isNotNull(), F.concat(n.cast("string"), F.lit(" x "),
                                                     kilos.cast("string"), F.lit(" KG"))) \
            .when(fee != "", fee).otherwise(after)
        is_miles = has_any(low, MILES)
        miles = F.when(is_miles, whole_number(F.regexp_replace(
            F.regexp_extract(line, r"(\d[\d.,]*)", 1), "[.,]", "")))
        return F.struct(F.when(~is_miles, key).alias("key"), status.alias("status"),
                        value.alias("value"), miles.alias("miles"))
    return let(F.lower(line), judge)


def tallied_cards(df: DataFrame, text="card", cabin="cabin") -> DataFrame:
    """Cards counted by all they say besides their price: ``cabin, text, n, price_total``, for ``parse_cards``.

    Each card's own price is read and summed; lines that are nothing but money then read ``$0``, since the rest of a card does
    not follow from their figures.  Cards without a price publish nothing and drop.
    """
    def priced(lines):
        shape = F.array_join(F.transform(lines, lambda s: F.when(is_price_line(s), "$0").otherwise(s)), "\n")
        return F.struct(card_price(lines).alias("price_value"), shape.alias(text))
    whole = F.filter(F.transform(F.array(card_lines(F.col(text))), priced), lambda c: c.price_value.isNotNull())
    return df.select(cabin, F.inline(whole)).groupBy(cabin, text).agg(F.count("*").alias("n"), F.sum("price_value").alias("price_total"))


def parse_cards(df: DataFrame, text="card", cabin="cabin") -> DataFrame:
    """Add name, price, effective cabin, rights and miles; cards that publish nothing drop.

    One generator parses each card once; filtering on a parsed column afterwards would make
    the optimiser parse it again for the filter.
    """
    def parsed(lines):
        cabin_line = F.get(F.filter(lines, is_cabin_line), F.lit(0))
        return F.struct(
            card_name(lines).alias("brand_name"), card_price(lines).alias("price_value"),
            F.coalesce(detect_cabin(cabin_line), F.col(cabin)).alias("card_cabin"),
            F.transform(F.filter(lines, lambda s: says_something(F.lower(s))), card_right).alias("facts"))
    whole = F.transform(F.array(card_lines(F.col(text))), parsed)
    kept = F.filter(whole, lambda c: c.brand_name.isNotNull() & c.price_value.isNotNull())
    out = df.where(~is_excluded_card(F.col(text))).select("*", F.inline(kept))
    return out.withColumns({
        "rights": F.filter("facts", lambda r: r.key.isNotNull()),
        "miles_earned": F.array_max(F.transform("facts", lambda r: r.miles))}).drop("facts")
