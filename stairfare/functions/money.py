"""Price text, currency, fees and display formats."""

from pyspark.sql import Column, functions as F

from ..rules import rights as R
from .names import literal_map

NUMBER = r"([-+]?\d[\d.,]*)"


def join_split_cents(text: Column) -> Column:
    """``319 .08 USD`` becomes ``319.08 USD``."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(\d)\s*\.\s*(\d)", "$1.$2"))


def plain_number(num: Column) -> Column:
    """Undo thousands separators; the separator seen last is the decimal one."""
    last_comma = F.length(num) - F.instr(F.reverse(num), ",")
    last_dot = F.length(num) - F.instr(F.reverse(num), ".")
    has_comma, has_dot = num.contains(","), num.contains(".")
    european = F.replace(F.replace(num, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    american = F.replace(num, F.lit(","), F.lit(""))
    return F.when(has_comma & has_dot, F.when(last_comma > last_dot, european).otherwise(american)) \
        .when(has_comma, F.when(num.rlike(r",\d{1,2}$"), european).otherwise(american)) \
        .otherwise(num)


def parse_price(text: Column) -> Column:
    """struct(value decimal(14,2), price_type, currency) of a rendered price."""
    raw = F.trim(F.coalesce(text, F.lit("")))
    word = F.upper(F.regexp_extract(raw, r"(?i)\b(USD|EUR|TRY|GBP|TL)\b", 1))
    currency = F.when(raw.contains("$"), "USD").when(raw.contains("€"), "EUR") \
        .when(raw.contains("₺"), "TRY").when(raw.contains("£"), "GBP") \
        .when(raw.contains("TL"), "TRY").when(word == "TL", "TRY").when(word != "", word)
    num = F.regexp_replace(F.regexp_extract(raw, NUMBER, 1), r"^\++", "")
    value = plain_number(num).try_cast("decimal(14,2)")
    return F.struct(
        value.alias("value"),
        F.when(raw.startswith("+"), "delta").otherwise("absolute").alias("price_type"),
        currency.alias("currency"))


def absolute_of(base: Column, delta: Column) -> Column:
    return F.when(base.isNotNull() & delta.isNotNull(), (base + delta).cast("decimal(14,2)")) \
        .when(delta.isNotNull(), delta).otherwise(base)


def to_usd(amount: Column, currency: Column, rate: Column) -> Column:
    """Lira amounts in dollars at the rate the record itself carries."""
    lira = (F.upper(F.coalesce(currency, F.lit("TRY"))) == "TRY") & rate.isNotNull() & (rate != 0)
    return F.when(lira, F.round(amount * rate, 2).cast("decimal(14,2)")).otherwise(amount)


def fee_amount_usd(text: Column) -> Column:
    """First amount with a currency in ``text``, in USD at the fixed display rates."""
    t = F.coalesce(text, F.lit(""))
    sym = F.regexp_extract(t, R.FEE_PATTERN, 1)
    amount = F.when(sym != "", F.regexp_extract(t, R.FEE_PATTERN, 2)) \
        .otherwise(F.regexp_extract(t, R.FEE_PATTERN, 3))
    word = F.upper(F.regexp_extract(t, R.FEE_PATTERN, 4))
    cur = F.coalesce(F.element_at(literal_map(R.SYMBOL_CURRENCY.items()), sym),
                     F.when(word == "TL", "TRY").otherwise(word))
    commas = F.length(amount) - F.length(F.replace(amount, F.lit(","), F.lit("")))
    last_comma = F.length(amount) - F.instr(F.reverse(amount), ",")
    last_dot = F.when(amount.contains("."), F.length(amount) - F.instr(F.reverse(amount), ".")) \
        .otherwise(-1)
    european = F.replace(F.replace(amount, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    n = F.when((commas == 1) & (last_comma > last_dot), european) \
        .otherwise(F.replace(amount, F.lit(","), F.lit(""))).try_cast("double")
    rate = F.coalesce(F.element_at(literal_map(R.FEE_RATES.items()), cur), F.lit(1.0))
    return F.when(amount != "", n * rate)


def fee_text(text: Column) -> Column:
    usd = fee_amount_usd(text)
    shown = F.replace(F.format_number(usd, 0), F.lit(","), F.lit("."))
    return F.when(usd > 0, F.concat(F.lit("~"), shown, F.lit(" USD"))).otherwise("")


def price_label(amount: Column, currency: Column, fallback: Column) -> Column:
    return F.when(amount.isNull(), F.coalesce(fallback, F.lit(""))) \
        .otherwise(F.trim(F.concat(F.format_number(amount, 2), F.lit(" "),
                                   F.coalesce(currency, F.lit("")))))
