"""Column expressions that recognise rights, their status and their short text."""

from pyspark.sql import Column, functions as F

from ..rules import rights as R
from ..rules.vocab import STATUS_RANK
from .money import fee_text
from .names import case_contains, let, literal_map, whole_number, words_pattern


def normalize_text(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.coalesce(text, F.lit("")))), r"\s+", " ")


def _longest_first():
    """Synonyms, longest first; equal lengths keep the order of the rights."""
    flat = [(w, key) for key, words in R.SYNONYMS for w in words]
    return sorted(flat, key=lambda p: -len(p[0]))


def right_of_label(label: Column) -> Column:
    """Right key of the longest synonym contained in a free-text label."""
    return let(normalize_text(label), lambda t: case_contains(t, _longest_first()))


def status_of_text(text: Column) -> Column:
    """Paid before negative before positive, so that ``not permitted`` stays negative."""
    raw = F.coalesce(text, F.lit(""))

    def judge(t):
        paid = raw.rlike(R.MONEY_PATTERN) | raw.rlike(R.PLUS_MONEY_PATTERN) \
            | t.rlike(words_pattern(R.PAID_HINTS))
        return F.when(paid, "Paid") \
            .when(t.rlike(words_pattern(R.EXCLUDED_HINTS)) | t.rlike(R.EXCLUDED_WORD_PATTERN),
                  "Not Included") \
            .when(t.rlike(words_pattern(R.INCLUDED_HINTS)) | t.rlike(R.INCLUDED_WORD_PATTERN),
                  "Included").otherwise("Unknown")
    return let(normalize_text(text), judge)


def item_status(available: Column, description: Column, shown: Column, tooltip: Column) -> Column:
    """Status of a marketplace item: its availability flag first, Included by default."""
    e = F.lit("")
    text = F.concat_ws(" ", F.coalesce(description, e), F.coalesce(shown, e), F.coalesce(tooltip, e))
    refund_cut = F.lower(text).contains("kesintili")
    judged = let(status_of_text(text), lambda st: F.when((st == "Paid") | refund_cut, "Paid")
                 .when(st == "Not Included", st).otherwise("Included"))
    return F.when(~F.coalesce(available, F.lit(True)), "Not Included").otherwise(judged)


def flagged_status(has_right: Column, with_charge: Column, state: Column) -> Column:
    """Status of an airline right from its flags and its state word."""
    s = F.coalesce(state, F.lit(""))
    no = F.coalesce(~has_right, F.lit(False)) | s.contains("NOT_ALLOWED")
    paid = F.coalesce(with_charge, F.lit(False)) | s.contains("PENALTY")
    yes = F.coalesce(has_right, F.lit(False)) | s.contains("ALLOWED")
    return F.when(no, "Not Included").when(paid, "Paid").when(yes, "Included").otherwise("Unknown")


def flagged_value(kilo: Column, piece: Column, amount: Column, currency: Column,
                  percentage: Column, state: Column) -> Column:
    def part(value, suffix):
        shown = value.cast("string")
        return F.when((F.coalesce(shown, F.lit("")) != "") & (value != 0),
                      F.trim(F.concat(shown, F.lit(" "), suffix)))
    pct = F.when((F.coalesce(percentage.cast("string"), F.lit("")) != "") & (percentage.try_cast("double") != 0),
                 F.concat(percentage.cast("string"), F.lit("%")))
    parts = F.array_compact(F.array(part(kilo, F.lit("KG")), part(piece, F.lit("PC")),
                                    part(amount, F.coalesce(currency, F.lit(""))), pct))
    return F.when(F.size(parts) > 0, F.array_join(parts, " x ")) \
        .otherwise(F.coalesce(state, F.lit("")))


def status_rank(status: Column) -> Column:
    return F.when(status == "Included", STATUS_RANK["Included"]) \
        .when(status == "Paid", STATUS_RANK["Paid"]) \
        .when(status == "Not Included", STATUS_RANK["Not Included"]).otherwise(0)


def rule_detail(key: Column, status: Column) -> Column:
    """Standard word of a rule right; null when the right has none, '' when no word fits."""
    words = literal_map((f"{k}|{s}", w) for k, p, i in R.RULE_DETAILS
                        for s, w in (("Paid", p), ("Included", i)))
    return F.when(key.isin([k for k, _, _ in R.RULE_DETAILS]), F.coalesce(
        F.element_at(words, F.concat_ws("|", key, status)), F.lit("")))


def baggage_short(text: Column) -> Column:
    """``2×23kg`` from any wording; a size in cm never counts as a weight."""
    t = F.coalesce(text, F.lit(""))
    both = R.BAG_PIECES_BY_WEIGHT_PATTERN
    weight = F.regexp_extract(t, R.BAG_WEIGHT_PATTERN, 1)
    pieces = F.regexp_extract(t, R.BAG_PIECES_PATTERN, 1)
    return F.when(t.rlike(both), F.concat(F.regexp_extract(t, both, 1), F.lit("×"),
                                          F.regexp_extract(t, both, 2), F.lit("kg"))) \
        .when((weight != "") & (pieces != ""), F.concat(pieces, F.lit("×"), weight, F.lit("kg"))) \
        .when(weight != "", F.concat(weight, F.lit("kg"))).otherwise("")


def short_detail(key: Column, value: Column, status: Column) -> Column:
    word, fee = rule_detail(key, status), fee_text(value)
    rule = F.when(fee != "", F.concat(word, F.lit(" · "), fee)).otherwise(word)
    return F.when(word.isNotNull(), rule) \
        .when(key.isin(R.BAGGAGE_KEYS), baggage_short(value)).otherwise("")


def baggage_text(piece: Column, allowance: Column, fallback: Column) -> Column:
    ok = F.coalesce(piece, F.lit(0)).cast("int") != 0
    ok = ok & (F.coalesce(allowance, F.lit("")) != "")
    return F.when(ok, F.concat(piece.cast("string"), F.lit(" parça X "), allowance, F.lit(" kg"))) \
        .otherwise(fallback)


def miles_feature(available: Column, earned: Column, bonus: Column):
    """(state, detail) of the mileage feature."""
    state = F.when(available, "Included").when(~available, "Not Included")
    detail = F.when(F.coalesce(earned, F.lit(0.0)) != 0,
                    F.concat(earned.cast("bigint").cast("string"), F.lit(" mil"))) \
        .when(F.coalesce(bonus, F.lit(0.0)) != 0,
              F.concat(F.lit("%"), bonus.cast("bigint").cast("string"), F.lit(" bonus")))
    return state, F.when(state.isNotNull(), F.coalesce(detail, F.lit("")))


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").when(~flag, "No").otherwise("")


def split_cell(cell: Column):
    """(status, detail) of a ``Status: detail`` cell; the status is null when unknown."""
    t = F.trim(F.coalesce(cell, F.lit("")))
    at = F.instr(t, ":")
    head = F.when(at > 0, F.substr(t, F.lit(1), at - 1)) \
        .otherwise(t)
    detail = F.when(at > 0, F.trim(F.substr(t, at + 1))).otherwise("")
    status = F.element_at(literal_map(R.CHANGESET_STATUS_WORDS.items()), F.lower(F.trim(head)))
    return F.when(t != "", status), detail


def cell_text(status: Column, detail: Column) -> Column:
    d = F.trim(F.coalesce(detail, F.lit("")))
    return F.when(d != "", F.concat(status, F.lit(": "), d)).otherwise(status)


def state_and_detail(status: Column, detail: Column) -> Column:
    d = F.trim(F.coalesce(detail, F.lit("")))
    return F.when(d != "", F.concat(status, F.lit(" — "), d)).otherwise(status)


def rule_line(line: Column) -> Column:
    """One panel line as struct(kind, key, status, value, earned, bonus)."""
    li = F.coalesce(line, F.lit(""))
    is_miles = li.rlike(R.MILES_LINE_PATTERN) & ~F.lower(li).contains("baggage")
    number = F.replace(F.regexp_extract(li, r"(\d[\d.,]*)", 1), F.lit(","), F.lit("")) \
        .try_cast("double")
    percent = li.rlike(R.PERCENT_LINE_PATTERN)
    is_bag = li.rlike(R.BAG_LINE_PATTERN)
    bag_kind = F.lower(F.regexp_extract(li, R.BAG_LINE_PATTERN, 1))
    pieces = whole_number(F.regexp_extract(li, R.BAG_LINE_PATTERN, 2))
    kg = whole_number(F.regexp_extract(li, R.BAG_LINE_PATTERN, 3))
    is_rule = li.rlike(R.RULE_LINE_PATTERN)
    token = F.upper(F.regexp_extract(li, R.RULE_LINE_PATTERN, 1))
    text = F.trim(F.regexp_extract(li, R.RULE_LINE_PATTERN, 2))
    tokens = literal_map(R.RULE_TOKENS)
    rule_key = F.when(F.map_contains_key(tokens, token), F.element_at(tokens, token)) \
        .otherwise(F.coalesce(right_of_label(token), F.lit("")))
    free_key = F.coalesce(right_of_label(li), F.lit(""))
    free_status = let(status_of_text(li), lambda st: F.when(st == "Unknown", "Included").otherwise(st))
    key = F.when(is_miles, "").when(is_bag, F.when(bag_kind.contains("cabin"), "cabin_baggage")
                                    .when(bag_kind.contains("personal"), "")
                                    .otherwise("checked_baggage")) \
        .when(is_rule, rule_key).otherwise(free_key)
    status = F.when(is_bag, F.when((pieces > 0) & (kg > 0), "Included").otherwise("Not Included")) \
        .when(is_rule, status_of_text(text)) \
        .otherwise(free_status)
    value = F.when(is_bag, F.concat(pieces.cast("string"), F.lit(" x "), kg.cast("string"),
                                    F.lit(" KG"))).when(is_rule, text).otherwise(li)

    def outcome(k):
        kind = F.when(is_miles, "miles").when(k != "", "right").when(is_bag, "ignored") \
            .otherwise("description")
        right = (k != "") & ~is_miles
        return F.struct(
            kind.alias("kind"), F.when(right, k).alias("key"), F.when(right, status).alias("status"),
            F.when(right, value).alias("value"),
            F.when(is_miles & ~percent, number).alias("earned"),
            F.when(is_miles & percent, number).alias("bonus"))
    return let(key, outcome)
