"""Personal data in free text: notes people typed beside a package, or descriptions a source printed.

Regular expressions propose spans, checksums confirm them (Luhn for cards, mod 97 for bank accounts),
and words close by adjust the score.  Everything is column expressions; nothing leaves the JVM.

Every pattern starts only where a run of its characters starts (or where the last match ended) and
takes its runs whole, so that a very long run without a match costs linear time.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .records import KEY, TEXT, keyed, once, packed, unpacked

#: kind -> (cheap test that a text may hold one, pattern).  Order is the order of the result.
BASE = {
    "email": (r"@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9](?:[ -]?[0-9]){12}", r"[0-9](?:[ -]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
}
ADDED = {
    # takes the start only, so that none is passed over; the group behind it is all that may belong to the number, and a character to tell its border
    "iban": (r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Za-z0-9]{1,4})?))"),
    "id_number": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    # keys, tokens and passwords: a long run of letters and digits
    "secret": (r"[A-Za-z0-9+/_-]{16}", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}+={0,2}(?![A-Za-z0-9+/_=-])"),
}
KINDS = [*BASE, *ADDED]
ACCOUNT = r"^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?$"

#: Score before context, and words within ``NEAR`` characters that raise it by ``LIFT``.
SCORE = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "id_number": 0.3, "secret": 0.3}
CONTEXT = {
    "email": r"mail|contact|kontakt|correo|courriel|eposta",
    "ip": r"\bip\b|address|host|server|adresse",
    "card": r"card|visa|master|amex|karte|carte|tarjeta|kart",
    "phone": r"phone|tel|call|mobil|fax|gsm|whatsapp",
    "iban": r"iban|bank|account|konto|compte|cuenta|hesap",
    "id_number": r"ssn|social|identity|passport|national id|ausweis|dni|kimlik",
    "secret": r"token|secret|passw|\bpwd\b|api.?key|\bkey\b|bearer|credential|auth",
}
NEAR, LIFT, LEAST = 40, 0.3, 0.5
#: Least bits a character of a secret (drawn at random; words have fewer), and digits it has at least.
SECRET_BITS, SECRET_DIGITS = 3.0, 2


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """13 to 19 digits whose Luhn sum is a multiple of ten."""
    def summed(d):
        def add(total, i):
            digit = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
            twice = digit * 2
            return total + F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)
        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add)
    d = _digits(match)
    return F.when(F.length(d).between(13, 19), summed(d) % 10 == 0).otherwise(False)


def _mod97(match: Column) -> Column:
    """Bank account check: the first four characters moved to the end, letters as 10 to 35, rest 1."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest, c):
        return F.when(c.rlike("[0-9]"), (rest * 10 + c.cast("int")) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)
    return F.length(plain).between(15, 34) & (F.aggregate(F.split(moved, "(?<=.)(?=.)"), F.lit(0), step) == 1)


def _account_length(run: Column) -> Column:
    """Characters of the longest part of ``run`` that ends at a border and passes the check; 0 if there is none.

    A word behind the number looks like a group of it, so the run alone does not tell where it ends.
    """
    def passes(n):
        head = F.substring(run, F.lit(1), n)
        return head.rlike(ACCOUNT) & ~F.substring(run, n + 1, F.lit(1)).rlike("[A-Za-z0-9]") & _mod97(head)
    return F.coalesce(F.get(F.filter(F.sequence(F.greatest(F.length(run), F.lit(15)), F.lit(15), F.lit(-1)), passes), 0), F.lit(0))


def _entropy(match: Column) -> Column:
    """Bits a character, by how often each occurs in the match."""
    chars, n = F.split(match, "(?<=.)(?=.)"), F.length(match).cast("double")

    def step(bits, c):
        share = F.size(F.filter(chars, lambda x: x == c)) / n
        return bits - share * F.log2(share)
    return F.aggregate(F.array_distinct(chars), F.lit(0.0), step)


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "secret":
        return (F.length(_digits(match)) >= SECRET_DIGITS) & match.rlike("[A-Za-z]") & (_entropy(F.substring(match, 1, 64)) >= SECRET_BITS)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


SPAN = "struct<kind:string,start:int,end:int,score:double>"


def _spans(kind: str, text: Column) -> Column:
    """Confirmed spans of one kind, in order, with code point bounds.

    The pieces between matches and the matches alternate, so running lengths give the bounds.
    """
    test, pattern = (BASE | ADDED)[kind]
    own = kind == "iban"
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern)

    def step(state, x):
        start = state["at"] + F.length(x["gap"])
        at = start + F.length(x["hit"])
        end = start + _account_length(F.concat(x["hit"], x["tail"])) if own else at
        fresh = (end > start) & (start >= state["upto"]) if own else _confirmed(kind, x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(at.alias("at"), F.when(fresh, end).otherwise(state["upto"]).alias("upto"),
                        F.when(fresh, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    pairs = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(g.alias("gap"), h.alias("hit")))
    if own:
        pairs = F.zip_with(pairs, F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x, t: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), t.alias("tail")))
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("upto"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    found = F.aggregate(pairs, state, step, lambda s: s["out"])

    def scored(s):
        near = F.lower(F.substring(text, F.greatest(s["start"] - NEAR, F.lit(0)) + 1, s["end"] - s["start"] + 2 * NEAR))
        score = F.lit(SCORE[kind]) + F.when(near.rlike(CONTEXT[kind]), LIFT).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        F.least(score, F.lit(1.0)).alias("score"))
    out = F.transform(found, scored)
    if kind in ADDED:
        out = F.filter(out, lambda s: s["score"] >= LEAST)
    return F.when(text.rlike(test), out).otherwise(F.array().cast(f"array<{SPAN}>"))


def _with_spans(df: DataFrame, text: str) -> DataFrame:
    df = once(df, **{f"__{k}": _spans(k, F.col(text)) for k in KINDS})
    return df.withColumn("spans", F.concat(*[f"__{k}" for k in KINDS]))


def find(notes: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """One row per note: ``package_key, n_email, n_ip, n_card, n_phone, base_spans, spans``.

    ``spans`` are ``kind, start, end, score`` in the order of ``KINDS``, then by start; ``start`` and
    ``end`` count code points, the end is exclusive.  ``base_spans`` are those of the four base kinds,
    which no score removes; bank accounts, identity numbers and secrets (keys, tokens, passwords that look drawn
    at random) are added if their score, lifted by words close by, reaches ``LEAST``.

    Null or empty text: no spans.  Null keys stay, repeated rows each keep their row, an empty table
    gives an empty one, other columns are not read.  A text is read whole, in linear time.
    """
    df = _with_spans(keyed(notes, key, text), "__text")
    return df.select(F.col("__key").alias(key), *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in BASE],
                     F.concat(*[f"__{k}" for k in BASE]).alias("base_spans"), "spans")


def masked(notes: DataFrame, text: str = TEXT) -> DataFrame:
    """``notes`` with each span replaced by its kind, such as ``[EMAIL]``; all other columns unchanged, whatever their names.

    Spans that overlap are one replacement, named after the first.  A null text stays null, repeated rows stay.
    """
    plain = packed(notes, __given=F.col(f"`{text}`"))
    df = _with_spans(once(plain, __text=F.coalesce("__given", F.lit(""))), "__text")

    def step(state, s):
        fresh = s["start"] >= state["at"]
        gap = F.substring(F.col("__text"), state["at"] + 1, s["start"] - state["at"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(state["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(state["out"]).alias("out"))

    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda s: F.concat(s["out"], F.substring(F.col("__text"), s["at"] + 1, F.length("__text"))))
    return unpacked(df, notes.columns, **{text: F.when(F.size("spans") == 0, F.col("__given")).otherwise(done)})
