"""The right taxonomy and the words that decide a right and its status.

FIXED VALUES: results depend on these exact words and on their order.
"""

# FIXED VALUES: right key | English column | feed key, in published order.
RIGHTS = [
    ("cabin_baggage", "Cabin Baggage", "baggage_cabin"),
    ("checked_baggage", "Checked Baggage", "checked_baggage"),
    ("seat_selection", "Seat Selection", "seat_selection"),
    ("meal", "Meal", "meal"),
    ("lounge_access", "Lounge", "lounge"),
    ("priority_boarding", "Priority Boarding", "priority_boarding"),
    ("fast_track", "Fast Track", "fast_track"),
    ("refund", "Refund", "refund"),
    ("change", "Change", "change"),
    ("no_show_refund", "No-Show Refund", "no_show_refund"),
    ("no_show_change", "No-Show Change", "no_show_change"),
    ("same_day_earlier_flight", "Same Day Earlier Flight", "same_day_change"),
    ("wifi", "WiFi", "wifi"),
    ("extra_baggage", "Extra Baggage", "extra_baggage"),
    ("sports_equipment", "Sports Equipment", "sport_equipment"),
    ("pet", "Pet", "pet"),
]
RIGHT_KEYS = [k for k, _, _ in RIGHTS]
RIGHT_TITLES = {k: t for k, t, _ in RIGHTS}
FEED_KEYS = {k: f for k, _, f in RIGHTS}
BAGGAGE_KEYS = ["cabin_baggage", "checked_baggage", "extra_baggage"]

# FIXED VALUES: baggage texts: pieces by weight, weight alone, pieces alone.
BAG_PIECES_BY_WEIGHT_PATTERN = r"(?i)(\d+)\s*(?:parça|pieces?|pc)?\s*[x×]\s*(\d+)\s*kg"
BAG_WEIGHT_PATTERN = r"(?i)(\d+)\s*kg"
BAG_PIECES_PATTERN = r"(?i)(\d+)\s*(?:parça|pieces?|pc)\b"

# FIXED VALUES: right key | substrings of a free-text label, comma separated.
SYNONYMS = [
    ("cabin_baggage", ["cabin bag", "carry-on", "carry on", "hand bag", "hand lug", "el bagaj", "kabin bagaj", "cabinbaggage"]),
    ("checked_baggage", ["checked bag", "hold bag", "baggage allowance", "free baggage", "check-in bag", "checkin bag", "bagaj hakk", "kayıtlı bagaj", "baggage"]),
    ("seat_selection", ["seat selection", "seat choice", "choose seat", "preferred seat", "standard seat", "koltuk seç", "koltuk", "seatselection"]),
    ("meal", ["meal", "catering", "buy on board", "food", "ikram", "yemek"]),
    ("lounge_access", ["lounge", "salon", "cip lounge", "vip lounge", "loungeaccess"]),
    ("priority_boarding", ["priority boarding", "prior board", "öncelikli biniş", "priorityboarding"]),
    ("fast_track", ["fast track", "fast-track", "hızlı geçiş", "priority security", "priority_security", "prioritysecurity"]),
    ("refund", ["refund", "iade", "para iade", "geri ödeme", "cancel_before", "cancellation before", "cancellation"]),
    ("change", ["change after", "reissue", "rebook", "date change", "biletdeğişik", "tarih değişik", "change_afterdeparture", "change after departure", "değişiklik", "exchange"]),
    ("no_show_refund", ["no-show refund", "no show refund", "cancel_noshow", "noshow refund", "gelmeme iade", "refund with penalty for no-show", "penalty for no-show", "no-show cancellation"]),
    ("no_show_change", ["no-show change", "no show change", "change_noshow", "noshow change", "gelmeme değişik", "change with no-show"]),
    ("same_day_earlier_flight", ["same day", "same-day", "earlier flight", "aynı gün", "standby earlier", "earlier same day"]),
    ("wifi", ["wifi", "wi-fi", "wireless internet", "kablosuz internet", "internet package", "internet paketi"]),
    ("extra_baggage", ["extra bag", "additional bag", "excess bag", "ek bagaj", "fazla bagaj", "extrabaggage"]),
    ("sports_equipment", ["sports equipment", "sport equip", "spor ekipman", "sportsequipment"]),
    ("pet", ["pet", "evcil hayvan", "pet in cabin", "avih"]),
]

# FIXED VALUES: status words, tested in the order paid, excluded, included.
PAID_HINTS = ["fee", "paid", "chargeable", "for a fee", "with charge", "deduction",
              "penalty", "purchas", "at charge", "at cost", "extra charge",
              "ücretli", "ek ücret"]
EXCLUDED_HINTS = ["not included", "not allowed", "not permitted", "unavailable",
                  "not available", "✗", "✕", "—", "dahil değil", "hariç", "yok", "0 x 0",
                  "non-refundable", "non refundable", "nonrefundable", "not refundable",
                  "non-exchangeable", "non exchangeable", "not exchangeable",
                  "non-changeable", "iade edilemez", "iadesiz", "değiştirilemez"]
INCLUDED_HINTS = ["included", "free of charge", "free", "allowed", "permitted",
                  "complimentary", "accrual", "✓", "✔", "dahil", "ücretsiz", "var"]
MONEY_PATTERN = r"(?i)[$€₺£]|\b\d+[.,]?\d*\s?(usd|eur|try|gbp|tl)\b"
PLUS_MONEY_PATTERN = r"\+\s*\d"
EXCLUDED_WORD_PATTERN = r"\b(no|none)\b"
INCLUDED_WORD_PATTERN = r"\b(yes|var)\b"

# FIXED VALUES: right | detail word when Paid | detail word when Included.
RULE_DETAILS = [
    ("refund", "Kesintili", "Kesintisiz"),
    ("change", "Ücretli", "Cezasız"),
    ("no_show_refund", "Kesintili", "Kesintisiz"),
    ("no_show_change", "Ücretli", "Cezasız"),
    ("same_day_earlier_flight", "Ücretli", "Ücretsiz"),
]

# FIXED VALUES: marketplace item name | right key.
ITEM_CODES = [
    ("cabin_baggage", "cabin_baggage"),
    ("hand_bag", "cabin_baggage"),
    ("hand_baggage", "cabin_baggage"),
    ("checked_baggage", "checked_baggage"),
    ("extra_baggage", "extra_baggage"),
    ("seat_selection", "seat_selection"),
    ("seat", "seat_selection"),
    ("meal", "meal"),
    ("catering", "meal"),
    ("lounge", "lounge_access"),
    ("lounge_access", "lounge_access"),
    ("priority_boarding", "priority_boarding"),
    ("priority_security", "fast_track"),
    ("fast_track", "fast_track"),
    ("change", "change"),
    ("reissue", "change"),
    ("refund", "refund"),
    ("cancellation", "refund"),
    ("wifi", "wifi"),
    ("wi_fi", "wifi"),
    ("no_show_refund", "no_show_refund"),
    ("no_show_change", "no_show_change"),
    ("same_day", "same_day_earlier_flight"),
    ("pet", "pet"),
    ("sport", "sports_equipment"),
    ("sports", "sports_equipment"),
    ("sports_equipment", "sports_equipment"),
]
MILES_ITEMS = ["mile", "miles", "mileage", "mil"]

# FIXED VALUES: airline right type | right key (blank = outside the taxonomy).
AIRLINE_RIGHT_TYPES = [
    ("CARRY_ON_BAGGAGE", "cabin_baggage"),
    ("CHECKED_BAGGAGE", "checked_baggage"),
    ("EXTRA_BAGGAGE", "extra_baggage"),
    ("MERGED_SEAT_SELECTION", "seat_selection"),
    ("SEAT_SELECTION", "seat_selection"),
    ("PAID_SEAT_SELECTION", "seat_selection"),
    ("REISSUE", "change"),
    ("RESERVATION_CHANGE", "change"),
    ("CHANGE", "change"),
    ("SAME_DAY_CHANGE", "same_day_earlier_flight"),
    ("EARLIER_FLIGHT_SAME_DAY", "same_day_earlier_flight"),
    ("REFUND", "refund"),
    ("FAST_TRACK", "fast_track"),
    ("LOUNGE", "lounge_access"),
    ("LOUNGE_USAGE", "lounge_access"),
    ("MEAL", "meal"),
    ("CATERING", "meal"),
    ("WIFI", "wifi"),
    ("PRIORITY_BOARDING", "priority_boarding"),
]
AIRLINE_MILE_TYPES = ["BONUS_MILE", "MILE", "BASE_MILE"]

# FIXED VALUES: bare brand code of the airline's payload -> name shown.
AIRLINE_BRAND_NAMES = {"CL": "EcoFly", "LG": "ExtraFly", "GN": "FlexFly"}

# FIXED VALUES: search-page rule token | right key (blank = ignored).
RULE_TOKENS = [
    ("SEATSELECTION", "seat_selection"),
    ("LOUNGEACCESS", "lounge_access"),
    ("PRIORITY_BOARDING", "priority_boarding"),
    ("PRIORITY_SECURITY", "fast_track"),
    ("PRIORITY_CHECKIN", ""),
    ("CHANGE_AFTERDEPARTURE", "change"),
    ("CHANGE_BEFOREDEPARTURE", "change"),
    ("CANCEL_AFTERDEPARTURE", "refund"),
    ("CANCEL_BEFOREDEPARTURE", "refund"),
    ("REFUND", "refund"),
    ("CANCEL_NOSHOWFIRST", "no_show_refund"),
    ("CANCEL_NOSHOWSUBSEQUENT", "no_show_refund"),
    ("CHANGE_NOSHOWFIRST", "no_show_change"),
    ("CHANGE_NOSHOWSUBSEQUENT", "no_show_change"),
    ("SAMEDAYCHANGE", "same_day_earlier_flight"),
    ("MEAL", "meal"),
    ("WIFI", "wifi"),
    ("PET", "pet"),
    ("SPORT", "sports_equipment"),
    ("SPORTS", "sports_equipment"),
    ("SPORTSEQUIPMENT", "sports_equipment"),
    ("EXTRABAGGAGE", "extra_baggage"),
]
BAG_LINE_PATTERN = r"(?i)(cabin baggage|personal item|baggage)\s*:?\s*(\d+)\s*x\s*(\d+)\s*kg"
RULE_LINE_PATTERN = r"^([A-Z][A-Z_]{2,})\s*-\s*(.+)$"
MILES_LINE_PATTERN = r"(?i)\bmil(e|es)?\b"
PERCENT_LINE_PATTERN = r"(?i)%|percent|yüzde"

# FIXED VALUES: fee amounts in text and the approximate rates used to show them in USD.
FEE_PATTERN = r"(?i)([$€£])\s*(\d[\d.,]*)|(\d[\d.,]*)\s*(TRY|USD|EUR|GBP|TL)"
SYMBOL_CURRENCY = {"$": "USD", "€": "EUR", "£": "GBP"}
FEE_RATES = {"USD": 1.0, "TRY": 1 / 41.0, "EUR": 1.09, "GBP": 1.27}

# FIXED VALUES: change-set status words besides the statuses themselves.
CHANGESET_STATUS_WORDS = {"included": "Included", "paid": "Paid",
                          "not included": "Not Included", "unknown": "Unknown",
                          "dahil": "Included", "var": "Included", "ucretli": "Paid",
                          "ücretli": "Paid", "yok": "Not Included", "-": "Not Included"}
