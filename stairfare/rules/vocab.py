"""Word lists and ordered text rules.

Everything in this module is a FIXED VALUE of the domain: results depend on these
exact words and on their order.  They are plain literals, one rule per line.
"""

CABINS = ["Economy", "Premium Economy", "Business", "First"]
CABIN_BASE = {"Economy": 0, "Premium Economy": 1000, "Business": 2000, "First": 3000}
CABIN_PREFIX = {"Economy": "Eco", "Premium Economy": "PEco", "Business": "Bus", "First": "Fir"}
SEASONS = ["Summer", "Winter"]
STATUSES = ["Included", "Paid", "Not Included", "Unknown"]
STATUS_RANK = {"Included": 3, "Paid": 2, "Not Included": 1, "Unknown": 0}

LOW_COST = ["PC", "VF", "TR", "U2", "FR", "W6", "W4", "W9", "G9", "J9",
            "6E", "XY", "ZF", "NO", "TU", "FZ", "4S"]


# FIXED VALUES: sub-tier key | rank | label, cheapest to most flexible.
SUBTIERS = [
    ("lite", 10, "Lite"),
    ("basic", 20, "Basic"),
    ("standard", 30, "Standard"),
    ("comfort", 40, "Comfort"),
    ("semiflex", 45, "Semi Flex"),
    ("flex", 50, "Flex"),
    ("premium", 60, "Premium"),
]
UNKNOWN_SUBTIER_RANK = 35

# FIXED VALUES: token | sub-tier, tested in this order (a trailing blank is part of the token).
SUBTIER_TOKENS = [
    ("primefly", "premium"),
    ("businessprime", "premium"),
    ("flexfly", "flex"),
    ("extrafly", "standard"),
    ("ecofly", "basic"),
    ("ecojet", "basic"),
    ("businessflex", "flex"),
    ("businessclassic", "standard"),
    ("light", "lite"),
    ("lite", "lite"),
    ("hafif", "lite"),
    ("basic", "basic"),
    ("basis", "basic"),
    ("saver", "basic"),
    ("promo", "basic"),
    ("value", "basic"),
    ("standard", "standard"),
    ("classic", "standard"),
    ("smart", "standard"),
    ("main", "standard"),
    ("semi-flex", "semiflex"),
    ("semi flex", "semiflex"),
    ("semiflex", "semiflex"),
    ("deluxe", "premium"),
    ("comfort", "comfort"),
    ("plus", "comfort"),
    ("advantage", "comfort"),
    ("flex", "flex"),
    ("flexible", "flex"),
    ("esnek", "flex"),
    ("premium", "premium"),
    ("prime", "premium"),
    ("full", "premium"),
    ("max", "premium"),
    ("top", "premium"),
    ("go ", "basic"),
    ("economy go", "basic"),
    ("eco ", "basic"),
]

# FIXED VALUES: token | cabin, tested in this order.
CABIN_TOKENS = [
    ("premium economy", "Premium Economy"),
    ("premium eco", "Premium Economy"),
    ("premium ekonomi", "Premium Economy"),
    ("prem economy", "Premium Economy"),
    ("prem eco", "Premium Economy"),
    ("prem econ", "Premium Economy"),
    ("premecon", "Premium Economy"),
    ("world traveller plus", "Premium Economy"),
    ("premium select", "Premium Economy"),
    ("business", "Business"),
    ("busines", "Business"),
    ("işletme", "Business"),
    ("club", "Business"),
    ("upper", "Business"),
    ("first", "First"),
    ("suite", "First"),
    ("economy", "Economy"),
    ("ekonomi", "Economy"),
    ("eco", "Economy"),
    ("coach", "Economy"),
    ("main", "Economy"),
]

# FIXED VALUES: fare-family codes that mean Premium Economy.
PE_CODE_PATTERN = "^PE[A-Z]{2,}$"
PE_CODES_BY_CARRIER = {"AC": ["PL", "PF", "PB"]}
BARE_CODE_PATTERN = r"^[A-Z]{2,3}\d?$"
HEX_ID_PATTERN = "^[0-9a-fA-F]{16,}$"

# FIXED VALUES: carrier | fare-family code | display name | cabin.
FAMILY_CODES = [
    ("AC", "PB", "Premium Economy Basic", "Premium Economy"),
    ("AC", "PL", "Premium Economy Lowest", "Premium Economy"),
    ("AC", "PF", "Premium Economy Flexible", "Premium Economy"),
    ("AC", "EB", "Business Basic", "Business"),
    ("AC", "EL", "Business Lowest", "Business"),
    ("AC", "EF", "Business Flexible", "Business"),
    ("RJ", "YDELUXE", "Economy Deluxe", "Economy"),
    ("RJ", "JDELUXE", "Business Deluxe", "Business"),
    ("SV", "NBASICE", "Economy Basic", "Economy"),
    ("SV", "NSEMIFLEXE", "Economy Semi Flex", "Economy"),
    ("SV", "NFLEXE", "Economy Flex", "Economy"),
    ("SV", "NBASICB", "Business Basic", "Business"),
    ("SV", "NSEMIFLEXB", "Business Semi Flex", "Business"),
    ("SV", "NFLEXB", "Business Flex", "Business"),
]

# FIXED VALUES: ordinary fare words that may be capitalised when written in capitals.
FARE_WORDS = ["flexible", "standard", "comfort", "latitude", "basic", "economy", "business", "flex", "classic", "saver", "value", "ultimate", "premium", "lite", "light", "smart", "prime", "restricted", "promo", "promotional", "plus", "elite", "convenience"]

# FIXED VALUES: opaque family tokens accepted as names.
ACCEPTED_TOKENS = ["PREMECON", "PESEL", "PEPRO", "PEFLEX"]

# FIXED VALUES: carrier | collapsed name | display spelling.
SPELLINGS = [
    ("TK", "ecofly", "EcoFly"),
    ("TK", "extrafly", "ExtraFly"),
    ("TK", "flexfly", "FlexFly"),
    ("TK", "primefly", "PrimeFly"),
    ("TK", "businessfly", "Business Fly"),
    ("TK", "businessprime", "Business Prime"),
    ("TK", "businessflex", "Business Flex"),
    ("QR", "blite", "Business Lite"),
    ("QR", "bclassic", "Business Classic"),
    ("QR", "bcomfort", "Business Comfort"),
    ("QR", "belite", "Business Elite"),
    ("EK", "ecosaver", "Economy Saver"),
    ("EK", "ecoflex", "Economy Flex"),
    ("EK", "ecoflxplus", "Economy Flex Plus"),
    ("EK", "bssaver", "Business Saver"),
    ("EK", "bsflex", "Business Flex"),
    ("EK", "bsflxplus", "Business Flex Plus"),
    ("EK", "pyflxplus", "Premium Economy Flex Plus"),
    ("EK", "premiumeconomyflexplus", "Premium Economy Flex Plus"),
    ("EY", "ybasic", "Economy Basic"),
    ("EY", "yvalue", "Economy Value"),
    ("EY", "ycomfort", "Economy Comfort"),
    ("EY", "ydeluxe", "Economy Deluxe"),
    ("EY", "jvalue", "Business Value"),
    ("EY", "jcomfort", "Business Comfort"),
    ("EY", "jdeluxe", "Business Deluxe"),
    ("AI", "ecovalu", "Economy Value"),
    ("AI", "ecoclas", "Economy Classic"),
    ("AI", "ecoflx", "Economy Flex"),
    ("AI", "busvalu", "Business Value"),
    ("AI", "busflx", "Business Flex"),
    ("AI", "peyvalu", "Premium Economy Value"),
    ("AI", "peyflx", "Premium Economy Flex"),
    ("DL", "mainbasic", "Main Basic"),
    ("DL", "mainclasc", "Main Classic"),
    ("DL", "mainextra", "Main Extra"),
    ("DL", "comftclasc", "Comfort Classic"),
    ("DL", "comftextra", "Comfort Extra"),
    ("DL", "dpsclasc", "Premium Select Classic"),
    ("DL", "dpsextra", "Premium Select Extra"),
    ("DL", "doneclasc", "Delta One Classic"),
    ("DL", "doneextra", "Delta One Extra"),
    ("LH", "ecobasepl", "Economy Basic Plus"),
    ("LH", "ecocmft", "Economy Comfort"),
    ("LH", "ecocmftpls", "Economy Comfort Plus"),
    ("LH", "ecoflex", "Economy Flex"),
    ("LH", "prelight", "Premium Economy Light"),
    ("LH", "precmft", "Premium Economy Comfort"),
    ("LH", "precmftpls", "Premium Economy Comfort Plus"),
    ("LH", "preflex", "Premium Economy Flex"),
    ("LH", "pregreic", "Premium Economy Green"),
    ("LH", "buslight", "Business Light"),
    ("LH", "buscmft", "Business Comfort"),
    ("LH", "buscmftpls", "Business Comfort Plus"),
    ("LH", "busgreic", "Business Green"),
    ("LH", "ecogreic", "Economy Green"),
    ("LH", "ecmftflxi", "Economy Comfort Flex"),
    ("LH", "buscmtflx", "Business Comfort Flex"),
    ("LH", "precmftflx", "Premium Economy Comfort Flex"),
    ("AF", "lightbag", "Light"),
    ("AF", "standard3", "Standard"),
    ("AF", "flex1", "Flex"),
    ("AF", "premstand", "Premium Standard"),
    ("AF", "premflex", "Premium Flex"),
    ("AF", "premlight", "Premium Light"),
    ("AF", "premlightb", "Premium Light"),
    ("AF", "bizlight", "Business Light"),
    ("KL", "bizlight", "Business Light"),
    ("KL", "premlight", "Premium Light"),
    ("KL", "premstand", "Premium Standard"),
    ("KL", "premflex", "Premium Flex"),
    ("KL", "lightbag", "Light"),
    ("KL", "standard3", "Standard"),
    ("KL", "flex1", "Flex"),
    ("KL", "premlightb", "Premium Light"),
    ("AZ", "ecocmft", "Economy Comfort"),
    ("AZ", "ecocmftpls", "Economy Comfort Plus"),
    ("AZ", "ecoflex", "Economy Flex"),
    ("AZ", "precmft", "Premium Economy Comfort"),
    ("AZ", "precmftpls", "Premium Economy Comfort Plus"),
    ("AZ", "preflex", "Premium Economy Flex"),
    ("AZ", "buscmft", "Business Comfort"),
    ("AZ", "buscmftpls", "Business Comfort Plus"),
    ("GQ", "bliss", "Bliss"),
    ("GQ", "blissplus", "Bliss Plus"),
    ("GQ", "enjoy", "Enjoy"),
    ("GQ", "joyplus", "Joy Plus"),
    ("GQ", "joy", "Joy"),
    ("J2", "budget", "Budget"),
    ("PC", "avantaj", "Avantaj"),
    ("RJ", "buvalue", "Business Value"),
    ("RJ", "busaver", "Business Saver"),
    ("RJ", "bssaver", "Business Saver"),
    ("RJ", "buflex", "Business Flex"),
    ("RJ", "jdeluxe", "Business Deluxe"),
    ("RJ", "ydeluxe", "Economy Deluxe"),
    ("RJ", "ecflex", "Economy Flex"),
    ("RJ", "ecsaver", "Economy Saver"),
    ("RJ", "ecvalue", "Economy Value"),
    ("RJ", "ecoflex", "Economy Flex"),
    ("AA", "fbus", "Flagship Business"),
    ("CA", "stdbiz", "Business Standard"),
    ("CA", "flexbiz", "Business Flex"),
    ("CA", "ltbiz", "Business Lite"),
    ("CX", "bizlight", "Business Light"),
    ("CX", "bizessent", "Business Essential"),
    ("CX", "bclassic", "Business Classic"),
    ("FB", "bexecutive", "Business Executive"),
    ("HO", "flexbiz", "Business Flex"),
    ("KE", "prstandard", "Prestige Standard"),
    ("KE", "prplus", "Prestige Plus"),
    ("NH", "bizclassic", "Business Classic"),
    ("NH", "bizstd", "Business Standard"),
    ("NH", "bizval", "Business Value"),
    ("NH", "bizvalpls", "Business Value Plus"),
    ("OZ", "prstandard", "Prestige Standard"),
    ("OZ", "prplus", "Prestige Plus"),
    ("PR", "busvalue", "Business Value"),
    ("TG", "bufl", "Business Flexible"),
    ("VS", "upper", "Upper Class"),
    ("GF", "ecolite", "Economy Lite"),
    ("GF", "ecosmart", "Economy Smart"),
    ("GF", "ecoflex", "Economy Flex"),
    ("GF", "bizsmart", "Business Smart"),
    ("UA", "premeco", "Premium Economy"),
    ("UA", "premecoref", "Premium Economy Refundable"),
    ("UA", "premecoprf", "Premium Economy Part Refundable"),
    ("UA", "busref", "Business Refundable"),
    ("UA", "buspartref", "Business Part Refundable"),
    ("BA", "econsel", "Economy Select"),
    ("BA", "econpro", "Economy Pro"),
    ("BA", "econflex", "Economy Flex"),
    ("BA", "bizpromo", "Business Promo"),
    ("BA", "bizsel", "Business Select"),
    ("BA", "bizpro", "Business Pro"),
    ("BA", "bizflex", "Business Flex"),
]

# FIXED VALUES: flag of an incomplete unit | issue text, before and behind the figure it names.
ISSUE_TEXTS = [
    ("missing_source", "no source recorded", ""),
    ("missing_cabin", "cabins found=", " < expected "),
    ("missing_business", "no Business cabin for non-LCC carrier ", ""),
    ("missing_brands", "no branded fares extracted", ""),
    ("missing_price", "no prices on any brand", ""),
    ("missing_rights", "no right data on any brand", ""),
    ("missing_miles", "no miles data on any brand", ""),
]
