"""Airports and carriers.  FIXED VALUES: published names, regions and spellings."""

# FIXED VALUES: airport | city code | city | country code | country | region.
AIRPORTS = [
    ("ADJ", "AMM", "Amman", "JO", "Jordan", "Middle East"),
    ("AGP", "AGP", "Malaga", "ES", "Spain", "Europe"),
    ("AMM", "AMM", "Amman", "JO", "Jordan", "Middle East"),
    ("AMS", "AMS", "Amsterdam", "NL", "Netherlands", "Europe"),
    ("AQJ", "AQJ", "Aqaba", "JO", "Jordan", "Middle East"),
    ("ATH", "ATH", "Athens", "GR", "Greece", "Europe"),
    ("BBU", "BUH", "Bucharest", "RO", "Romania", "Europe"),
    ("BCN", "BCN", "Barcelona", "ES", "Spain", "Europe"),
    ("BER", "BER", "Berlin", "DE", "Germany", "Europe"),
    ("BEY", "BEY", "Beirut", "LB", "Lebanon", "Middle East"),
    ("BHX", "BHX", "Birmingham", "GB", "UK", "Europe"),
    ("BKK", "BKK", "Bangkok", "TH", "Thailand", "Asia"),
    ("BLQ", "BLQ", "Bologna", "IT", "Italy", "Europe"),
    ("BOM", "BOM", "Mumbai", "IN", "India", "Asia"),
    ("BOS", "BOS", "Boston", "US", "USA", "N. America"),
    ("BRU", "BRU", "Brussels", "BE", "Belgium", "Europe"),
    ("CAN", "CAN", "Guangzhou", "CN", "China", "Asia"),
    ("CDG", "PAR", "Paris", "FR", "France", "Europe"),
    ("CGH", "SAO", "Sao Paulo", "BR", "Brazil", "S. America"),
    ("CLJ", "CLJ", "Cluj-Napoca", "RO", "Romania", "Europe"),
    ("CMB", "CMB", "Colombo", "LK", "Sri Lanka", "Asia"),
    ("CND", "CND", "Constanta", "RO", "Romania", "Europe"),
    ("CRL", "BRU", "Brussels", "BE", "Belgium", "Europe"),
    ("DAC", "DAC", "Dhaka", "BD", "Bangladesh", "Asia"),
    ("DEL", "DEL", "Delhi", "IN", "India", "Asia"),
    ("DFW", "DFW", "Dallas/Fort Worth", "US", "USA", "N. America"),
    ("DME", "MOW", "Moscow", "RU", "Russia", "Europe"),
    ("DMK", "BKK", "Bangkok", "TH", "Thailand", "Asia"),
    ("DPS", "DPS", "Denpasar (Bali)", "ID", "Indonesia", "Asia"),
    ("DTW", "DTT", "Detroit", "US", "USA", "N. America"),
    ("DUS", "DUS", "Dusseldorf", "DE", "Germany", "Europe"),
    ("ECN", "ECN", "North Nicosia", "CY", "Cyprus", "Europe"),
    ("EDI", "EDI", "Edinburgh", "GB", "UK", "Europe"),
    ("EVN", "EVN", "Yerevan", "AM", "Armenia", "Asia"),
    ("FCO", "ROM", "Rome", "IT", "Italy", "Europe"),
    ("FRA", "FRA", "Frankfurt", "DE", "Germany", "Europe"),
    ("GMP", "SEL", "Seoul", "KR", "South Korea", "Asia"),
    ("GRU", "SAO", "Sao Paulo", "BR", "Brazil", "S. America"),
    ("HAM", "HAM", "Hamburg", "DE", "Germany", "Europe"),
    ("HAN", "HAN", "Hanoi", "VN", "Vietnam", "Asia"),
    ("HHN", "HHN", "Frankfurt-Hahn", "DE", "Germany", "Europe"),
    ("HKG", "HKG", "Hong Kong", "HK", "Hong Kong", "Asia"),
    ("HKT", "HKT", "Phuket", "TH", "Thailand", "Asia"),
    ("HND", "TYO", "Tokyo", "JP", "Japan", "Asia"),
    ("IAD", "WAS", "Washington", "US", "USA", "N. America"),
    ("IAH", "HOU", "Houston", "US", "USA", "N. America"),
    ("ICN", "SEL", "Seoul", "KR", "South Korea", "Asia"),
    ("ISB", "ISB", "Islamabad", "PK", "Pakistan", "Asia"),
    ("JED", "JED", "Jeddah", "SA", "Saudi Arabia", "Middle East"),
    ("JFK", "NYC", "New York", "US", "USA", "N. America"),
    ("EWR", "NYC", "New York", "US", "USA", "N. America"),
    ("KHI", "KHI", "Karachi", "PK", "Pakistan", "Asia"),
    ("KIX", "OSA", "Osaka", "JP", "Japan", "Asia"),
    ("KRK", "KRK", "Krakow", "PL", "Poland", "Europe"),
    ("KUL", "KUL", "Kuala Lumpur", "MY", "Malaysia", "Asia"),
    ("LAX", "LAX", "Los Angeles", "US", "USA", "N. America"),
    ("LED", "LED", "St Petersburg", "RU", "Russia", "Europe"),
    ("LGW", "LON", "London", "GB", "UK", "Europe"),
    ("LHR", "LON", "London", "GB", "UK", "Europe"),
    ("LHE", "LHE", "Lahore", "PK", "Pakistan", "Asia"),
    ("LTN", "LON", "London", "GB", "UK", "Europe"),
    ("MAD", "MAD", "Madrid", "ES", "Spain", "Europe"),
    ("MAN", "MAN", "Manchester", "GB", "UK", "Europe"),
    ("MED", "MED", "Medina", "SA", "Saudi Arabia", "Middle East"),
    ("MEL", "MEL", "Melbourne", "AU", "Australia", "Oceania"),
    ("MLE", "MLE", "Male", "MV", "Maldives", "Asia"),
    ("MNL", "MNL", "Manila", "PH", "Philippines", "Asia"),
    ("MUC", "MUC", "Munich", "DE", "Germany", "Europe"),
    ("MXP", "MIL", "Milan", "IT", "Italy", "Europe"),
    ("NCE", "NCE", "Nice", "FR", "France", "Europe"),
    ("NQZ", "NQZ", "Astana", "KZ", "Kazakhstan", "Asia"),
    ("NRT", "TYO", "Tokyo", "JP", "Japan", "Asia"),
    ("ORD", "CHI", "Chicago", "US", "USA", "N. America"),
    ("OTP", "BUH", "Bucharest", "RO", "Romania", "Europe"),
    ("PEK", "BJS", "Beijing", "CN", "China", "Asia"),
    ("PKX", "BJS", "Beijing", "CN", "China", "Asia"),
    ("PRG", "PRG", "Prague", "CZ", "Czechia", "Europe"),
    ("PVG", "SHA", "Shanghai", "CN", "China", "Asia"),
    ("RUH", "RUH", "Riyadh", "SA", "Saudi Arabia", "Middle East"),
    ("SFO", "SFO", "San Francisco", "US", "USA", "N. America"),
    ("SGN", "SGN", "Ho Chi Minh City", "VN", "Vietnam", "Asia"),
    ("SIN", "SIN", "Singapore", "SG", "Singapore", "Asia"),
    ("SJJ", "SJJ", "Sarajevo", "BA", "Bosnia and Herzegovina", "Europe"),
    ("SKG", "SKG", "Thessaloniki", "GR", "Greece", "Europe"),
    ("SOF", "SOF", "Sofia", "BG", "Bulgaria", "Europe"),
    ("SVO", "MOW", "Moscow", "RU", "Russia", "Europe"),
    ("SVQ", "SVQ", "Seville", "ES", "Spain", "Europe"),
    ("SYD", "SYD", "Sydney", "AU", "Australia", "Oceania"),
    ("TBS", "TBS", "Tbilisi", "GE", "Georgia", "Asia"),
    ("TIF", "TIF", "Taif", "SA", "Saudi Arabia", "Middle East"),
    ("TPE", "TPE", "Taipei", "TW", "Taiwan", "Asia"),
    ("VAR", "VAR", "Varna", "BG", "Bulgaria", "Europe"),
    ("VCE", "VCE", "Venice", "IT", "Italy", "Europe"),
    ("VKO", "MOW", "Moscow", "RU", "Russia", "Europe"),
    ("WAW", "WAW", "Warsaw", "PL", "Poland", "Europe"),
    ("YNB", "YNB", "Yanbu", "SA", "Saudi Arabia", "Middle East"),
    ("YTZ", "YTO", "Toronto", "CA", "Canada", "N. America"),
    ("YUL", "YMQ", "Montreal", "CA", "Canada", "N. America"),
    ("YVR", "YVR", "Vancouver", "CA", "Canada", "N. America"),
    ("YYZ", "YTO", "Toronto", "CA", "Canada", "N. America"),
    ("ZYR", "BRU", "Brussels", "BE", "Belgium", "Europe"),
    ("IST", "IST", "Istanbul", "TR", "Türkiye", "Turkey"),
    ("SAW", "IST", "Istanbul", "TR", "Türkiye", "Turkey"),
    ("ESB", "ANK", "Ankara", "TR", "Türkiye", "Turkey"),
    ("ADB", "IZM", "Izmir", "TR", "Türkiye", "Turkey"),
    ("AYT", "AYT", "Antalya", "TR", "Türkiye", "Turkey"),
]

# FIXED VALUES: carrier | published name | other spellings, comma separated.
CARRIERS = [
    ("TK", "Turkish Airlines", ""),
    ("EK", "Emirates", ""),
    ("QR", "Qatar Airways", ""),
    ("LH", "Lufthansa", ""),
    ("EY", "Etihad Airways", ""),
    ("SV", "Saudia", "Saudi Arabian Airlines"),
    ("PC", "Pegasus", ""),
    ("BA", "British Airways", ""),
    ("AF", "Air France", ""),
    ("SU", "Aeroflot", ""),
    ("MS", "EgyptAir", ""),
    ("GF", "Gulf Air", ""),
    ("AI", "Air India", ""),
    ("UA", "United Airlines", ""),
    ("KL", "KLM", "KLM Royal Dutch Airlines"),
    ("A3", "Aegean", "Aegean Airlines"),
    ("VF", "AJet", "AnadoluJet"),
    ("KE", "Korean Air", ""),
    ("OZ", "Asiana", "Asiana Airlines"),
    ("VS", "Virgin Atlantic", ""),
    ("MU", "China Eastern", "China Eastern Airlines,Shanghai Airlines"),
    ("AZ", "ITA Airways", "ITA Airways,Alitalia"),
    ("AC", "Air Canada", ""),
    ("CX", "Cathay Pacific", ""),
    ("SQ", "Singapore Airlines", ""),
    ("MH", "Malaysia Airlines", ""),
    ("QF", "Qantas", ""),
    ("TR", "Scoot", ""),
    ("BR", "EVA Air", ""),
    ("CI", "China Airlines", ""),
    ("NH", "ANA", "All Nippon Airways"),
    ("DL", "Delta", ""),
    ("CA", "Air China", ""),
    ("AA", "American Airlines", ""),
    ("JL", "Japan Airlines", ""),
    ("CZ", "China Southern", "China Southern Airlines"),
    ("TG", "Thai Airways", "Thai Airways International"),
    ("SK", "SAS", "Scandinavian Airlines"),
    ("LX", "SWISS", "Swiss International Air Lines"),
    ("OS", "Austrian", "Austrian Airlines"),
    ("3F", "FlyOne Armenia", ""),
    ("3L", "Air Arabia Abu Dhabi", ""),
    ("A9", "Georgian Airways", ""),
    ("DY", "Norwegian", ""),
    ("FR", "Ryanair", ""),
    ("H4", "HiSky", ""),
    ("JX", "Starlux Airlines", ""),
    ("T5", "Turkmenistan Airlines", ""),
    ("WZ", "Red Wings", ""),
    ("GQ", "SKY express", ""),
    ("RO", "Tarom", ""),
    ("HV", "Transavia", ""),
    ("HU", "Hainan Airlines", ""),
    ("U2", "easyJet", ""),
    ("DE", "Condor", "Condor Flugdienst"),
    ("SN", "Brussels Airlines", ""),
    ("UL", "SriLankan Airlines", "Sri Lankan Airlines"),
    ("3U", "Sichuan Airlines", ""),
    ("OE", "Lauda Europe", ""),
    ("W6", "Wizz Air", ""),
    ("W4", "Wizz Air Malta", ""),
    ("W9", "Wizz Air UK", ""),
]

# FIXED VALUES: accepted header spellings of a job list, per role.
HEADER_ALIASES = {
    "carrier": ["carrier", "airline", "carriercode", "carrier_code", "crr", "taşıyıcı", "tasiyici"],
    "origin": ["origin", "orgn", "from", "dep", "departure", "o", "kalkış", "kalkis"],
    "destination": ["destination", "dest", "to", "arrival", "arr", "d", "varış", "varis"],
    "ond": ["ond", "route", "od", "o-d"],
}

# FIXED VALUES: date planning defaults (days).
MIN_LEAD, HORIZON, TRIP_LENGTH = 21, 300, 3
FAR_BAND = (300, 330)
FALLBACK_BANDS = ((210, 20), (150, 20), (90, 20))
BLOCK_DAYS = 5
