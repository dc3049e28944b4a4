"""Lists, tables and patterns that results depend on, in their given order."""

# Patterns are Java's; (?U) makes \b, \s and \d those of Unicode.
FLAGS = "(?iU)"

# Legal forms, replaced in this order: the first that fits changes the text for the next.
LEGAL_FORMS = [
    (r"\b(private\s+limited|pvt\s*\.?\s*ltd\s*\.?|pvt\s*\.?\s*limited|private\s+ltd\s*\.?)\b", " pvt ltd "),
    (r"\b(public\s+limited|pub\s*\.?\s*ltd\s*\.?|public\s+ltd\s*\.?)\b", " ltd "),
    (r"\b(limited\s+liability\s+company|l\s*\.?\s*l\s*\.?\s*c\s*\.?)\b", " llc "),
    (r"\b(limited\s+liability\s+partnership|l\s*\.?\s*l\s*\.?\s*p\s*\.?)\b", " llp "),
    (r"\b(professional\s+limited\s+liability\s+company|p\s*\.?\s*l\s*\.?\s*l\s*\.?\s*c\s*\.?)\b", " pllc "),
    (r"\b(societe\s+a\s+responsabilite\s+limitee|s\s*\.?\s*a\s*\.?\s*r\s*\.?\s*l\s*\.?)\b", " sarl "),
    (r"\b(societe\s+par\s+actions\s+simplifiee\s+unipersonnelle|s\s*\.?\s*a\s*\.?\s*s\s*\.?\s*u\s*\.?)\b", " sas "),
    (r"\b(societe\s+par\s+actions\s+simplifiee|s\s*\.?\s*a\s*\.?\s*s\s*\.?)\b", " sas "),
    (r"\b(entreprise\s+unipersonnelle\s+a\s+responsabilite\s+limitee|e\s*\.?\s*u\s*\.?\s*r\s*\.?\s*l\s*\.?)\b", " eurl "),
    (r"\b(societe\s+civile\s+immobiliere|s\s*\.?\s*c\s*\.?\s*i\s*\.?)\b", " sci "),
    (r"\b(societe\s+anonyme|s\s*\.?\s*a\s*\.?)\b", " sa "),
    (r"\b(et\s+fils|&\s*fils)\b", " fils "),
    (r"\b(et\s+freres|&\s*freres)\b", " freres "),
    (r"\b(corporation|corp\s*\.?)\b", " corp "),
    (r"\b(incorporated|inc\s*\.?)\b", " inc "),
    (r"\b(limited|ltd\s*\.?)\b", " ltd "),
    (r"\b(company|co\s*\.?)\b", " co "),
    (r"\b(compagnie|cie\s*\.?)\b", " cie "),
]
ALIAS = r"\b(?:dba|d/b/a|aka|a/k/a|trading\s+as|t/a|formerly\s+known\s+as|fka|f/k/a|n[eé]e)[:\s]+([^\n]+)"
METADATA_ID = r"[\(\[]\s*(?:id:?|#)\s*\d+\s*[\)\]]"
HONORIFIC = r"^(?:m/s\.?|shri\.?|sri\.?|dr\.?|mr\.?|mrs\.?)\s+"

# Neither letter, number, underscore nor white space. Combining marks are none of these.
NON_WORD = r"[^\p{L}\p{N}_\s]"

NAME_STOPWORDS = [
    "and", "the", "for", "with", "from", "inc", "corp", "corporation", "ltd", "limited", "pvt", "private", "llc", "llp", "pllc", "co", "company",
    "sarl", "sas", "sasu", "sci", "eurl", "sa", "cie", "fils", "freres", "group", "services", "service", "solutions", "solution", "enterprises",
    "enterprise", "industries", "industry", "trading", "consulting", "india", "france", "usa", "center", "centre", "international", "association",
    "de", "du", "des", "la", "le", "les", "et", "en", "un", "une",
]

ADDRESS_STOPWORDS = [
    "road", "street", "avenue", "boulevard", "drive", "lane", "court", "place", "highway", "square",
    "parkway", "way", "path", "floor", "apartment", "suite", "unit", "number", "building", "house",
    "plot", "survey", "room", "block", "sector", "phase", "society", "near", "opposite", "behind",
    "beside", "north", "south", "east", "west", "central", "new", "old", "city", "state", "town",
    "de", "du", "des", "la", "le", "les", "et", "en", "rue", "allee", "impasse", "chemin", "route",
    "and", "the", "for", "with", "from", "first", "second", "third",
]

ADDRESS_PHRASES = [
    (r"\bnext\s+to\b", " next to "),
    (r"\bin\s+front\s+of\b", " in front of "),
    (r"\badjacent\s+to\b", " adjacent to "),
    (r"\bp\s*\.?\s*o\s*\.?\s*box\b", " po box "),
    (r"\bh\s*\.?\s*no\s*\.?\b", " house number "),
    (r"\bplot\s+no\s*\.?\b", " plot number "),
    (r"\bs\s*\.?\s*no\s*\.?\b", " survey number "),
]
ABBREVIATIONS = {
    "rd": "road", "st": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard",
    "bd": "boulevard", "bvd": "boulevard", "dr": "drive", "hwy": "highway", "ln": "lane",
    "ct": "court", "pkwy": "parkway", "sq": "square", "pl": "place", "rte": "route",
    "all": "allee", "imp": "impasse", "chem": "chemin", "ste": "suite", "apt": "apartment",
    "apts": "apartments", "flr": "floor", "fl": "floor", "1st": "1", "2nd": "2",
    "3rd": "3", "4th": "4", "5th": "5", "bldg": "building", "chs": "society",
    "soc": "society", "sec": "sector", "dist": "district", "no": "number",
    "nr": "near", "nrs": "number", "opp": "opposite",
}

LANDMARK = r"\b(?:near|opp|opposite|behind|beside|next\s+to|in\s+front\s+of|adjacent\s+to|above|below)\b[^,;()]*"
PINCODE_STREET = r"\b(?:street|st|road|rd|avenue|ave|rue|drive|dr|boulevard|blvd|lane|ln|way|court|ct|walk|circle|terrace|pkwy)\b"
CITY_STREET = r"\b(road|street|avenue|rue|drive|lane|boulevard|blvd|court|way|floor|unit|apt|apartment|suite|no|number|building|sector|phase|block)\b"
REGIONS = [
    "al", "ak", "az", "ar", "ca", "co", "ct", "de", "fl", "ga", "hi", "id", "il", "in", "ia", "ks", "ky", "la", "me", "md", "ma", "mi", "mn", "ms", "mo", "mt", "ne", "nv", "nh", "nj", "nm", "ny",
    "nc", "nd", "oh", "ok", "or", "pa", "ri", "sc", "sd", "tn", "tx", "ut", "vt", "va", "wa", "wv", "wi", "wy", "dc",
    "andhra pradesh", "arunachal pradesh", "assam", "bihar", "chhattisgarh", "goa", "gujarat",
    "haryana", "himachal pradesh", "jharkhand", "karnataka", "kerala", "madhya pradesh",
    "maharashtra", "manipur", "meghalaya", "mizoram", "nagaland", "odisha", "orissa", "punjab",
    "rajasthan", "sikkim", "tamil nadu", "telangana", "tripura", "uttar pradesh", "uttarakhand",
    "west bengal", "delhi", "new delhi", "chandigarh", "puducherry", "jammu and kashmir", "ladakh",
    "auvergne-rhone-alpes", "bourgogne-franche-comte", "bretagne", "centre-val de loire",
    "corse", "grand est", "hauts-de-france", "ile-de-france", "normandie", "nouvelle-aquitaine",
    "occitanie", "pays de la loire", "provence-alpes-cote d azur",
]
HOUSE_NUMBER = r"^(?:unit\s+|apt\s+)?(\d+[a-z]?)"

NAME_CAP, NAME_BUCKET = 25, 1500
ADDRESS_CAP, ADDRESS_BUCKET = 25, 500
ADDRESS_WEIGHTS = {"exact": 100, "pincode": 15, "token": 8, "city": 5, "prefix": 4}
RULE_CAP = 20
COSINE_LEAST = 0.38

NAME_FEATURES = ["levenshtein_sim", "token_jaccard", "char_ngram_cos", "token_sort_ratio", "token_set_ratio", "exact_match"]
ADDRESS_FEATURES = [
    "levenshtein_sim", "token_jaccard", "tfidf_cosine", "exact_pincode_match", "exact_city_match", "exact_country_match",
    "exact_address_match", "char_ngram_cos", "token_overlap_count", "address_len_ratio", "digit_overlap_ratio",
    "house_number_match", "landmark_sim",
]
