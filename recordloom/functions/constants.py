"""Word lists and tables of the record-linkage rules.

Fixed values: results depend on every entry. All of them stand here, in the order of their use.
"""

#: Null words of free text, after trimming and lower-casing.
NULL_WORDS = ("na", "nan", "none", "null")

#: Legal forms of company names and the token each is folded to.
LEGAL_FORMS = {
    "corporation": "corp", "corp": "corp", "incorporated": "inc", "inc": "inc", "company": "co", "co": "co", "ltd": "ltd", "limited": "ltd",
    "private": "pvt", "pvt": "pvt", "llp": "llp", "llc": "llc", "plc": "plc", "gmbh": "gmbh", "ag": "ag", "bv": "bv", "nv": "nv", "sa": "sa",
    "sas": "sas", "sarl": "sarl", "spa": "spa", "pty": "pty", "sdn": "sdn", "bhd": "bhd", "kft": "kft", "sp": "sp", "zoo": "zoo", "kg": "kg",
    "ohg": "ohg", "pc": "pc", "psc": "psc", "lp": "lp", "lllp": "lllp", "trust": "trust", "trustee": "trust",
}

#: Tokens that the core of a name does without.
CORE_STOP = (
    "corp", "inc", "co", "ltd", "pvt", "llp", "llc", "plc", "gmbh", "ag", "bv", "nv", "sa", "sas", "sarl", "spa", "pty", "sdn", "bhd", "kft", "sp",
    "zoo", "kg", "ohg", "ek", "pc", "psc", "lp", "lllp", "trust", "and", "the", "of", "for", "a", "an", "at", "in", "on",
)

#: Characters of names that decomposition leaves, and what stands for them.
NAME_LETTERS = {"&": " and ", "+": " and ", "@": " at ", "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "'": "", "’": "", "ʼ": ""}

#: Address words and their short forms.
ADDRESS_WORDS = {
    "road": "rd", "street": "st", "avenue": "av", "boulevard": "blvd", "drive": "dr", "lane": "ln", "court": "ct", "square": "sq", "place": "pl",
    "plaza": "plz", "apartment": "apt", "floor": "fl", "building": "bldg", "district": "dist", "section": "sec", "society": "soc", "housing": "hsg",
    "group": "grp", "opposite": "opp", "number": "no", "numbers": "nos", "junction": "jn", "cross": "x", "market": "mkt", "postoffice": "po",
    "apart": "apt", "first": "1st", "second": "2nd", "third": "3rd", "fourth": "4th", "fifth": "5th",
}

#: Words after which a house number may stand.
NUMBER_MARKERS = (
    "no", "nos", "nro", "num", "shop", "shopno", "unit", "flat", "apt", "fl", "floor", "sco", "plot", "house", "hs", "bldg", "block", "blk", "door",
    "stall", "off", "office", "premises", "site", "grd", "ground", "1st", "2nd", "3rd", "4th", "5th", "#",
)

#: Address words that locate nothing.
ADDRESS_NOISE = ("and", "the", "of", "at", "in", "near", "nr", "opposite", "opp", "behind", "beside", "next", "to", "from", "via", "by", "nearby")

#: Country values that count as missing, after normalisation.
MISSING_COUNTRY = ("", "na", "n/a", "nan", "none", "null", "-", "--", "?", "unknown", "unspecified", "not available")

#: In-memory generation: address tokens that do not block.
GENERIC_ADDRESS = (
    "near", "opposite", "behind", "beside", "next", "nearby", "road", "street", "avenue", "lane", "drive", "boulevard", "court", "square", "place",
    "main", "cross", "junction", "nagar", "colony", "sector", "block", "plot", "house", "building", "floor", "flat", "apartment", "shop", "office",
    "premises", "new", "old", "station", "bus", "stand", "market", "temple", "church", "park", "lake", "view", "hill", "garden", "towers", "apart",
    "and", "the", "of", "at", "in", "to", "postoffice", "pincode", "zipcode",
)

#: Indexed generation: tokens that the name index and the address index leave out.
NAME_STOP = (
    "and", "the", "of", "for", "a", "an", "at", "in", "on", "to", "by", "corp", "inc", "co", "ltd", "pvt", "gmbh", "ag", "bv", "nv", "sa", "sas",
    "sarl", "spa", "pty", "sdn", "bhd", "kft", "sp", "zoo", "kg", "ohg", "ek", "pc", "psc", "lp", "lllp", "llp", "llc", "plc", "trust", "trustee",
    "company", "limited", "private", "corporation", "incorporated",
)
ADDRESS_STOP = (
    "and", "the", "of", "at", "in", "to", "near", "nr", "opp", "opposite", "behind", "beside", "next", "from", "via", "by", "nearby", "1st", "2nd",
    "3rd", "rd", "st", "av", "blvd", "dr", "ln", "ct", "sq", "plz", "pl", "apt", "fl", "bldg", "dist", "soc", "hsg", "grp", "jn", "x", "mkt", "po",
    "no", "nos", "nro", "num", "shop", "unit", "sec", "bl", "col",
)

#: Input columns by the headers that stand for them, lower case.
COLUMN_ALIASES = {
    "id": "entity_id", "entityid": "entity_id", "entity_id": "entity_id", "businessid": "entity_id", "business_id": "entity_id",
    "name": "business_name", "businessname": "business_name", "business_name": "business_name", "company_name": "business_name", "companyname": "business_name",
    "address": "business_address", "businessaddress": "business_address", "business_address": "business_address", "addr": "business_address",
    "country_code": "country", "countrycode": "country", "country": "country", "nation": "country",
}
TRUTH_ALIASES = {
    "source1_entity_id": "source1_id", "s1_id": "source1_id", "source_1_id": "source1_id", "entity_id": "source1_id", "source1": "source1_id", "source1_id": "source1_id",
    "matched_entity_ids": "matched_ids", "matched_ids": "matched_ids", "matched_entity_id": "matched_ids", "match_ids": "matched_ids",
    "matches": "matched_ids", "s2_s3_ids": "matched_ids", "s2_s3_id": "matched_ids",
}
TRUTH_LONG = ("source2_id", "source3_id", "target_id", "match_id")
TRUTH_LABELS = ("is_match", "label", "match", "target", "y")
NULL_IDS = ("na", "nan", "none", "[]", "null")

#: Values that count as null when a table is read.
NULL_VALUES = ("", "NA", "N/A", "null", "NULL", "nan", "NaN")

#: Strategy bits of both generations, and the weights that rank the second's.
LEGACY_BITS = {"exact_normalized": 1, "exact_core": 2, "token_name": 4, "tfidf_name": 8, "address_token": 16, "country_aware": 32}
SCALE_BITS = {"exact_normalized": 1, "exact_core": 2, "name_token": 4, "address_token": 8, "sorted_neighbourhood": 16, "country_token": 32}
REPORT_ORDER = ("exact_normalized", "exact_core", "name_token", "sorted_neighbourhood", "address_token", "country_token")
STRATEGY_WEIGHTS = {"exact_normalized": 100.0, "exact_core": 90.0, "name_token": 10.0, "sorted_neighbourhood": 6.0, "address_token": 4.0, "country_token": 1.0}
