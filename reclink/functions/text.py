"""Cleaning and formatting rules as native column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------------------------------------------------
USA = "UNITED STATES OF AMERICA"
NOT_AVAILABLE = "n/a"
DBA_PREFIX = r"^(DBA|BDA|dba|dba:|d/b/a) "
CASE_ID = r"(H-[0-9\-]+)"

STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO",
    "connecticut": "CT", "delaware": "DE", "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID",
    "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY", "louisiana": "LA",
    "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS",
    "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH", "new jersey": "NJ",
    "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH",
    "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC",
    "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA",
    "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY", "district of columbia": "DC",
    "american samoa": "AS", "guam": "GU", "northern mariana islands": "MP", "puerto rico": "PR",
    "united states minor outlying islands": "UM", "u.s. virgin islands": "VI",
}

# All characters that count as white space.
WHITE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Letters without a canonical decomposition.
PLAIN_LETTERS = {"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ħ": "h", "Ħ": "H", "ı": "i"}
DOUBLE_LETTERS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE"}
# --------------------------------------------------------------------------------------------------------------------

# Plain letters stand first, so that most characters are told by one test.
_WORD_START = r"([^A-Za-z \p{Lu}\p{Ll}\p{Lt}])(?=[A-Za-z\p{Lu}\p{Ll}\p{Lt}])"
_MARK = "\ue000"


def _accent_table() -> tuple[str, str]:
    """Latin letters with an accent and their base letters, from the Unicode decomposition."""
    pairs = dict(PLAIN_LETTERS)
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            pairs[chr(code)] = base
    return "".join(pairs), "".join(pairs.values())


_ACCENTED, _BASE = _accent_table()


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def empty_to_null(value: Column | str) -> Column:
    return F.nullif(as_column(value), F.lit(""))


def strip_space(value: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.btrim(value, F.lit(WHITE))


def clean_string(value: Column | str) -> Column:
    """Collapse spaces, flatten lines, drop outer quotes; empty or not-available text becomes null.

    A column given by its name is looked at first, as most texts hold no two spaces side by side.
    """
    text = F.regexp_replace(as_column(value), " {2,}", " ")
    if isinstance(value, str):
        text = F.when(F.contains(F.col(value), F.lit("  ")), text).otherwise(F.col(value))
    text = strip_space(F.replace(text, F.lit("\n"), F.lit(" ")))
    text = strip_space(F.btrim(F.btrim(text, F.lit('"')), F.lit("'")))
    return empty_to_null(F.regexp_replace(text, f"(?i)^{NOT_AVAILABLE}$", ""))


def clean_phone(value: Column | str, country: Column | str) -> Column:
    """Digits only; a ten-digit number of the USA or of an unknown country gets the prefix 1."""
    digits = empty_to_null(F.regexp_replace(as_column(value), "[^0-9]", ""))
    prefix = F.when(F.coalesce(as_column(country), F.lit(USA)) == USA, F.lit("1$0")).otherwise(F.lit("$0"))
    return F.regexp_replace(digits, F.lit("^[0-9]{10}$"), prefix)


def strip_dba(value: Column | str) -> Column:
    """Remove one leading "doing business as" marker."""
    return F.regexp_replace(as_column(value), DBA_PREFIX, "")


def state_abbrev(value: Column | str) -> Column:
    """Full state or territory name, in any case, to its abbreviation; other text stays as it is."""
    value = as_column(value)
    names = F.str_to_map(F.lit(",".join(f"{name}:{short}" for name, short in STATES.items())))
    return F.coalesce(names[F.lower(value)], value)


def is_state(value: Column | str) -> Column:
    """Whether the text is a known abbreviation, in any case."""
    return F.coalesce(F.find_in_set(F.upper(as_column(value)), F.lit(",".join(STATES.values()))) > 0, F.lit(False))


def default_country(country: Column | str, state: Column | str) -> Column:
    """The USA where no country is given and the state is a known abbreviation."""
    country = as_column(country)
    return F.when((F.coalesce(country, F.lit("")) == "") & is_state(state), F.lit(USA)).otherwise(country)


def title_case(value: Column | str) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest."""
    # initcap starts a word after a space only, so a marked space goes in front of every other word for its sake.
    marked = F.regexp_replace(as_column(value), _WORD_START, f"$1{_MARK} ")
    return F.replace(F.initcap(marked), F.lit(f"{_MARK} "), F.lit(""))


def format_address(address_1, address_2, city, state, postal_code, country) -> Column:
    """One line from the six parts; missing parts leave no separator behind."""
    parts = [empty_to_null(part) for part in (address_1, address_2, city, state, postal_code, country)]
    street = empty_to_null(F.concat_ws(" ", parts[0], parts[1]))
    place = empty_to_null(F.concat_ws(", ", parts[2], parts[3]))
    return F.concat_ws(" ", empty_to_null(F.concat_ws(", ", street, place)), parts[4], parts[5])


def address_is_null(*parts) -> Column:
    return strip_space(format_address(*parts)) == ""


def normalize_address(text: Column | str) -> Column:
    """Match key of an address line."""
    return F.coalesce(title_case(text), F.lit(""))


def address_hash(*parts) -> Column:
    """Fingerprint of the formatted address, to see whether a stored geocode is stale."""
    return F.md5(format_address(*parts))


def slug_lower(value: Column | str) -> Column:
    return F.lower(as_column(value))


def slugify(value: Column | str) -> Column:
    """Accent-free lower-case text with hyphens between words."""
    text = F.translate(as_column(value), _ACCENTED, _BASE)
    for letter, plain in DOUBLE_LETTERS.items():
        text = F.replace(text, F.lit(letter), F.lit(plain))
    text = F.regexp_replace(F.lower(text), r"[^a-z0-9\-_]+", "-")
    return F.regexp_replace(F.regexp_replace(text, r"-+$", ""), "^-", "")


def format_phone(value: Column | str) -> Column:
    """Print form of a phone number; null becomes empty text."""
    digits = F.regexp_replace(F.regexp_replace(as_column(value), r"^\+?1?", ""), "[ ()-]", "")
    return F.coalesce(F.regexp_replace(digits, r"(?s)^(.{3})(.{3})(.{4})$", "$1-$2-$3"), F.lit(""))


def short_country(value: Column | str) -> Column:
    value = as_column(value)
    return F.when(value == USA, F.lit("USA")).otherwise(value)


def visa_class(file_name: Column | str) -> Column:
    """Visa class named by a file; null when it names both or none."""
    name = F.lower(as_column(file_name))
    a, b = name.contains("h-2a"), name.contains("h-2b")
    return F.when(a & ~b, F.lit("H-2A")).when(b & ~a, F.lit("H-2B"))


def extract_ids(link: Column | str) -> Column:
    """All case ids in a link."""
    return F.regexp_extract_all(as_column(link), F.lit(CASE_ID), F.lit(1))


def format_pub_date(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd")


def text_key(*parts: Column) -> Column:
    """One fixed-width key for several nullable texts; null and empty text stay apart."""
    marked = [F.coalesce(F.concat(F.lit("="), part), F.lit("~")) for part in parts]
    return F.md5(F.concat_ws("\x1f", *marked))
