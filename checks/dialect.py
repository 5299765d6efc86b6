"""The scalar rules as DuckDB SQL text."""

from __future__ import annotations

from reclink.functions.text import CASE_ID, DBA_PREFIX, STATES, USA


def clean(x: str) -> str:
    flat = f"replace(regexp_replace({x}, '  +', ' ', 'g'), chr(10), ' ')"
    bare = strip(f"trim(trim({strip(flat)}, '\"'), '''')")
    return f"nullif(regexp_replace({bare}, '^[nN]/[aA]$', ''), '')"


WHITE_CHARS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(133) || chr(160) || chr(8239) || chr(12288)"


def strip(x: str) -> str:
    return f"trim({x}, {WHITE_CHARS})"


def phone(x: str, country: str) -> str:
    digits = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return (
        f"nullif(case when length({digits}) = 10 and ({country} is null or {country} = '{USA}') "
        f"then '1' || {digits} else {digits} end, '')"
    )


def dba(x: str) -> str:
    return f"regexp_replace({x}, '{DBA_PREFIX}', '')"


def state(x: str) -> str:
    whens = " ".join(f"when '{name}' then '{short}'" for name, short in STATES.items())
    return f"case lower({x}) {whens} else {x} end"


STATE_LIST = ", ".join(f"'{s}'" for s in STATES.values())


def country(x: str, state_name: str) -> str:
    return f"case when coalesce({x}, '') = '' and upper({state_name}) in ({STATE_LIST}) then '{USA}' else {x} end"


def title(x: str) -> str:
    runs = "[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+"
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({x}), '{runs}'), "
        "lambda p: case when p[1] = 'ß' then 'Ss' else upper(p[1]) end || p[2:]), '')"
    )


def address(a1, a2, city, state_name, postal, country_name) -> str:
    parts = [f"nullif({p}, '')" for p in (a1, a2, city, state_name, postal, country_name)]
    street = f"nullif(concat_ws(' ', {parts[0]}, {parts[1]}), '')"
    place = f"nullif(concat_ws(', ', {parts[2]}, {parts[3]}), '')"
    return f"concat_ws(' ', nullif(concat_ws(', ', {street}, {place}), ''), {parts[4]}, {parts[5]})"


def slug(x: str) -> str:
    text = x
    for letter, twin in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE")):
        text = f"replace({text}, '{letter}', '{twin}')"
    hyphens = f"regexp_replace(lower(strip_accents({text})), '[^a-z0-9_-]+', '-', 'g')"
    return f"regexp_replace(regexp_replace({hyphens}, '-+$', ''), '^-', '')"


def print_phone(x: str) -> str:
    digits = f"regexp_replace(regexp_replace({x}, '^\\+?1?', ''), '[ ()-]', '', 'g')"
    return (
        f"coalesce(case when length({digits}) = 10 then substr({digits}, 1, 3) || '-' || substr({digits}, 4, 3) || '-' "
        f"|| substr({digits}, 7) else {digits} end, '')"
    )


def ids(x: str) -> str:
    return f"regexp_extract_all({x}, '{CASE_ID}', 1)"


def text_key(*parts: str) -> str:
    marked = ", ".join(f"coalesce('=' || {p}, '~')" for p in parts)
    return f"md5(concat_ws(chr(31), {marked}))"


def day(x: str) -> str:
    return f"cast(cast({x} as date) as varchar)"
