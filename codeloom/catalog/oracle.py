"""SQL fragments of the comparison engine for the scalar functions."""

from __future__ import annotations

from codeloom.functions.codes import MAJOR_GROUPS, MISSING_CODES
from codeloom.functions.text import ABBREVIATIONS, abbreviation_pattern

MISSING_LIST = ", ".join(f"'{c}'" for c in MISSING_CODES)
MAJOR_LIST = ", ".join(str(g) for g in MAJOR_GROUPS)


def expand(text: str) -> str:
    for short, full in ABBREVIATIONS:
        text = f"regexp_replace({text}, '{abbreviation_pattern(short)}', '{full}', 'g')"
    return text


def norm(text: str) -> str:
    return "coalesce(" + expand(f"trim(regexp_replace(lower({text}), '[^a-z0-9+#/\\-]+', ' ', 'g'))") + ", '')"


def code_number(column: str) -> str:
    return (f"case when {column} is null or isnan({column}) or isinf({column}) then null "
            f"when abs({column} - round_even({column}, 0)) < 1e-8 then cast(cast(round_even({column}, 0) as bigint) as varchar) "
            f"else cast({column} as varchar) end")


def code_text(column: str) -> str:
    return (f"case when trim({column}) = '' then null when regexp_full_match(trim({column}), '\\d+\\.0+') "
            f"then cast(cast(cast(trim({column}) as double) as bigint) as varchar) else trim({column}) end")


def rounded(column: str) -> str:
    return f"round_even({column}, 0)"


def occupation_missing(column: str) -> str:
    return (f"({column} is null or {column} < 100000 or {column} > 999999 "
            f"or floor({rounded(column)} / 10000) not in ({MAJOR_LIST}))")


def occupation_labelled(column: str) -> str:
    return f"coalesce({rounded(column)} between 100000 and 999999, false)"


def code_missing(code: str) -> str:
    return f"({code} is null or {code} in ({MISSING_LIST}))"


def float_text(column: str) -> str:
    """Whole numbers only, which is what the survey's coded columns hold."""
    return f"cast(cast({column} as bigint) as varchar) || '.0'"


def key_part(text: str) -> str:
    return f"coalesce(nullif({norm(text)}, ''), 'MISSING')"
