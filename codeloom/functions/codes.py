"""Classification codes: cleaning, display, grouping and missing tests as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.functions.probability import bind
from codeloom.functions.text import float_text, normalize_text

# Code texts that mean "no answer".
MISSING_CODES = ("", "0", "00", "000", "0000", "00000", "000000", "999", "9999", "99999", "999999")

# The two-digit major groups of the occupation classification.
MAJOR_GROUPS = (11, 13, 15, 17, 19, 21, 23, 25, 27, 29, 31, 33, 35, 37, 39, 41, 43, 45, 47, 49, 51, 53, 55)

MISSING = "MISSING"

# The characters that Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

FRACTIONAL_TYPES = ("double", "float", "decimal")
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def clean_code(value: Column, kind: str = "string") -> Column:
    """A code as text: whole numbers without ``.0``, blanks and non-finite numbers as null."""
    if kind in FRACTIONAL_TYPES:
        number = value.cast("double")
        whole = F.rint(number)
        return (
            F.when(number.isNull() | F.isnan(number) | (F.abs(number) == float("inf")), F.lit(None).cast("string"))
            .when(F.abs(number - whole) < 1e-8, whole.try_cast("decimal(38,0)").cast("string"))
            .otherwise(bind(number, float_text))
        )
    if kind != "string":
        return value.cast("string")
    text = F.btrim(value, F.lit(WHITESPACE))
    as_whole = text.try_cast("double").try_cast("decimal(38,0)").cast("string")
    return (
        F.when(F.length(text) == 0, F.lit(None).cast("string"))
        .when(text.rlike(r"^\d+\.0+$"), F.coalesce(as_whole, text))
        .otherwise(text)
    )


def code_of(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("string")
    return clean_code(F.col(name), df.schema[name].dataType.typeName())


def code_or_missing(df: DataFrame, name: str) -> Column:
    return F.coalesce(code_of(df, name), F.lit(MISSING))


def numeric(value: Column, kind: str = "string") -> Column:
    """Number or null. Java's float suffixes (``12d``) and hex floats do not count as numbers."""
    if kind in ("string",):
        text = F.btrim(value, F.lit(WHITESPACE))
        return F.when(text.rlike(NUMBER), text.try_cast("double"))
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def number_of(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("double")
    return numeric(F.col(name), df.schema[name].dataType.typeName())


def major_group(number: Column) -> Column:
    """First two digits of a six-digit code, null outside 100000..999999. Rounds half to even."""
    rounded = F.rint(number)
    return F.when(rounded.between(100000, 999999), F.floor(rounded / 10000).cast("int"))


def six_digits(number: Column) -> Column:
    """Zero-padded display of an occupation code; other numbers as they are, null as MISSING."""
    rounded = F.rint(number)
    return (
        F.when(number.isNull() | F.isnan(number), F.lit(MISSING))
        .when(rounded.between(0, 999999), F.lpad(rounded.cast("int").cast("string"), 6, "0"))
        .otherwise(float_text(number))
    )


def occupation_missing(number: Column, listed: Sequence[int] = ()) -> Column:
    """No usable occupation code. The range is tested before rounding, the group after it."""
    group = F.floor(F.rint(number) / 10000)
    missing = number.isNull() | (number < 100000) | (number > 999999) | ~group.isin(*MAJOR_GROUPS)
    if listed:
        missing = missing | number.isin(*[float(v) for v in listed])
    return F.coalesce(missing, F.lit(True))


def occupation_labelled(number: Column, listed: Sequence[int] = ()) -> Column:
    """Usable as a training label: range tested after rounding."""
    rounded = F.rint(number)
    keep = rounded.between(100000, 999999)
    if listed:
        keep = keep & ~rounded.isin(*[float(v) for v in listed])
    return F.coalesce(keep, F.lit(False))


def code_missing(code: Column, listed: Sequence[str] = ()) -> Column:
    """A cleaned code that is null, a no-answer code, or listed as missing."""
    return bind(code, lambda c: c.isNull() | c.isin(*MISSING_CODES, *listed))


def text_key(text: Column) -> Column:
    """A text as a key part: normalised, MISSING when nothing is left."""
    return bind(normalize_text(text), lambda t: F.when(t == "", F.lit(MISSING)).otherwise(t))


def key_part(df: DataFrame, name: str) -> Column:
    """One part of a dictionary key: text columns are normalised, others code-cleaned."""
    if name not in df.columns:
        return F.lit(MISSING)
    if df.schema[name].dataType.typeName() == "string":
        return text_key(F.col(name))
    return code_or_missing(df, name)


def join_key(parts: Sequence[Column]) -> Column:
    """Key parts joined with ``||``; null when every part is MISSING."""
    blank = "||".join([MISSING] * len(parts))
    return bind(F.concat_ws("||", *parts), lambda key: F.when(key != blank, key))


def composite_key(df: DataFrame, names: Sequence[str]) -> Column:
    return join_key([key_part(df, name) for name in names])
