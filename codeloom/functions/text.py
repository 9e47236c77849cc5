"""Text normalisation and document assembly as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.functions.probability import bind

# Abbreviations and their expansions, applied in this order as whole words.
ABBREVIATIONS = (
    ("asst", "assistant"),
    ("mgr", "manager"),
    ("mgmt", "management"),
    ("svcs", "services"),
    ("svc", "service"),
    ("tech", "technician"),
    ("admin", "administrative"),
    ("dept", "department"),
    ("supv", "supervisor"),
    ("supvr", "supervisor"),
    ("maint", "maintenance"),
    ("dir", "director"),
    ("exec", "executive"),
    ("ceo", "chief executive officer"),
    ("cfo", "chief financial officer"),
    ("coo", "chief operating officer"),
    ("rn", "registered nurse"),
    ("lpn", "licensed practical nurse"),
    ("lvn", "licensed vocational nurse"),
    ("cna", "certified nursing assistant"),
    ("emt", "emergency medical technician"),
    ("cdl", "commercial drivers license"),
    ("a+", "a plus"),
)

KEPT_CHARACTER = r"[a-z0-9+#/\-]"

EMPTY_DOC = "__EMPTY__"
FIELD_SEPARATOR = " | "


def abbreviation_pattern(short: str) -> str:
    return r"\b" + short.replace("+", r"\+") + r"\b"


ANY_ABBREVIATION = r"\b(?:" + "|".join(short for short, _ in ABBREVIATIONS if short != "a+") + r")\b|\ba\+\b"


WORD_EXPANSIONS = ",".join(f"{short}:{full}" for short, full in ABBREVIATIONS if short != "a+")
PLUS_PATTERN = abbreviation_pattern("a+")


def expand_abbreviations(text: Column) -> Column:
    """Rewrite whole-word abbreviations; texts without any are passed through.

    No expansion contains another abbreviation, so one pass over the words gives what the ordered rewrites
    give. ``a+`` is not a word: it is rewritten where a word follows it directly.
    """
    table = F.str_to_map(F.lit(WORD_EXPANSIONS), F.lit(","), F.lit(":"))
    tokens = F.regexp_extract_all(text, F.lit(r"\w+|\W+"), F.lit(0))
    expanded = F.array_join(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(table, t), t)), "")
    return F.when(text.rlike(ANY_ABBREVIATION), F.regexp_replace(expanded, PLUS_PATTERN, "a plus")).otherwise(text)


def normalize_text(text: Column) -> Column:
    """Lower-case, keep ``a-z 0-9 + # / -``, squeeze the rest to single spaces, expand abbreviations."""
    squeezed = F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9+#/\-]+", " "))
    return F.coalesce(bind(squeezed, expand_abbreviations), F.lit(""))


def float_text(value: Column) -> Column:
    """A double printed the way survey exports print it: ``561110.0``, plain digits up to 1e16."""
    magnitude = F.abs(value)
    java = value.cast("string")
    whole = F.concat(F.rint(value).cast("decimal(20,0)").cast("string"), F.lit(".0"))
    plain = F.regexp_replace(java.cast("decimal(38,18)").cast("string"), "0+$", "")
    exponent = F.regexp_extract(java, r"E-?(\d+)$", 1)
    scientific = F.concat(
        F.regexp_replace(F.regexp_extract(java, r"^(-?[\d.]+)E", 1), r"\.0$", ""),
        F.when(java.contains("E-"), F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(exponent, 2, "0"),
    )
    return (
        F.when(F.isnan(value), F.lit(None).cast("string"))
        .when(magnitude == float("inf"), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when((magnitude < 1e16) & (value == F.rint(value)), whole)
        .when((magnitude >= 1e16) | (magnitude < 1e-4), scientific)
        .when(java.contains("E"), plain)
        .otherwise(java)
    )


def raw_text(df: DataFrame, name: str) -> Column:
    """A column as text, by its type; an absent column is null."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    kind = df.schema[name].dataType.typeName()
    if kind in ("double", "float"):
        return bind(F.col(name).cast("double"), float_text)
    return F.col(name).cast("string")


def normalized(df: DataFrame, name: str) -> Column:
    return normalize_text(raw_text(df, name))


def text_present(df: DataFrame, names: Sequence[str]) -> Column:
    """True when any of the columns holds text after normalisation."""
    present = F.lit(False)
    for name in names:
        if name in df.columns:
            present = present | F.coalesce(F.lower(raw_text(df, name)).rlike(KEPT_CHARACTER), F.lit(False))
    return present


def with_lead(text: Column, lead: str) -> Column:
    """Text after a fixed lead; null when there is no text."""
    return bind(text, lambda t: F.when(t != "", F.concat(F.lit(lead), t)))


def build_document(df: DataFrame, names: Sequence[str], prefixes: Mapping[str, str]) -> Column:
    """Prefixed, normalised fields joined with `` | ``; ``__EMPTY__`` when no field has text."""
    parts = []
    for name in names:
        if name not in df.columns:
            continue
        prefix = prefixes.get(name, "")
        lead = f"{prefix} " if prefix else ""
        parts.append(with_lead(normalized(df, name), lead))
    if not parts:
        return F.lit(EMPTY_DOC)
    return bind(F.concat_ws(FIELD_SEPARATOR, *parts), lambda doc: F.when(doc == "", F.lit(EMPTY_DOC)).otherwise(doc))


def review_context(df: DataFrame, names: Sequence[str], max_chars: int | None = None) -> Column:
    """``column: text`` lines for a reviewer, cut to ``max_chars`` characters where a limit is given."""
    parts = [
        with_lead(normalized(df, name), f"{name}: ")
        for name in names if name in df.columns
    ]
    if not parts:
        return F.lit("")
    context = F.concat_ws("\n", *parts)
    return context if max_chars is None else F.substring(context, 1, max_chars)
