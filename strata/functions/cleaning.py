"""Value clean-up used between layers: rules, flags, lists, casts, ratios."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of three cities, tried in this order on lower-case text.
CITY_RULES = [
    ("like", "%edmont%", "Edmonton"),
    ("rlike", r"st[\s\.]*alb|saint alb|staint alb", "St. Albert"),
    ("rlike", r"sherwood park|sherwood", "Sherwood Park"),
]


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_by_rules(col: str | Column, rules: Sequence[tuple[str, str, str]] = CITY_RULES) -> Column:
    """First matching rule wins; no match keeps the original; null stays null."""
    original, text = _c(col), F.lower(_c(col))
    tests = {"like": text.like, "rlike": text.rlike}
    out = None
    for kind, pattern, value in rules:
        hit = tests[kind](pattern)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return original if out is None else out.otherwise(original)


def try_bool(col: str | Column) -> Column:
    """Tolerant flag: 'True' -> true, 'None' or any other text -> null."""
    return _c(col).try_cast("boolean")


def unquote_flag(col: str | Column, yes: str, no: str) -> Column:
    """Tri-state flag from a quoted literal such as ``u'free'``.

    The characters ``u`` and ``'`` are deleted wherever they stand, so the
    values to compare with must be given without the letter u as well.
    """
    bare = F.translate(_c(col), "u'", "")
    return F.when(bare == yes, True).when(bare == no, False)


def split_list(col: str | Column, sep: str = r",\s*") -> Column:
    """Delimited text to an array; blank text gives null, not ``['']``."""
    text = F.trim(_c(col))
    return F.when(text != "", F.split(text, sep))


def list_count(col: str | Column, sep: str = r",\s*") -> Column:
    """Number of list entries, 0 for blank or null text."""
    return F.coalesce(F.size(split_list(col, sep)), F.lit(0))


def array_count(col: str | Column) -> Column:
    """Array size with 0 for null."""
    return F.coalesce(F.size(_c(col)), F.lit(0))


def at_least(col: str | Column, threshold: float) -> Column:
    """Threshold flag; null counts as not reached."""
    return F.coalesce(_c(col) >= threshold, F.lit(False))


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """``a / b`` where b is positive, else null."""
    return F.when(_c(b) > 0, _c(a) / _c(b))


def percent_to_fraction(col: str | Column) -> Column:
    """Whole-number percent text to decimal(16,6)."""
    return (_c(col).try_cast("decimal(10,0)") / 100).cast("decimal(16,6)")


def cast_layout(types: Mapping[str, str]) -> dict[str, Column]:
    """Tolerant casts at a layer change, for ``withColumns``: what does not fit
    becomes null instead of failing the job."""
    return {name: F.col(name).try_cast(dtype) for name, dtype in types.items()}


def to_ts(col: str | Column, fmt: str | None = None) -> Column:
    """Timestamp from text; null when it does not parse."""
    return F.try_to_timestamp(_c(col), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(col))


def to_day(col: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return to_ts(col, fmt).cast("date")


def render_text(fmt: str, *cols: Column) -> Column:
    """One sentence per row with formatted dates and numbers."""
    return F.format_string(fmt, *cols)


def first_words(col: str | Column, n: int) -> Column:
    """The first n words of a text, joined by single blanks."""
    return F.array_join(F.slice(F.split(F.trim(_c(col)), r"\s+"), 1, n), " ")


def join_elements(parsed: str | Column, separator: str = "\n\n") -> Column:
    """Text of a parsed document (JSON text), null when the parse reported an error.

    Elements without content are left out.
    """
    v = F.try_parse_json(_c(parsed))
    texts = F.transform(
        F.try_variant_get(v, "$.document.elements", "array<variant>"),
        lambda e: F.try_variant_get(e, "$.content", "string"),
    )
    failed = F.try_variant_get(v, "$.error_status", "string").isNotNull()
    return F.when(~failed & texts.isNotNull(), F.array_join(F.array_compact(texts), separator))


def extract_fields(doc: str | Column, fields: Mapping[str, str]) -> dict[str, Column]:
    """Typed columns out of a JSON text or variant column, for ``withColumns``."""
    c = _c(doc)
    return {name: F.try_variant_get(F.try_parse_json(c), f"$.{name}", dtype) for name, dtype in fields.items()}
