"""Column expressions over text: tokens, digit ratio, content type, paths, formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------
#: A token is a run of letters and numbers of any script.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"

#: Digits by the Unicode property Numeric_Type (Decimal or Digit): the decimal
#: digits \p{Nd} and these further characters (superscripts, circled digits, ...).
OTHER_DIGITS = (
    r"\x{B2}-\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}"
    r"\x{24EA}\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}"
    r"\x{278A}-\x{2792}\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}"
    r"\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
#: What counts as numeric in a passage: digits and the signs $ % ,
NON_NUMERIC_PATTERN = r"[^\p{Nd}" + OTHER_DIGITS + r"$%,]+"
#: The same for text of ASCII characters alone, which is far cheaper to match.
NON_NUMERIC_ASCII = r"[^0-9$%,]+"

#: Substrings that mark a passage as a table.
TABLE_MARKS = ("|", "\t", "  ")
#: Above this share of numeric characters a passage counts as a table.
TABLE_RATIO = 0.1
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    """Lower-cased tokens of a text, in order; an empty array for a null text."""
    lowered = F.lower(F.coalesce(_col(text), F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(TOKEN_PATTERN), F.lit(0))


def token_count(text: Column | str) -> Column:
    lowered = F.lower(F.coalesce(_col(text), F.lit("")))
    return F.regexp_count(lowered, F.lit(TOKEN_PATTERN)).cast("bigint")


def numeric_ratio(text: Column | str) -> Column:
    """Share of characters that are digits or one of ``$ % ,``; 0 for empty text."""
    t = _col(text)
    ascii_only = F.octet_length(t) == F.length(t)
    kept = F.when(
        ascii_only, F.length(F.regexp_replace(t, NON_NUMERIC_ASCII, ""))
    ).otherwise(F.length(F.regexp_replace(t, NON_NUMERIC_PATTERN, "")))
    return F.when(F.length(t) > 0, kept.cast("double") / F.length(t)).otherwise(F.lit(0.0))


def is_table_like(text: Column | str, ratio: Column | None = None) -> Column:
    t = _col(text)
    ratio = numeric_ratio(t) if ratio is None else ratio
    marks = reduce(lambda a, b: a | b, [F.contains(t, F.lit(m)) for m in TABLE_MARKS])
    return F.coalesce(marks | (ratio > TABLE_RATIO), F.lit(False))


def detected_type(text: Column | str, ratio: Column | None = None) -> Column:
    return F.when(is_table_like(text, ratio), F.lit("table")).otherwise(F.lit("narrative"))


def type_weight(content_type: Column | str, narrative_weight: float, table_weight: float) -> Column:
    return F.when(_col(content_type) == "table", F.lit(float(table_weight))).otherwise(
        F.lit(float(narrative_weight))
    )


def effective_type(content_type: Column | str, detected: Column | str) -> Column:
    """The row's own type, else the detected one, else ``unknown``."""
    return F.coalesce(_col(content_type), _col(detected), F.lit("unknown"))


def last_segment(path: Column | str, separator: str = "/") -> Column:
    return F.element_at(F.split(_col(path), separator), -1)


def has_extension(name: Column | str, extension: str) -> Column:
    """Whether a name ends with the extension, in any letter case."""
    return F.endswith(F.lower(_col(name)), F.lit(extension.lower()))


def trailing_number(ref: Column | str) -> Column:
    """Integer after the last slash of a reference; null when there is none."""
    return last_segment(ref).try_cast("bigint")


def trim_trailing_slash(url: Column | str) -> Column:
    return F.regexp_replace(_col(url), "/+$", "")


def fixed_decimals(value: Column | str, places: int) -> Column:
    """Text of a number with a fixed count of decimals (missing counts as 0)."""
    number = F.coalesce(_col(value).cast("double"), F.lit(0.0))
    return F.round(number, places).cast(f"decimal(20,{places})").cast("string")


def join_headings(headings: Column | str, separator: str = ", ") -> Column:
    """Headings as one string; an empty string when there are none."""
    return F.coalesce(F.array_join(_col(headings), separator), F.lit(""))


def contextualize(headings: Column | str, text: Column | str) -> Column:
    """Headings, one per line, above the text."""
    lines = F.array_join(_col(headings), "\n")
    return F.concat_ws("\n", F.when(F.size(_col(headings)) > 0, lines), _col(text))


def fill_template(template: str, context: Column | str, question: Column | str) -> Column:
    """Put context and question into a template.

    The template is cut at its placeholders first, so a placeholder that occurs
    inside the inserted text stays as it is. A null context or question is empty.
    """
    check_template(template)
    parts: list[Column] = []
    rest = template
    while rest:
        hits = [(rest.find(m), m) for m in ("{context}", "{question}") if m in rest]
        if not hits:
            parts.append(F.lit(rest))
            break
        at, mark = min(hits)
        if at:
            parts.append(F.lit(rest[:at]))
        value = _col(context) if mark == "{context}" else _col(question)
        parts.append(F.coalesce(value, F.lit("")))
        rest = rest[at + len(mark):]
    return F.concat(*parts)


def check_template(template: str) -> None:
    missing = [m for m in ("{context}", "{question}") if m not in template]
    if missing:
        raise ValueError(f"the template lacks the placeholders {missing}")


def merge_maps(first: Column | str, second: Column | str) -> Column:
    """Union of two maps where the second one wins on equal keys."""
    a, b = _col(first), _col(second)
    kept = F.map_filter(a, lambda k, _v: ~F.map_contains_key(b, k))
    return F.when(b.isNull(), a).when(a.isNull(), b).otherwise(F.map_concat(kept, b))


def error_excerpt(message: Column | str, limit: int = 100) -> Column:
    """The shown part of an error message."""
    return F.substring(_col(message), 1, limit)
