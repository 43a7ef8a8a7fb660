"""String and JSON helpers (ST1-ST5, J1, T2, T3, AR1-AR3) as built-in
Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from risingtide.params import NEWS_SEPARATOR

# ``find("[")`` ... ``rfind("]")``: a greedy match across lines spans the
# first opening bracket to the last closing one.
JSON_ARRAY_PATTERN = r"(?s)(\[.*\])"
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def extract_json_array(reply: Column) -> Column:
    """ST5: the text from the first ``[`` to the last ``]``; NULL when the
    reply has no such span (the reference would fail to parse and retry)."""
    return F.nullif(F.regexp_extract(reply, JSON_ARRAY_PATTERN, 1), F.lit(""))


def parse_json_rows(reply: Column, element_ddl: str) -> Column:
    """``array<struct<...>>`` parsed from a free-text reply; NULL when
    the span from the first to the last bracket is not one JSON array.

    ``from_json`` alone stops at the end of the first value and would take
    ``[..] then [..]`` for its first array; as a field of an object the span
    must be followed by the closing brace, so anything after the array makes
    the whole reply malformed.  Field types are enforced by the schema: a
    value of the wrong JSON type (e.g. the string ``"true"`` for a boolean)
    becomes NULL.  Single quotes and NaN are not JSON."""
    whole = F.concat(F.lit('{"x": '), extract_json_array(reply), F.lit("}"))
    return F.from_json(whole, f"x array<struct<{element_ddl}>>", STRICT_JSON)["x"]


def split_joined(text: Column, sep: str = NEWS_SEPARATOR) -> Column:
    """ST1 + ST2: split a ``sep``-joined string and trim each piece.  The
    separator is matched literally (``***`` is not a valid regex)."""
    return F.transform(F.split(text, literal_pattern(sep)), lambda x: F.trim(x))


def literal_pattern(text: str) -> str:
    """A regular expression that matches ``text`` itself."""
    return "".join(f"[{ch}]" if ch in r"$.|?*+(){}" else "\\" + ch if ch in r"\^[]" else ch for ch in text)


def zip_shortest(a: Column, b: Column, a_name: str = "a", b_name: str = "b") -> Column:
    """AR2: pairs ``(a[i], b[i])`` for i up to the shorter length (Python's
    ``zip``); ``arrays_zip`` alone pads the shorter side with NULL."""
    n = F.least(F.size(a), F.size(b))
    # 1..n, empty for n = 0 (sequence(1, 0) would count down)
    idx = F.filter(F.sequence(F.lit(0), n), lambda i: i > 0)
    return F.transform(idx,
                       lambda i: F.struct(F.element_at(a, i).alias(a_name),
                                          F.element_at(b, i).alias(b_name)))


def label_key(label: Column) -> Column:
    """The comparison key of a label -- case, outer blanks, blanks
    around hyphens and runs of blanks do not distinguish labels."""
    s = F.regexp_replace(F.trim(label), r"\s*-\s*", "-")
    return F.lower(F.regexp_replace(s, r"\s+", " "))


def word_count(text: Column) -> Column:
    """Number of blank-separated words (0 for an empty or blank string)."""
    t = F.trim(text)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"\s+")))
