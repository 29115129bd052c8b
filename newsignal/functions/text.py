"""Text expressions: keys, scoring text, word-boundary patterns, headline lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A word character is a letter, a digit or "_".  The class is spelled out because
# regex engines disagree on whether \b and \w cover accented letters.
WORD = r"\p{L}\p{N}_"
BEFORE = rf"(^|[^{WORD}])"
AFTER = rf"($|[^{WORD}])"
TOKEN = rf"[{WORD}]+"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def dedup_key(url: Column, title: Column, source: Column, published: Column) -> Column:
    """sha256 of the normalised url, or of title+source+time when there is no url.

    A blank url counts as none, so that unrelated articles do not share its key.
    """
    fallback = F.concat(or_empty(title), or_empty(source), or_empty(published))
    basis = F.when(F.length(strip(url)) > 0, strip(url)).otherwise(fallback)
    return F.sha2(F.lower(basis), 256)


def match_text(title: Column, description: Column) -> Column:
    """Title and description side by side; a missing part counts as empty."""
    return F.concat(or_empty(title), F.lit(" "), or_empty(description))


def scoring_text(title: Column, description: Column) -> Column:
    """Text handed to a scorer; falls back to the title, then to "no text"."""
    text = strip(match_text(title, description))
    return F.when(text != "", text).otherwise(F.coalesce(title, F.lit("no text")))


def bounded_pattern(literal: str) -> str:
    """Regex for ``literal`` with no word character on either side."""
    quoted = "".join(c if re.match(r"[\w\s]", c) else "\\" + c for c in literal)
    return BEFORE + quoted + AFTER


def bounded_pattern_of(literal: Column) -> Column:
    """``bounded_pattern`` for a literal held in a column."""
    quoted = F.regexp_replace(literal, rf"([^{WORD}\s])", r"\\$1")
    return F.concat(F.lit(BEFORE), quoted, F.lit(AFTER))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1))


def path_date(path: Column, prefix: str, suffix: str = "") -> Column:
    """The YYYY-MM-DD behind ``prefix`` in a file path; null when there is none."""
    found = F.regexp_extract(path, re.escape(prefix) + r"(\d{4}-\d{2}-\d{2})" + suffix, 1)
    return F.nullif(found, F.lit(""))


def parse_headlines(raw: Column) -> Column:
    """A list written as text becomes an array without blanks; other text one item."""
    parsed = F.from_json(raw, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})
    kept = F.filter(parsed, lambda h: h != "")
    single = F.when(strip(raw) != "", F.array(raw))
    return F.coalesce(kept, single, F.array().cast("array<string>"))
