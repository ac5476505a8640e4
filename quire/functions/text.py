"""Text predicates and snippets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separator controls that Python's strip() also removes.
_BLANK = r"\s\x1c-\x1f"

SNIPPET_CHARS = 300
SNIPPET_LEAD = 120
PAGE_BREAK = "\f"


def is_nonblank(text: Column) -> Column:
    """True when anything is left after stripping Unicode white space (NULL counts as blank)."""
    return F.coalesce(text.rlike(f"(?U)[^{_BLANK}]"), F.lit(False))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^[{_BLANK}]+|[{_BLANK}]+$", "")


def squeeze(text: Column) -> Column:
    """Every run of white space becomes one blank; none at the ends."""
    return F.trim(F.regexp_replace(text, f"(?U)[{_BLANK}]+", " "))


def contains_term(text: Column, term: str | None) -> Column:
    """Case-insensitive LIKE with the term in the middle.

    ``%`` and ``_`` in the term stay wildcards. A backslash is an ordinary character, so
    it is doubled for Spark, whose LIKE would take it as the escape sign.
    """
    if term is None:
        return F.lit(None).cast("boolean")
    return text.ilike("%" + term.replace("\\", "\\\\") + "%")


def snippet_around(text: Column, term: str | None) -> Column:
    """300 characters starting 120 before the first hit (from the start if not found literally)."""
    needle = F.lower(F.lit(term).cast("string"))
    start = F.greatest(F.lit(1), F.instr(F.lower(text), needle) - SNIPPET_LEAD)
    return F.substr(text, start, F.lit(SNIPPET_CHARS))


def snippet_head(text: Column) -> Column:
    return F.substring(text, 1, SNIPPET_CHARS)


def fixed_size_pages(text: Column, chars: int) -> Column:
    """The text cut into pieces of ``chars`` characters, in one linear pass.

    A substring per piece would walk the text from its start for each piece.
    """
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chars}}}"), F.lit(0))


def page_break_pages(text: Column) -> Column:
    return F.split(text, PAGE_BREAK, -1)
