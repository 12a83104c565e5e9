"""Native expressions that match patterns and whole words in a text column.

All of them expect text that is lowercased already, so a log is lowercased once per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from commandwatch.policy import Rule

# Unicode words and blanks; only "\n" ends a line for ".".
REGEX_FLAGS = "(?dU)"
# Rules match without regard to case, whatever case they are written in.
RULE_FLAGS = "(?diuU)"


def pattern_hit(
    text: Column, pattern: str, needs: str | None = None, flags: str = REGEX_FLAGS
) -> Column:
    """True where ``pattern`` occurs in ``text``.

    ``needs`` is a literal that every match contains. Its plain substring test runs first
    and spares most rows the regex.
    """
    hit = text.rlike(flags + pattern)
    return (F.contains(text, F.lit(needs.lower())) & hit) if needs else hit


def rule_hit(text: Column, rule: Rule) -> Column:
    # Only a pattern with capitals needs the slower matching; the text is lowercased.
    flags = RULE_FLAGS if re.search(r"(?<!\\)[A-Z]", rule.search) else REGEX_FLAGS
    return pattern_hit(text, rule.search, rule.needs, flags)


def word_hit(text: Column, word: str) -> Column:
    r"""True where ``word`` occurs in ``text`` as a whole word, as by ``\bword\b``.

    The pattern starts with the word itself, which lets the regex engine skip ahead, and
    looks back for the boundary in front of it.
    """
    escaped = re.escape(word.lower())
    return pattern_hit(text, rf"{escaped}(?<=\b{escaped})\b", word.lower())


def words(text: Column) -> Column:
    """The distinct maximal runs of word characters in ``text``."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(REGEX_FLAGS + r"(\w+)")))
