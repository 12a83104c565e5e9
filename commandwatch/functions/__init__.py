"""Column expressions and column steps shared by the operators."""

from commandwatch.functions.staged import add_any, add_first, explode_hits, once
from commandwatch.functions.text import pattern_hit, rule_hit, word_hit, words
from commandwatch.functions.verdict import denial_message, verdict_record

__all__ = [
    "add_any",
    "add_first",
    "denial_message",
    "explode_hits",
    "once",
    "pattern_hit",
    "rule_hit",
    "verdict_record",
    "word_hit",
    "words",
]
