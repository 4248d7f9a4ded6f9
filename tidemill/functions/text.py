"""Token, snippet and prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates tokens, and what ends a line.
BLANKS = r" \t\n\r\f"
LINE_BREAK = r"\r\n|\r|\n"

# From the first to the last letter of a run of non-blanks: what is left of a word once
# non-letters are stripped from both ends.
_TOKEN = rf"[a-z](?:[^{BLANKS}]*[a-z])?"


def tokenize(text: Column) -> Column:
    """Array of lower-cased tokens without leading and trailing non-letters, none empty."""
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


def has_token(text: Column) -> Column:
    """True where ``tokenize`` gives at least one token."""
    return F.lower(text).rlike("[a-z]")


def first_pieces(text: Column, n: int) -> Column:
    """The first ``n`` blank-separated pieces of the text."""
    pieces = F.array_remove(F.split(text, rf"[{BLANKS}]+"), "")
    return F.array_join(F.slice(pieces, 1, n), " ")


def distinct_tokens(text: Column, max_tokens: int | None = None) -> Column:
    """Distinct tokens of the text, or of its first ``max_tokens`` blank-separated pieces."""
    return F.array_distinct(tokenize(text if max_tokens is None else first_pieces(text, max_tokens)))


def prefix2(term: Column) -> Column:
    """First two characters; only meaningful for terms of two or more."""
    return F.substring(term, 1, 2)


def snippet(line: Column, width: int = 80) -> Column:
    """The line, cut to ``width`` characters plus ``...`` where it is longer."""
    return F.when(
        F.length(line) > width, F.concat(F.substring(line, 1, width), F.lit("..."))
    ).otherwise(line)
