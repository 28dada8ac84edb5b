"""Column expressions over text and over arrays of terms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A token is a run of [\w-] (ASCII) made of three or more letters;
# the unicode mode takes letters of any script and separates on anything else.
TOKEN_PATTERNS = {
    "ascii": r"(?<![\w-])[A-Za-z]{3,}+(?![\w-])",
    "unicode": r"(?<![\p{L}-])\p{L}{3,}+(?![\p{L}-])",
}

# The plural rules of Harman's S-stemmer (1991), in order.
ENGLISH_PLURAL_RULES = [
    (r"(?<=[a-z&&[^ea]])ies\b", "y"),
    (r"(?<=[a-z&&[^aeo]])es\b", "e"),
    (r"(?<=[a-z&&[^us]])s\b", ""),
]


def tokenize(text: Column | str, mode: str = "ascii") -> Column:
    """Lower-case letter tokens of more than two characters, in text order.

    Equals splitting on every other character, lower-casing and dropping tokens
    that are short or hold digits, hyphens or underscores, but in one regex pass
    that never creates the dropped tokens.
    """
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN_PATTERNS[mode]), F.lit(0)), F.lower)


def singular_english(terms: Column | str) -> Column:
    """Apply a light English plural rule to every term of an array.

    An approximation of stemming. Each rule runs once over the joined terms of a
    document instead of once per term.
    """
    terms = F.col(terms) if isinstance(terms, str) else terms
    joined = F.array_join(terms, " ")
    for pattern, replacement in ENGLISH_PLURAL_RULES:
        joined = F.regexp_replace(joined, pattern, replacement)
    return F.when(F.size(terms) == 0, terms).otherwise(F.split(joined, " "))


def non_word_to_space(text: Column | str) -> Column:
    return F.regexp_replace(text, r"\W", " ")
