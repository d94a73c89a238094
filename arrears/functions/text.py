"""Text expressions: trimming, normalisation, terms, keyword categories."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

from arrears import contracts as K

#: Every character that counts as white space, not just the blank.
_BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]+"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_BLANKS}|{_BLANKS}$", "")


def client_name(c: Column) -> Column:
    """Trimmed upper-case name, so that variants of one client collapse."""
    return F.upper(strip(c))


@lru_cache(maxsize=1)
def _accented_letters() -> tuple[str, str]:
    """Characters whose canonical decomposition is one A-Z letter plus marks.

    Derived from the Unicode database by rule; letters such as Ø or Ł do not
    decompose and are left out on purpose.
    """
    accented, plain = [], []
    for code in range(0x80, 0x20000):
        char = chr(code)
        base = "".join(
            p for p in unicodedata.normalize("NFD", char) if unicodedata.category(p) != "Mn"
        )
        if base != char and len(base) == 1 and "A" <= base <= "Z":
            accented.append(char)
            plain.append(base)
    return "".join(accented), "".join(plain)


def normalize(c: Column) -> Column:
    """Upper case, accents folded, only A-Z, 0-9 and single blanks left.

    Works on the whole text with built-in expressions only.  A missing text
    reads ``NONE``.
    """
    accented, plain = _accented_letters()
    upper = F.upper(F.coalesce(c, F.lit("None")))
    folded = F.translate(F.regexp_replace(upper, r"\p{Mn}+", ""), accented, plain)
    return F.trim(F.regexp_replace(folded, "[^A-Z0-9]+", " "))


def unigrams(normalized: Column) -> Column:
    """Tokens of a normalised text, single characters included."""
    return F.regexp_extract_all(normalized, F.lit("([A-Z0-9]+)"), 1)


def bigrams(tokens: Column) -> Column:
    """Adjacent token pairs, empty for fewer than two tokens."""
    last = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), last),
        F.slice(tokens, F.lit(2), last),
        lambda left, right: F.concat_ws(" ", left, right),
    )


def keyword_category(
    c: Column, rules: dict[str, list[str]] = K.KEYWORD_RULES, default: str = K.OTHER
) -> Column:
    """First category, in rule order, with a keyword inside the upper-case text.

    Keywords are plain substrings, not patterns.
    """
    text = F.upper(F.coalesce(c, F.lit("nan")))
    chosen = None
    for category, words in rules.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(text, F.lit(word))
        chosen = F.when(hit, category) if chosen is None else chosen.when(hit, category)
    return F.lit(default) if chosen is None else chosen.otherwise(default)
