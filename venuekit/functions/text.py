"""Text clean-up, tokens and term look-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define what is cut from a review.  The path part
# of a link is possessive because Java matches a greedy group by recursion, which
# overflows the stack on very long links; the text matched is the same.
ASCII_ONLY = r"[^\x01-\x7E]"
LINK = r"https?://(?:www.)?\w+\.\w+(?:/\w+)*+/?"
PUNCTUATION = r"\p{Punct}"
NUMBER = r"\d+"
WORD = r"\w+"


# HTML entities and their characters; the ampersand comes last, so that
# an escaped entity is not read twice.
ENTITIES = {
    "&nbsp;": " ",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&amp;": "&",
}


def without_markup(c: Column) -> Column:
    """Text of an HTML fragment: tags become spaces, entities their characters."""
    c = F.regexp_replace(c, r"<[^>]+>", " ")
    for entity, character in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(character))
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def without_spaces(c: Column) -> Column:
    return F.regexp_replace(c, " ", "")


def strip_chars(c: Column, chars: str) -> Column:
    """Delete every character listed in ``chars``."""
    return F.translate(c, chars, "")


def strip_non_ascii(c: Column) -> Column:
    """Keep the characters 1 to 126."""
    return F.regexp_replace(c, ASCII_ONLY, "")


def remove_features(c: Column) -> Column:
    """Replace links, then punctuation, then digit runs, each with one space."""
    for pattern in (LINK, PUNCTUATION, NUMBER):
        c = F.regexp_replace(c, pattern, " ")
    return c


def tokens(c: Column) -> Column:
    """Lower-case word tokens, as MLlib's ``RegexTokenizer`` gives them."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def without_stopwords(words: Column, stopwords: Sequence[str]) -> Column:
    # A long literal IN list is planned as a hash set, unlike array_contains.
    return F.filter(words, lambda w: ~w.isin(list(stopwords)))


def look_up(indexes: Column, vocabulary: Column) -> Column:
    """Replace each zero-based index by the vocabulary entry; NULL out of range."""
    return F.transform(indexes, lambda i: F.get(vocabulary, i))


def item(c: Column, separator: str, position: int) -> Column:
    """The item at a zero-based position of a split text; NULL where there is none."""
    return F.get(F.split(c, separator), position)


def postcode_area(c: Column) -> Column:
    """The part of a postal code before its first space."""
    return F.substring_index(c, " ", 1)


def clean_words(c: Column, stopwords: Sequence[str]) -> Column:
    """A text's words as one line: lower case, ASCII only, without links, punctuation, digits and stop words.

    The steps go in this order, so that a link is known by its punctuation.
    A NULL text gives NULL, and one without such words an empty line.
    """
    plain = remove_features(strip_non_ascii(F.lower(c)))
    return F.array_join(without_stopwords(tokens(plain), stopwords), " ")
