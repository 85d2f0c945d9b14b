"""Text cleaning and extraction as native Column expressions.

Java's ``\\w``, ``\\d`` and ``\\s`` know ASCII only, so the Unicode classes are spelled out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatterscope.functions import words

WORDS = "array<string>"
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"

# The white space of SPACE, character by character.
SPACE_CHARACTERS = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

URL = rf"(?:http|www)[^{SPACE}]+"
# A mention goes as a whole, any other character that is neither a letter, a
# non-decimal number, an underscore nor white space goes alone. The lookahead passes
# over the common characters before the costly class is tried.
NOISE_UNICODE = rf"(?![a-zA-Z ])(?:@[{WORD}]*|[^\p{{L}}\p{{Nl}}\p{{No}}_{SPACE}@]+)"
NOISE_ASCII = rf"(?![a-zA-Z ])(?:@[{WORD}]*|[^A-Za-z_\t-\r\x1c-\x1f @]+)"
# Runs of white space, but for a single blank before a letter, which may stay.
SPACE_RUNS = rf"(?! ?[a-z])[{SPACE}]+"


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def strip(c: Column) -> Column:
    """Trim every kind of white space; by default Spark trims U+0020 only."""
    return F.btrim(c, F.lit(SPACE_CHARACTERS))


def is_blank(c: Column) -> Column:
    return F.coalesce(~c.rlike(rf"[^{SPACE}]"), F.lit(True))


def _lowered(c: Column, ascii_only: bool) -> Column:
    """The text without URLs, mentions, signs and digits, in lower case."""
    # Looking for the two prefixes is far cheaper than running the pattern on every text.
    no_urls = F.when(
        c.contains("http") | c.contains("www"), F.regexp_replace(c, URL, "")
    ).otherwise(c)
    kept = F.regexp_replace(no_urls, NOISE_ASCII if ascii_only else NOISE_UNICODE, "")
    return F.lower(kept)


def clean_text(c: Column, ascii_only: bool = False) -> Column:
    """Drop URLs, mentions, signs and digits, lower-case, collapse white space; null gives ''."""
    collapsed = F.regexp_replace(_lowered(c, ascii_only), SPACE_RUNS, " ")
    return F.coalesce(F.btrim(collapsed), F.lit(""))


def clean_words(c: Column, ascii_only: bool = False) -> Column:
    """``clean_tokens(clean_text(c))``, cleaned and split by Arrow batches."""
    return words.column(words.clean, WORDS, c, ascii_only)


def _names_after(c: Column, sign: str) -> Column:
    found = F.regexp_extract_all(c, F.lit(f"{sign}([{WORD}]+)"), F.lit(1))
    return F.coalesce(found, empty_strings())


def extract_hashtags(c: Column) -> Column:
    return _names_after(c, "#")


def extract_mentions(c: Column) -> Column:
    return _names_after(c, "@")


def repost_target(c: Column) -> Column:
    """User named by a leading ``RT @user``, else null."""
    name = F.regexp_extract(c, f"RT @([{WORD}]+)", 1)
    return F.when(c.startswith("RT @") & (name != ""), name)


def space_tokens(c: Column) -> Column:
    """Split on one space, keeping empty tokens."""
    return F.split(c, " ")


def word_tokens(c: Column) -> Column:
    """Lower-case and split on runs of white space."""
    found = F.filter(F.split(F.lower(c), f"[{SPACE}]+"), lambda w: w != "")
    return F.coalesce(found, empty_strings())


def clean_tokens(cleaned: Column) -> Column:
    """Tokens of an already cleaned text, where one space separates words."""
    return words.column(words.split, WORDS, cleaned)


def without(tokens: Column, stopwords: Sequence[str]) -> Column:
    """Drop stop words, keeping order and repeats."""
    if not stopwords:
        return tokens
    return words.column(words.without, WORDS, tokens, list(stopwords))


def remove_stopwords(cleaned: Column, stopwords: Sequence[str]) -> Column:
    return F.array_join(without(clean_tokens(cleaned), stopwords), " ")


def alphabetic_tokens(tokens: Column, stopwords: Sequence[str]) -> Column:
    """Of the words of a cleaned text those made of letters only, stop words left out."""
    return words.column(words.alphabetic, WORDS, tokens, list(stopwords))


def replaced(tokens: Column, entries: words.Entries) -> Column:
    """Each token's entry, or the token itself where it has none."""
    return words.column(words.replaced, WORDS, tokens, entries)


def content_type(c: Column) -> Column:
    return (
        F.when(c.isNull(), "Other")
        .when(c.contains("http") | c.contains("www"), "Links")
        .when(c.contains("#"), "Hashtags")
        .when(c.contains("@"), "Mentions")
        .when(F.length(c) > 140, "Long Text")
        .otherwise("Short Text")
    )


def one_line(c: Column) -> Column:
    """Replace line breaks by a space, so that one text makes one line."""
    return F.regexp_replace(c, r"\r\n|[\r\n]", " ")
