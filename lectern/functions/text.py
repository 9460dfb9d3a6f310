"""Text expressions: cleaning, hashing, tokenising, tolerant date parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.stopwords import ENGLISH_STOP_WORDS

# Separators and defaults that decide what counts as a token.
LETTERS_ONLY = r"[^a-zA-Z]+"
NON_WORD = r"\W+"
MIN_TOKEN_LENGTH = 2
MARKUP = r"<[^>]+>"

# The characters trimmed from both ends of scoring input, i.e.
# every character Unicode counts as white space.
UNICODE_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_markup(text: Column) -> Column:
    """Replace every ``<...>`` run by one space."""
    return F.regexp_replace(text, MARKUP, " ")


def squash_blanks(text: Column) -> Column:
    """Turn each run of control characters and white space into one space.

    Line breaks, tabs, the other control characters and ``\\s`` all lie in one
    class, so a single scan does the work of three replacements.  A lone space is
    already right, and the pattern leaves it alone.
    """
    return F.regexp_replace(text, r"[\x00-\x1F\x7F][\x00-\x20\x7F]*| [\x00-\x20\x7F]+", " ")


def clean_body(text: Column) -> Column:
    """Lower case, no markup, no control characters, single spaces.

    Only spaces are trimmed, and only before the replacements: a text may keep
    one space at either end.
    """
    return squash_blanks(strip_markup(F.lower(F.trim(text))))


def clean_title(title: Column) -> Column:
    """Lower case, white space collapsed; markup and other controls stay."""
    return F.regexp_replace(F.lower(F.trim(title)), r"[\t\n\x0B\f\r]\s*| \s+", " ")


def is_present(text: Column) -> Column:
    """True for a text that is not null and not made of spaces only."""
    return text.isNotNull() & (F.length(F.trim(text)) > 0)


def strip_ends(text: Column) -> Column:
    """Trim all Unicode white space, not just spaces, from both ends."""
    return F.btrim(text, F.lit(UNICODE_BLANKS))


def clip(text: Column, max_chars: int | None) -> Column:
    """First ``max_chars`` characters; the whole text when it is None."""
    return text if max_chars is None else F.substring(text, 1, max_chars)


def row_key(name: str) -> Column:
    """A key column that fails the job where it is null, rather than lose rows."""
    message = F.lit(f"null in key column {name}; use another key, or none")
    return F.coalesce(F.col(name), F.raise_error(message))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def content_digest(text: Column) -> Column:
    """The content hash as 32 bytes, half of what its digits take in a shuffle."""
    return F.unhex(content_hash(text))


def split_words(text: Column, pattern: str = LETTERS_ONLY) -> Column:
    """Lower-cased pieces between separators, before any token is dropped."""
    return F.split(F.lower(text), pattern)


def is_token(word: Column, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    return F.length(word) >= min_length


def is_stop_word(word: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Membership of a lower-case word in the list, whatever the list's case."""
    return word.isin(*(w.lower() for w in stop_words)) if stop_words else F.lit(False)


def tokenize(text: Column, pattern: str = LETTERS_ONLY, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """Array of tokens, the same ones ``RegexTokenizer`` produces."""
    return F.filter(split_words(text, pattern), lambda w: is_token(w, min_length))


def drop_stop_words(tokens: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Tokens that are no stop word; order and repetitions are kept."""
    return F.filter(tokens, lambda w: ~is_stop_word(F.lower(w), stop_words))


# Date formats, each with the shape of the spellings it reads.
DATE_FORMATS: dict[str, str] = {
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]": r"^\d{4}-\d{2}-\d{2} \d",
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "MMMM d, yyyy": r"^\p{Alpha}{4,} \d",
    "MMM d, yyyy": r"^\p{Alpha}{3} \d",
    "d-MMM-yy": r"^\d{1,2}-\p{Alpha}{3}-\d{2}$",
}


def parse_date(raw: Column, formats: Mapping[str, str] = DATE_FORMATS) -> Column:
    """Date by the first format that fits, null when none does.

    A format is tried only on spellings of its shape: each failed attempt costs
    an exception, many times the price of the match.
    """
    trimmed = F.trim(raw)
    attempts = (
        F.when(trimmed.rlike(shape), F.try_to_timestamp(trimmed, F.lit(fmt)))
        for fmt, shape in formats.items()
    )
    return F.to_date(F.coalesce(*attempts))
