"""Text statistics as built-in column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Java's \w and \s are ASCII-only, so the classes are spelled out.
# The whitespace beyond Latin-1 sits behind one range test, which letters fail at once.
WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = (
    r"\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0"
    r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
)
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PUNCTUATION_MARK = r"\p{Punct}"
SENTENCE_MARKS = ".!?"

# One match per piece between sentence marks that holds more than whitespace.
SENTENCE_PIECE = f"[^{SENTENCE_MARKS}{SPACE_CHARS}][^{SENTENCE_MARKS}]*+"

# Syllables: vowel groups without a silent final e (after a consonant other than
# l), at least one per word. One match per syllable: either a whole word that has
# no counted vowel group, or a vowel group that is not a silent e.
_VOWELS = "aeiouy"
_NOT_VOWEL = f"[{WORD_CHARS}&&[^{_VOWELS}]]"
_BEFORE_SILENT = f"[{WORD_CHARS}&&[^{_VOWELS}l]]"
_WORD_END = f"(?![{WORD_CHARS}])"
_BARE_WORD = f"(?<![{WORD_CHARS}]){_NOT_VOWEL}*+(?:(?<={_BEFORE_SILENT})e)?(?<=[{WORD_CHARS}]){_WORD_END}"
_GROUP_FROM_E = f"e(?:[{_VOWELS}]++|(?=[{WORD_CHARS}])|(?<!{_BEFORE_SILENT}e))"
SYLLABLE = f"[aiouy][{_VOWELS}]*+|{_GROUP_FROM_E}|{_BARE_WORD}"


def text_or_empty(text: Column) -> Column:
    """A missing text is an empty text."""
    return F.coalesce(text, F.lit(""))


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE_CHARS}]+|[{SPACE_CHARS}]+$", "")


def squeeze_space(text: Column) -> Column:
    """Strip, then turn every run of whitespace into one blank."""
    return F.regexp_replace(strip_space(text), f"[{SPACE_CHARS}]+", " ")


def words(text: Column) -> Column:
    """Lower-case words, in order."""
    # Splitting is about three times as fast as extracting every match.
    return F.array_remove(F.split(F.lower(text), f"[^{WORD_CHARS}]+"), "")


def spaced_tokens(text: Column) -> Column:
    """Whitespace-separated tokens, in order."""
    return F.array_remove(F.split(text, f"[{SPACE_CHARS}]+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient rounded to four decimals, 0.0 where the divisor is zero."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(F.round(top / bottom, 4))


def char_count(text: Column, char: str) -> Column:
    """How often one character occurs in ``text``."""
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def punctuation_frequency(text: Column) -> Column:
    """Punctuation marks per 100 characters."""
    # What is left without the long runs of other characters: no string is made for a mark.
    hits, total = F.length(F.regexp_replace(text, r"[^\p{Punct}]+", "")), F.length(text)
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(hits / total * 100, 4))


def vocab_diversity(text: Column) -> Column:
    """Distinct words over all words."""
    return diversity_of(words(text))


def diversity_of(word_array: Column) -> Column:
    return ratio(F.size(F.array_distinct(word_array)), F.size(word_array))


def sentence_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SENTENCE_PIECE))


def avg_sentence_length(text: Column) -> Column:
    """Words per non-blank piece between sentence marks."""
    return ratio(word_count(text), sentence_count(text))


def syllable_count(text: Column) -> Column:
    return F.regexp_count(F.lower(text), F.lit(SYLLABLE))


def reading_ease_of(n_words: Column, n_sentences: Column, n_syllables: Column) -> Column:
    """Flesch reading ease (1948); text without words scores 0.0."""
    score = (
        F.lit(206.835)
        - F.lit(1.015) * (n_words / n_sentences)
        - F.lit(84.6) * (n_syllables / n_words)
    )
    return F.when((n_words == 0) | (n_sentences == 0), F.lit(0.0)).otherwise(F.round(score, 4))


def flesch_reading_ease(text: Column) -> Column:
    return reading_ease_of(word_count(text), sentence_count(text), syllable_count(text))


def flesch_kincaid_grade(text: Column) -> Column:
    """Flesch-Kincaid grade level (1975); text without words scores 0.0."""
    n_words, n_sentences = word_count(text), sentence_count(text)
    score = (
        F.lit(0.39) * (n_words / n_sentences)
        + F.lit(11.8) * (syllable_count(text) / n_words)
        - F.lit(15.59)
    )
    return F.when((n_words == 0) | (n_sentences == 0), F.lit(0.0)).otherwise(F.round(score, 4))


def html_escape(text: Column) -> Column:
    """Escape the five markup characters, the ampersand first."""
    # Fixed values.
    entities = {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&#x27;"}
    for char, entity in entities.items():
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def token_key(token: Column) -> Column:
    """Lookup key of a token: word characters only, lower case."""
    return F.lower(F.regexp_replace(token, f"[^{WORD_CHARS}]", ""))
