"""Word tokens, stop words, punctuation and bigrams as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewscope.functions.wordlists import ENGLISH_STOP_WORDS, PUNCTUATION

_MARKS = r""";@#$%&?!\[\](){}<>\""""
_SPACE = r"[\s\p{Z}]"
_CLOSING = r"[\])}>\"']*"


def _breaks(final: str) -> str:
    """Places where English word tokens break apart without white space.

    Each match becomes a token of its own (or the left half of a glued word), so
    one pass that puts blanks around the matches and one split give all tokens.
    ``final`` says what follows a final period. No group repeats without bound,
    so one very long word cannot exhaust the stack.
    """
    word_end = rf"(?={_SPACE}|[{_MARKS}]|[:,](?![0-9])|\.{{3}}|\.{_CLOSING}{final}|--|$)"
    return "|".join([
        r"\.{3}",                                                   # ellipsis
        r"--",                                                      # double dash
        rf"[{_MARKS}]",                                             # brackets, marks, double quote
        r"[:,](?![0-9])",                                           # not inside 10:30 or 1,000
        rf"\.(?<=[^.\s\p{{Z}}]\.)(?={_CLOSING}{final})",            # final period
        rf"(?:n't|N'T)(?<=[^'\s\p{{Z}}]...){word_end}",             # do n't
        rf"'(?<=[^'\s\p{{Z}}]')(?:[sSmMdD]|ll|LL|re|RE|ve|VE)?{word_end}",  # it 's, we 'll, dogs '
        r"\b(?:[cC][aA][nN](?=(?i:not)\b)|[gG][iI][mM](?=(?i:me)\b)|[gG][oO][nN](?=(?i:na)\b)"
        r"|[gG][oO][tT](?=(?i:ta)\b)|[lL][eE][mM](?=(?i:me)\b)|[wW][aA][nN](?=(?i:na)\b))",
    ])


_BREAKS, _SENTENCE_BREAKS = _breaks(rf"(?:{_SPACE}|$)"), _breaks("$")


def spaced_words(text: Column) -> Column:
    """``text`` with a blank on both sides of every token that touches another one."""
    return F.regexp_replace(text, _BREAKS, " $0 ")


def raw_tokens(text: Column) -> Column:
    """Tokens in text order; the first and last may be empty."""
    return F.split(spaced_words(text), r"[\s\p{Z}]+")


def word_tokens(text: Column) -> Column:
    """English word tokens: punctuation, possessives and contractions come apart.

    ``"I can't, it's 1,000."`` gives ``I ca n't , it 's 1,000 .``. Every final
    period before white space is a token, after abbreviations too, and double
    quotes stay as they are written.
    """
    return F.filter(raw_tokens(text), lambda t: t != "")


def sentence_tokens(sentence: Column) -> Column:
    """``word_tokens`` of one sentence: only the period at its very end comes apart, those inside stay with their word."""
    spaced = F.regexp_replace(sentence, _SENTENCE_BREAKS, " $0 ")
    return F.filter(F.split(spaced, r"[\s\p{Z}]+"), lambda t: t != "")


def is_stop_word(word: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    return F.lower(word).isin(list(stop_words))


def remove_stop_words(tokens: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Drop stop words whatever their case; the others keep theirs."""
    return F.filter(tokens, lambda t: ~is_stop_word(t, stop_words))


def strip_punctuation(text: Column) -> Column:
    """Delete every ASCII punctuation character."""
    return F.translate(text, PUNCTUATION, "")


def strip_token_punctuation(tokens: Column) -> Column:
    """Delete punctuation inside the tokens and drop those left empty or blank."""
    return F.filter(F.transform(tokens, strip_punctuation), lambda t: ~t.isin("", " "))


def clean_tokens(tokens: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Stop words first, punctuation second: ``the.`` is no stop word and ends as ``the``."""
    return strip_token_punctuation(remove_stop_words(tokens, stop_words))


def bigrams(tokens: Column) -> Column:
    """Adjacent pairs as an array of (w1, w2); empty for fewer than two tokens."""
    length = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), length),
        F.slice(tokens, F.lit(2), length),
        lambda a, b: F.struct(a.alias("w1"), b.alias("w2")),
    )
