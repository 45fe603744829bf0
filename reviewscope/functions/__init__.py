from reviewscope.functions.calendar import month_name, weekday_name
from reviewscope.functions.cleaning import clean_reviews, strip_byte_prefix, strip_quotes
from reviewscope.functions.numbers import binarize, is_number, round_abs
from reviewscope.functions.text import (
    bigrams, clean_tokens, remove_stop_words, strip_punctuation, strip_token_punctuation,
    word_tokens,
)

__all__ = [
    "bigrams", "binarize", "clean_reviews", "clean_tokens", "is_number", "month_name",
    "remove_stop_words", "round_abs", "strip_byte_prefix", "strip_punctuation", "strip_quotes",
    "strip_token_punctuation", "weekday_name", "word_tokens",
]
