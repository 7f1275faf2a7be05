"""Tokens and n-grams for the text block, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark ML's default English stop-word list
# (pyspark.ml.feature.StopWordsRemover.loadDefaultStopWords("english")), in its
# own order.  Kept as text so the DuckDB oracle can use the same list.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's",
    "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't",
    "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot",
    "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's",
    "where's", "who's", "why's", "would",
]

# A token is a run of two or more word characters.
TOKEN_PATTERN = r"\b\w\w+\b"


def stop_tokens(words) -> list[str]:
    """The words and, since tokens never hold an apostrophe, the tokens inside contractions."""
    return list(dict.fromkeys([*words, *(t for w in words for t in re.findall(TOKEN_PATTERN, w))]))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(x, stop_words: list[str] | None = None) -> Column:
    """Lower-cased tokens of 2+ word characters, stop words removed (array<string>)."""
    words = F.regexp_extract_all(F.lower(F.coalesce(_c(x), F.lit(""))), F.lit(TOKEN_PATTERN), 0)
    stop = stop_tokens(STOP_WORDS) if stop_words is None else stop_words
    # a long IN list becomes a hash-set lookup (InSet)
    return F.filter(words, lambda w: ~w.isin(*stop))


def with_bigrams(t) -> Column:
    """Unigrams then bigrams (adjacent kept tokens joined by a space) of a token array.

    Pass a column that already holds the tokens (select them first) so the
    tokenizer runs once per row.
    """
    t = _c(t)
    n_pairs = F.greatest(F.size(t) - 1, F.lit(0))
    bigrams = F.zip_with(F.slice(t, 1, n_pairs), F.slice(t, 2, n_pairs),
                         lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(t, bigrams)


def ngrams(x, stop_words: list[str] | None = None) -> Column:
    return with_bigrams(tokens(x, stop_words))


def word_count(x) -> Column:
    """Number of whitespace-separated words (0 for blank text)."""
    s = F.regexp_replace(_c(x), r"^\s+|\s+$", "")
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.split(s, r"\s+")))
