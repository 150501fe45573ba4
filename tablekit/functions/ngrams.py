"""N-gram overlap expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_symbols, split_ws


def ngram_words(col) -> Column:
    """Words for n-gram matching: symbols removed, lower case, whitespace split."""
    c = F.col(col) if isinstance(col, str) else col
    return split_ws(F.lower(clean_symbols(c)))


def word_ngrams(words, n: int) -> Column:
    """Word n-grams as space-joined strings (words hold no whitespace, so the
    join is injective). Fewer than ``n`` words gives an empty array.

    ``words`` should be a column reference: an expression here would be
    re-evaluated inside the lambda for every position."""
    words = F.col(words) if isinstance(words, str) else words
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(1), F.size(words) - n + 1),
        lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def common_ngrams(words1, words2, n: int) -> Column:
    """Size of the intersection of two texts' n-gram *sets*, from word-array
    columns (see ``ngram_words`` and ``with_ngram_words``)."""
    return F.size(F.array_intersect(word_ngrams(words1, n), word_ngrams(words2, n))).cast("int")


def with_ngram_words(df, **named_texts):
    """Materialise ``ngram_words`` arrays as columns (``name=text_column``)."""
    return df.withColumns({k: ngram_words(v) for k, v in named_texts.items()})


def char_ngrams(col, n: int = 2) -> Column:
    """Every ``n`` characters in a row: the characters are split once and
    neighbouring array elements joined."""
    c = F.col(col) if isinstance(col, str) else col

    def grams(chars):
        heads = F.slice(chars, 1, F.greatest(F.size(chars) - n + 1, F.lit(0)))
        return F.transform(heads, lambda _, i: F.array_join(F.slice(chars, i + 1, n), ""))
    # the one-element array binds the characters once
    return F.transform(F.array(F.split(c, "")), grams)[0]


def common_char_ngrams(s1, s2, n: int = 2) -> Column:
    return F.size(F.array_intersect(char_ngrams(s1, n), char_ngrams(s2, n))).cast("int")


def unigram_ratio(ngrams, n1, n2) -> Column:
    """``ngrams / (1 + max(n1, n2))``."""
    g = F.col(ngrams) if isinstance(ngrams, str) else ngrams
    a = F.col(n1) if isinstance(n1, str) else n1
    b = F.col(n2) if isinstance(n2, str) else n2
    return g / (F.greatest(a, b) + 1)
