"""Text column expressions. All run JVM-side inside whole-stage codegen.

Regex notes: Java's ``\\w``/``\\s`` are ASCII-only, so letter/number classes
are written with ``\\p{L}``/``\\p{N}`` to keep accented words intact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop-word list the reference filters with
# (179 words, in the list's own order).
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him",
    "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's", "its",
    "itself", "they", "them", "their", "theirs", "themselves", "what", "which", "who",
    "whom", "this", "that", "that'll", "these", "those", "am", "is", "are", "was",
    "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did",
    "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until",
    "while", "of", "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from", "up",
    "down", "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any", "both",
    "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only",
    "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "don't", "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain",
    "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't",
    "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma",
    "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't",
    "wouldn", "wouldn't",
)

# Symbol class removed before n-gram matching (anything that is
# not whitespace, a letter or a digit; underscore included).
SYMBOLS = "[^\\s\\p{L}\\p{N}]+"

# The normaliser's ordered literal replacements, applied after
# lower-casing, then punctuation to space, then 1000000 -> 1m and 1000 -> 1k.
NORMALIZE_REPLACEMENTS = (
    (",000,000", "m"), (",000", "k"), ("′", "'"), ("’", "'"),
    ("won't", "will not"), ("cannot", "can not"), ("can't", "can not"),
    ("n't", " not"), ("what's", "what is"), ("it's", "it is"), ("'ve", " have"),
    ("i'm", "i am"), ("'re", " are"), ("he's", "he is"), ("she's", "she is"),
    ("'s", " own"), ("%", " percent "), ("₹", " rupee "), ("$", " dollar "),
    ("€", " euro "), ("'ll", " will"), ("=", " equal "), ("+", " plus "),
)
NORMALIZE_PUNCTUATION = "[“”()'…!^\".;:,\\-?？{}\\[\\]\\\\/*@]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_symbols(col) -> Column:
    """Drop symbol runs: ``Koh-i-Noor`` -> ``KohiNoor``."""
    return F.regexp_replace(_c(col), SYMBOLS, "")


def split_ws(col) -> Column:
    """Whitespace split without empty pieces (Python's bare ``split()``)."""
    return F.filter(F.split(_c(col), "\\s+"), lambda w: w != "")


def words_spaces_plus_one(col) -> Column:
    """Word count as number of single spaces + 1 (``''`` gives 1)."""
    c = _c(col)
    return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1).cast("int")


def sym_ratio(x, y) -> Column:
    """``|x - y| / (x + y + 1e-15)``; ``(0, 0)`` gives 0."""
    x, y = _c(x), _c(y)
    return F.abs(x - y) / (x + y + F.lit(1e-15))


def tokenize(col) -> Column:
    """Lower-case and split on single whitespace characters; empty tokens kept
    (``''`` -> ``['']``)."""
    return F.split(F.lower(_c(col)), "\\s")


def content_words(col, stop_words=STOP_WORDS) -> Column:
    """Lower, whitespace split, keep purely alphabetic words that are not stop
    words (``back?`` is dropped, not stripped)."""
    # more than ten literals are a hash set to Spark; an array is searched from its start
    return F.filter(split_ws(F.lower(_c(col))),
                    lambda w: w.rlike("^\\p{L}+$") & ~w.isin(*stop_words))


def normalize(col) -> Column:
    """Ordered literal replacements, punctuation to spaces, number suffixes,
    whitespace collapsed."""
    c = F.lower(_c(col))
    for old, new in NORMALIZE_REPLACEMENTS:
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.regexp_replace(c, NORMALIZE_PUNCTUATION, " ")
    c = F.regexp_replace(c, "([0-9]+)000000", "$1m")
    c = F.regexp_replace(c, "([0-9]+)000", "$1k")
    return F.array_join(split_ws(c), " ")


def sentences(col, lang: str = "", country: str = "") -> Column:
    """Sentence and word segmentation (``array<array<string>>``)."""
    return F.sentences(_c(col), F.lit(lang), F.lit(country))
