"""Treebank word tokens: ordered rewrite rules put spaces round punctuation,
quotes and the parts of contractions, then the text is split at spaces. Texts are cut
into sentences first, as only a sentence's last period is a token of its own.
"""

from __future__ import annotations

import functools
import itertools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import split_ws

# Words whose period ends no sentence.
ABBREVIATIONS = ("mr", "mrs", "ms", "dr", "prof", "st", "vs", "etc", "inc", "ltd", "co", "corp", "jr", "sr", "e.g", "i.e", "u.s", "no", "fig")

# The tokenizer's rules in their order, as patterns with groups.
# Opening quotes, punctuation, brackets, dashes; then closing quotes and
# possessives; then contractions of two words.
QUOTES_AND_PUNCTUATION = (
    (r'^"', r" `` "), (r"(``)", r" \1 "), (r'([ (\[{<])("|\'\')', r"\1 `` "),
    (r"([:,])([^0-9])", r" \1 \2"), (r"([:,])\z", r" \1 "), (r"(\.\.\.)", r" \1 "), (r"([;@#$%&])", r" \1 "),
    (r'([^.])(\.)([\])}>"\']*)\s*\z', r"\1 \2\3 "), (r"([?!])", r" \1 "), (r"([^'])' ", r"\1 ' "),
    (r"([\]\[(){}<>])", r" \1 "), (r"(--)", r" \1 "))
CLOSING = (
    (r'(")', r" '' "), (r"(\S)('')", r"\1 \2 "), (r"([^' ])('[sS]|'[mM]|'[dD]|') ", r"\1 \2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", r"\1 \2 "))
CONTRACTIONS = (("can", "not"), ("d", "'ye"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("more", "'n"), ("wan", "na"),
                ("'t", "is"), ("'t", "was"))

#: A sentence ends at a mark, closing quotes and brackets, and white space before a
#: capital letter or a digit.
SENTENCE_END = r"""([.!?]["')\]]*)\s+(["'(\[]*[\p{Lu}0-9])"""
BREAK, DOT = "\x01", "\x02"


def rewrite_rules() -> list[tuple[str, str]]:
    """All rules of one sentence in order; a space stands at either end of the text
    from the closing quotes on, and two between words from the contractions on."""
    joins = [(r"(?i)([^\p{L}\p{N}_'])(" + a + ")(" + b + r")([^\p{L}\p{N}_])", r"\1\2 \3\4") for a, b in CONTRACTIONS]
    return [*QUOTES_AND_PUNCTUATION, (r"^", " "), (r"\z", " "), *CLOSING, (r"\s+", "  "), *joins]


def sentence_rules() -> list[tuple[str, str]]:
    """Rules that put a break at each end of a sentence; an abbreviation's or an
    initial's period is hidden meanwhile."""
    words = "|".join(w.replace(".", r"\.") for w in ABBREVIATIONS)
    return [(r"(?i)(^|[^\p{L}\p{N}_.])(" + words + r")\.(\s)", r"\1\2" + DOT + r"\3"), (r"(^|[^\p{L}\p{N}_.])(\p{Lu})\.(\s)", r"\1\2" + DOT + r"\3"),
            (SENTENCE_END, r"\1" + BREAK + r"\2"), (DOT, ".")]


# What a text must have for a rule to find a match, where that is quicker to look for than the
# rule: any of some strings, or a pattern. Rules only put in spaces, quotes and marks, so
# what the rules of one run need is tested once, before the first of them.
_CONTRACTED = r"(?i)[cdglmw'](?:annot|'ye|imme|onna|otta|emme|ore'n|anna|tis|twas)"
_JOINS = tuple(pattern for pattern, _ in rewrite_rules()[-len(CONTRACTIONS):])
_NEEDS = {
    r'^"': ('"',), r"(``)": ("``",), r'([ (\[{<])("|\'\')': ('"', "''"), r"([:,])([^0-9])": (":", ","), r"([:,])\z": (":", ","),
    r"(\.\.\.)": ("...",), r"([^'])' ": ("' ",), r"(--)": ("--",), r'(")': ('"',), r"(\S)('')": ("''",),
    r"([^' ])('[sS]|'[mM]|'[dD]|') ": ("'",), r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ": ("'",),
    sentence_rules()[0][0]: r"\.(?=\s)(?<=(?:^|[^\p{L}\p{N}_.])(?i:" + "|".join(w.replace(".", r"\.") for w in ABBREVIATIONS) + r")\.)",
    # (a look behind meets the second half of a character beyond 16 bits)
    sentence_rules()[1][0]: r"\.(?=\s)(?<=[\p{Lu}\uDC00-\uDFFF]\.)", DOT: (DOT,)} | dict.fromkeys(_JOINS, _CONTRACTED)
# The same matches from the period on, with what stands before it looked at behind it.
_PERIOD = (r'([^.])(\.)([\])}>"\']*)\s*\z', r'(\.)(?<=[^.]\.)([\])}>"\']*)\s*\z')


def _replaced(text: Column, pattern: str, new: str) -> Column:
    if pattern == "^":
        return F.concat(F.lit(new), text)
    if pattern == r"\z":
        return F.concat(text, F.lit(new))
    if pattern == _PERIOD[0]:
        pattern, new = _PERIOD[1], r" \1\2 "
    return F.regexp_replace(text, pattern, new.replace("\\", "$"))


def _rewritten(texts: Column, rules) -> Column:
    """The rules in their order on each text of an array."""
    for need, run in itertools.groupby(rules, lambda rule: _NEEDS.get(rule[0])):
        run = list(run)

        def all_of(text: Column) -> Column:
            out = text
            for pattern, new in run:
                out = _replaced(out, pattern, new)
            if need is None:
                return out
            may = text.rlike(need) if isinstance(need, str) else functools.reduce(operator.or_, [text.contains(x) for x in need])
            return F.when(may, out).otherwise(text)

        texts = F.transform(texts, all_of)
    return texts


def treebank_sentences(col) -> Column:
    """Sentences, trimmed; a text without any gives an empty array."""
    text = _rewritten(F.array(F.col(col) if isinstance(col, str) else col), sentence_rules())[0]
    return F.filter(F.transform(F.split(text, BREAK), lambda s: F.regexp_replace(s, r"^\s+|\s+\z", "")), lambda s: s != "")


def words_of_sentences(sentences) -> Column:
    """The tokens of an array of sentences in one array."""
    return F.flatten(F.transform(_rewritten(F.col(sentences) if isinstance(sentences, str) else sentences, rewrite_rules()), split_ws))


def treebank_words(col) -> Column:
    """The tokens of all sentences in one array."""
    return words_of_sentences(treebank_sentences(col))
