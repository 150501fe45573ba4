"""Porter stemming as a column expression.

A word is read as consonants and vowels; its measure is how often a run of
vowels is followed by a run of consonants. Ordered steps replace a suffix if
what is left before it meets a condition on that reading. A ``y`` is a consonant at
the beginning of a word and after a vowel.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffixes of the algorithm's steps and what replaces them, in
# the order in which they are tried; the first that a word ends with decides.
STEP_1A = (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", ""))
STEP_2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"),
          ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"),
          ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
STEP_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")

# Words that the extended algorithm has by heart.
IRREGULAR = (("sky", "sky"), ("skies", "sky"), ("dying", "die"), ("lying", "lie"), ("tying", "tie"), ("news", "news"),
             ("innings", "inning"), ("inning", "inning"), ("outings", "outing"), ("outing", "outing"), ("cannings", "canning"),
             ("canning", "canning"), ("howe", "howe"), ("proceed", "proceed"), ("exceed", "exceed"), ("succeed", "succeed"))


def letter_kinds(word: Column) -> Column:
    """``c`` or ``v`` for each letter."""
    def kind(done, ch):
        y = F.when(F.endswith(done, F.lit("c")), "v").otherwise("c")
        return F.concat(done, F.when(ch.isin(*"aeiou"), "v").when(ch == "y", y).otherwise("c"))
    return F.aggregate(F.filter(F.split(word, ""), lambda ch: ch != ""), F.lit(""), kind)


class _Word:
    """A word with the reading of its letters, or what is left of both without
    the last letters."""

    def __init__(self, text: Column, kinds: Column):
        self.text, self.kinds = text, kinds

    def ends(self, suffix: str) -> Column:
        return F.endswith(self.text, F.lit(suffix))

    def without(self, n: int) -> "_Word":
        return _Word(F.left(self.text, F.length(self.text) - n), F.left(self.kinds, F.length(self.kinds) - n))

    def measure(self) -> Column:
        return (F.length(self.kinds) - F.length(F.replace(self.kinds, F.lit("vc"), F.lit("")))) / 2

    def has_vowel(self) -> Column:
        return F.contains(self.kinds, F.lit("v"))

    def ends_double(self) -> Column:
        return (F.length(self.text) > 1) & F.endswith(self.kinds, F.lit("c")) & (F.right(self.text, F.lit(1)) == F.substring(self.text, -2, 1))

    def ends_short(self, extended: bool) -> Column:
        """Consonant, vowel, consonant other than w, x and y."""
        short = F.endswith(self.kinds, F.lit("cvc")) & ~F.right(self.text, F.lit(1)).isin("w", "x", "y")
        return short | (self.kinds == "vc") if extended else short


def _choose(cases: list, otherwise: Column) -> Column:
    out = None
    for holds, value in cases:
        out = F.when(holds, value) if out is None else out.when(holds, value)
    return out.otherwise(otherwise)


def _replace(w: _Word, rules, condition) -> Column:
    """The first rule whose suffix the word has decides: its replacement if the
    rest meets the condition, else the word as it is."""
    cases = []
    for suffix, new in rules:
        rest = w.without(len(suffix))
        cases.append((w.ends(suffix), F.when(condition(suffix, rest), F.concat(rest.text, F.lit(new))).otherwise(w.text)))
    return _choose(cases, w.text)


def _step_1a(w: _Word, extended: bool) -> Column:
    out = _replace(w, STEP_1A, lambda s, rest: F.lit(True))
    return F.when(w.ends("ies") & (F.length(w.text) == 4), F.concat(w.without(3).text, F.lit("ie"))).otherwise(out) if extended else out


def _mended(w: _Word, extended: bool) -> Column:
    """After a dropped ``ed`` or ``ing``."""
    return _choose([
        (w.ends("at") | w.ends("bl") | w.ends("iz"), F.concat(w.text, F.lit("e"))),
        (w.ends_double(), F.when(F.right(w.text, F.lit(1)).isin("l", "s", "z"), w.text).otherwise(w.without(1).text)),
        ((w.measure() == 1) & w.ends_short(extended), F.concat(w.text, F.lit("e")))], w.text)


def _step_1b(w: _Word, extended: bool) -> Column:
    eed, ied = w.without(3), w.without(3)
    cases = [(w.ends("ied"), F.concat(ied.text, F.when(F.length(w.text) == 4, "ie").otherwise("i")))] if extended else []
    cases.append((w.ends("eed"), F.when(eed.measure() > 0, F.concat(eed.text, F.lit("ee"))).otherwise(w.text)))
    for suffix in ("ed", "ing"):
        rest = w.without(len(suffix))
        cases.append((w.ends(suffix) & rest.has_vowel(), _mended(rest, extended)))
    return _choose(cases, w.text)


def _step_1c(w: _Word, extended: bool) -> Column:
    rest = w.without(1)
    holds = (F.length(rest.text) > 1) & F.endswith(rest.kinds, F.lit("c")) if extended else rest.has_vowel()
    return F.when(w.ends("y") & holds, F.concat(rest.text, F.lit("i"))).otherwise(w.text)


def _step_2a(w: _Word, extended: bool) -> Column:
    """The extended algorithm drops ``li`` after ``al`` before the other suffixes are tried."""
    rest = w.without(4)
    return F.when(w.ends("alli") & (rest.measure() > 0), F.concat(rest.text, F.lit("al"))).otherwise(w.text) if extended else w.text


def _step_2(w: _Word, extended: bool) -> Column:
    more = (("fulli", "ful"), ("logi", "log")) if extended else (("logi", "log"),)
    # the rest before "logi" is measured with its "l"
    return _replace(w, STEP_2 + more, lambda s, rest: (w.without(3) if s == "logi" else rest).measure() > 0)


def _step_3(w: _Word, extended: bool) -> Column:
    return _replace(w, STEP_3, lambda s, rest: rest.measure() > 0)


def _step_4(w: _Word, extended: bool) -> Column:
    def holds(suffix, rest):
        long = rest.measure() > 1
        return long & F.right(rest.text, F.lit(1)).isin("s", "t") if suffix == "ion" else long
    return _replace(w, [(s, "") for s in STEP_4], holds)


def _step_5a(w: _Word, extended: bool) -> Column:
    rest = w.without(1)
    m = rest.measure()
    return F.when(w.ends("e") & ((m > 1) | ((m == 1) & ~rest.ends_short(extended))), rest.text).otherwise(w.text)


def _step_5b(w: _Word, extended: bool) -> Column:
    rest = w.without(1)
    return F.when(w.ends("ll") & (rest.measure() > 1), rest.text).otherwise(w.text)


STEPS = (_step_1a, _step_1b, _step_1c, _step_2a, _step_2, _step_3, _step_4, _step_5a, _step_5b)


def porter_stem(col, extended: bool = True) -> Column:
    """The stem of a word, lower-cased; words of two letters or fewer stay.
    ``extended`` has the customary additions (words known by heart, ``ies`` and ``ied`` of
    short words, ``y`` only after a consonant, ``fulli``); without them it is the
    algorithm as its author publishes it."""
    word = F.lower(F.col(col) if isinstance(col, str) else col)

    def apply(step):
        # the one-element arrays bind each step's word and reading once
        return lambda w: F.transform(F.array(letter_kinds(w)), lambda k: step(_Word(w, k), extended))[0]

    out = word
    for step in STEPS:
        out = F.transform(F.array(out), apply(step))[0]
    known = [(word == w, F.lit(stem)) for w, stem in IRREGULAR] if extended else []
    return _choose([*known, (F.length(word) <= 2, word)], out)
