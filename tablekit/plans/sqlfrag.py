"""DuckDB SQL fragments mirroring the column expressions (oracle side only)."""

from __future__ import annotations

from ..functions import stemming as ST
from ..functions import treebank as TB
from ..functions.text import NORMALIZE_REPLACEMENTS, STOP_WORDS
from ..operators.sampling import MULT, PRIME
from .lexicon import LEMMAS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SYM = lit("[^\\s\\p{L}\\p{N}]+")
PUNCT = lit("[“”()'…!^\".;:,\\-?？{}\\[\\]\\\\/*@]")
STOP = "[" + ", ".join(lit(w) for w in STOP_WORDS) + "]"


def split_ws(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')"


def wc(x: str) -> str:
    return f"CAST(length({x}) - length(replace({x}, ' ', '')) + 1 AS INTEGER)"


def ratio(x: str, y: str) -> str:
    return f"abs({x} - {y}) / ({x} + {y} + 1e-15)"


def ngram_words(x: str) -> str:
    return split_ws(f"lower(regexp_replace({x}, {SYM}, '', 'g'))")


def ngrams(words: str, n: int) -> str:
    return (f"CASE WHEN len({words}) >= {n} THEN list_transform(range(1, len({words}) - {n} + 2), "
            f"lambda i: array_to_string({words}[i:i + {n - 1}], ' ')) ELSE []::VARCHAR[] END")


def common(words1: str, words2: str, n: int) -> str:
    return f"CAST(len(list_intersect({ngrams(words1, n)}, {ngrams(words2, n)})) AS INTEGER)"


def content_words(x: str) -> str:
    return (f"list_filter({split_ws(f'lower({x})')}, lambda w: regexp_full_match(w, '\\p{{L}}+') "
            f"AND NOT list_contains({STOP}, w))")


def _case(pos: str) -> str:
    arms = " ".join(f"WHEN {lit(f)} THEN {lit(l)}" for f, p, l in LEMMAS if p == pos)
    return f"CASE w {arms} ELSE w END"


def lemmatize(words: str, min_len: int = 0) -> str:
    noun = f"list_transform({words}, lambda w: CASE WHEN length(w) < {min_len} THEN w ELSE {_case('n')} END)"
    return f"list_transform({noun}, lambda w: CASE WHEN length(w) < {min_len} THEN w ELSE {_case('v')} END)"


def lemma_text(x: str) -> str:
    return f"array_to_string({lemmatize(content_words(x))}, ' ')"


def normalize(x: str) -> str:
    c = f"lower({x})"
    for old, new in NORMALIZE_REPLACEMENTS:
        c = f"replace({c}, {lit(old)}, {lit(new)})"
    c = f"regexp_replace({c}, {PUNCT}, ' ', 'g')"
    c = f"regexp_replace({c}, '([0-9]+)000000', '\\1m', 'g')"
    c = f"regexp_replace({c}, '([0-9]+)000', '\\1k', 'g')"
    return f"array_to_string({split_ws(c)}, ' ')"


def fuzzy_tokens(x: str) -> str:
    return split_ws(f"lower(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))")


def fratio(a: str, b: str) -> str:
    mx = f"greatest(length({a}), length({b}))"
    return (f"CAST(CASE WHEN {mx} = 0 THEN 100 ELSE round(({mx} - levenshtein({a}, {b})) * 100 / {mx}) END "
            f"AS INTEGER)")


def one_byte(table: str, *cols: str) -> str:
    """``WITH ..., one_byte``: the table with each non-ASCII character of the
    columns replaced by an ASCII character that none of them has. DuckDB's
    ``levenshtein`` counts bytes; a one-to-one renaming keeps every distance
    between characters."""
    whole = " || ".join(f"coalesce({c}, '')" for c in cols)
    put = ", ".join(f"translate({c}, f, t) AS {c}" for c in cols)
    return f"""WITH raw AS (SELECT * FROM {table} z),
 used AS (SELECT DISTINCT unnest(string_split({whole}, '')) AS c FROM raw),
 far AS (SELECT c, row_number() OVER (ORDER BY c) AS k FROM used WHERE unicode(c) > 127),
 free AS (SELECT chr(CAST(x AS INTEGER)) AS c, row_number() OVER (ORDER BY x) AS k FROM range(1, 127) r(x)
           WHERE chr(CAST(x AS INTEGER)) NOT IN (SELECT c FROM used)),
 names AS (SELECT coalesce(string_agg(far.c, '' ORDER BY far.k), '') AS f, coalesce(string_agg(free.c, '' ORDER BY far.k), '') AS t
             FROM far JOIN free ON far.k = free.k),
 one_byte AS (SELECT raw.* EXCLUDE ({', '.join(cols)}), {put} FROM raw, names)"""


def rewritten(x: str, rules) -> str:
    for pattern, new in rules:
        x = f"regexp_replace({x}, {lit(pattern)}, {lit(new)}, 'g')"
    return x


def treebank_sentences(x: str) -> str:
    parts = f"string_split({rewritten(x, TB.sentence_rules())}, {lit(TB.BREAK)})"
    return rf"list_filter(list_transform({parts}, lambda s: regexp_replace(s, '^\s+|\s+\z', '', 'g')), lambda s: s <> '')"


def treebank_words(x: str) -> str:
    return f"flatten(list_transform({treebank_sentences(x)}, lambda s: {split_ws(rewritten('s', TB.rewrite_rules()))}))"


def _kinds(x: str) -> str:
    return (f"list_reduce(list_prepend('', string_split({x}, '')), lambda a, c: a || CASE WHEN c IN ('a', 'e', 'i', 'o', 'u') THEN 'v' "
            "WHEN c = 'y' AND a[-1] = 'c' THEN 'v' ELSE 'c' END)")


def _m(n: int) -> str:
    """Measure of the word without its last n letters."""
    k = f"k[:length(k) - {n}]"
    return f"((length({k}) - length(replace({k}, 'vc', ''))) / 2)"


def _rest(n: int) -> str:
    return f"x[:length(x) - {n}]"


def _cvc(n: int) -> str:
    k, last = f"k[:length(k) - {n}]", f"x[length(x) - {n}]"
    return f"((ends_with({k}, 'cvc') AND {last} NOT IN ('w', 'x', 'y')) OR {k} = 'vc')"


def _suffix_case(rules, least: int) -> str:
    arms = []
    for suffix, new in rules:
        n = len(suffix)
        holds = f"{_m(3 if suffix == 'logi' else n)} > {least}"
        if suffix == "ion":
            holds += f" AND x[length(x) - {n}] IN ('s', 't')"
        arms.append(f"WHEN ends_with(x, '{suffix}') THEN CASE WHEN {holds} THEN {_rest(n)} || '{new}' ELSE x END")
    return f"CASE {' '.join(arms)} ELSE x END"


def _after_drop(n: int) -> str:
    """What becomes of the word without its last n letters, an ``ed`` or ``ing``."""
    r = _rest(n)
    return (f"CASE WHEN ends_with({r}, 'at') OR ends_with({r}, 'bl') OR ends_with({r}, 'iz') THEN {r} || 'e' "
            f"WHEN length({r}) > 1 AND k[length(k) - {n}] = 'c' AND x[length(x) - {n}] = x[length(x) - {n + 1}] "
            f"THEN CASE WHEN x[length(x) - {n}] IN ('l', 's', 'z') THEN {r} ELSE {_rest(n + 1)} END "
            f"WHEN {_m(n)} = 1 AND {_cvc(n)} THEN {r} || 'e' ELSE {r} END")


def porter_ctes(words: str) -> str:
    """CTEs from ``words`` (with a lower-case column ``w``) to ``stems (word, stem)``."""
    plain = " ".join(f"WHEN ends_with(x, '{s}') THEN {_rest(len(s))} || '{new}'" for s, new in ST.STEP_1A)
    has_vowel = "contains(k[:length(k) - {n}], 'v')"
    steps = [
        f"CASE WHEN ends_with(x, 'ies') AND length(x) = 4 THEN {_rest(3)} || 'ie' {plain} ELSE x END",
        f"CASE WHEN ends_with(x, 'ied') THEN {_rest(3)} || CASE WHEN length(x) = 4 THEN 'ie' ELSE 'i' END "
        f"WHEN ends_with(x, 'eed') THEN CASE WHEN {_m(3)} > 0 THEN {_rest(3)} || 'ee' ELSE x END "
        f"WHEN ends_with(x, 'ed') AND {has_vowel.format(n=2)} THEN {_after_drop(2)} "
        f"WHEN ends_with(x, 'ing') AND {has_vowel.format(n=3)} THEN {_after_drop(3)} ELSE x END",
        f"CASE WHEN ends_with(x, 'y') AND length(x) > 2 AND k[length(k) - 1] = 'c' THEN {_rest(1)} || 'i' ELSE x END",
        f"CASE WHEN ends_with(x, 'alli') AND {_m(4)} > 0 THEN {_rest(4)} || 'al' ELSE x END",
        _suffix_case((*ST.STEP_2, ("fulli", "ful"), ("logi", "log")), 0),
        _suffix_case(ST.STEP_3, 0),
        _suffix_case([(s, "") for s in ST.STEP_4], 1),
        f"CASE WHEN ends_with(x, 'e') AND ({_m(1)} > 1 OR ({_m(1)} = 1 AND NOT {_cvc(1)})) THEN {_rest(1)} ELSE x END",
        f"CASE WHEN ends_with(x, 'll') AND {_m(1)} > 1 THEN {_rest(1)} ELSE x END"]
    out = [f"p0 AS (SELECT DISTINCT w AS word, w AS x FROM {words})"]
    for i, step in enumerate(steps):
        out.append(f"q{i} AS (SELECT word, x, {_kinds('x')} AS k FROM p{i})")
        out.append(f"p{i + 1} AS (SELECT word, {step} AS x FROM q{i})")
    known = " ".join(f"WHEN word = {lit(w)} THEN {lit(s)}" for w, s in ST.IRREGULAR)
    out.append(f"stems AS (SELECT word, CASE {known} WHEN length(word) <= 2 THEN word ELSE x END AS stem FROM p{len(steps)})")
    return ",\n ".join(out)


def seeded_hash(key: str, seed: int) -> str:
    return f"((((({key}) % {PRIME}) * {MULT} + {seed}) % {PRIME}) * {MULT} % {PRIME})"


def mixed_hash(key: str, seed: int) -> str:
    x = seeded_hash(key, seed)
    return f"((({x} * {x} + {seed + 1}) % {PRIME}) * {MULT} % {PRIME})"


def sig(x: str, digits: int = 10) -> str:
    return f"CAST(printf('%.{digits - 1}e', {x}) AS DOUBLE)"


def _fix(v: str) -> str:
    return f"(CASE WHEN abs({v}) < 1e-300 THEN 1e-300 ELSE {v} END)"


def _cf(a: str, b: str, x: str, iters: int = 300) -> str:
    """Continued fraction of the incomplete beta (modified Lentz), as a
    struct-state fold; mirrors ``functions.special._cf``."""
    qab, qap, qam = f"({a} + {b})", f"({a} + 1.0)", f"({a} - 1.0)"
    d0 = f"(1.0 / {_fix(f'(1.0 - {qab} * {x} / {qap})')})"
    m, m2 = "CAST(m AS DOUBLE)", "(2.0 * CAST(m AS DOUBLE))"
    aa = f"({m} * ({b} - {m}) * {x} / (({qam} + {m2}) * ({a} + {m2})))"
    d1 = f"(1.0 / {_fix(f'(1.0 + {aa} * s.d)')})"
    c1 = _fix(f"(1.0 + {aa} / s.c)")
    aa2 = f"(-({a} + {m}) * ({qab} + {m}) * {x} / (({a} + {m2}) * ({qap} + {m2})))"
    d2 = f"(1.0 / {_fix(f'(1.0 + {aa2} * {d1})')})"
    c2 = _fix(f"(1.0 + {aa2} / {c1})")
    step = f"{{'c': {c2}, 'd': {d2}, 'h': s.h * {d1} * {c1} * {d2} * {c2}}}"
    init = f"{{'c': 1.0::DOUBLE, 'd': {d0}::DOUBLE, 'h': {d0}::DOUBLE}}"
    return f"list_reduce(range(1, {iters + 1}), lambda s, m: {step}, {init}).h"


def betainc(a: str, b: str, x: str) -> str:
    front = f"exp(lgamma({a} + {b}) - lgamma({a}) - lgamma({b}) + {a} * ln({x}) + {b} * ln(1.0 - {x}))"
    return (f"(CASE WHEN {x} <= 0 THEN 0.0 WHEN {x} >= 1 THEN 1.0 "
            f"WHEN {x} < ({a} + 1.0) / ({a} + {b} + 2.0) THEN {front} * {_cf(a, b, x)} / {a} "
            f"ELSE 1.0 - {front} * {_cf(b, a, f'(1.0 - {x})')} / {b} END)")
