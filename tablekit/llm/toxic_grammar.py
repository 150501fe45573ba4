"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read a clause's symbols: insults and threats (arcs over the
letters of words and word stems, with learnt weights), targets, negation and
reported speech. They are composed to one machine whose states are the
reachable tuples of theirs; a clause's score is the sum of its matches' weights
times the factors that the machine puts out (an insult aimed at someone counts
more, a negated or reported one less). An arc may ask for several matches in a
document and weighs little until then. A document's score is a logistic
function of its clauses' scores, their largest and their sum by text length.

Arcs, weights and factors are learnt from labelled rows: at most ``TOXIC``
toxic and ``CLEAN`` clean documents, those of the smallest hash of the id (a
documented bound; near copies among them count once). A stem or word enters if
enough toxic documents that no earlier arc explains have it, and few clean
ones, by matches neither negated nor reported; as a threat if it tells toxic
documents from clean ones only where it is aimed at someone. The factors start
from ``FACTORS`` and move as far as the labels ask for. With too few labels
the fixed seed words and factors alone stand.

Null and empty texts have no clause and get the score of a text without a
match. Null labels are not learnt from. Repeated rows repeat their result; an
empty table gives an empty one; extra columns are left out or carried unread.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .runtime import ship, slices, text_column, utf8_bytes

#: Bounds of the learning sample, and of the patterns looked at.
TOXIC, CLEAN, PATTERNS = 3000, 4500, 4000
#: Patterns that a task counts before it sends them on.
FLUSH = 150_000
STEMS = range(3, 9)
#: Matches that an arc may ask for, and the weight's share before them.
REPEATS, EARLY = 3, 0.2
#: What the machine puts out for an aimed, a negated and a reported match, and
#: for a threat at nobody, before labels move it.
FACTORS = (1.5, 0.3, 0.5, 0.2)
#: Factors whose product tells which of the four were in force.
MARKS = (2.0, 3.0, 5.0, 7.0)

# Common words of each class in English, German, French, Spanish.
SEEDS = "idiot stupid moron loser scum trash worthless pathetic disgusting clown fool jerk dumb vermin filth".split()
THREATS = "kill hurt destroy beat stab shoot burn hang crush töten schlagen tuer frapper matar golpear".split()
TARGETS = ("you your yours yourself they them he she him her we all everyone people "
           "du dich dir ihr euch sie tu toi vous ils elles te tú usted ustedes vosotros").split()
NEGATIONS = "not no never none nobody isn't aren't don't doesn't wasn't nicht kein keine nie pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says say wrote writes quoted quotes claimed claims called calls reported sagte schrieb dit écrit dijo escribió".split()

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;\n]+")
_SYMBOL = {w: s for s, ws in (("report", REPORTS), ("target", TARGETS), ("negation", NEGATIONS)) for w in ws}


# ---- transducers ---------------------------------------------------------

@dataclass
class Transducer:
    """``arcs[state, symbol] = (state, factor)``; other symbols follow
    ``arcs[state, None]``, or stay with factor 1."""
    arcs: dict = field(default_factory=dict)
    start: int = 0

    def step(self, state, symbol):
        return self.arcs.get((state, symbol)) or self.arcs.get((state, None)) or (state, 1.0)


def scope(opener: str, width: int, factor: float) -> Transducer:
    """For ``width`` symbols after an opener, matches get a factor."""
    t = Transducer()
    for s in range(width + 1):
        after = max(0, s - 1)
        t.arcs[s, None] = (after, 1.0)
        t.arcs[s, opener] = (width, 1.0)
        for match in ("insult", "threat"):
            t.arcs[s, match] = (after, factor if s else 1.0)
    return t


def needs(match: str, opener: str, width: int, without: float) -> Transducer:
    """A match with no opener among the ``width`` symbols before it gets a factor."""
    t = scope(opener, width, 1.0)
    for s in range(width + 1):
        t.arcs[s, match] = (max(0, s - 1), 1.0 if s else without)
    return t


def compose(*parts: Transducer) -> Transducer:
    """The machine that runs all parts at once and multiplies their factors."""
    symbols = ("insult", "threat", "target", "negation", "report", None)
    out, number, todo = Transducer(), {}, [tuple(p.start for p in parts)]
    number[todo[0]] = 0
    while todo:
        state = todo.pop()
        for symbol in symbols:
            steps = [p.step(s, symbol) for p, s in zip(parts, state)]
            to = tuple(s for s, _ in steps)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            out.arcs[number[state], symbol] = (number[to], math.prod(f for _, f in steps))
    return out


def grammar(factors: tuple = FACTORS) -> Transducer:
    aimed, negated, reported, nobody = factors
    return compose(scope("target", 4, aimed), scope("negation", 3, negated), scope("report", 8, reported),
                   needs("threat", "target", 6, nobody))


# ---- patterns ------------------------------------------------------------

@dataclass
class Model:
    """``weights``: pattern (a stem, or a word and ``$``) to weight; ``kinds``:
    its symbol; ``logit``: intercept and weights of a text's features;
    ``least``: matches that a pattern asks for, if more than one."""
    weights: dict
    kinds: dict
    logit: tuple
    factors: tuple = FACTORS
    least: dict = field(default_factory=dict)

    def matcher(self):
        import ahocorasick
        machine = ahocorasick.Automaton()
        for p in self.weights:
            machine.add_word(p.rstrip("$"), p) if not p.endswith("$") else None
        for p in self.weights:
            if p.endswith("$"):
                machine.add_word(p[:-1], p)
        machine.make_automaton()
        return machine


class Scorer:
    def __init__(self, model: Model, factors: tuple | None = None):
        self.model, self.machine = model, model.matcher() if model.weights else None
        self.table = grammar(factors or model.factors).arcs

    def hits(self, text: str):
        """(word start, end, pattern) of every match in a lower-case text."""
        for end, p in self.machine.iter(text) if self.machine else ():
            a = end + 1 - len(p) + p.endswith("$")
            if (a and text[a - 1].isalpha()) or (p[-1] == "$" and end + 1 < len(text) and text[end + 1].isalpha()):
                continue
            yield a, end + 1, p

    def matches(self, text: str) -> dict[int, tuple[int, str]]:
        """Word start to (end, pattern): of several, the heaviest."""
        found = {}
        weights = self.model.weights
        for a, end, p in self.hits(text):
            if a not in found or weights[p] > weights[found[a][1]]:
                found[a] = end, p
        return found

    def clauses(self, text: str, starts) -> list[tuple[int, int]]:
        """Begin and end of the clauses that have a match."""
        cuts = [0, *(m.end() for m in _CLAUSE.finditer(text)), len(text)]
        at = sorted({int(np.searchsorted(cuts, a, "right")) - 1 for a in starts})
        return [(cuts[c], cuts[c + 1]) for c in at]

    def walk(self, text: str, a: int, b: int, kinds: dict):
        """(word start, factor) of the clause's words that ``kinds`` calls a match."""
        state = 0
        for m in _WORD.finditer(text, a, b):
            kind = kinds.get(m.start())
            state, factor = self.table[state, kind or _SYMBOL.get(m.group())]
            if kind:
                yield m.start(), factor

    def weighed(self, text: str):
        """Per clause with a match, the (weight, factor) of its matches."""
        found = self.matches(text)
        kinds = {a: self.model.kinds[p] for a, (_, p) in found.items()}
        had = Counter()
        for a, b in self.clauses(text, found):
            yield [(self.weight(found[at][1], had), f) for at, f in self.walk(text, a, b, kinds)]

    def weight(self, p: str, had: Counter) -> float:
        had[p] += 1
        return self.model.weights[p] * (EARLY if had[p] < self.model.least.get(p, 1) else 1.0)

    def features(self, text: str) -> tuple[float, float, float]:
        """Log of one more than the clauses' scores together, the largest, and
        log of one more than their sum in a thousand characters."""
        scores = [sum(w * f for w, f in clause) for clause in self.weighed(text.lower())]
        if not scores:
            return 0.0, 0.0, 0.0
        total = sum(scores)
        return math.log1p(total), max(scores), math.log1p(1000 * total / max(len(text), 500))

    def cells(self, text: str) -> list[float]:
        """Weights summed by the set of factors in force (of a machine with ``MARKS``)."""
        out = [0.0] * (1 << len(MARKS))
        for clause in self.weighed(text.lower()):
            for w, f in clause:
                out[in_force(f)] += w
        return out

    def score(self, text: str) -> float:
        z = self.model.logit[0] + sum(w * x for w, x in zip(self.model.logit[1:], self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def in_force(product: float) -> int:
    """Bit i set: the i-th of ``MARKS`` divides the product."""
    return sum(1 << i for i, m in enumerate(MARKS) if product % m == 0)


# ---- learning ------------------------------------------------------------

def patterns_of(text: str) -> set[str]:
    """All words (with ``$``) and stems of a text."""
    words = set(_WORD.findall(text.lower()))
    out = {w + "$" for w in words}
    for n in STEMS:
        out.update(w[:n] for w in words if len(w) > n)
    return out


def learning_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``(id, text, y)``: the bounded sample, near copies (texts with the same
    least 3-word shingle) once. Only the sample's ids are broadcast."""
    known = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("y")).filter("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    order = F.xxhash64("id")
    some = (known.filter("y = 1").orderBy(order, "id").limit(TOXIC)
            .union(known.filter("y = 0").orderBy(order, "id").limit(CLEAN)))
    src = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = src.join(F.broadcast(some), "id")

    def mark(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words, first = textops.word_hashes(*utf8_bytes(part.column("text")), lower=True)
                w = textops.window_hashes(words, 3)
                least = [int(w[a:b - 2].min()) if b - a > 2 else -1 - int(a) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("text"), part.column("y").cast(pa.int32()),
                     pa.array([str(x) for x in least], pa.string())], ["id", "text", "y", "mark"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text", "y").mapInArrow(mark, f"id {kind}, text string, y int, mark string")


def _pattern_counts(batches):
    yes, no, size = Counter(), Counter(), [0, 0]
    for batch in batches:
        for part in slices(batch, "text"):
            for t, y in zip(part.column("text").to_pylist(), part.column("y").to_pylist()):
                (yes if y else no).update(patterns_of(t))
                size[1 if y else 0] += 1
                if len(yes) + len(no) > FLUSH:
                    yield from _counts_batches(yes, no)
    yield from _counts_batches(yes, no)
    yield _counts_batch([""], [size[1]], [size[0]])


def _counts_batches(yes: Counter, no: Counter):
    """The counts so far, which then begin anew."""
    names = list(yes.keys() | no.keys())
    for i in range(0, len(names), 50_000):
        part = names[i:i + 50_000]
        yield _counts_batch(part, [yes[p] for p in part], [no[p] for p in part])
    yes.clear()
    no.clear()


def _counts_batch(names, a, b):
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["p", "a", "b"])


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The grammar's arcs and weights from labelled documents."""
    from .runtime import written
    spark = docs.sparkSession
    ship(spark)
    seeds = {w + "$": 2.0 for w in SEEDS + THREATS}
    kinds = {w + "$": "threat" if w in THREATS else "insult" for w in SEEDS + THREATS}
    plain = Model(seeds, kinds, (-3.0, 3.0, 0.0))
    rows = written(learning_rows(docs, labels, key, text, label), "toxic-sample")
    one = rows.groupBy("mark", "y").agg(F.min("id").alias("id")).select("id")
    rows = rows.join(F.broadcast(one), "id", "left_semi")
    counts = rows.select("text", "y").mapInArrow(_pattern_counts, "p string, a bigint, b bigint")
    counts = written(counts.groupBy("p").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).filter("a > 0"), "toxic-patterns")
    size = counts.filter("p = ''").first()
    pos, neg = (size["a"], size["b"]) if size else (0, 0)
    if pos < 5 or neg < 5:
        return plain
    odds = (F.log((F.col("a") + 0.5) / (F.lit(float(pos)) - F.col("a") + 0.5))
            - F.log((F.col("b") + 0.5) / (F.lit(float(neg)) - F.col("b") + 0.5)))
    fit = counts.filter((F.col("p") != "") & (F.col("a") >= 3)).withColumn("w", odds).filter("w > 1")
    top = fit.orderBy(F.expr("w * w / (1 / (a + 0.5) + 1 / (b + 0.5))").desc(), F.length("p").desc(), "p").limit(PATTERNS).collect()
    if not top:
        return plain
    names = sorted({r["p"] for r in top})
    known = Model(dict.fromkeys(names, 1.0), dict.fromkeys(names, "threat"), (0, 0, 0))
    shared = spark.sparkContext.broadcast(known)

    def hits(batches):
        scorer = Scorer(shared.value, MARKS)
        for batch in batches:
            for part in slices(batch, "text"):
                got = [straight(scorer, t.lower()) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), *(pa.array([g[i] for g in got], pa.list_(pa.string())) for i in (0, 1))], ["y", "ps", "aimed"])

    seen = rows.select("text", "y").mapInArrow(hits, "y int, ps array<string>, aimed array<string>").collect()
    arcs = cover([(r["y"], Counter(r["ps"]), set(r["aimed"])) for r in seen])
    weights = {p: w for p, (w, _, _) in arcs.items()}
    weights |= {p: w for p, w in seeds.items() if p not in weights}
    kinds |= {p: kind for p, (_, kind, _) in arcs.items()}
    model = Model(weights, {p: kinds[p] for p in weights}, (0, 0, 0), least={p: m for p, (_, _, m) in arcs.items() if m > 1})
    # the classes weigh as among all labels, not as in the sample
    rate = labels.filter(F.col(f"`{label}`").isin(0, 1)).agg(F.avg(F.col(f"`{label}`").cast("double"))).first()[0]
    rate = min(max(rate, 0.001), 0.999)

    def measured(model: Model, how: str, factors: tuple):
        shared = spark.sparkContext.broadcast(model)

        def run(batches):
            scorer = Scorer(shared.value, factors)
            for batch in batches:
                for part in slices(batch, "text"):
                    got = [list(getattr(scorer, how)(t)) for t in part.column("text").to_pylist()]
                    yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(got, pa.list_(pa.float64()))], ["y", "x"])

        points = rows.select("text", "y").mapInArrow(run, "y int, x array<double>").collect()
        y = np.array([r["y"] for r in points], float)
        share = np.where(y == 1, rate / max(y.mean(), 1e-9), (1 - rate) / max(1 - y.mean(), 1e-9))
        return np.array([r["x"] for r in points]), y, share

    factors = fit_factors(*measured(model, "cells", MARKS))
    x, y, share = measured(model, "features", factors)
    return Model(model.weights, model.kinds, rising(np.column_stack([np.ones(len(x)), x]), y, share), factors, model.least)


def straight(scorer: Scorer, text: str) -> tuple[list[str], list[str]]:
    """The patterns of all matches neither negated nor reported (each at most
    ``REPEATS`` times), and those of them that were aimed at someone."""
    at: dict[int, list[str]] = {}
    for a, _, p in scorer.hits(text):
        at.setdefault(a, []).append(p)
    kinds, had, aimed = dict.fromkeys(at, "threat"), Counter(), set()
    for a, b in scorer.clauses(text, at):
        for start, f in scorer.walk(text, a, b, kinds):
            force = in_force(f)
            if not force & 6:
                had.update(at[start])
                if not force & 8:
                    aimed.update(at[start])
    return [p for p, n in sorted(had.items()) for _ in range(min(n, REPEATS))], sorted(aimed)


def log_odds(a: int, b: int, pos: int, neg: int) -> float:
    return math.log((a + 0.5) / (pos - a + 0.5)) - math.log((b + 0.5) / (neg - b + 0.5))


def cover(docs: list) -> dict[str, tuple[float, str, int]]:
    """Pattern to (weight, kind, matches it asks for), of ``(y, matches of each
    pattern, patterns aimed at someone)``: patterns, those of the most toxic and
    fewest clean documents first, that toxic documents need: at least two of
    those with fewer than two arcs so far, and more than twice as many as clean
    ones. One in many toxic and next to no clean documents enters anyway."""
    pos = sum(1 for y, _, _ in docs if y)
    neg, many = len(docs) - pos, 0.02 * pos
    yes: dict[tuple, list[int]] = {}
    no: Counter = Counter()
    for i, (y, ps, aimed) in enumerate(docs):
        marks = [(p, m, "insult") for p, n in ps.items() for m in range(1, n + 1)] + [(p, 1, "threat") for p in aimed]
        for mark in marks:
            if y:
                yes.setdefault(mark, []).append(i)
            else:
                no[mark] += 1
    covered: Counter = Counter()
    out, having = {}, {}
    for mark in sorted(yes, key=lambda k: (3 * no[k] - len(yes[k]), k[2], k[1], -len(k[0]), k[0])):
        p, m, kind = mark
        have, bad = len(yes[mark]), no[mark]
        if p in out or (kind == "threat" and not only_aimed(mark, yes, no, pos, neg)):
            continue
        fresh = sum(1 for i in yes[mark] if covered[i] < 2)
        sure = have >= max(5, many) and bad <= 0.02 * have
        if have < 3 or (not sure and (fresh < 2 or fresh < 0.05 * have or have <= 2 * bad)):
            continue
        bare = p.rstrip("$")
        if any(bare.startswith(q) or (q.startswith(bare) and have - len(having[q]) < 2) for q in out):
            continue  # a chosen stem has it already, or it adds nothing to a chosen word
        w = log_odds(have, bad, pos, neg)
        if w <= 1.5:
            continue
        for i in yes[mark]:
            covered[i] += 1
        out[p], having[p] = (min(w, 8.0), kind, m), yes[mark]
    return out


def only_aimed(mark: tuple, yes: dict, no: Counter, pos: int, neg: int) -> bool:
    """Whether matches at nobody tell toxic documents from clean ones much less,
    beyond chance: 2.5 standard errors of the log odds."""
    p = mark[0]
    a, b = len(yes[mark]), no[mark]
    c, d = len(yes[p, 1, "insult"]) - a, no[p, 1, "insult"] - b
    gap = math.log((a + 0.5) / (b + 0.5)) - math.log((c + 0.5) / (d + 0.5))
    return d >= 5 and gap > 1.5 and gap > 2.5 * math.sqrt(sum(1 / (n + 0.5) for n in (a, b, c, d)))


def fit_factors(cells: np.ndarray, y: np.ndarray, share: np.ndarray, prior: tuple = FACTORS) -> tuple:
    """Factors under which the weights' sums tell toxic documents best. Each is
    moved by halves and doubles (three rounds over all four); leaving ``prior``
    costs half a squared doubling, so that few matches move nothing."""
    force = np.array([[c >> i & 1 for i in range(len(MARKS))] for c in range(cells.shape[1])], float)

    def cost(steps):
        total = cells @ np.exp(force @ (np.log(prior) + np.log(2) * steps))
        x = np.column_stack([np.ones(len(total)), np.log1p(total)])
        z = np.clip(x @ np.array(logistic(x, y, share)), -30, 30)
        return float((share * (np.logaddexp(0, z) - y * z)).sum()) + 0.5 * float((steps ** 2).sum())

    steps = np.zeros(len(MARKS))
    best = cost(steps)
    for _ in range(3):
        for i in range(len(MARKS)):
            for move in (-1, 1):
                to = steps.copy()
                to[i] += move
                if abs(to[i]) <= 3 and (got := cost(to)) < best - 1e-9:
                    steps, best = to, got
    return tuple(float(f) for f in np.array(prior) * 2.0 ** steps)


def rising(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple:
    """``logistic`` without the features that it would weigh below zero: a
    further match never makes a text less toxic."""
    use = list(range(x.shape[1]))
    while True:
        w = logistic(x[:, use], y, share)
        low = min(use[1:], key=lambda i: w[use.index(i)], default=None)
        if low is None or w[use.index(low)] >= 0:
            return tuple(w[use.index(i)] if i in use else 0.0 for i in range(x.shape[1]))
        use.remove(low)


def logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> tuple:
    """Weighted ridge logistic regression by Newton's steps."""
    w = np.zeros(x.shape[1])
    pen = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (y - p)) - pen @ w
        hess = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + pen
        step = np.linalg.solve(hess, grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def score(df: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None, below: float | None = None) -> DataFrame:
    """``(row, score)``: ``row`` has the input columns ``carry`` (default: all).
    With ``below``, only the rows whose score is less."""
    spark = df.sparkSession
    ship(spark)
    carry = carry or df.columns
    place = carry.index(text) if text in carry else None
    cols = [F.struct(*[df[f"`{c}`"] for c in carry]).alias("row")]
    src = df.select(*cols) if place is not None else df.select(*cols, df[f"`{text}`"].alias("text"))
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            row = batch.column("row")
            whole = pa.RecordBatch.from_arrays([row, batch.column("text") if place is None else row.field(place)], ["row", "text"])
            for part in slices(whole, "text"):
                got = np.array([scorer.score(t) for t in text_column(part, "text").to_pylist()])
                out = pa.RecordBatch.from_arrays([part.column("row"), pa.array(got, pa.float64())], ["row", "score"])
                yield out if below is None else out.filter(pa.array(got < below))

    return src.mapInArrow(run, f"row {src.schema['row'].dataType.simpleString()}, score double")


def fold(key: str, parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(f"`{key}`").cast("string")) % parts
