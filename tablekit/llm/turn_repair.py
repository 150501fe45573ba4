"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation's rows are edited, at the least cost, to roles that read as a
system row or none and then user and assistant in turn: Keep costs nothing, a
Rerole 2, a Delete 3 (required for blank and duplicate rows), an Insert of an
empty row 2, and a truncated row that stays 1. The cheapest edits are a shortest path
through four states (nothing yet, after the system row, after a user's, after an
assistant's), found from the end backwards: each row turns the vector of four costs
after it into the one before it. Of equally cheap edits those whose initials are
least in ASCII order are taken, by going forward along the vectors.

Rows are put in order by one range shuffle, so that most conversations lie whole
within a task, which repairs them at once. Those at a task's borders, and long
ones, are cut into pieces of at most ``PIECE_ROWS`` rows and ``PIECE_BYTES`` of text, and
the pieces of one conversation run side by side: each begins from a speculative
vector, that of a conversation's end. Fix-up passes hand each piece the vector
that the next piece now begins with; a piece whose vector differs by more than a
constant reruns from its end, only until its vectors differ from the old ones by
a constant alone, as from there on all do. The passes end when no piece reruns.
The edits of each piece are then traced from all four states, the states that
pieces begin in are found by the same passes forward, and the pieces' edits and
texts are put together in order.

Order of rows: by turn (null first), then role and text. Rows alike in all of
them are counted before any shuffle by order. Null roles and texts are one space;
a role that is empty or begins with none of ``s``, ``u`` and ``a`` is never kept. Each
row's first fault counts: blank (white space only), duplicate (role and text seen
earlier in the conversation) or truncated (the last character that is no white
space is not one of ``.!?``). ``times`` says how often a row stands there; 0 only names
its conversation, which then has a result even without rows: zeros, no edits, the
digest of an empty text. Rows with a null conversation are one conversation. An
empty table gives an empty one; other columns are never read.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import dense_index
from .runtime import ship, written

PIECE_ROWS = 4096
PIECE_BYTES = 1 << 20
#: Code points of a text that the ranges of rows may tell apart.
RANGE_CHARS = 200
_SPACE = " \t\n\x0b\x0c\r"

# ---- costs ---------------------------------------------------------------

#: Nothing yet, after the system row, after a user's row, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or reroled row.
FREE = (USER, USER, ASSISTANT, USER)
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Cost of ending in each state: what has to be inserted.
END = (0, 4, 2, 0)
FORCED = "x"


def symbol(initial: str, truncated: bool) -> str:
    """A row that may stay: its role's initial (o: another one), upper case if truncated."""
    letter = initial if initial in KEEP else "o"
    return letter.upper() if truncated else letter


@lru_cache(maxsize=None)
def edits(row: str, state: int) -> tuple:
    """``(initial, cost, next state)`` of the edits that use the row up."""
    out = [("D", 3, state)]
    if row != FORCED:
        more, kept = int(row.isupper()), KEEP.get(row.lower(), {}).get(state)
        if kept is not None:
            out.append(("K", more, kept))
        out.append(("R", 2 + more, FREE[state]))
    return tuple(out)


@lru_cache(maxsize=None)
def before(row: str, after: tuple) -> tuple:
    """The vector before a row from the one after it, less its least cost, and
    that least cost. Vectors differ by at most a few units, so there are few of them."""
    cost = [min(c + after[to] for _, c, to in edits(row, s)) for s in range(4)]
    for _ in range(2):  # up to two inserted rows before it
        cost = [min(c, 2 + cost[FREE[s]]) for s, c in enumerate(cost)]
    least = min(cost)
    return tuple(c - least for c in cost), least


@lru_cache(maxsize=None)
def choice(row: str, here: tuple, least: int, after: tuple, state: int) -> tuple:
    """Initials of the edits up to and with the row, their cost, and the next state."""
    letters, cost = "", 0
    while True:
        ways = {e: (c, to) for e, c, to in edits(row, state) if c + after[to] - least == here[state]}
        if "D" not in ways and 2 + here[FREE[state]] == here[state]:
            letters, cost, state = letters + "I", cost + 2, FREE[state]
            continue
        e = min(ways)
        return letters + e, cost + ways[e][0], ways[e][1]


def backward(rows: str, end: tuple, old: tuple[list, list] | None = None) -> tuple[list, list]:
    """Vectors at each row and after the last, and each row's least cost. With the
    ``old`` ones, only until a vector equals the old one, whose rest then holds."""
    vectors, least = [end], []
    for at in range(len(rows) - 1, -1, -1):
        v, low = before(rows[at], vectors[-1])
        vectors.append(v)
        least.append(low)
        if old and old[0][at] == v:
            return old[0][:at] + vectors[::-1], old[1][:at] + least[::-1]
    return vectors[::-1], least[::-1]


def forward(rows: str, vectors: list, least: list, state: int, last: bool) -> tuple[list, int, int]:
    """Initials row by row (and after the ``last`` one), their cost, the state after them."""
    out, cost = [], 0
    for at, row in enumerate(rows):
        letters, c, state = choice(row, vectors[at], least[at], vectors[at + 1], state)
        out.append(letters)
        cost += c
    tail = ""
    while last and END[state]:
        tail, cost, state = tail + "I", cost + 2, FREE[state]
    return [*out, tail], cost, state


def body(turns: list, letters: list, state: int) -> str:
    """The repaired rows ``role:text``; each but a conversation's first begins with a newline."""
    out = []
    for (role, text), own in zip([*turns, (None, None)], letters):
        for e in own:
            if e == "D":
                continue
            to = KEEP[role[:1]][state] if e == "K" else FREE[state]
            name = role if e == "K" else "user" if to == USER else "assistant"
            out.append(("" if state == START else "\n") + name + ":" + ("" if e == "I" else text))
            state = to
    return "".join(out)


# ---- rows and their faults -----------------------------------------------

class Faults:
    """What one piece has: its rows as symbols, and counts to be added up."""

    def __init__(self, rows: list):
        """``rows``: ``(turn, role, text, times, first)``; ``first``: not seen earlier."""
        self.turns, symbols = [], []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.n, self.lo, self.hi, self.distinct, self.head, self.tail = 0, None, None, 0, None, None
        for turn, role, text, times, first in rows:
            if not times:
                continue
            bare = text.rstrip(_SPACE)
            if not bare:
                self.blank += times
                symbols.append(FORCED * times)
            else:
                cut = first and bare[-1] not in ".!?"
                self.truncated += cut
                self.duplicate += times - first
                symbols.append((symbol(role[:1], cut) if first else "") + FORCED * (times - first))
            self.turns += [(role, text)] * times
            self.illegal += times - 1 + (self.n > 0 and illegal(self.tail, role[:1]))
            self.head = role[:1] if self.n == 0 else self.head
            self.tail = role[:1]
            self.n += times
            if turn is not None:
                self.distinct += self.hi != turn
                self.lo, self.hi = turn if self.lo is None else self.lo, turn
        self.symbols = "".join(symbols)

    def counts(self) -> tuple:
        return self.n, self.lo, self.hi, self.distinct, self.blank, self.duplicate, self.truncated, self.illegal, self.head, self.tail


def illegal(one: str, two: str) -> int:
    return int(one + two not in ("su", "ua", "au"))


class Total:
    """The pieces of a conversation, in order, put together."""

    def __init__(self):
        self.n, self.lo, self.hi, self.tail = 0, None, None, None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.audit, self.digest = [], sha256()

    def add(self, counts: tuple, audit: str, cost: int, text: str):
        n, lo, hi, distinct, blank, duplicate, truncated, wrong, head, tail = counts
        if n:
            self.illegal += wrong + (self.n > 0 and illegal(self.tail, head))
            self.n, self.tail = self.n + n, tail
        if lo is not None:
            self.distinct += distinct - (self.hi == lo)
            self.lo, self.hi = lo if self.lo is None else self.lo, hi
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self.cost += cost
        self.audit.append(audit)
        self.digest.update(text.encode("utf-8", "surrogatepass"))
        return self

    def row(self) -> dict:
        gaps = 0 if self.lo is None else self.hi - self.lo + 1 - self.distinct
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_RESULT = pa.struct([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in RESULT.split(", ")])


def repaired(rows: list) -> dict:
    """The result of a whole conversation: ``rows`` of ``(turn, role, text, times)`` in order."""
    seen, known = set(), []
    for turn, role, text, times in rows:
        known.append((turn, role, text, times, times > 0 and (role, text) not in seen))
        if times:
            seen.add((role, text))
    f = Faults(known)
    vectors, least = backward(f.symbols, END)
    letters, cost, _ = forward(f.symbols, vectors, least, START, True)
    return Total().add(f.counts(), "".join(letters), cost, body(f.turns, letters, START)).row()


# ---- first pass: whole conversations, and rows of all others ----------------

def _read(piece_rows: int, piece_bytes: int, kind: pa.DataType):
    names = ["conv", "result", "part", "no", "at", "turn", "role", "text", "times"]
    kinds = [kind, _RESULT, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches):
        part, no = TaskContext.get().partitionId(), 0
        conv, held, size = None, [], 0
        begun, cut = False, True  # the first conversation may have begun in another task
        out = []

        def piece():
            nonlocal held, size, no
            out.extend((conv, None, part, no, i, *r) for i, r in enumerate(held))
            no, held, size = no + bool(held), [], 0

        def flush(whole: bool):
            nonlocal out
            if out and (whole or len(out) >= piece_rows):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []

        for batch in batches:
            for key, *row in zip(*(batch.column(k).to_pylist() for k in ("conv", "turn", "role", "text", "times"))):
                if not begun or key != conv:
                    if begun and not cut:
                        out.append((conv, repaired(held), *[None] * 7))
                        held, size = [], 0
                    elif begun:
                        piece()
                    cut, begun, conv = not begun, True, key
                    yield from flush(False)
                held.append(tuple(row))
                size += len(row[2])
                if len(held) >= piece_rows or size >= piece_bytes:
                    cut = True
                    piece()
                    yield from flush(False)
        piece()  # the last conversation may go on in another task
        yield from flush(True)

    return run


# ---- pieces ----------------------------------------------------------------

_VECTORS = "symbols string, used binary, vectors binary, least binary, start binary"


def _pack(vectors: list) -> bytes:
    return bytes(x for v in vectors for x in v)


def _unpack(raw: bytes) -> list:
    return list(zip(*[iter(raw)] * 4))


def _columns(batch: pa.RecordBatch, *names: str):
    return zip(*(batch.column(n).to_pylist() for n in names))


def _out(rows: list, names: list, kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(names), kinds)], names)


def _vector_row(pos: int, rows: str, found: tuple, end: tuple, moved: bool) -> tuple:
    vectors, least = found
    return pos, rows, bytes(end), _pack(vectors), bytes(least), bytes(vectors[0]), moved


_V_NAMES = ["pos", "symbols", "used", "vectors", "least", "start", "moved"]
_V_KINDS = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
_V_SCHEMA = f"pos bigint, {_VECTORS}, moved boolean"


def _speculate(batches):
    for batch in batches:
        out = []
        for pos, turns in _columns(batch, "pos", "turns"):
            rows = Faults([tuple(t.values())[1:] for t in turns]).symbols
            out.append(_vector_row(pos, rows, backward(rows, END), END, True))
        yield _out(out, _V_NAMES, _V_KINDS)


def _fix(batches):
    """Reruns of the pieces whose next one begins with another vector than they used."""
    for batch in batches:
        out = []
        for pos, rows, used, vectors, least, follows in _columns(batch, "pos", "symbols", "used", "vectors", "least", "follows"):
            old, end = (_unpack(vectors), list(least)), tuple(follows or used)
            if end == tuple(used):
                out.append(_vector_row(pos, rows, old, end, False))
            else:
                out.append(_vector_row(pos, rows, backward(rows, end, old), end, True))
        yield _out(out, _V_NAMES, _V_KINDS)


def _trace(batches):
    """The state after each piece, for each of the four states before it."""
    for batch in batches:
        out = []
        for pos, rows, vectors, least, last in _columns(batch, "pos", "symbols", "vectors", "least", "last"):
            v, low = _unpack(vectors), list(least)
            out.append((pos, [forward(rows, v, low, s, last)[2] for s in range(4)]))
        yield _out(out, ["pos", "exits"], [pa.int64(), pa.list_(pa.int32())])


_COUNTS = ["n", "lo", "hi", "distinct", "blank", "duplicate", "truncated", "illegal", "head", "tail"]
_COUNT_KINDS = [*[pa.int64()] * 8, pa.string(), pa.string()]


def _edit(batches):
    """Each piece's edits and repaired text from the state that it begins in."""
    names = ["pos", *_COUNTS, "audit", "cost", "body"]
    for batch in batches:
        for pos, turns, vectors, least, last, state in _columns(batch, "pos", "turns", "vectors", "least", "last", "entry"):
            f = Faults([tuple(t.values())[1:] for t in turns])
            letters, cost, _ = forward(f.symbols, _unpack(vectors), list(least), state, last)
            row = (pos, *f.counts(), "".join(letters), cost, body(f.turns, letters, state))
            yield _out([row], names, [pa.int64(), *_COUNT_KINDS, pa.string(), pa.int64(), pa.string()])


def _join_up(kind: pa.DataType):
    """Pieces in order to one row a conversation: texts go through the digest
    piece by piece."""
    def run(batches):
        conv, total = None, None
        for batch in batches:
            out = []
            for key, audit, cost, text, *counts in _columns(batch, "conv", "audit", "cost", "body", *_COUNTS):
                if total is None or key != conv:
                    if total:
                        out.append((conv, total.row()))
                    conv, total = key, Total()
                total.add(tuple(counts), audit, cost, text)
            if out:
                yield _out(out, ["conv", "result"], [kind, _RESULT])
        if total:
            yield _out([(conv, total.row())], ["conv", "result"], [kind, _RESULT])

    return run


def _pieces(rows: DataFrame) -> DataFrame:
    """``(pos, conv, part, no, last, turns)``: the pieces numbered in order, with
    their rows, each marked if it is the first of its role and text."""
    place = ["part", "no", "at"]
    firsts = rows.filter("times > 0").groupBy("conv", "role", F.sha2("text", 256).alias("digest")).agg(
        F.min(F.struct(*place)).alias("x")).select("x.*", F.lit(True).alias("first"))
    turn = F.struct("at", "turn", "role", "text", "times", F.coalesce("first", F.lit(False)).alias("first"))
    pieces = written(rows.join(firsts, place, "left").groupBy("conv", "part", "no").agg(F.array_sort(F.collect_list(turn)).alias("turns")), "repair-pieces")
    numbered = written(dense_index(pieces.select("conv", "part", "no"), ["part", "no"], name="pos"), "repair-order")
    after = numbered.select((F.col("pos") - 1).alias("pos"), F.col("conv").alias("after"), F.lit(True).alias("some"))
    order = numbered.join(after, "pos", "left").select(
        "pos", "part", "no", (~F.coalesce(F.col("some") & F.col("conv").eqNullSafe(F.col("after")), F.lit(False))).alias("last"))
    return written(pieces.join(order, ["part", "no"]), "repair-numbered")


def _vectors(pieces: DataFrame) -> DataFrame:
    """The pieces' cost vectors: speculative ones, then fix-up passes."""
    now = written(pieces.select("pos", "turns").mapInArrow(_speculate, _V_SCHEMA), "repair-vectors")
    ends = pieces.filter("last").select("pos", F.lit(True).alias("last"))
    while True:
        after = now.select((F.col("pos") - 1).alias("pos"), F.col("start").alias("follows")).join(ends, "pos", "left_anti")
        now = written(now.drop("moved").join(after, "pos", "left").mapInArrow(_fix, _V_SCHEMA), "repair-vectors")
        if now.filter("moved").limit(1).count() == 0:
            return now


def _entries(pieces: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(pos, entry)``: the state that each piece begins in, first guessed as if
    the piece before it began a conversation, then by passes until none changes."""
    exits = vectors.join(pieces.select("pos", "last"), "pos").mapInArrow(_trace, "pos bigint, exits array<int>")
    exits = written(exits.join(pieces.select("pos", "last"), "pos"), "repair-exits")
    before_it = exits.filter(~F.col("last")).select((F.col("pos") + 1).alias("pos"), F.col("exits").alias("way"))
    chain = written(exits.select("pos").join(before_it, "pos", "left").select("pos", "way", F.coalesce(F.col("way")[START], F.lit(START)).alias("entry")), "repair-entries")
    while True:
        earlier = chain.select((F.col("pos") + 1).alias("pos"), F.col("entry").alias("was"))
        entry = F.coalesce(F.element_at("way", F.col("was") + 1), F.lit(START))
        chain = written(chain.join(earlier, "pos", "left").select("pos", "way", entry.alias("entry"), (entry != F.col("entry")).alias("moved")), "repair-entries")
        if chain.filter("moved").limit(1).count() == 0:
            return chain.select("pos", "entry")


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: str | None = None,
           piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256)``, a row for each conversation."""
    ship(df.sparkSession)
    how_often = df[f"`{times}`"].cast("bigint") if times else F.lit(1).cast("bigint")
    rows = df.select(df[f"`{conv}`"].alias("conv"), df[f"`{turn}`"].cast("bigint").alias("turn"),
                     *[F.coalesce(df[f"`{c}`"], F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))], how_often.alias("times"))
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("times").alias("times"))
    order = ["conv", "turn", "role"]
    rows = rows.repartitionByRange(*order, F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions(*order, "text")
    kind = rows.schema["conv"].dataType.simpleString()
    arrow = pa.string() if kind == "string" else {"bigint": pa.int64(), "int": pa.int32()}[kind]
    schema = f"conv {kind}, result struct<{RESULT.replace(' ', ':').replace(',:', ',')}>, part int, no bigint, at bigint, turn bigint, role string, text string, times bigint"
    read = written(rows.mapInArrow(_read(piece_rows, piece_bytes, arrow), schema), "repair-read")
    pieces = _pieces(read.filter("result is null").drop("result"))
    vectors = _vectors(pieces)
    known = pieces.join(vectors.select("pos", "vectors", "least"), "pos").join(_entries(pieces, vectors), "pos")
    counts = ", ".join(f"{n} {'string' if k == pa.string() else 'bigint'}" for n, k in zip(_COUNTS, _COUNT_KINDS))
    done = known.select("pos", "turns", "vectors", "least", "last", "entry").mapInArrow(
        _edit, f"pos bigint, {counts}, audit string, cost bigint, body string")
    done = done.join(pieces.select("pos", "conv"), "pos").repartition("conv").sortWithinPartitions("conv", "pos")
    joined = done.mapInArrow(_join_up(arrow), schema.split(", part int")[0])
    out = read.filter("result is not null").select("conv", "result").union(joined)
    return out.select(F.col("conv").alias(conv), "result.*")
