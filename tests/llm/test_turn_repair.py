"""Conversation repair against a plain shortest path over all edits, and the query against plain Python."""

import heapq
import random
import re
import zlib
from hashlib import sha256

import pytest

from tablekit.llm import queries
from tablekit.llm import turn_repair as V

SMOKE = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, times int"
COLS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def fits(roles):
    return re.fullmatch("(s?(ua)+)?", roles) is not None


def plain(rows):
    """``rows``: ``(turn, role, text)`` in order."""
    seen, kinds, faults = set(), [], [0, 0, 0]
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        kinds.append(kind)
        seen.add((role, text))
        if kind:
            faults[["blank", "duplicate", "truncated"].index(kind)] += 1
    # uniform-cost search by (cost, audit): states (row, roles so far by their last initial)
    heap, done = [(0, "", 0, "", "")], set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            break

        def push(more, e, to, initial, line):
            if initial is not None:
                legal = last + initial in ("s", "u", "su", "ua", "au")
                if not legal:
                    return
            heapq.heappush(heap, (cost + more, audit + e, to, last if initial is None else initial, out + (line or "")))

        def line(role, text):
            return ("\n" if last else "") + f"{role}:{text}"

        for role in ("user", "assistant"):
            push(2, "I", at, role[0], line(role, ""))
        if at < len(rows):
            _, role, text = rows[at]
            push(3, "D", at + 1, None, None)
            if kinds[at] not in ("blank", "duplicate"):
                cut = int(kinds[at] == "truncated")
                if role:
                    push(cut, "K", at + 1, role[:1], line(role, text))
                for other in ("user", "assistant"):
                    push(2 + cut, "R", at + 1, other[0], line(other, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *faults, illegal, cost, audit, sha256(out.encode()).hexdigest())


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def want(table):
    groups = {}
    for conv, turn, role, text, times in table:
        own = groups.setdefault(conv, [])
        own += [(turn, " " if role is None else role, " " if text is None else text)] * times
    return {c: plain(ordered(rows)) for c, rows in groups.items()}


def got(df):
    out = {}
    for r in df.collect():
        assert r["conv_id"] not in out
        out[r["conv_id"]] = tuple(r[c] for c in COLS)
    return out


TEXTS = ["Yes.", "No!", "What?", "cut off", "cut off ", "  ", "", "\x85", "Ünïcode.", "So. \n", None, "a\nb.", "😀"]


def conversation(rnd, conv, n):
    rows = []
    for t in range(n):
        role = rnd.choice(["user", "assistant"]) if rnd.random() < 0.4 else ("user", "assistant")[t % 2]
        role = rnd.choice(["system", "tool", "", None, "unknown", "user"]) if rnd.random() < 0.15 else role
        text = rnd.choice(TEXTS) if rnd.random() < 0.4 else f"text {rnd.randrange(1000)}{rnd.choice(['.', '!', '', '? '])}"
        turn = None if rnd.random() < 0.05 else t + (rnd.random() < 0.1) * rnd.randrange(-2, 5)
        rows.append((conv, turn, role, text, rnd.choice([1, 1, 1, 1, 1, 2, 0, 3])))
    return rows


@pytest.fixture(scope="module")
def table():
    rnd = random.Random(12)
    rows = [r for c in range(120) for r in conversation(rnd, c, rnd.randrange(1, 14))]
    rows += conversation(rnd, 500, 300) + conversation(rnd, None, 40)
    return rows + [(600, 0, "user", "gone.", 0)] + [(601, 3, "system", "alone.", 1)] + [(602, 0, "assistant", "Hm.", 1)]


@pytest.mark.parametrize("piece_rows, piece_bytes", [(4096, 1 << 20), (7, 1 << 20), (1, 10), (50, 200)])
def test_against_a_plain_shortest_path(spark, table, piece_rows, piece_bytes):
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    assert got(V.repair(df, times="times", piece_rows=piece_rows, piece_bytes=piece_bytes)) == want(table)


def test_pieces_agree_with_the_whole():
    rnd = random.Random(3)
    for _ in range(300):
        rows = "".join(rnd.choice("suaSUAox") for _ in range(rnd.randrange(1, 60)))
        vectors, least = V.backward(rows, V.END)
        cut = rnd.randrange(len(rows) + 1)
        tail, _ = V.backward(rows[cut:], V.END)
        speculative = V.backward(rows[:cut], V.END)
        mended = V.backward(rows[:cut], tail[0], speculative)
        assert mended == (vectors[:cut + 1], least[:cut])


def test_fix_up_stops_where_vectors_converge():
    rows = "ua" * 500
    old = V.backward(rows, V.END)
    old[0][3] = marked = tuple(old[0][3])  # a rerun keeps the very objects that it never reached
    again = V.backward(rows, (4, 4, 0, 2), old)
    assert again[0][3] is marked and again[0][-1] == (4, 4, 0, 2)


def test_a_long_conversation_needs_few_passes(spark, monkeypatch):
    rnd = random.Random(4)
    rows = conversation(rnd, 1, 3000)
    passes = []
    real = V.written

    def counted(df, name):
        passes.append(name)
        return real(df, name)
    monkeypatch.setattr(V, "written", counted)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(V.repair(df, times="times", piece_rows=100)) == want(rows)
    assert passes.count("repair-vectors") <= 4 and passes.count("repair-entries") <= 4


def test_ties_take_the_least_initials(spark):
    rows = [(1, 0, "user", "a.", 1), (1, 1, "user", "b.", 1), (1, 2, "assistant", "c.", 1), (2, 0, "assistant", "x", 1)]
    out = got(V.repair(spark.createDataFrame(rows, SCHEMA), times="times"))
    assert out[1][5:7] == (2, "KIKK")  # inserting costs less than deleting
    assert out == want(rows)


def test_empty_table_and_clashing_columns(spark):
    from pyspark.sql import functions as F
    assert V.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, 0, "user", "a.", 1), (1, 1, "assistant", "b.", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "part", "no", "at", "pos", "result", "first", "cost"):
        df = df.withColumn(name, F.lit("x"))
    assert got(V.repair(df)) == want(rows)
    text = spark.createDataFrame([("c", 0, "user", "a.")], "conv_id string, turn bigint, role string, text string")
    assert got(V.repair(text)) == {"c": plain([(0, "user", "a.")])}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_text, turn_text = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out.append((conv, turn, "user" if fate == 4 else role, text, {0: 0, 3: 2}.get(fate, 1)))
    return out


def test_query_on_the_whole_table(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{SMOKE}/conversations.parquet").collect()]
    out = got(queries.op12_rank_convergence_viterbi(spark, SMOKE))
    assert out == want(damaged(rows)) and len(out) > 10


def test_query_with_nulls_and_very_long_texts(spark, tmp_path):
    rows = [(None, None, None, None), (None, 1, "user", "x" * 300_000), (1, 0, "user", "y " * 200_000 + "."), (1, 1, None, "z."),
            (1, 1, None, "z."), (2, None, "user", None), (3, 5, "assistant", "ok.")] + [(4, t, "ua"[t % 2], f"{t}.") for t in range(60)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(queries.op12_rank_convergence_viterbi(spark, str(tmp_path))) == want(damaged(rows))
