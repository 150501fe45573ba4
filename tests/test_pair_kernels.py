"""Pairs of texts compared in blocks: exact, and long pairs in a short time."""

import random
import time

import pytest

from tablekit.functions.blocks import matched_length
from tablekit.functions.fuzzy import with_partial_ratio
from tablekit.functions.matching import with_matching_ratios
from tablekit.functions.windows import code_points, least_window_distances

from test_text_more import plain_blocks


def lev(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        new = [i]
        for j, e in enumerate(y, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != e)))
        row = new
    return row[-1]


def test_window_distances_of_unlike_lengths_in_one_block():
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abcé😀") for _ in range(n))
    pairs = [(word(m), word(n)) for m, n in [(1, 1), (1, 9), (7, 7), (16, 50), (30, 31)] + [(rnd.randint(1, 20), rnd.randint(20, 60)) for _ in range(150)]]
    got = least_window_distances([(code_points(a), code_points(b)) for a, b in pairs])
    assert got == [min(lev(a, b[j:j + len(a)]) for j in range(len(b) - len(a) + 1)) for a, b in pairs]


def test_long_pairs_take_one_pass(spark):
    rnd = random.Random(4)
    short = "".join(rnd.choice("abcdefgh ") for _ in range(4000))
    near = "".join(c if rnd.random() > 0.1 else "z" for c in short)
    long_ = "".join(rnd.choice("abcdefgh ") for _ in range(9000)) + near + "".join(rnd.choice("abcdefgh ") for _ in range(9000))
    df = spark.createDataFrame([(1, short, long_), (2, None, ""), (3, None, "a"), (4, "a", None)], "id int, a string, b string")
    began = time.time()
    got = {r["id"]: r["r"] for r in with_partial_ratio(df, "a", "b", "r").collect()}
    assert time.time() - began < 60
    assert got == {1: round((4000 - near.count("z")) * 100 / 4000), 2: 0, 3: None, 4: None}


@pytest.mark.parametrize("cells", [0, 40, 1 << 22])
def test_blocks_by_rows_and_by_table(monkeypatch, cells):
    monkeypatch.setattr("tablekit.functions.blocks.TABLE_CELLS", cells)
    rnd = random.Random(6)
    for _ in range(200):
        a, b = ("".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 30))) for _ in range(2))
        x, y = code_points(a), code_points(b)
        want = plain_blocks(a, b, False) * (len(a) + len(b)) / 2
        assert len(a) + len(b) == 0 or matched_length(x, y, x, y) == pytest.approx(want)


def test_blocks_of_long_pairs(spark):
    rnd = random.Random(7)
    text = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(3000))
    rows = [(i, text(), text()) for i in range(4)] + [(9, None, "a")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    began = time.time()
    got = {r["id"]: (r["p"], r["q"]) for r in with_matching_ratios(df, "a", "b", {"p": True, "q": False}).collect()}
    assert time.time() - began < 60 and got[9] == (None, None)
    for i, a, b in rows[:1]:
        assert got[i][1] == pytest.approx(plain_blocks(a, b, False), abs=1e-12)
