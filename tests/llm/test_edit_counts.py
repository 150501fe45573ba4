"""Counts after edits against a count of the edited text from its beginning."""

import random

import numpy as np
import public_tokenizers

from tablekit.llm import edit_counts as E
from tablekit.llm.bpe_bitmap import Coder, _Numbers, tokenizer_file


def coder():
    return Coder.of(tokenizer_file(), public_tokenizers.PATTERN)


def applied(text, edits):
    for at, gone, new in edits:
        at = min(max(0, at), len(text))
        text = text[:at] + new + text[at + max(0, gone):]
    return text


def planted(text, c, numbers):
    pieces = c.split(text)
    toks = [len(c.encode([p])[0]) for p in pieces]
    return E.Document(text, np.array([len(p) for p in pieces], np.int64), np.array(toks, np.int64), E.even(len(pieces)), c, numbers)


def test_random_edits_give_the_split_of_the_edited_text():
    c, rnd, letters = coder(), random.Random(3), "ab é's  \n\tl!?09r'ev漢"
    for _ in range(300):
        text = "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 5, 40, 900])))
        edits = [(rnd.randint(0, 950), rnd.choice([0, 0, 1, 3, 200]), "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 2, 9, 300, 4000]))))
                 for _ in range(rnd.randint(1, 5))]
        numbers = _Numbers()
        d = planted(text, c, numbers)
        for e in edits:
            d.edit(*e)
        want = applied(text, edits)
        assert d.text == want
        per_piece = np.diff(c.merge([p.encode() for p in numbers])[1])
        lens, toks, leaves, total = d.state(per_piece)
        split = c.split(want)
        assert lens.tolist() == [len(p) for p in split] and d.n_pieces == len(split) and leaves.sum() == len(split)
        assert toks.tolist() == [len(c.encode([p])[0]) for p in split]
        assert (total, d.chars.total) == (len(c.encode([want])[0]), len(want))


def test_an_edit_touches_a_path_only():
    c, numbers = coder(), _Numbers()
    d = planted("some words in a row " * 50_000, c, numbers)
    d.edit(500_000, 3, "other")
    assert d.redone <= 6 and d.paths <= 2 * len(d.chars.levels) and len(d.changed) <= 2


def test_leaves_stay_small():
    c, numbers = coder(), _Numbers()
    d = planted("a b c", c, numbers)
    for i in range(60):
        d.edit(3, 0, " more words come in here" * 20)
    assert max(d.flattened()[2]) <= E.LARGEST and d.n_leaves > 10


def test_kept_trees_are_edited_again(spark, docs, prose):
    """Two rounds of edits on kept trees are as trees planted from the edited texts."""
    from pyspark.sql import functions as F
    texts = [prose(300, 1), "", "x y", prose(2000, 2)]
    kept = E.plant(docs(texts))
    for _ in range(2):
        kept = E.regrow(kept.withColumn("edits", E.sample_edits())).drop("old_chars", "old_pieces", "old_tokens", "redone_pieces", "updated_nodes")
    fresh = {r["doc_id"]: r for r in E.plant(kept.select("doc_id", "text")).collect()}
    for r in kept.collect():
        f = fresh[r["doc_id"]]
        assert all(r[c] == f[c] for c in ("text", "n_chars", "n_pieces", "n_tokens", "lens", "toks"))
        assert sum(r["leaves"]) == r["n_pieces"]
    little = E.regrow(E.plant(docs([prose(3000, 5)])).withColumn("edits", F.expr("array(named_struct('at', 900, 'gone', 2, 'new', 'zz'))"))).first()
    assert little["redone_pieces"] < 8 and little["n_pieces"] > 2000


def test_table(spark, docs, prose):
    from pyspark.sql import functions as F
    texts = [None, "", "x", prose(400, 1), prose(400, 1), "a" * 5000, " \n " * 300]
    df = docs(texts, extra=True).withColumn("edits", E.sample_edits())
    got = {r["doc_id"]: r for r in E.recount(E.plant(df, carry=["edits"])).collect()}
    scripts = {r["doc_id"]: [(e["at"], e["gone"], e["new"]) for e in r["edits"]] for r in df.collect()}
    c = coder()
    for i, t in enumerate(texts):
        want = applied(t or "", scripts[i])
        r = got[i]
        assert (r["n_chars"], r["n_pieces"], r["n_tokens"]) == (len(t or ""), len(c.split(t or "")), len(c.encode([t or ""])[0]))
        assert (r["edited_chars"], r["edited_pieces"], r["edited_tokens"]) == (len(want), len(c.split(want)), len(c.encode([want])[0]))
    assert got[3]["edited_tokens"] == got[4]["edited_tokens"]
    assert E.recount(E.plant(docs([])).withColumn("edits", E.sample_edits())).count() == 0
    odd = spark.createDataFrame([(1, "abc def", None), (2, "abc def", [(None, None, None), None, (99, 5, "!")]), (3, "abc", [(-4, 2, "z")])],
                                "doc_id bigint, text string, edits array<struct<at:int,gone:int,new:string>>")
    got = {r["doc_id"]: r for r in E.recount(E.plant(odd, carry=["edits"])).collect()}
    assert got[1]["edited_chars"] == 7 and got[2]["edited_chars"] == 8 and got[3]["edited_chars"] == 2
