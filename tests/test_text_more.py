"""Matching blocks, stems, Treebank words and the full-join corpus against plain versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablekit.functions.matching import matching_ratio
from tablekit.functions.stemming import porter_stem
from tablekit.functions.text import split_ws
from tablekit.functions.treebank import rewrite_rules, sentence_rules, treebank_sentences, treebank_words
from tablekit.operators import tokens as TK


def plain_blocks(a, b, popular):
    """Matched characters by plain recursion over the longest blocks."""
    hidden = set()
    if popular and len(b) >= 200:
        hidden = {c for c, n in Counter(b).items() if n > len(b) // 100 + 1}

    def longest(alo, ahi, blo, bhi):
        best, run = (alo, blo, 0), {}
        for i in range(alo, ahi):
            now = {}
            for j in range(blo, bhi):
                if a[i] == b[j] and b[j] not in hidden:
                    k = now[j] = run.get(j - 1, 0) + 1
                    if k > best[2]:
                        best = (i - k + 1, j - k + 1, k)
            run = now
        i, j, n = best
        while i > alo and j > blo and a[i - 1] == b[j - 1]:
            i, j, n = i - 1, j - 1, n + 1
        while i + n < ahi and j + n < bhi and a[i + n] == b[j + n]:
            n += 1
        return i, j, n

    def matched(alo, ahi, blo, bhi):
        if alo >= ahi or blo >= bhi:
            return 0
        i, j, n = longest(alo, ahi, blo, bhi)
        return n and n + matched(alo, i, blo, j) + matched(i + n, ahi, j + n, bhi)

    return 2.0 * matched(0, len(a), 0, len(b)) / (len(a) + len(b)) if a or b else 1.0


def random_pairs(n, seed):
    rnd, out = random.Random(seed), []
    for i in range(n):
        letters = rnd.choice(["ab", "abcd", "abcdefghij é", "abcdefghijklmnopqrstuvwxyz 0123456789äöüß,."])
        a = "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 3, 10, 40, 90])))
        b = a
        for _ in range(rnd.randrange(8)):
            at = rnd.randrange(len(b) + 1)
            b = b[:at] + rnd.choice(["", "x", "ab", "é", "😀"]) + b[at + rnd.randrange(3):]
        if rnd.random() < 0.3:
            b = "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 5, 30, 210])))
        out.append((i, a, b))
    return out


@pytest.mark.parametrize("popular", [True, False])
def test_matching_blocks_on_500_pairs(spark, popular):
    rows = random_pairs(500, 21)
    rnd = random.Random(2)
    for i in range(20):  # around the length from which characters can be popular
        n = rnd.choice([199, 200, 201, 260])
        a = "".join(rnd.choice("abcdefghijklmnop" * 4 + "äöüßéèç" + chr(rnd.randrange(300, 600))) for _ in range(n))
        at = rnd.randrange(n)
        rows.append((500 + i, a, a[:at] + "".join(chr(rnd.randrange(97, 300)) for _ in range(rnd.randrange(60))) + a[rnd.randrange(n):]))
    df = spark.createDataFrame(rows, "id int, a string, b string").repartition(8)
    got = dict(df.select("id", matching_ratio("a", "b", popular)).collect())
    for i, a, b in rows:
        assert got[i] == pytest.approx(plain_blocks(a, b, popular), abs=1e-12), (a, b)


def test_matching_blocks_of_nulls_and_long_equal_texts(spark):
    same = "the same words again " * 400
    rows = [(None, "a"), ("a", None), ("", ""), ("", "a"), (same, same)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(matching_ratio("a", "b")).collect()] == [None, None, 1.0, 0.0, 1.0]


# Published examples of the algorithm's steps and their stems.
STEMS = {
    "caresses": "caress", "ponies": "poni", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
    "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz",
    "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "valenci": "valenc", "hesitanci": "hesit", "digitizer": "digit", "conformabli": "conform",
    "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam",
    "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac",
    "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "homologou": "homolog", "communism": "commun",
    "activate": "activ", "angulariti": "angular", "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
}


def test_porter_stems(spark):
    df = spark.createDataFrame([(w,) for w in STEMS], "w string")
    for extended in (False, True):
        assert dict(df.select("w", porter_stem("w", extended)).collect()) == STEMS
    odd = spark.createDataFrame([("ties",), ("dying",), ("enjoy",), ("by",), ("S",), ("",), (None,), ("Skies",), ("größen",)], "w string")
    got = {r[0]: (r[1], r[2]) for r in odd.select("w", porter_stem("w", False), porter_stem("w")).collect()}
    assert got == {"ties": ("ti", "tie"), "dying": ("dy", "die"), "enjoy": ("enjoi", "enjoy"), "by": ("by", "by"), "S": ("s", "s"),
                   "": ("", ""), None: (None, None), "Skies": ("ski", "sky"), "größen": ("größen", "größen")}


def test_map_words_keeps_order_and_rows_without_words(spark):
    df = spark.createDataFrame([(1, ["cats", "cat", "cats"]), (2, []), (3, None)], "id int, w array<string>")
    assert {r["id"]: r["words"] for r in TK.map_words(df, "id", "w", porter_stem).collect()} == {1: ["cat", "cat", "cat"], 2: [], 3: []}


def test_treebank_words(spark):
    want = {
        "Good muffins cost $3.88 in New York.  Please buy me two of them. Thanks.":
            ["Good", "muffins", "cost", "$", "3.88", "in", "New", "York", ".", "Please", "buy", "me", "two", "of", "them", ".", "Thanks", "."],
        "They'll save and invest more.": ["They", "'ll", "save", "and", "invest", "more", "."],
        "hi, my name can't hello,": ["hi", ",", "my", "name", "ca", "n't", "hello", ","],
        'He said, "I cannot go." Dr. Smith isn\'t (really) here -- no...':
            ["He", "said", ",", "``", "I", "can", "not", "go", ".", "''", "Dr.", "Smith", "is", "n't", "(", "really", ")", "here", "--", "no", "..."],
        "Gimme more'n that; wanna go? 'Twas 3:15.":
            ["Gim", "me", "more", "'n", "that", ";", "wan", "na", "go", "?", "'T", "was", "3:15", "."],
        "cannot cannot": ["can", "not", "can", "not"], "": [], " \n ": [],
    }
    df = spark.createDataFrame([(t,) for t in want], "t string")
    assert dict(df.select("t", treebank_words("t")).collect()) == want
    both = df.select("t", treebank_sentences("t")).collect()
    assert {t: len(s) for t, s in both}["Good muffins cost $3.88 in New York.  Please buy me two of them. Thanks."] == 3


def test_treebank_rules_are_skipped_only_where_they_find_nothing(spark):
    rnd = random.Random(5)
    bits = ['"', "''", "``", "'", ". ", ".", "...", ", ", ",", ":", "; ", "?", "! ", "(", ")", "[", "--", "\n", "A", "a", "9", "$", "é", "\U0001d4b3", "Mr", "Dr",
            "e.g", "u.s", "No", "cannot", "can", "not", "d'ye", "Gimme", "gonna", "gotta", "LEMME", "more'n", "wanna", "'tis", "'Twas", "n't", "'ll",
            "'S", "I'm", "Smith", "it's ", "x.\" ", ".)", "_", "\x02", "St. "]
    texts = ["".join(rnd.choice(bits) + rnd.choice(["", "", " "]) for _ in range(rnd.randint(0, 20))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").repartition(8)

    def plain(text, rules):
        for pattern, new in rules:
            text = F.regexp_replace(text, pattern, new.replace("\\", "$"))
        return text

    parts = F.split(plain(F.col("t"), sentence_rules()), "\x01")
    parts = F.filter(F.transform(parts, lambda s: F.regexp_replace(s, r"^\s+|\s+\z", "")), lambda s: s != "")
    want = df.select("t", parts.alias("s")).withColumn("w", F.flatten(F.transform("s", lambda s: split_ws(plain(s, rewrite_rules())))))
    unlike = want.filter(~(F.col("s").eqNullSafe(treebank_sentences("t")) & F.col("w").eqNullSafe(treebank_words("t"))))
    assert [tuple(r) for r in unlike.limit(3).collect()] == []
    # nearly all rules are behind a test of what they need
    plan = df.select(treebank_words("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN") >= 10


@pytest.fixture(scope="module")
def token_pairs(spark):
    rnd = random.Random(9)
    texts = [["a", "b", "a"], ["b"], ["c", "a"], [], ["a", "b", "a"], ["d", "d"], None]
    rows = [(i, rnd.choice(texts), rnd.choice(texts)) for i in range(120)] + [(200, ["x", "only", "left"], ["y", "only", "right"])]
    return spark.createDataFrame(rows, "id int, t1 array<string>, t2 array<string>")


def test_corpus_equals_a_true_full_join(spark, token_pairs):
    a, b = token_pairs.select(F.col("t1").alias("words")), token_pairs.select(F.col("t2").alias("words"))
    joined = a.join(b, "words", "full")
    want = Counter(None if r[0] is None else tuple(r[0]) for r in joined.collect())
    corpus = TK.full_join_corpus(token_pairs, "t1", "t2")
    assert {None if r["tokens"] is None else tuple(r["tokens"]): r["times"] for r in corpus.collect()} == want
    df, total = Counter(), Counter()
    for words, n in want.items():
        for w in set(words or ()):
            df[w] += n
        for w in words or ():
            total[w] += n
    got = {r["term"]: (r["df"], r["total"]) for r in TK.corpus_vocabulary(corpus, min_df=2.0).collect()}
    assert got == {w: (df[w], total[w]) for w in df if df[w] >= 2}
    least = 0.3 * sum(want.values())
    assert {r["term"] for r in TK.corpus_vocabulary(corpus, min_df=0.3).collect()} == {w for w in df if df[w] >= least}
    top = {r["term"] for r in TK.corpus_vocabulary(corpus, vocab_size=2).collect()}
    assert top == set(sorted(total, key=lambda w: (-total[w], w))[:2])


def test_full_join_distance(spark, token_pairs):
    import math
    corpus = {None if r["tokens"] is None else tuple(r["tokens"]): r["times"] for r in TK.full_join_corpus(token_pairs, "t1", "t2").collect()}
    m, df = sum(corpus.values()), Counter()
    for words, n in corpus.items():
        for w in set(words or ()):
            df[w] += n
    got = {r["id"]: r["dist"] for r in TK.tfidf_pair_distance(token_pairs, "id", "t1", "t2", min_df=2.0, corpus_mode="fulljoin").collect()}
    for r in token_pairs.collect():
        one, two = Counter(r["t1"] or ()), Counter(r["t2"] or ())
        want = sum(((one[w] - two[w]) * math.log((m + 1) / (df[w] + 1))) ** 2 for w in set(one) | set(two) if df[w] >= 2)
        assert got[r["id"]] == pytest.approx(want, abs=1e-9)
    with pytest.raises(ValueError):
        TK.tfidf_pair_distance(token_pairs, "id", "t1", "t2", corpus_mode="other")
