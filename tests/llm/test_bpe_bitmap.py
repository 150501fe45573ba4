"""Byte-level BPE against tiktoken, and exact round trips."""

import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken

from tablekit.llm import bpe_bitmap as B

ROWS = [None, "", " ", "a", "It's  the\n\nend's 漢字 😀 x\t ", "aaabaaab" * 300, "ab" * 5000, "é" * 999, "\x02\r\n\x0b"]


def coder():
    return B.Coder.of(B.tokenizer_file(), public_tokenizers.PATTERN)


def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder().ranks, special_tokens={})


def test_random_texts_match_the_public_library():
    rnd, enc, c = random.Random(1), reference(), coder()
    texts = ["".join(rnd.choice("abé 'sl\n\t  漢字😀09") for _ in range(rnd.randint(0, 90))) for _ in range(1500)]
    texts += ["".join(rnd.choice("aeinrst") for _ in range(rnd.randint(20, 500))) for _ in range(300)]
    ids, at = c.encode(texts)
    for i, t in enumerate(texts):
        own = ids[at[i]:at[i + 1]]
        assert own.tolist() == enc.encode_ordinary(t)
        assert c.decode(own)[0].tobytes().decode() == t


def test_pre_tokens_of_many_texts_are_the_patterns_matches():
    rnd, c = random.Random(7), coder()
    some = [" ", "  ", "\n", "\t", " \n", "\u00a0", "\u3000", "\x1c", "\x85", "a", "don't", "'s", "'", "'r", "e", "l", "'l", "'ve", "'d", "é", "e\u0301", "漢字", "😀", "²", "Ⅷ", "12", "...", "bar,"]
    texts = ["", " ", "'", "x'", "'s", ""] + ["".join(rnd.choice(some) for _ in range(rnd.randrange(12))) for _ in range(5000)]
    column = pa.array(texts, pa.string())
    found, ends = c.pieces(column)
    found = [p.decode() for p in found.to_pylist()]
    assert [found[a:b] for a, b in zip([0, *ends[:-1]], ends)] == [c.split(t) for t in texts]
    for part in (column, column.slice(3, 900), column[:1], column[:0], pa.array(["a b", None, "c"])):
        (ids, at), (same, begin) = c.encode([t or "" for t in part.to_pylist()]), c.encode_at_once(part)
        assert ids.tolist() == same.tolist() and at.tolist() == begin.tolist()


def test_merges_of_one_piece_by_the_definition():
    """Lowest rank first, leftmost first, one merge at a time."""
    c, rnd = coder(), random.Random(5)
    for _ in range(300):
        piece = bytes(rnd.choice(b"ainst'ero") for _ in range(rnd.randint(1, 40)))
        parts = [bytes([b]) for b in piece]
        while piece not in c.ranks:
            best = min(((c.ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in c.ranks), default=None)
            if best is None:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        want = [c.ranks[piece]] if piece in c.ranks else [c.ranks[p] for p in parts]
        assert c.merge([piece])[0].tolist() == want


def test_long_pre_token_takes_linear_steps():
    ids, _ = coder().encode(["xyq" * 100_000])
    assert len(ids) > 100_000


def test_column_edge_rows(spark, docs):
    out = {r["doc_id"]: r for r in B.encode_column(docs(ROWS + [ROWS[4]], extra=True)).collect()}
    enc = reference()
    assert len(out) == len(ROWS) + 1
    for i, t in enumerate(ROWS + [ROWS[4]]):
        ids = enc.encode_ordinary(t or "")
        raw = np.array(ids, "<u4").tobytes()
        assert (out[i]["n_tokens"], bytes(out[i]["ids"])) == (len(ids), raw)
        assert out[i]["ids_sha256"] == sha256(raw).hexdigest()
        assert out[i]["decoded_sha256"] == sha256((t or "").encode()).hexdigest()
    assert B.encode_column(docs([])).count() == 0


def test_slices_of_any_size_give_the_same_ids(spark, docs, prose):
    from tablekit.llm import bpe_bitmap
    df = docs([prose(i % 70, i) for i in range(60)] + [None, "", prose(3000, 1)]).coalesce(2)
    want = sorted(map(tuple, bpe_bitmap.encode_column(df).collect()))
    assert want == sorted(map(tuple, bpe_bitmap.encode_column(df, slice_bytes=500).collect()))
