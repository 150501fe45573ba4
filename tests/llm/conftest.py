import random

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    """``docs(texts, extra=False)``: documents with the texts; with ``extra``,
    columns whose names the operators use themselves."""
    def make(texts, extra=False, start=0, langs=None, sources=None):
        rows = [(start + i, t, (langs or ["en"] * len(texts))[i], (sources or ["s"] * len(texts))[i], None if t is None else len(t))
                for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, DOC)
        if extra:
            from pyspark.sql import functions as F
            for name in ("id", "key", "row", "tokens", "score", "n", "comp", "slot", "part", "name", "size", "y", "gram", "log_ppl"):
                df = df.withColumn(name, F.lit(None).cast("int") if name != "row" else F.lit("x"))
        return df
    return make


SYLLABLES = "an be co du er fi ga ho in ja ka lo mi no".split()


@pytest.fixture(scope="session")
def prose():
    """``prose(n, seed)``: n invented words with line breaks."""
    def make(n, seed=0):
        rnd = random.Random(seed)
        words = ["".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 4))) for _ in range(n)]
        return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words)).replace(". ", ".\n", 3)
    return make


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}
