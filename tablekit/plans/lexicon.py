"""A small English lemma dictionary ``(form, pos, lemma)``.

The lookup operator works with any dictionary of this shape (a full lexical
database exported as a table); this one holds the forms the tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values: (surface form, part of speech n/v, lemma).
LEMMAS = (
    ("dogs", "n", "dog"), ("pets", "n", "pet"), ("puppies", "n", "puppy"),
    ("diamonds", "n", "diamond"), ("governments", "n", "government"),
    ("questions", "n", "question"), ("answers", "n", "answer"), ("words", "n", "word"),
    ("children", "n", "child"), ("women", "n", "woman"), ("men", "n", "man"),
    ("stole", "v", "steal"), ("stolen", "v", "steal"), ("stealing", "v", "steal"),
    ("happened", "v", "happen"), ("happening", "v", "happen"), ("ran", "v", "run"),
    ("running", "v", "run"), ("went", "v", "go"), ("gone", "v", "go"),
    ("made", "v", "make"), ("making", "v", "make"), ("said", "v", "say"),
    ("worked", "v", "work"), ("working", "v", "work"), ("used", "v", "use"),
    ("using", "v", "use"), ("learned", "v", "learn"), ("learning", "v", "learn"),
    ("answering", "v", "answer"), ("asked", "v", "ask"), ("asking", "v", "ask"),
)


def lemma_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEMMAS), "form string, pos string, lemma string")
