"""The 21-column text-pair feature table, with no Python UDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ngrams as NG
from ..functions import text as TX
from ..operators import tokens as TK
from ..session import cut_lineage

# The names and order of the feature table's columns.
FEATURE_NAMES = ['lWCount1', 'lWCount2', 'qWCount1', 'qWCount2', 'lLen1', 'lLen2', 'qLen1', 'qLen2',
                 'lWCount_ratio', 'qWCount_ratio', 'lLen_ratio', 'qLen_ratio',
                 'qNgrams_1', 'qNgrams_2', 'qNgrams_3', 'lNgrams_1', 'lNgrams_2', 'lNgrams_3',
                 'qUnigram_ratio', 'lUnigram_ratio', 'tfidfDistance']


def lemmatize_columns(df: DataFrame, key: str, words: dict, lemmas: DataFrame,
                      min_len: int = 0, keep_input: bool = True) -> DataFrame:
    """For each ``name -> word-array expression``, add ``name``: the words
    lemmatised by dictionary and space-joined. All columns are stacked with a
    side tag and go through one explode/lookup pass and one regroup by the
    unique ``key`` (no pivot shuffle). ``keep_input=True`` joins the result to
    ``df`` once; ``keep_input=False`` returns only ``key`` and the new columns."""
    names = list(words)
    stacked = None
    for i, n in enumerate(names):
        part = df.select(key, F.lit(i).alias("_side"), F.posexplode_outer(words[n]).alias("_pos", "_w"))
        stacked = part if stacked is None else stacked.unionByName(part)
    ex = TK.lookup_lemmas(stacked, "_w", lemmas, "_lem", min_len)
    grouped = ex.groupBy(key).agg(F.array_sort(F.collect_list(
        F.when(F.col("_pos").isNotNull(), F.struct("_side", "_pos", "_lem")))).alias("_s"))
    def side_text(i):
        # one-argument lambda: a second parameter would be the array index
        return F.array_join(F.transform(F.filter("_s", lambda s: s["_side"] == i), lambda s: s["_lem"]), " ")
    wide = grouped.select(key, *[side_text(i).alias(n) for i, n in enumerate(names)])
    return df.join(wide, key) if keep_input else wide


def with_lemmas(pairs: DataFrame, lemmas: DataFrame, key: str = "id",
                q1: str = "question1", q2: str = "question2") -> DataFrame:
    """Add ``lemma1``/``lemma2``: content words (stop words and non-alphabetic
    tokens removed), lemmatised by dictionary, space-joined."""
    return lemmatize_columns(pairs, key, {"lemma1": TX.content_words(q1), "lemma2": TX.content_words(q2)},
                             lemmas)


def normalized_pairs(pairs: DataFrame, lemmas: DataFrame, key: str = "id",
                     q1: str = "question1", q2: str = "question2") -> DataFrame:
    """``(key, q1, q2)``: normalised texts whose words of 4+ characters are
    lemmatised (noun, then verb) by dictionary."""
    norm = pairs.select(key, TX.normalize(q1).alias("_n1"), TX.normalize(q2).alias("_n2"))
    return lemmatize_columns(norm, key, {"q1": TX.split_ws("_n1"), "q2": TX.split_ws("_n2")},
                             lemmas, min_len=4, keep_input=False)


def pair_features(pairs: DataFrame, lemmas: DataFrame, key: str = "id",
                  q1: str = "question1", q2: str = "question2", min_df: float = 2.0) -> DataFrame:
    # the lemma table feeds both the row features and the TF-IDF corpus:
    # materialise it once (reliable checkpoint) instead of recomputing it
    lp = cut_lineage(with_lemmas(pairs, lemmas, key, q1, q2))
    c = {
        "lWCount1": TX.words_spaces_plus_one("lemma1"), "lWCount2": TX.words_spaces_plus_one("lemma2"),
        "qWCount1": TX.words_spaces_plus_one(q1), "qWCount2": TX.words_spaces_plus_one(q2),
        "lLen1": F.length("lemma1"), "lLen2": F.length("lemma2"),
        "qLen1": F.length(q1), "qLen2": F.length(q2),
    }
    f = lp.select(key, *[v.alias(k) for k, v in c.items()],
                  NG.ngram_words(q1).alias("_qw1"), NG.ngram_words(q2).alias("_qw2"),
                  NG.ngram_words("lemma1").alias("_lw1"), NG.ngram_words("lemma2").alias("_lw2"))
    f = f.select(
        key, *c.keys(),
        TX.sym_ratio("lWCount1", "lWCount2").alias("lWCount_ratio"),
        TX.sym_ratio("qWCount1", "qWCount2").alias("qWCount_ratio"),
        TX.sym_ratio("lLen1", "lLen2").alias("lLen_ratio"),
        TX.sym_ratio("qLen1", "qLen2").alias("qLen_ratio"),
        *[NG.common_ngrams("_qw1", "_qw2", n).alias(f"qNgrams_{n}") for n in (1, 2, 3)],
        *[NG.common_ngrams("_lw1", "_lw2", n).alias(f"lNgrams_{n}") for n in (1, 2, 3)])
    f = (f.withColumn("qUnigram_ratio", NG.unigram_ratio("qNgrams_1", "qWCount1", "qWCount2"))
          .withColumn("lUnigram_ratio", NG.unigram_ratio("lNgrams_1", "lWCount1", "lWCount2")))
    toks = lp.select(key, TX.tokenize("lemma1").alias("t1"), TX.tokenize("lemma2").alias("t2"))
    dist = TK.tfidf_pair_distance(toks, key, "t1", "t2", min_df=min_df)
    return f.join(dist.withColumnRenamed("dist", "tfidfDistance"), key).select(key, *FEATURE_NAMES)
