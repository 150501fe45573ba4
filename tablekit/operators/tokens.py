"""Token-table operators: explode, join, regroup.

Per-row arrays are exploded with their position, joined against a lookup,
and rebuilt in position order. A regrouped array holds one text's tokens, so
its size is bounded by that text, not by the table.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import collapse_flagged
from ..functions.text import split_ws
from ..session import cut_lineage
from .ordering import dense_index, desc

# The default characters a frequency tokenizer treats as
# separators (punctuation, tab and newline).
TOKENIZER_FILTERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"


def filtered_words(col):
    """Lower case, filter characters become separators, split on spaces."""
    c = F.col(col) if isinstance(col, str) else col
    cls = "[" + "".join("\\" + ch if ch in "[]\\^-" else ch for ch in TOKENIZER_FILTERS) + "]"
    return split_ws(F.regexp_replace(F.lower(c), cls, " "))


def lookup_lemmas(exploded: DataFrame, word: str, lemmas: DataFrame, name: str = "_lem",
                  min_len: int = 0) -> DataFrame:
    """Add ``name``: ``word`` replaced by its noun lemma, then that by its verb
    lemma, from a ``(form, pos, lemma)`` dictionary; misses pass through;
    words shorter than ``min_len`` are left alone. No broadcast hint: a small
    dictionary is broadcast by its measured size."""
    nouns = lemmas.filter(F.col("pos") == "n").select(F.col("form").alias("_lw"), F.col("lemma").alias("_ln"))
    verbs = lemmas.filter(F.col("pos") == "v").select(F.col("form").alias("_lw1"), F.col("lemma").alias("_lv"))
    w = F.col(word)
    ex = exploded.join(nouns, w == F.col("_lw"), "left").withColumn(
        "_lw1", F.when(F.length(w) < min_len, w).otherwise(F.coalesce("_ln", w)))
    ex = ex.join(verbs, "_lw1", "left").withColumn(
        name, F.when(F.length(w) < min_len, w).otherwise(F.coalesce("_lv", "_lw1")))
    return ex.drop("_lw", "_ln", "_lw1", "_lv")


def _replace_words(df: DataFrame, key: str, words: str, name: str, change) -> DataFrame:
    """``(key, name)``: the words of the array column ``words`` with those replaced that
    ``change`` gives: of rows ``(key, _w)``, a text's distinct words, it makes ``(key, _w, _new)``
    for the words that become others. Texts are dealt by their unique key once; only
    changed words are gathered to a text, as a map, and the text's array is never
    taken apart and put together again. No words give an empty array."""
    rows = df.select(key, F.coalesce(F.col(words), F.array().cast("array<string>")).alias("_ws")).repartition(key)
    new = change(rows.select(key, F.explode(F.array_distinct("_ws")).alias("_w")))
    maps = new.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_w", "_new"))).alias("_m"))
    whole = rows.join(maps, key, "left")
    return whole.select(key, F.when(F.col("_m").isNull(), F.col("_ws")).otherwise(
        F.transform("_ws", lambda w: F.coalesce(F.try_element_at("_m", w), w))).alias(name))


def lemmatize(df: DataFrame, key: str, words: str, lemmas: DataFrame, name: str = "lemmas",
              min_len: int = 0, keep_input: bool = True) -> DataFrame:
    """Replace each word of the array column ``words`` by its lemma
    (``lookup_lemmas`` of a text's distinct words); rows with no words get an empty array.
    ``keep_input=False`` returns ``(key, name)`` with no join back to ``df``."""
    def change(ex):
        return lookup_lemmas(ex, "_w", lemmas, "_new", min_len).filter(F.col("_new") != F.col("_w"))
    g = _replace_words(df, key, words, name, change)
    return df.join(g, key, "left") if keep_input else g


def map_words(df: DataFrame, key: str, words: str, change, name: str = "words") -> DataFrame:
    """``(key, name)``: each word of the array column ``words`` replaced by
    ``change`` of it, a column expression applied once to every distinct word. The
    changed words are written first, so that a frequent word's partition can be
    split in the join back; rows without words get an empty array."""
    ex = df.select(key, F.posexplode_outer(words).alias("_pos", "_w"))
    changed = cut_lineage(ex.select("_w").filter(F.col("_w").isNotNull()).distinct().withColumn("_new", change(F.col("_w"))))
    g = ex.join(changed, "_w", "left").groupBy(key).agg(F.array_sort(F.collect_list(
        F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_new")))).alias("_s"))
    return g.select(key, F.transform("_s", lambda s: s["_new"]).alias(name))


def vocabulary(texts: DataFrame, text_cols: list[str], min_df: int, tokens=split_ws) -> DataFrame:
    """Words occurring in at least ``min_df`` distinct texts, over the
    distinct union of the text columns."""
    allt = None
    for c in text_cols:
        t = texts.select(F.col(c).alias("text"))
        allt = t if allt is None else allt.unionByName(t)
    distinct = allt.filter(F.col("text").isNotNull()).distinct()
    words = distinct.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("word"))
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
            .filter(F.col("df") >= min_df))


def _explode_sides(df: DataFrame, key: str, cols: dict) -> DataFrame:
    """``(key, _side, _pos, _tok)``: one row per token of each column
    (``out_name -> column``), sides numbered in order. The outer explode keeps
    one row with a null position for a column without tokens, so a regroup by
    the unique ``key`` sees every row and needs no join back."""
    out = None
    for i, col in enumerate(cols.values()):
        c = F.col(col) if isinstance(col, str) else col
        part = df.select(key, F.lit(i).alias("_side"), F.posexplode_outer(c).alias("_pos", "_tok"))
        out = part if out is None else out.unionByName(part)
    return out


def _collect_sides(ex: DataFrame, key: str, keep: Column, *fields: str) -> DataFrame:
    """``(key, _s)``: per key, the ``(_side, _pos, *fields)`` of the rows
    where ``keep`` holds, in side and position order (bounded by the row's
    token count; the key is unique, so no group is hot)."""
    return ex.groupBy(key).agg(F.array_sort(F.collect_list(
        F.when(F.col("_pos").isNotNull() & keep, F.struct("_side", "_pos", *fields)))).alias("_s"))


def _side(i: int, field: str) -> Column:
    return F.transform(F.filter("_s", lambda s: s["_side"] == i), lambda s: s[field])


def collapse_rare_columns(df: DataFrame, key: str, cols: dict, vocab: DataFrame,
                          placeholder: str = "suspense", keep_last: int = 30) -> DataFrame:
    """``(key, *out_names)``: for each token column (``out_name -> column``),
    runs of out-of-vocabulary words become one ``placeholder`` and the last
    ``keep_last`` tokens are kept; no tokens give an empty array. A token is
    in vocabulary when it is a ``word`` of ``vocab`` or the placeholder itself,
    which is added to it. All columns go through one explode/lookup pass and
    one regroup; the vocabulary is written first, so that the lookup's inputs
    are plain shuffles and a frequent token's partition can be split."""
    ex = _explode_sides(df, key, cols)
    v = cut_lineage(vocab.select(F.col("word").alias("_tok")).filter(F.col("_tok") != placeholder).distinct()
                    .withColumn("_oov", F.lit(False)))
    ex = ex.join(v, "_tok", "left").withColumn("_oov", F.coalesce("_oov", F.col("_tok") != placeholder, F.lit(True)))
    g = _collect_sides(ex, key, F.lit(True), "_tok", "_oov")
    names = list(cols)
    # token and flag arrays become columns before the lambdas that index them
    arrays = g.select(key, *[_side(i, "_tok").alias(f"_t{i}") for i in range(len(names))],
                      *[_side(i, "_oov").alias(f"_f{i}") for i in range(len(names))])
    return arrays.select(key, *[collapse_flagged(F.col(f"_t{i}"), F.col(f"_f{i}"), placeholder, keep_last)
                                .alias(n) for i, n in enumerate(names)])


def collapse_rare(df: DataFrame, key: str, tokens: str, vocab: DataFrame,
                  placeholder: str = "suspense", keep_last: int = 30, name: str = "prepared") -> DataFrame:
    """``(key, name)``: ``collapse_rare_columns`` for one token column."""
    return collapse_rare_columns(df, key, {name: tokens}, vocab, placeholder, keep_last)


def word_index(df: DataFrame, tokens: str) -> DataFrame:
    """``(word, n, index)``: words numbered from 1 by descending corpus count,
    ties by word. Numbering is a distributed ordered scan."""
    counts = (df.select(F.explode(tokens).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    return dense_index(counts, [desc("n"), "word"], name="index")


def encode_columns(df: DataFrame, key: str, cols: dict, index: DataFrame) -> DataFrame:
    """``(key, *out_names)``: each token column (``out_name -> column``) with
    words replaced by their index, in order; words without an index are
    dropped. One explode/lookup pass and one regroup for all columns; the
    lookup is a left join so rows whose words all miss keep an empty array."""
    ex = _explode_sides(df, key, cols)
    ex = ex.join(index.select(F.col("word").alias("_tok"), F.col("index").alias("_idx")), "_tok", "left")
    g = _collect_sides(ex, key, F.col("_idx").isNotNull(), "_idx")
    return g.select(key, *[_side(i, "_idx").alias(n) for i, n in enumerate(cols)])


def encode(df: DataFrame, key: str, tokens: str, index: DataFrame, name: str = "seq") -> DataFrame:
    """``(key, name)``: ``encode_columns`` for one token column."""
    return encode_columns(df, key, {name: tokens}, index)


def embedding_matrix(index: DataFrame, vectors: DataFrame, dim: int,
                     key: str = "index", vec: str = "vec") -> DataFrame:
    """One row per vocabulary index; the vector of that word or zeros."""
    return (index.select(key).join(vectors.select(key, vec), key, "left")
            .select(key, F.coalesce(F.col(vec), F.array_repeat(F.lit(0.0), dim)).alias(vec)))


def term_counts(docs: DataFrame, key: str, tokens: str, min_df: float = 1.0,
                min_tf: float = 1.0, vocab_size: int | None = None, binary: bool = False):
    """Relational count-vectorizer: returns ``(vocab, counts)`` where vocab is
    ``(term, df, total)`` after the document-frequency filter (and, if the
    caller names a ``vocab_size``, the terms of the largest corpus counts), written to the
    shared folder, and counts is
    ``(key, term, tf)`` restricted to the vocabulary.

    ``min_df``/``min_tf`` >= 1 are absolute counts, < 1 are fractions (of
    documents / of the document's token count)."""
    ex = docs.select(key, F.explode(tokens).alias("term"))
    per_doc = ex.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    if min_tf >= 1:
        kept = per_doc.filter(F.col("tf") >= min_tf)
    else:
        sizes = docs.select(key, F.size(tokens).alias("_len"))
        kept = per_doc.join(sizes, key).filter(F.col("tf") >= F.col("_len") * min_tf).drop("_len")
    stats = per_doc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    if min_df >= 1:
        stats = stats.filter(F.col("df") >= min_df)
    else:
        n_docs = docs.agg(F.count(F.lit(1))).scalar()
        stats = stats.filter(F.col("df") >= n_docs * min_df)
    # ranks by a distributed ordered scan, not a top-k merged in one task
    vocab = stats if vocab_size is None else (
        dense_index(stats, [desc("total"), "term"], name="_rank")
        .filter(F.col("_rank") <= vocab_size).drop("_rank"))
    # written: the join's inputs are plain shuffles, and a hot term's
    # partition can be split
    vocab = cut_lineage(vocab)
    counts = kept.join(vocab.select("term"), "term", "left_semi")
    if binary:
        counts = counts.withColumn("tf", F.lit(1).cast("long"))
    return vocab, counts


def idf_weights(vocab: DataFrame, n_docs) -> DataFrame:
    """``idf = ln((m + 1) / (df + 1))`` per vocabulary term."""
    return vocab.select("term", F.ln((F.lit(n_docs) + 1) / (F.col("df") + 1)).alias("idf"))


def full_join_corpus(pairs_tokens: DataFrame, tokens1: str, tokens2: str) -> DataFrame:
    """``(tokens, times)``: the documents of a full outer join of the two token
    columns on equal arrays, without its pairs. An array that stands m times on the left
    and n times on the right makes m * n rows of the join, or m + n where one side lacks it
    (a NULL array equals none); counting both sides in one aggregate gives every
    distinct array and how often it occurs."""
    both = (pairs_tokens.select(F.col(tokens1).alias("tokens"), F.lit(1).alias("_l"), F.lit(0).alias("_r"))
            .unionByName(pairs_tokens.select(F.col(tokens2).alias("tokens"), F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    counts = both.groupBy("tokens").agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    met = F.col("tokens").isNotNull() & (F.col("_l") > 0) & (F.col("_r") > 0)
    return counts.select("tokens", F.when(met, F.col("_l") * F.col("_r")).otherwise(F.col("_l") + F.col("_r")).alias("times"))


def corpus_vocabulary(corpus: DataFrame, tokens: str = "tokens", times: str = "times", min_df: float = 1.0,
                      vocab_size: int | None = None) -> DataFrame:
    """``(term, df, total)`` of a corpus whose documents carry a multiplicity: a
    document counts ``times`` times. ``min_df`` and ``vocab_size`` as in
    ``term_counts``."""
    places = corpus.select(F.col(times).alias("_n"), F.col(tokens).alias("_t"), F.posexplode(tokens).alias("_pos", "term"))
    # a document counts for a term at the term's first place
    new = F.array_position("_t", F.col("term")) == F.col("_pos") + 1
    stats = places.groupBy("term").agg(F.sum(F.when(new, F.col("_n"))).alias("df"), F.sum("_n").alias("total"))
    if min_df >= 1:
        stats = stats.filter(F.col("df") >= min_df)
    else:
        stats = stats.filter(F.col("df") >= corpus.agg(F.sum(times)).scalar() * min_df)
    if vocab_size is not None:
        stats = dense_index(stats, [desc("total"), "term"], name="_rank").filter(F.col("_rank") <= vocab_size).drop("_rank")
    return cut_lineage(stats.select("term", "df", "total"))


def tfidf_pair_distance(pairs_tokens: DataFrame, key: str, tokens1: str, tokens2: str,
                        min_df: float = 2.0, corpus_mode: str = "union",
                        vocab_size: int | None = None) -> DataFrame:
    """Squared Euclidean distance between the TF-IDF vectors of two texts of
    a pair. The corpus that vocabulary and document frequencies come from is the
    bag union of both token columns (``corpus_mode="union"``, each text is a
    document) or their full outer join on equal arrays (``"fulljoin"``, counted
    by ``full_join_corpus``). Sparse vectors are ``(key, term, weight)`` rows, combined
    per ``(key, term)`` by aggregation. Returns ``(key, dist)`` for every
    key."""
    if corpus_mode not in ("union", "fulljoin"):
        raise ValueError(f"unknown corpus mode {corpus_mode!r}")
    side = F.lit
    pairs_tokens = pairs_tokens.select(key, tokens1, tokens2)
    docs = (pairs_tokens.select(key, side(1).alias("_side"), F.col(tokens1).alias("_tok"))
            .unionByName(pairs_tokens.select(key, side(2).alias("_side"), F.col(tokens2).alias("_tok"))))
    docs = docs.select(F.struct(key, "_side").alias("_doc"), "_tok")
    if corpus_mode == "union":
        vocab, counts = term_counts(docs, "_doc", "_tok", min_df=min_df, vocab_size=vocab_size)
        n_docs = docs.agg(F.count(F.lit(1))).scalar()
    else:
        corpus = cut_lineage(full_join_corpus(pairs_tokens, tokens1, tokens2))
        vocab = corpus_vocabulary(corpus, min_df=min_df, vocab_size=vocab_size)
        terms = docs.select("_doc", F.explode("_tok").alias("term")).groupBy("_doc", "term").agg(F.count(F.lit(1)).alias("tf"))
        counts = terms.join(vocab.select("term"), "term", "left_semi")
        n_docs = corpus.agg(F.sum("times")).scalar()
    w = (counts.join(idf_weights(vocab, n_docs), "term")
         .select(F.col("_doc")[key].alias(key), F.col("_doc")["_side"].alias("_side"), "term",
                 (F.col("tf") * F.col("idf")).alias("w")))
    # per (key, term) both weights by conditional sums (a partial aggregate,
    # instead of a two-sided full outer join), then the squared differences
    # per key; a zero row per key keeps keys without vocabulary terms
    per_term = w.groupBy(key, "term").agg(
        F.sum(F.when(F.col("_side") == 1, F.col("w"))).alias("w1"),
        F.sum(F.when(F.col("_side") == 2, F.col("w"))).alias("w2"))
    sq = per_term.select(key, F.pow(F.coalesce("w1", F.lit(0.0)) - F.coalesce("w2", F.lit(0.0)), 2).alias("_sq"))
    zero = pairs_tokens.select(key, F.lit(0.0).alias("_sq"))
    return sq.unionByName(zero).groupBy(key).agg(F.sum("_sq").alias("dist"))
