"""Registered text, sequence and vector queries (inventory T01-T27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from . import sqlfrag as Q
from .features import FEATURE_NAMES, normalized_pairs, pair_features, with_lemmas
from .lexicon import lemma_table
from .registry import query
from ..functions import fuzzy as FZ
from ..functions import matching as MB
from ..functions import ngrams as NG
from ..functions import sequences as SQ
from ..functions import stemming as ST
from ..functions import text as TX
from ..functions import treebank as TB
from ..functions import vectors as V
from ..operators import tokens as TK
from ..session import cut_lineage
from ..sources.tables import read_spread as RS
from ..sources.tables import read_table as T
from ..sources.tables import scatter_rows

PAIRS = B.PAIRS_SQL


@query("text_split_words", section="T01/T02", sql=f"""
SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_space,
       CAST(len({Q.split_ws('text')}) AS INTEGER) AS n_ws,
       CAST(len(string_split(text, chr(9))) AS INTEGER) AS n_tab,
       CAST(len(string_split(text, '|')) AS INTEGER) AS n_pipe,
       CAST(len(list_filter(string_split_regex(text, '[^\\p{{L}}\\p{{N}}_]+'), lambda w: w <> '')) AS INTEGER) AS n_word,
       upper(replace(split_part(text, ' ', 1), 'ß', 'ss')) AS first_upper, lower(split_part(text, ' ', 1)) AS first_lower
  FROM documents""")
def q_split_words(spark, d):
    docs = RS(spark, d, "documents", "doc_id", "doc_id", "text")
    first = F.split("text", " ")[0]
    return docs.select(
        "doc_id", F.size(F.split("text", " ")).alias("n_space"), F.size(TX.split_ws("text")).alias("n_ws"),
        F.size(F.split("text", "\t")).alias("n_tab"), F.size(F.split("text", "\\|")).alias("n_pipe"),
        F.size(F.filter(F.split("text", "[^\\p{L}\\p{N}_]+"), lambda w: w != "")).alias("n_word"),
        F.upper(first).alias("first_upper"), F.lower(first).alias("first_lower"))


@query("text_long_words", section="T03", sql=f"""
SELECT DISTINCT w AS word FROM (SELECT UNNEST(string_split(upper(replace(line, 'ß', 'ss')), ' ')) AS w FROM {B.TEXT_LINES_SQL} t) x
 WHERE length(w) > 4""")
def q_long_words(spark, d):
    words = B.text_lines(spark, d).select(F.explode(F.split(F.upper("line"), " ")).alias("word"))
    return words.filter(F.length("word") > 4).distinct().orderBy("word")


@query("feat_lengths", section="T04/T05", sql=f"""
SELECT id, {Q.wc('question1')} AS qWCount1, {Q.wc('question2')} AS qWCount2,
       CAST(length(question1) AS INTEGER) AS qLen1, CAST(length(question2) AS INTEGER) AS qLen2 FROM {PAIRS} p""")
def q_feat_lengths(spark, d):
    p = B.pairs(spark, d)
    return p.select("id", TX.words_spaces_plus_one("question1").alias("qWCount1"),
                    TX.words_spaces_plus_one("question2").alias("qWCount2"),
                    F.length("question1").alias("qLen1"), F.length("question2").alias("qLen2"))


@query("feat_ratios", section="T06", sql=f"""
WITH f AS (SELECT id, {Q.wc('question1')} AS a, {Q.wc('question2')} AS b,
                  length(question1) AS c, length(question2) AS e FROM {PAIRS} p)
SELECT id, {Q.ratio('a', 'b')} AS qWCount_ratio, {Q.ratio('c', 'e')} AS qLen_ratio FROM f""")
def q_feat_ratios(spark, d):
    p = B.pairs(spark, d)
    f = p.select("id", TX.words_spaces_plus_one("question1").alias("a"),
                 TX.words_spaces_plus_one("question2").alias("b"),
                 F.length("question1").alias("c"), F.length("question2").alias("e"))
    return f.select("id", TX.sym_ratio("a", "b").alias("qWCount_ratio"),
                    TX.sym_ratio("c", "e").alias("qLen_ratio"))


@query("text_clean", section="T07", sql=f"""
SELECT doc_id, regexp_replace(text, {Q.SYM}, '', 'g') AS cleaned FROM documents""")
def q_text_clean(spark, d):
    return RS(spark, d, "documents", "doc_id", "doc_id", "text").select(
        "doc_id", TX.clean_symbols("text").alias("cleaned"))


@query("feat_common_ngrams", section="T08", sql=f"""
WITH w AS (SELECT id, {Q.ngram_words('question1')} AS w1, {Q.ngram_words('question2')} AS w2 FROM {PAIRS} p)
SELECT id, {Q.common('w1', 'w2', 1)} AS qNgrams_1, {Q.common('w1', 'w2', 2)} AS qNgrams_2,
       {Q.common('w1', 'w2', 3)} AS qNgrams_3 FROM w""")
def q_common_ngrams(spark, d):
    p = NG.with_ngram_words(B.pairs(spark, d), w1="question1", w2="question2")
    return p.select("id", *[NG.common_ngrams("w1", "w2", n).alias(f"qNgrams_{n}") for n in (1, 2, 3)])


@query("feat_char_bigrams", section="T09", sql=f"""
SELECT id, CAST(len(list_intersect(
         CASE WHEN length(question1) >= 2 THEN list_transform(range(1, length(question1)), lambda i: substring(question1, i, 2)) ELSE []::VARCHAR[] END,
         CASE WHEN length(question2) >= 2 THEN list_transform(range(1, length(question2)), lambda i: substring(question2, i, 2)) ELSE []::VARCHAR[] END))
       AS INTEGER) AS char_bigrams FROM {PAIRS} p""")
def q_char_bigrams(spark, d):
    p = B.pairs(spark, d)
    return p.select("id", NG.common_char_ngrams("question1", "question2", 2).alias("char_bigrams"))


@query("feat_unigram_ratio", section="T10", sql=f"""
WITH w AS (SELECT id, {Q.ngram_words('question1')} AS w1, {Q.ngram_words('question2')} AS w2,
                  {Q.wc('question1')} AS c1, {Q.wc('question2')} AS c2 FROM {PAIRS} p)
SELECT id, {Q.common('w1', 'w2', 1)} / (1 + greatest(c1, c2)) AS qUnigram_ratio FROM w""")
def q_unigram_ratio(spark, d):
    p = NG.with_ngram_words(B.pairs(spark, d), w1="question1", w2="question2")
    g = NG.common_ngrams("w1", "w2", 1)
    return p.select("id", NG.unigram_ratio(g, TX.words_spaces_plus_one("question1"),
                                           TX.words_spaces_plus_one("question2")).alias("qUnigram_ratio"))


@query("text_tokenize", section="T11", sql="""
SELECT doc_id, string_split_regex(lower(text), '\\s') AS tokens FROM documents""")
def q_tokenize(spark, d):
    return RS(spark, d, "documents", "doc_id", "doc_id", "text").select("doc_id", TX.tokenize("text").alias("tokens"))


@query("text_stopwords", section="T12", sql=f"""
SELECT doc_id, array_to_string({Q.content_words('text')}, ' ') AS content FROM documents""")
def q_stopwords(spark, d):
    return RS(spark, d, "documents", "doc_id", "doc_id", "text").select(
        "doc_id", F.array_join(TX.content_words("text"), " ").alias("content"))


@query("text_lemmatize", section="T13", sql=f"""
SELECT doc_id, {Q.lemma_text('text')} AS lemma FROM documents""")
def q_lemmatize(spark, d):
    docs = RS(spark, d, "documents", "doc_id", "doc_id", "text").select("doc_id", TX.content_words("text").alias("w"))
    out = TK.lemmatize(docs, "doc_id", "w", lemma_table(spark), name="lem", keep_input=False)
    return out.select("doc_id", F.array_join("lem", " ").alias("lemma"))


@query("text_stem", section="T13", sql=f"""
WITH ex AS (SELECT doc_id, UNNEST(ws) AS w, UNNEST(range(1, len(ws) + 1)) AS pos FROM (
       SELECT doc_id, {Q.content_words('text')} AS ws FROM documents) d),
 {Q.porter_ctes('ex')},
 g AS (SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS stems FROM ex JOIN stems ON ex.w = stems.word GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.stems, '') AS stems FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id""")
def q_stem(spark, d):
    docs = RS(spark, d, "documents", "doc_id", "doc_id", "text").select("doc_id", TX.content_words("text").alias("w"))
    out = TK.map_words(docs, "doc_id", "w", ST.porter_stem, "stems")
    return out.select("doc_id", F.array_join("stems", " ").alias("stems"))


@query("text_treebank", section="T14", sql=f"""
SELECT doc_id, CAST(len({Q.treebank_sentences('text')}) AS INTEGER) AS n_sentences, {Q.treebank_words('text')} AS words FROM documents""")
def q_treebank(spark, d):
    docs = RS(spark, d, "documents", "doc_id", "doc_id", "text").select("doc_id", TB.treebank_sentences("text").alias("s"))
    return docs.select("doc_id", F.size("s").alias("n_sentences"), TB.words_of_sentences("s").alias("words"))


@query("text_sentences", section="T14")
def q_sentences(spark, d):
    s = RS(spark, d, "documents", "doc_id", "doc_id", "text", "lang").select(
        "doc_id", TX.sentences("text", F.coalesce("lang", F.lit("en"))).alias("s"))
    return s.select("doc_id", F.size("s").alias("n_sentences"),
                    F.aggregate("s", F.lit(0), lambda acc, x: acc + F.size(x)).alias("n_words"))


@query("text_normalize", section="T15", sql=f"""
SELECT doc_id, {Q.normalize('text')} AS normalized FROM documents""")
def q_normalize(spark, d):
    return RS(spark, d, "documents", "doc_id", "doc_id", "text").select(
        "doc_id", TX.normalize("text").alias("normalized"))


MIN_DF = 3


def _normalized_pairs(spark, d):
    # normalised, then words of 4+ characters lemmatised; reused by several
    # steps of each sequence plan, so materialised once
    return cut_lineage(normalized_pairs(B.pairs(spark, d), lemma_table(spark)))


def _cut_sql(x):
    return f"array_to_string({Q.lemmatize(Q.split_ws(Q.normalize(x)), 4)}, ' ')"


NORM_PAIRS_SQL = f"(SELECT id, {_cut_sql('question1')} AS q1, {_cut_sql('question2')} AS q2 FROM {PAIRS} p)"
VOCAB_SQL = f"""(SELECT w AS word, COUNT(*) AS df FROM (
    SELECT UNNEST(list_distinct({Q.split_ws('t')})) AS w FROM (
      SELECT DISTINCT t FROM (SELECT q1 AS t FROM {NORM_PAIRS_SQL} a UNION ALL SELECT q2 AS t FROM {NORM_PAIRS_SQL} b) u) x) y
  GROUP BY w HAVING COUNT(*) >= {MIN_DF})"""


@query("vocab_min_df", section="T16", sql=f"SELECT word, df FROM {VOCAB_SQL} v")
def q_vocab(spark, d):
    return TK.vocabulary(_normalized_pairs(spark, d), ["q1", "q2"], MIN_DF)


def _collapse_sql(col):
    return f"""(SELECT np.id, COALESCE(c.kept[greatest(len(c.kept) - 29, 1):], []::VARCHAR[]) AS prepared
  FROM {NORM_PAIRS_SQL} np LEFT JOIN (
  WITH ex AS (SELECT id, UNNEST(toks) AS tok, UNNEST(range(1, len(toks) + 1)) AS pos FROM
          (SELECT id, {Q.split_ws(col)} AS toks FROM {NORM_PAIRS_SQL} n) t),
   fl AS (SELECT ex.id, ex.pos, ex.tok, v.word IS NULL AS oov FROM ex LEFT JOIN {VOCAB_SQL} v ON v.word = ex.tok),
   g AS (SELECT id, list(tok ORDER BY pos) AS toks, list(oov ORDER BY pos) AS flags FROM fl GROUP BY id)
  SELECT id, list_transform(
          list_filter(range(1, len(toks) + 1), lambda i: NOT (flags[i] AND COALESCE(flags[i + 1], false))),
          lambda i: CASE WHEN flags[i] THEN 'suspense' ELSE toks[i] END) AS kept FROM g) c ON np.id = c.id)"""


@query("seq_collapse_rare", section="T17", sql=f"""
SELECT a.id, a.prepared AS prepared1, b.prepared AS prepared2
  FROM {_collapse_sql('q1')} a JOIN {_collapse_sql('q2')} b ON a.id = b.id""")
def q_collapse(spark, d):
    np_ = _normalized_pairs(spark, d)
    vocab = TK.vocabulary(np_, ["q1", "q2"], MIN_DF)
    return TK.collapse_rare_columns(np_, "id", {"prepared1": TX.split_ws("q1"), "prepared2": TX.split_ws("q2")},
                                    vocab, "suspense", 30)


def _encoded(spark, d):
    np_ = _normalized_pairs(spark, d)
    toks = np_.select("id", TK.filtered_words("q1").alias("t1"), TK.filtered_words("q2").alias("t2"))
    corpus = toks.select(F.concat("t1", "t2").alias("t"))
    index = TK.word_index(corpus, "t")
    return toks, index


def _encode_both(spark, d):
    toks, index = _encoded(spark, d)
    return TK.encode_columns(toks, "id", {"seq1": "t1", "seq2": "t2"}, index)


_FILTERS_SQL = Q.lit("[" + "".join("\\" + ch if ch in "[]\\^-" else ch for ch in TK.TOKENIZER_FILTERS) + "]")


def _kw(x):
    return Q.split_ws(f"regexp_replace(lower({x}), {_FILTERS_SQL}, ' ', 'g')")


INDEX_SQL = f"""(SELECT word, n, ROW_NUMBER() OVER (ORDER BY n DESC, word) AS "index" FROM (
   SELECT w AS word, COUNT(*) AS n FROM (
     SELECT UNNEST({_kw('q1')}) AS w FROM {NORM_PAIRS_SQL} a
     UNION ALL SELECT UNNEST({_kw('q2')}) AS w FROM {NORM_PAIRS_SQL} b) x GROUP BY w) y)"""


def _seq_sql(col):
    return f"""(SELECT np.id, COALESCE(e.seq, []::BIGINT[]) AS seq FROM {NORM_PAIRS_SQL} np LEFT JOIN (
   SELECT id, list(i."index" ORDER BY pos) AS seq FROM (
     SELECT id, UNNEST(t) AS word, UNNEST(range(1, len(t) + 1)) AS pos FROM (SELECT id, {_kw(col)} AS t FROM {NORM_PAIRS_SQL} c) z) x
   JOIN {INDEX_SQL} i ON i.word = x.word GROUP BY id) e ON np.id = e.id)"""


SEQ_SQL = f"""(SELECT a.id, a.seq AS seq1, b.seq AS seq2 FROM {_seq_sql('q1')} a JOIN {_seq_sql('q2')} b ON a.id = b.id)"""


@query("seq_encode", section="T18", sql=f"SELECT id, seq1, seq2 FROM {SEQ_SQL} s")
def q_encode(spark, d):
    return _encode_both(spark, d)


def _pad_sql(x, n, padding, truncating):
    t = f"{x}[greatest(len({x}) - {n - 1}, 1):]" if truncating == "pre" else f"{x}[1:{n}]"
    fill = f"list_transform(range(0, {n} - len({t})), lambda i: 0::BIGINT)"
    return f"list_concat({fill}, {t})" if padding == "pre" else f"list_concat({t}, {fill})"


@query("seq_pad", section="T19", sql=f"""
SELECT id, {_pad_sql('seq1', 30, 'pre', 'pre')} AS pad_pre1, {_pad_sql('seq1', 30, 'post', 'post')} AS pad_post1,
       {_pad_sql('seq2', 30, 'pre', 'pre')} AS pad_pre2, {_pad_sql('seq2', 30, 'post', 'post')} AS pad_post2
  FROM {SEQ_SQL} s""")
def q_pad(spark, d):
    enc = _encode_both(spark, d)
    return enc.select("id", *[SQ.pad_sequences(f"seq{i}", 30, p, p).alias(f"pad_{p}{i}")
                              for i in (1, 2) for p in ("pre", "post")])


@query("embed_matrix", section="T20", sql=f"""
SELECT i."index", COALESCE(v.vec, list_transform(range(0, 64), lambda k: 0.0::DOUBLE)) AS vec
  FROM {INDEX_SQL} i LEFT JOIN {B.VECTORS_SQL} v ON v.vec_id = i."index" """)
def q_embed(spark, d):
    _, index = _encoded(spark, d)
    vecs = B.vectors(spark, d).select(F.col("vec_id").alias("index"), "vec")
    return TK.embedding_matrix(index, vecs, 64)


@query("vec_group_unit_sum", section="T21", sql=f"""
WITH s AS (SELECT label, k, SUM(vec[k]) AS x FROM {B.VECTORS_SQL} v, range(1, 65) r(k) GROUP BY label, k),
 n AS (SELECT label, sqrt(SUM(x * x)) AS nrm FROM s GROUP BY label)
SELECT s.label, list(round(s.x / n.nrm, 9) ORDER BY s.k) AS unit_sum FROM s JOIN n ON s.label = n.label GROUP BY s.label""")
def q_group_unit_sum(spark, d):
    from .vectorplans import group_unit_sum
    out = group_unit_sum(B.vectors(spark, d), "label", "vec")
    return out.select("label", F.transform("unit_sum", lambda x: F.round(x, 9)).alias("unit_sum"))


_BAG_SQL = f"""(WITH w AS (SELECT id, 1 AS side, UNNEST({_kw('q1')}) AS word FROM {NORM_PAIRS_SQL} a
   UNION ALL SELECT id, 2 AS side, UNNEST({_kw('q2')}) AS word FROM {NORM_PAIRS_SQL} b),
 wv AS (SELECT i.word, v.vec FROM {INDEX_SQL} i JOIN {B.VECTORS_SQL} v ON v.vec_id = i."index"),
 s AS (SELECT id, side, k, SUM(vec[k]) AS x FROM w JOIN wv ON wv.word = w.word, range(1, 65) r(k) GROUP BY ALL),
 n AS (SELECT id, side, sqrt(SUM(x * x)) AS l FROM s GROUP BY ALL)
 SELECT s.id, s.side, s.k, CASE WHEN n.l > 0 THEN s.x / n.l ELSE 0.0 END AS u FROM s JOIN n ON n.id = s.id AND n.side = s.side)"""


@query("vec_text_unit_sum", section="T21", sql=f"""
WITH g AS {_BAG_SQL},
 z AS (SELECT np.id, r.k, coalesce(a.u, 0.0) AS x, coalesce(b.u, 0.0) AS y FROM {NORM_PAIRS_SQL} np CROSS JOIN range(1, 65) r(k)
   LEFT JOIN g a ON a.id = np.id AND a.side = 1 AND a.k = r.k LEFT JOIN g b ON b.id = np.id AND b.side = 2 AND b.k = r.k)
SELECT id, round(sqrt(SUM((x - y) * (x - y))), 6) AS euclidean, round(SUM(x * y), 6) AS dot FROM z GROUP BY id""")
def q_text_unit_sum(spark, d):
    from .vectorplans import text_unit_sums
    # vectors are stored as floats: the cast back loses nothing and halves the traffic
    toks, index = _encoded(spark, d)
    known = index.join(B.vectors(spark, d), index["index"] == F.col("vec_id")).select("word", F.col("vec").cast("array<float>").alias("vec"))
    out = text_unit_sums(toks, "id", {"u": "t1", "w": "t2"}, known, 64)
    return out.select("id", F.round(V.euclidean("u", "w"), 6).alias("euclidean"), F.round(V.dot("u", "w"), 6).alias("dot"))


_POS, _NEG, _TOPK = (1, 2), (3,), 10


@query("vec_most_similar", section="T22", sql=f"""
WITH v AS {B.VECTORS_SQL},
 u AS (SELECT vec_id, list_transform(vec, lambda x: x / sqrt(list_reduce(list_transform(vec, lambda y: y * y), lambda a, b: a + b))) AS uv FROM v),
 sgn AS (SELECT CASE WHEN vec_id IN {tuple(_NEG) if len(_NEG) > 1 else f'({_NEG[0]})'} THEN -1.0 ELSE 1.0 END AS s, uv
           FROM u WHERE vec_id IN {tuple(_POS + _NEG)}),
 m AS (SELECT k, SUM(sgn.s * sgn.uv[k]) / {len(_POS) + len(_NEG)} AS x FROM sgn, range(1, 65) r(k) GROUP BY k),
 q AS (SELECT list(x ORDER BY k) AS qv FROM m),
 qn AS (SELECT list_transform(qv, lambda x: x / sqrt(list_reduce(list_transform(qv, lambda y: y * y), lambda a, b: a + b))) AS qv FROM q)
SELECT vec_id, round(sim, 9) AS similarity FROM (
  SELECT v.vec_id, list_reduce(list_transform(range(1, 65), lambda k: v.vec[k] * qn.qv[k]), lambda a, b: a + b)
         / sqrt(list_reduce(list_transform(v.vec, lambda y: y * y), lambda a, b: a + b)) AS sim
    FROM v, qn WHERE v.vec_id NOT IN {tuple(_POS + _NEG)}) x
 ORDER BY sim DESC, vec_id LIMIT {_TOPK}""")
def q_most_similar(spark, d):
    from .vectorplans import most_similar
    out = most_similar(B.vectors(spark, d), "vec_id", "vec", list(_POS), list(_NEG), _TOPK)
    return out.select("vec_id", F.round("similarity", 9).alias("similarity"))


def _vsql(expr):
    return f"list_reduce(list_transform(range(1, len(a.vec) + 1), lambda k: {expr}), lambda x, y: x + y)"


@query("vec_distances", section="T23", sql=f"""
SELECT a.vec_id AS id1, b.vec_id AS id2,
 round(1.0 - {_vsql('a.vec[k] * b.vec[k]')} / (sqrt({_vsql('a.vec[k] * a.vec[k]')}) * sqrt({_vsql('b.vec[k] * b.vec[k]')})), 9) AS cosine,
 round({_vsql('abs(a.vec[k] - b.vec[k])')}, 9) AS cityblock,
 round(sqrt({_vsql('(a.vec[k] - b.vec[k]) * (a.vec[k] - b.vec[k])')}), 9) AS euclidean,
 round({_vsql('(a.vec[k] - b.vec[k]) * (a.vec[k] - b.vec[k])')}, 9) AS sqeuclidean,
 round(pow({_vsql('pow(abs(a.vec[k] - b.vec[k]), 3.0)')}, 1.0 / 3.0), 9) AS minkowski3,
 round({_vsql('abs(a.vec[k] - b.vec[k])')} / {_vsql('abs(a.vec[k] + b.vec[k])')}, 9) AS braycurtis,
 round({_vsql('CASE WHEN abs(a.vec[k]) + abs(b.vec[k]) = 0 THEN 0.0 ELSE abs(a.vec[k] - b.vec[k]) / (abs(a.vec[k]) + abs(b.vec[k])) END')}, 9) AS canberra,
 round(list_max(list_transform(range(1, len(a.vec) + 1), lambda k: abs(a.vec[k] - b.vec[k]))), 9) AS chebyshev
FROM {B.VECTORS_SQL} a JOIN {B.VECTORS_SQL} b ON b.vec_id = a.vec_id + 1""")
def q_vec_distances(spark, d):
    v = B.vectors(spark, d)
    a, b = v.alias("a"), v.alias("b")
    j = a.join(b, F.col("b.vec_id") == F.col("a.vec_id") + 1).select(
        F.col("a.vec_id").alias("id1"), F.col("b.vec_id").alias("id2"),
        F.col("a.vec").alias("u"), F.col("b.vec").alias("w"))
    r = lambda c: F.round(c, 9)
    return j.select("id1", "id2", r(V.cosine("u", "w")).alias("cosine"), r(V.cityblock("u", "w")).alias("cityblock"),
                    r(V.euclidean("u", "w")).alias("euclidean"), r(V.sqeuclidean("u", "w")).alias("sqeuclidean"),
                    r(V.minkowski("u", "w", 3.0)).alias("minkowski3"), r(V.braycurtis("u", "w")).alias("braycurtis"),
                    r(V.canberra("u", "w")).alias("canberra"), r(V.chebyshev("u", "w")).alias("chebyshev"))


@query("vec_jaccard", section="T23", sql=f"""
WITH p AS (SELECT a.vec_id AS id1, list_transform(a.vec, lambda x: round(x, 1)) AS u,
                  list_transform(b.vec, lambda x: round(x, 1)) AS w
             FROM {B.VECTORS_SQL} a JOIN {B.VECTORS_SQL} b ON b.vec_id = a.vec_id + 1)
SELECT id1, round(CASE WHEN e = 0 THEN 0.0 ELSE df / e END, 9) AS jaccard FROM (
  SELECT id1,
   list_reduce(list_transform(range(1, len(u) + 1), lambda k: CASE WHEN u[k] <> 0 OR w[k] <> 0 THEN 1.0 ELSE 0.0 END), lambda x, y: x + y) AS e,
   list_reduce(list_transform(range(1, len(u) + 1), lambda k: CASE WHEN (u[k] <> 0 OR w[k] <> 0) AND u[k] <> w[k] THEN 1.0 ELSE 0.0 END), lambda x, y: x + y) AS df
  FROM p) z""")
def q_vec_jaccard(spark, d):
    v = B.vectors(spark, d)
    a, b = v.alias("a"), v.alias("b")
    j = a.join(b, F.col("b.vec_id") == F.col("a.vec_id") + 1).select(
        F.col("a.vec_id").alias("id1"),
        F.transform("a.vec", lambda x: F.round(x, 1)).alias("u"),
        F.transform("b.vec", lambda x: F.round(x, 1)).alias("w"))
    return j.select("id1", F.round(V.jaccard("u", "w"), 9).alias("jaccard"))


def _conv_docs(spark, d):
    c = T(spark, d, "conversations", "conv_id", "turn", "text")
    return c.select(F.struct("conv_id", "turn").alias("doc"), TX.tokenize("text").alias("tokens"))


@query("tf_counts", section="T24", sql="""
WITH docs AS (SELECT conv_id, turn, string_split_regex(lower(text), '\\s') AS tokens FROM conversations),
 tf AS (SELECT conv_id, turn, term, COUNT(*) AS tf FROM (SELECT conv_id, turn, UNNEST(tokens) AS term FROM docs) x GROUP BY ALL),
 v AS (SELECT term FROM tf GROUP BY term HAVING COUNT(*) >= 2)
SELECT tf.conv_id, tf.turn, tf.term, tf.tf FROM tf WHERE tf.term IN (SELECT term FROM v)""")
def q_tf_counts(spark, d):
    _, counts = TK.term_counts(_conv_docs(spark, d), "doc", "tokens", min_df=2.0)
    return counts.select("doc.conv_id", "doc.turn", "term", "tf")


LEMMA_PAIRS_SQL = f"""(SELECT id, string_split_regex(lower({Q.lemma_text('question1')}), '\\s') AS t1,
        string_split_regex(lower({Q.lemma_text('question2')}), '\\s') AS t2 FROM {PAIRS} p)"""

TFIDF_SQL = f"""(WITH lp AS {LEMMA_PAIRS_SQL},
 docs AS (SELECT id, 1 AS side, t1 AS t FROM lp UNION ALL SELECT id, 2 AS side, t2 AS t FROM lp),
 tf AS (SELECT id, side, term, COUNT(*) AS tf FROM (SELECT id, side, UNNEST(t) AS term FROM docs) x GROUP BY ALL),
 dfs AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term HAVING COUNT(*) >= 2),
 m AS (SELECT COUNT(*) AS m FROM docs),
 w AS (SELECT tf.id, tf.side, tf.term, tf.tf * ln((m.m + 1) / (dfs.df + 1)) AS w FROM tf JOIN dfs ON tf.term = dfs.term, m),
 w1 AS (SELECT id, term, w FROM w WHERE side = 1), w2 AS (SELECT id, term, w FROM w WHERE side = 2),
 dd AS (SELECT COALESCE(w1.id, w2.id) AS id, SUM(pow(COALESCE(w1.w, 0.0) - COALESCE(w2.w, 0.0), 2)) AS dist
          FROM w1 FULL JOIN w2 ON w1.id = w2.id AND w1.term = w2.term GROUP BY 1)
 SELECT lp.id, COALESCE(dd.dist, 0.0) AS dist FROM lp LEFT JOIN dd ON lp.id = dd.id)"""


@query("tfidf_distance", section="T25/J10", sql=f"SELECT id, round(dist, 4) AS tfidfDistance FROM {TFIDF_SQL} t")
def q_tfidf(spark, d):
    lp = with_lemmas(B.pairs(spark, d), lemma_table(spark))
    toks = cut_lineage(lp.select("id", TX.tokenize("lemma1").alias("t1"), TX.tokenize("lemma2").alias("t2")))
    out = TK.tfidf_pair_distance(toks, "id", "t1", "t2", min_df=2.0)
    return out.select("id", F.round("dist", 4).alias("tfidfDistance"))


#: The full outer join of both token columns on equal arrays, as it stands.
FULL_JOIN_SQL = f"(SELECT coalesce(a.t1, b.t2) AS words FROM {LEMMA_PAIRS_SQL} a FULL JOIN {LEMMA_PAIRS_SQL} b ON a.t1 = b.t2)"
FULL_JOIN_VOCAB_SQL = f"""(WITH c AS (SELECT row_number() OVER () AS r, words FROM {FULL_JOIN_SQL} j),
 tf AS (SELECT r, term, COUNT(*) AS tf FROM (SELECT r, UNNEST(words) AS term FROM c) x GROUP BY ALL)
 SELECT term, COUNT(*) AS df, CAST(SUM(tf) AS BIGINT) AS total, (SELECT COUNT(*) FROM c) AS n_docs FROM tf GROUP BY term HAVING COUNT(*) >= 2)"""


def _lemma_tokens(spark, d):
    lp = with_lemmas(B.pairs(spark, d), lemma_table(spark))
    return cut_lineage(lp.select("id", TX.tokenize("lemma1").alias("t1"), TX.tokenize("lemma2").alias("t2")))


@query("corpus_full_join", section="J12/T24", sql=f"SELECT term, df, total, n_docs FROM {FULL_JOIN_VOCAB_SQL} v")
def q_corpus_full_join(spark, d):
    corpus = cut_lineage(TK.full_join_corpus(_lemma_tokens(spark, d), "t1", "t2"))
    return TK.corpus_vocabulary(corpus, min_df=2.0).withColumn("n_docs", corpus.agg(F.sum("times")).scalar())


@query("tfidf_full_join", section="J12/T25", sql=f"""
WITH lp AS {LEMMA_PAIRS_SQL}, v AS {FULL_JOIN_VOCAB_SQL},
 tf AS (SELECT id, side, term, COUNT(*) AS tf FROM (
   SELECT id, 1 AS side, UNNEST(t1) AS term FROM lp UNION ALL SELECT id, 2 AS side, UNNEST(t2) AS term FROM lp) x GROUP BY ALL),
 w AS (SELECT id, term, SUM(CASE WHEN side = 1 THEN tf ELSE -tf END) * ln((any_value(n_docs) + 1) / (any_value(df) + 1)) AS w
         FROM tf JOIN v USING (term) GROUP BY id, term)
SELECT lp.id, round(coalesce(SUM(w.w * w.w), 0.0), 4) AS dist FROM lp LEFT JOIN w ON w.id = lp.id GROUP BY lp.id""")
def q_tfidf_full_join(spark, d):
    out = TK.tfidf_pair_distance(_lemma_tokens(spark, d), "id", "t1", "t2", min_df=2.0, corpus_mode="fulljoin")
    return out.select("id", F.round("dist", 4).alias("dist"))


AB_SQL = f"(SELECT id, question1 AS a, question2 AS b FROM {PAIRS} p)"


def _ab(spark, d):
    return B.pairs(spark, d, materialize=False).select("id", F.col("question1").alias("a"), F.col("question2").alias("b"))


@query("fuzzy_ratio", section="T26", sql=Q.one_byte(AB_SQL, "a", "b") + f"""
SELECT id, {Q.fratio('a', 'b')} AS ratio FROM one_byte""")
def q_fuzzy_ratio(spark, d):
    return _ab(spark, d).select("id", FZ.ratio("a", "b").alias("ratio"))


@query("fuzzy_ratio01", section="T26", sql=Q.one_byte(f"(SELECT id, lower(a) AS a, lower(b) AS b FROM {AB_SQL} x)", "a", "b") + """
SELECT id, round(CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0
   ELSE (greatest(length(a), length(b)) - levenshtein(a, b)) / greatest(length(a), length(b)) END, 9) AS similarity FROM one_byte""")
def q_fuzzy_ratio01(spark, d):
    return _ab(spark, d).select("id", F.round(FZ.ratio01(F.lower("a"), F.lower("b")), 9).alias("similarity"))


def _sorted_sql(x):
    return f"array_to_string(list_sort({Q.fuzzy_tokens(x)}), ' ')"


@query("fuzzy_token_sort", section="T26", sql=Q.one_byte(
    f"(SELECT id, {_sorted_sql('a')} AS a, {_sorted_sql('b')} AS b FROM {AB_SQL} x)", "a", "b") + f"""
SELECT id, {Q.fratio('a', 'b')} AS token_sort_ratio FROM one_byte""")
def q_fuzzy_sort(spark, d):
    return _ab(spark, d).select("id", FZ.token_sort_ratio("a", "b").alias("token_sort_ratio"))


_SETS_SQL = f"""(WITH t AS (SELECT id, {Q.fuzzy_tokens('a')} AS t1, {Q.fuzzy_tokens('b')} AS t2 FROM {AB_SQL} p),
 s AS (SELECT id, array_to_string(list_sort(list_intersect(t1, t2)), ' ') AS i,
              array_to_string(list_sort(list_distinct(list_filter(t1, lambda x: NOT list_contains(t2, x)))), ' ') AS d1,
              array_to_string(list_sort(list_distinct(list_filter(t2, lambda x: NOT list_contains(t1, x)))), ' ') AS d2 FROM t),
 u AS (SELECT id, i, trim(concat_ws(' ', i, d1)) AS s1, trim(concat_ws(' ', i, d2)) AS s2 FROM s) SELECT * FROM u)"""


@query("fuzzy_token_set", section="T26", sql=Q.one_byte(_SETS_SQL, "i", "s1", "s2") + f"""
SELECT id, greatest({Q.fratio('i', 's1')}, {Q.fratio('i', 's2')}, {Q.fratio('s1', 's2')}) AS token_set_ratio FROM one_byte""")
def q_fuzzy_set(spark, d):
    return _ab(spark, d).select("id", FZ.token_set_ratio("a", "b").alias("token_set_ratio"))


@query("fuzzy_partial", section="T26", sql=Q.one_byte(AB_SQL, "a", "b") + f"""
, x AS (SELECT id, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s,
                  CASE WHEN length(a) <= length(b) THEN b ELSE a END AS l FROM one_byte)
SELECT id, CAST(CASE WHEN length(s) = 0 THEN 0 ELSE round((length(s) - list_min(list_transform(
         range(1, length(l) - length(s) + 2), lambda j: levenshtein(s, substring(l, j, length(s)))))) * 100 / length(s)) END
       AS INTEGER) AS partial_ratio FROM x""")
def q_fuzzy_partial(spark, d):
    return FZ.with_partial_ratio(scatter_rows(_ab(spark, d), "id"), "a", "b")


@query("fuzzy_blocks", section="T26")
def q_fuzzy_blocks(spark, d):
    """Matching blocks of whole lower-cased texts, with and without popular characters."""
    lower = scatter_rows(_ab(spark, d), "id").select("id", F.lower("a").alias("a"), F.lower("b").alias("b"))
    out = MB.with_matching_ratios(lower, "a", "b", {"similarity": True, "all_blocks": False})
    return out.select("id", *[F.round(c, 9).alias(c) for c in ("similarity", "all_blocks")])


@query("pair_features", section="T27/J10", sql=f"""
WITH b AS (SELECT id, question1 AS q1, question2 AS q2, {Q.lemma_text('question1')} AS l1,
                  {Q.lemma_text('question2')} AS l2 FROM {PAIRS} p),
 c AS (SELECT id, {Q.wc('l1')} AS lWCount1, {Q.wc('l2')} AS lWCount2, {Q.wc('q1')} AS qWCount1, {Q.wc('q2')} AS qWCount2,
              CAST(length(l1) AS INTEGER) AS lLen1, CAST(length(l2) AS INTEGER) AS lLen2,
              CAST(length(q1) AS INTEGER) AS qLen1, CAST(length(q2) AS INTEGER) AS qLen2,
              {Q.ngram_words('q1')} AS qw1, {Q.ngram_words('q2')} AS qw2,
              {Q.ngram_words('l1')} AS lw1, {Q.ngram_words('l2')} AS lw2 FROM b),
 f AS (SELECT id, lWCount1, lWCount2, qWCount1, qWCount2, lLen1, lLen2, qLen1, qLen2,
              {Q.ratio('lWCount1', 'lWCount2')} AS lWCount_ratio, {Q.ratio('qWCount1', 'qWCount2')} AS qWCount_ratio,
              {Q.ratio('lLen1', 'lLen2')} AS lLen_ratio, {Q.ratio('qLen1', 'qLen2')} AS qLen_ratio,
              {Q.common('qw1', 'qw2', 1)} AS qNgrams_1, {Q.common('qw1', 'qw2', 2)} AS qNgrams_2,
              {Q.common('qw1', 'qw2', 3)} AS qNgrams_3, {Q.common('lw1', 'lw2', 1)} AS lNgrams_1,
              {Q.common('lw1', 'lw2', 2)} AS lNgrams_2, {Q.common('lw1', 'lw2', 3)} AS lNgrams_3 FROM c)
SELECT f.id, {', '.join(n for n in FEATURE_NAMES if n not in ('qUnigram_ratio', 'lUnigram_ratio', 'tfidfDistance'))},
       qNgrams_1 / (1 + greatest(qWCount1, qWCount2)) AS qUnigram_ratio,
       lNgrams_1 / (1 + greatest(lWCount1, lWCount2)) AS lUnigram_ratio,
       round(t.dist, 4) AS tfidfDistance
  FROM f JOIN {TFIDF_SQL} t ON f.id = t.id""")
def q_pair_features(spark, d):
    out = pair_features(B.pairs(spark, d), lemma_table(spark))
    return out.withColumn("tfidfDistance", F.round("tfidfDistance", 4))
