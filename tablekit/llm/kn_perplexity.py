"""Quality rules: word measures and n-gram perplexity bands.

A modified Kneser-Ney model of the UTF-16 units of the texts, four units an
n-gram, one model per language. Spark counts the four-grams of the whole
corpus (each task sends its distinct n-grams only), and the lower orders,
discounts, back-off weights and interpolated probabilities are joins and
aggregates over the distinct n-grams. Four units pack into one 64-bit key, so a
model is arrays of sorted keys beside arrays of log-probabilities, searched by
bisection. Documents whose mean negative log-probability a unit lies outside
their language's band are rejected. The band comes from the documents that pass
the word rules: their median, less and more ``REACH`` robust standard
deviations, of the documents below it and of those above, whatever their number.

The arrays go to the tasks as a broadcast only if their rows number at most
``broadcast_rows``; beyond that the documents' distinct n-grams are joined with
the model's rows, which gives the same scores.

Null and empty texts have zero measures, fail the word rules and have no
perplexity. A null language counts as ``und``. Repeated rows repeat their
result (they count in the corpus as often as they occur). An empty table gives
an empty one. Extra columns are left out, or carried unread in ``row``.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops
from .runtime import ship, slices, text_column, utf8_bytes, written

ORDER = 4
#: Robust deviations from the median to either end of a language's band.
REACH = 4.5
PAD = "\x02"
COUNT_BYTES = 2 << 20
U = np.uint64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


# ---- word measures -------------------------------------------------------

def word_measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of texts."""
    buf, offs = utf8_bytes(texts)
    s, e, first = textops.word_spans(buf, offs)
    n_words = np.diff(first)
    lead = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=lead[1:])
    in_words = np.zeros(len(s) + 1, np.int64)
    np.cumsum(lead[e] - lead[s], out=in_words[1:])
    symbols = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_SYMBOL[buf], out=symbols[1:])
    return {"n_words": n_words, "word_chars": np.diff(in_words[first]), "n_symbols": np.diff(symbols[offs]),
            "n_dup_lines": np.array([repeated_lines(t) for t in texts.to_pylist()], np.int64),
            "n_repeat_words": repeated_words(textops.span_hashes(buf, s, e), first)}


def repeated_lines(text: str) -> int:
    lines = text.split("\n")
    if len(lines) < 2:
        return 0
    return sum(n - 1 for line, n in Counter(lines).items() if n > 1 and line.strip(" \t\n\x0b\x0c\r"))


def repeated_words(words: np.ndarray, first: np.ndarray, k: int = 8) -> np.ndarray:
    """Words of each text in a ``k``-word window that the text has twice."""
    n = len(words)
    covered = np.zeros(n + 1, np.int64)
    if n >= k:
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        inside = text[:n - k + 1] == text[k - 1:]
        h = textops.window_hashes(words, k)
        h = np.where(inside, textops.mix(h + text[:n - k + 1].astype(U) * U(0x9E3779B97F4A7C15)),
                     np.arange(n - k + 1).astype(U))
        ranked = np.sort(h[inside])
        twice = ranked[1:][ranked[1:] == ranked[:-1]]
        if len(twice):
            at = np.flatnonzero(inside & np.isin(h, twice))
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + k, -1)
            np.cumsum(np.cumsum(edge[:n]) > 0, out=covered[1:])
    return np.diff(covered[first])


# ---- counting ------------------------------------------------------------

def gram_keys(texts: list[str]) -> np.ndarray:
    """Packed four-grams of texts, one for each unit; pads stand before a text."""
    pads = PAD * (ORDER - 1)
    joined = pads + pads.join(t.replace(PAD, "\x03") if PAD in t else t for t in texts)
    v = np.frombuffer(joined.encode("utf-16-le"), "<u2").astype(U)
    if len(v) < ORDER:
        return np.zeros(0, U)
    keys = v[3:] | v[2:-1] << U(16) | v[1:-2] << U(32) | v[:-3] << U(48)
    return keys[v[3:] != U(ord(PAD))]


def runs(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their counts or summed weights."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    if weights is None:
        return keys[begin], np.diff(np.append(begin, len(keys)))
    return keys[begin], np.add.reduceat(weights, begin)


def _count_task(batches):
    got: dict[str, list] = {}
    for batch in batches:
        for part in slices(batch, "text", COUNT_BYTES):
            langs = part.column("lang").to_pylist()
            texts = text_column(part, "text").to_pylist()
            for lang in set(langs):
                own = got.setdefault(lang, [])
                own.append(runs(gram_keys([t for t, x in zip(texts, langs) if x == lang])))
                if len(own) >= 8:
                    got[lang] = [_merged(own)]
    for lang, own in got.items():
        keys, n = _merged(own)
        for a in range(0, len(keys), 100_000):
            k = keys[a:a + 100_000].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(k), pa.string()), pa.array(k), pa.array(n[a:a + 100_000], pa.int64())],
                ["lang", "gram", "n"])


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    return runs(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))


def _source(df: DataFrame, text: str, lang: str, carry: list[str] = ()) -> DataFrame:
    """``(lang, text)``, before it ``row`` with the carried columns; the text is
    not repeated beside a row that has it."""
    cols = [F.coalesce(df[f"`{lang}`"].cast("string"), F.lit("und")).alias("lang")]
    if text not in carry:
        cols.append(df[f"`{text}`"].alias("text"))
    return df.select(*([F.struct(*[df[f"`{c}`"] for c in carry]).alias("row")] if carry else []), *cols)


def count_grams(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, gram, n)`` over all texts; ``gram`` packs four UTF-16 units."""
    ship(df.sparkSession)
    parts = _source(df, text, lang).mapInArrow(_count_task, "lang string, gram bigint, n bigint")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# ---- modified Kneser-Ney -------------------------------------------------

def _unit(gram, place: int):
    """The unit ``place`` units before the last."""
    return F.shiftrightunsigned(gram, 16 * place).bitwiseAND(F.lit(0xFFFF))


def _tail(gram, n: int):
    """The last ``n`` units."""
    return gram.bitwiseAND(F.lit((1 << 16 * n) - 1))


def _lower(table: DataFrame, n: int) -> DataFrame:
    """Counts of order ``n`` from those of order ``n + 1``: distinct units that
    stand before an n-gram; an n-gram that begins with a pad keeps its count."""
    g = _tail(F.col("gram"), n)
    out = table.groupBy("lang", g.alias("gram")).agg(F.count("*").alias("kinds"), F.sum("n").alias("total"))
    starts = _unit(F.col("gram"), n - 1) == ord(PAD) if n > 1 else F.lit(False)
    return out.select("lang", "gram", F.when(starts, F.col("total")).otherwise(F.col("kinds")).alias("n"))


def _discounts(table: DataFrame) -> DataFrame:
    """``(lang, d1, d2, d3)`` by the counts of counts; 0.5, 1 and 1.5 where a
    language has too few n-grams for them."""
    n = [F.count(F.when(F.col("n") == k, 1)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    some = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)

    def d(k):
        raw = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        return F.when(some & (raw > 0) & (raw < k), raw).otherwise(k / 2).alias(f"d{k}")
    return table.groupBy("lang").agg(*n).withColumn("some", some).select(
        "lang", *[F.when(F.col("some"), d(k)).otherwise(k / 2).alias(f"d{k}") for k in (1, 2, 3)])


def _of_language(rows: DataFrame, *values: str):
    """A struct of ``rows``' values for the language at hand. ``rows`` has one
    row a language; as a scalar map it spares a shuffle by language, where one
    task would get a language's every row."""
    entry = F.struct(F.col("lang"), F.struct(*values))
    found = rows.agg(F.map_from_entries(F.collect_list(entry))).scalar()
    return F.try_element_at(found, F.col("lang"))


def _smoothed(table: DataFrame, n: int, below: DataFrame | None) -> DataFrame:
    """``(lang, gram, p, context, backoff, kinds)`` of order ``n``. A context has
    at most 65,536 n-grams, so the window holds a bounded group."""
    w = Window.partitionBy("lang", "context")
    by_count = F.col("by_count")
    d = F.when(F.col("n") == 1, by_count["d1"]).when(F.col("n") == 2, by_count["d2"]).otherwise(by_count["d3"])
    t = (table.withColumn("by_count", _of_language(_discounts(table), "d1", "d2", "d3"))
         .select("lang", "gram", "n", d.alias("d"),
                 (F.shiftrightunsigned("gram", 16) if n > 1 else F.lit(0).cast("bigint")).alias("context"))
         .select("*", F.sum("n").over(w).alias("total"), F.sum("d").over(w).alias("held"), F.count("*").over(w).alias("kinds")))
    if n == 1:
        base = F.lit(1.0) / (F.col("kinds") + 1)  # one more for units never seen
    else:
        t = t.withColumn("tail", _tail(F.col("gram"), n - 1)).join(
            below.select("lang", F.col("gram").alias("tail"), F.col("p").alias("base")), ["lang", "tail"])
        base = F.col("base")
    back = F.col("held") / F.col("total")
    return t.select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("total") + back * base).alias("p"), "context",
                    back.alias("backoff"), "kinds")


def smooth(counts: DataFrame) -> DataFrame:
    """The model's rows ``(lang, kind, key, value)`` with log values: kind n is
    the probability of an n-gram, kind -n the back-off weight of a context of n
    units, kind 0 the probability of a unit that the language never has."""
    tables = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = written(_lower(tables[n + 1], n), f"kn-counts{n}")
    out, below = [], None
    for n in range(1, ORDER + 1):
        below = written(_smoothed(tables[n], n, below), f"kn-order{n}")
        value = F.log(F.max("backoff") / (F.max("kinds") + 1) if n == 1 else F.max("backoff"))
        out.append(below.groupBy("lang", F.col("context").alias("key")).agg(value.alias("value"))
                   .select("lang", F.lit(1 - n).alias("kind"), "key", "value"))
        out.append(below.select("lang", F.lit(n).alias("kind"), F.col("gram").alias("key"), F.log("p").alias("value")))
    return reduce(DataFrame.unionAll, out)


class Arrays:
    """One language's model: sorted keys and their values by kind."""

    def __init__(self, kinds: np.ndarray, keys: np.ndarray, values: np.ndarray):
        self.parts = {}
        for k in np.unique(kinds).tolist():
            own = kinds == k
            key = keys[own].astype(np.int64).view(U)
            order = np.argsort(key)
            self.parts[k] = key[order], values[own][order]

    def find(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, values = self.parts.get(kind, (np.zeros(0, U), np.zeros(0)))
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, values[at]

    def log_p(self, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Log-probability of each n-gram's last unit after the others."""
        hit, out = self.find(n, keys)
        out = out.copy()
        miss = np.flatnonzero(~hit)
        if len(miss):
            if n == 1:
                out[miss] = self.parts[0][1][0]
            else:
                some, back = self.find(1 - n, keys[miss] >> U(16))
                tails = keys[miss] & U((1 << 16 * (n - 1)) - 1)
                out[miss] = np.where(some, back, 0.0) + self.log_p(tails, n - 1)
        return out


def _pack(batches):
    """A partition's rows as one pair of byte strings for each language and kind."""
    got: dict[tuple, list] = {}
    for batch in batches:
        langs, kinds = batch.column("lang").to_pylist(), batch.column("kind").to_numpy()
        keys, values = batch.column("key").to_numpy(), batch.column("value").to_numpy()
        langs = np.array(langs, object)
        for lang in set(langs.tolist()):
            for kind in np.unique(kinds[langs == lang]).tolist():
                own = (langs == lang) & (kinds == kind)
                got.setdefault((lang, kind), []).append((keys[own], values[own]))
    for (lang, kind), parts in got.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([kind], pa.int32()), pa.array([np.concatenate([k for k, _ in parts]).astype("<i8").tobytes()]),
             pa.array([np.concatenate([v for _, v in parts]).astype("<f8").tobytes()])], ["lang", "kind", "keys", "values"])


def load_arrays(model: DataFrame) -> dict[str, Arrays]:
    """The model as arrays, 16 bytes a row; callers check the number of rows."""
    got: dict[str, list] = {}
    for r in model.mapInArrow(_pack, "lang string, kind int, keys binary, values binary").toLocalIterator():
        got.setdefault(r["lang"], []).append((r["kind"], np.frombuffer(r["keys"], "<i8"), np.frombuffer(r["values"], "<f8")))
    return {lang: Arrays(np.concatenate([np.full(len(k), kind) for kind, k, _ in parts]), np.concatenate([k for _, k, _ in parts]),
                         np.concatenate([v for _, _, v in parts])) for lang, parts in got.items()}


# ---- scoring -------------------------------------------------------------

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def score(df: DataFrame, model: DataFrame, text: str = "text", lang: str = "lang",
          carry: list[str] | None = None, broadcast_rows: int = 8_000_000) -> DataFrame:
    """``(row, lang, measures, n_units, log_ppl)``: ``row`` has the input columns
    ``carry`` (default: all), ``log_ppl`` is the mean negative log-probability
    of a unit (null without units, or where the model lacks the language)."""
    spark = df.sparkSession
    ship(spark)
    carry = carry or df.columns
    src = _source(df, text, lang, carry)
    place = carry.index(text) if text in carry else None
    small = model.limit(broadcast_rows + 1).count() <= broadcast_rows
    shared = spark.sparkContext.broadcast(load_arrays(model)) if small else None

    def run(batches):
        for batch in batches:
            row = batch.column("row")
            texts = batch.column("text") if place is None else row.field(place)
            whole = pa.RecordBatch.from_arrays([row, batch.column("lang"), texts], ["row", "lang", "text"])
            for part in slices(whole, "text"):
                col = text_column(part, "text")
                got = word_measures(col)
                langs, total, units, grams = part.column("lang").to_pylist(), [], [], []
                for t, x in zip(col.to_pylist(), langs):
                    keys, n = runs(gram_keys([t]))
                    units.append(int(n.sum()))
                    if shared:
                        own = shared.value.get(x)
                        total.append(float((own.log_p(keys) * n).sum()) if own and len(keys) else None)
                    else:
                        grams.append((keys.astype(np.int64), n))
                cols = [part.column("row"), part.column("lang"), *[pa.array(got[k], pa.int64()) for k in MEASURES],
                        pa.array(units, pa.int64())]
                if shared:
                    cols.append(pa.array([None if x is None else -x / n for x, n in zip(total, units)], pa.float64()))
                else:
                    cols += [pa.array([k.tolist() for k, _ in grams], pa.list_(pa.int64())),
                             pa.array([n.tolist() for _, n in grams], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names)

    names = ["row", "lang", *MEASURES, "n_units", *(["log_ppl"] if small else ["keys", "times"])]
    head = (src.schema["row"].dataType.simpleString(), "string", *["bigint"] * (len(MEASURES) + 1))
    kinds = [*head, *(["double"] if small else ["array<bigint>", "array<bigint>"])]
    out = src.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    if small:
        return out
    # beyond the bound: the documents' distinct n-grams meet the model's rows
    out = written(out.withColumn("id", F.expr("uuid()")), "kn-documents")
    grams = written(out.select("id", "lang", F.explode(F.arrays_zip("keys", "times")).alias("x")).select(
        "id", "lang", F.col("x.keys").alias("key"), F.col("x.times").alias("n")), "kn-document-grams")
    known = log_p_rows(grams.select("lang", "key").distinct(), model)
    sums = grams.join(known, ["lang", "key"]).groupBy("id").agg(F.sum(F.col("n") * F.col("log_p")).alias("s"))
    return out.drop("keys", "times").join(sums, "id", "left").withColumn(
        "log_ppl", F.when(F.col("n_units") > 0, -F.col("s") / F.col("n_units"))).drop("id", "s")


def log_p_rows(grams: DataFrame, model: DataFrame) -> DataFrame:
    """``(lang, key, log_p)`` of distinct n-grams, as ``Arrays.log_p``: an n-gram
    that the model lacks takes its context's back-off weight and the next lower
    order, down to the probability of a unit never seen."""
    def rows(kind: int, name: str) -> DataFrame:
        return model.filter(F.col("kind") == kind).select("lang", F.col("key").alias("part"), F.col("value").alias(name))

    whole = written(grams.join(rows(ORDER, "log_p").withColumnRenamed("part", "key"), ["lang", "key"], "left"), "kn-known")
    rest = whole.filter("log_p is null").select("lang", "key")
    for n in range(ORDER - 1, -1, -1):  # the context of n units, then the n-gram that is left
        context = F.shiftrightunsigned(_tail(F.col("key"), n + 1), 16) if n < ORDER - 1 else F.shiftrightunsigned("key", 16)
        rest = rest.withColumn("part", context if n else F.lit(0).cast("bigint")).join(rows(-n, f"b{n}"), ["lang", "part"], "left")
        if n:
            rest = rest.withColumn("part", _tail(F.col("key"), n)).join(rows(n, f"p{n}"), ["lang", "part"], "left")
    found = F.col("b0")
    for n in range(1, ORDER):
        found = F.coalesce(F.col(f"p{n}"), found) + F.coalesce(F.col(f"b{n}"), F.lit(0.0))
    return whole.filter("log_p is not null").union(rest.select("lang", "key", found.alias("log_p")))


def base_failed():
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def bands(scored: DataFrame, lower: float = REACH, upper: float = REACH, least: float = 0.02) -> DataFrame:
    """``(lang, low, high)``: the median of ``log_ppl`` of the documents that pass
    the word rules, less ``lower`` and more ``upper`` robust standard deviations
    (1.4826 times the median distance from it, ``least`` at least) of the documents
    on that side of it."""
    grid = 1000

    def median(table: DataFrame, value: str, name: str) -> DataFrame:
        """By whole bins: a language has a few thousand of them at most."""
        bins = table.groupBy("lang", F.round(F.col(value) * grid).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
        lists = bins.groupBy("lang").agg(F.sum("n").alias("all"), F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("l"))
        run = F.aggregate("l", F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("at")),
                          lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"),
                                                F.coalesce(a["at"], F.when((a["seen"] + x["n"]) * 2 >= F.col("all"), x["bin"])).alias("at")))
        return lists.select("lang", (run["at"] / grid).alias(name))

    ok = scored.filter(~base_failed() & F.col("log_ppl").isNotNull()).select("lang", "log_ppl")
    mid = median(ok, "log_ppl", "mid")
    off = F.col("log_ppl") - _of_language(mid, "mid")["mid"]
    off = ok.select("lang", off.alias("off"), F.abs(off).alias("away"))

    def end(out: DataFrame, times: float, side: int, name: str) -> DataFrame:
        out = out.join(median(off.filter(F.round(side * F.col("off") * grid) > 0), "away", "mad"), "lang", "left")
        sigma = F.greatest(F.lit(least), 1.4826 * F.coalesce("mad", F.lit(0.0)))
        return out.withColumn(name, F.col("mid") + side * times * sigma).drop("mad")

    return end(end(mid, lower, -1, "low"), upper, 1, "high").select("lang", "low", "high")


def judge(df: DataFrame, text: str = "text", lang: str = "lang", carry: list[str] | None = None,
          lower: float = REACH, upper: float = REACH) -> DataFrame:
    """``(row, lang, measures, n_units, log_ppl, low, high, base_failed, kept)``;
    ``lower`` and ``upper`` as in ``bands``."""
    model = written(smooth(written(count_grams(df, text, lang), "kn-counts")), "kn-model")
    scored = written(score(df, model, text, lang, carry), "kn-scored")
    limits = F.col("limits")
    inside = F.col("log_ppl").between(limits["low"], limits["high"])
    return (scored.withColumn("limits", _of_language(bands(scored, lower, upper), "low", "high"))
            .select("*", limits["low"].alias("low"), limits["high"].alias("high"), base_failed().alias("base_failed"))
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))))
