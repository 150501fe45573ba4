"""N-gram Jaccard join by adaptive multi-match prefixes.

A document's set is its distinct shingles of ``k`` words (3), as 64-bit tokens in a
global order from rare to frequent. The order comes from a count sketch over every
shingle of the corpus: a token is the sketch's level (log count) followed by
the shingle's hash. Any order gives right results; this one makes prefixes of
rare tokens.

Two sets link if their Jaccard similarity is ``percent`` / 100 (90) or more. With
sizes m and n they then share at least ``need(m, n)`` tokens, so for any l the first ``m - need + l`` tokens of the one and the first
``n - need + l`` of the other share at least l tokens. Each document takes the l of
the least estimated cost, of meeting the other documents on its prefix tokens
and of verifying those met l times: a longer prefix meets more, and must be met
more often. A pair uses the smaller l of its two documents.

Links, not pairs, are wanted whole, so the join leaves out pairs that cannot
add one: equal sets are one class; then each class is verified against the
leader of each of its prefix tokens (the class with the fewest rarer tokens),
and the components so far tell which pairs are already joined. The prefix join
then yields pairs of different components only: on each token, classes outside
the leader's component meet all other classes. Every pair found is verified on
the whole sets.

Documents without words (or null) have an empty set and link with nothing; with
fewer than ``k`` words the whole sequence is one token. Rows of one ``doc_id`` count
as one document. An empty table gives an empty one; extra columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .components import components
from .runtime import keep_columns, list_array, ship, slices, utf8_bytes, written

U = np.uint64
#: Cells of the count sketch and of the bitmap of wanted documents.
SKETCH_BITS = 22
BLOCKS = 64
#: Largest l; cost of a verification, in rows met on a token.
MOST = 4
VERIFY = 50


# ---- sets ----------------------------------------------------------------

def shingle_sets(texts: pa.Array, k: int = 3) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    buf, offs = utf8_bytes(texts)
    words, first = textops.word_hashes(buf, offs, lower=True)
    windows = textops.window_hashes(words, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(windows[a:b - k + 1]))
        elif b > a:
            out.append(np.array([textops.sequence_hash(words[a:b])], U))
        else:
            out.append(np.zeros(0, U))
    return out


def tokens(shingles: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Tokens in the global order: level, then 56 bits of the hash."""
    level = levels[(shingles >> U(64 - SKETCH_BITS)).astype(np.int64)].astype(U)
    return np.sort(level << U(56) | shingles >> U(8)).astype(np.int64)


def _cells(blocks_of) -> callable:
    """A task that adds up cells and sends them in compressed blocks."""
    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.uint32)  # a task's own; sums over tasks take 64 bits
        for batch in batches:
            for cells in blocks_of(batch):
                own, n = np.unique(cells, return_counts=True)
                total[own] += n.astype(np.uint32)
        for i, part in enumerate(np.split(total, BLOCKS)):
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([zlib.compress(part.astype("<i8").tobytes(), 1)], pa.binary())],
                    ["block", "cells"])
    return run


def _add_blocks(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, raw in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist()):
            part = np.frombuffer(zlib.decompress(raw), "<i8")
            total[i] = total[i] + part if i in total else part
    for i, part in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([i], pa.int32()), pa.array([zlib.compress(part.astype("<i8").tobytes(), 1)], pa.binary())], ["block", "cells"])


def _gathered(parts: DataFrame) -> np.ndarray:
    """All cells: blocks are summed on the executors, one running sum a block;
    the driver gets ``BLOCKS`` rows whatever the input."""
    rows = parts.repartition(BLOCKS, "block").mapInArrow(_add_blocks, "block int, cells binary").collect()
    out = np.zeros((BLOCKS, (1 << SKETCH_BITS) // BLOCKS), np.int64)
    for r in rows:
        out[r["block"]] = np.frombuffer(zlib.decompress(r["cells"]), "<i8")
    return out.reshape(-1)


def frequency_levels(texts: DataFrame, k: int = 3) -> np.ndarray:
    """Sketch of all shingles of the ``text`` column as levels 0 to 127."""
    def cells(batch):
        for part in slices(batch, "text"):
            yield (np.concatenate(shingle_sets(part.column("text"), k)) >> U(64 - SKETCH_BITS)).astype(np.int64)

    counts = _gathered(texts.mapInArrow(_cells(cells), "block int, cells binary"))
    return np.minimum(np.round(4 * np.log2(1.0 + counts)), 127).astype(np.uint8)


def least_overlap(n: int, percent: int = 90) -> int:
    """Tokens that a set of n shares with any set it links with, at least."""
    return (percent * n + 99) // 100


def make_sets(src: DataFrame, levels, k: int = 3, percent: int = 90) -> DataFrame:
    """``(doc_id, n, h1, h2, prefix)``: set size, digest of the set, and its first
    tokens, enough for every l."""
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), k)
                heads, h1, h2 = [], [], []
                for s in sets:
                    n = len(s)
                    heads.append(tokens(s, levels.value)[:n - least_overlap(n, percent) + MOST] if n else np.zeros(0, np.int64))
                    h1.append(int(s.sum(dtype=U)))
                    h2.append(int(textops.mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U)))
                lens = [len(h) for h in heads]
                flat = np.concatenate(heads) if heads else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(np.array(h1, U).astype(np.int64)), pa.array(np.array(h2, U).astype(np.int64)),
                     list_array(flat, lens, pa.int64())], ["doc_id", "n", "h1", "h2", "prefix"])

    return src.mapInArrow(run, f"doc_id {kind}, n bigint, h1 bigint, h2 bigint, prefix array<bigint>")


# ---- verification --------------------------------------------------------

def wanted_sets(src: DataFrame, levels, ids: DataFrame, k: int = 3) -> DataFrame:
    """``(id, tokens)`` of the documents in ``ids`` (and some others): a bitmap
    of fixed size tells the tasks which texts to shingle again."""
    kind = src.schema["doc_id"].dataType.simpleString()
    cell = F.shiftrightunsigned(F.xxhash64("id"), 64 - SKETCH_BITS).cast("int")

    def marks(batch):
        yield batch.column("cell").to_numpy()

    bits = _gathered(ids.select(cell.alias("cell")).mapInArrow(_cells(marks), "block int, cells binary")) > 0
    shared = src.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches):
        want = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(want[batch.column("cell").to_numpy()]))
            for part in slices(batch, "text"):
                sets = [tokens(s, levels.value) for s in shingle_sets(part.column("text"), k)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), list_array(np.concatenate(sets), [len(s) for s in sets], pa.int64())], ["id", "tokens"])

    cells = src.select("doc_id", "text", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - SKETCH_BITS).cast("int").alias("cell"))
    return cells.mapInArrow(run, f"id {kind}, tokens array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = 90) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets link."""
    one = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    met = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("ta", "tb")))
    return met.filter((100 + percent) * F.col("common") >= percent * (F.size("ta") + F.size("tb"))).select("a", "b").distinct()


# ---- join ----------------------------------------------------------------

def _need(m, n, percent: int):
    return F.ceil(percent * (m + n) / F.lit(100 + percent))


def _matches(x: DataFrame, y: DataFrame, percent: int = 90) -> DataFrame:
    """Pairs ``(a, b)`` of the two sides that meet on as many tokens of their
    l-prefixes as they must; l is the smaller of the two documents'."""
    x, y = x.alias("x"), y.alias("y")
    need = _need(F.col("x.n"), F.col("y.n"), percent)
    l = F.least(F.col("x.l"), F.col("y.l"), need)
    met = x.join(y, F.col("x.token") == F.col("y.token")).filter(
        (F.col("x.comp") != F.col("y.comp")) & (F.col("x.pos") < F.col("x.n") - need + l) & (F.col("y.pos") < F.col("y.n") - need + l)
        & (~F.col("y.probe") | (F.col("x.id") < F.col("y.id"))))
    ids = F.col("x.id"), F.col("y.id")
    return (met.groupBy(F.least(*ids).alias("a"), F.greatest(*ids).alias("b")).agg(F.count("*").alias("met"), F.min(l).alias("l"))
            .filter("met >= l").select("a", "b"))


def shared_tokens(sets: DataFrame, percent: int = 90) -> DataFrame:
    """``(token, pos, n, id, l)``: prefix tokens that several classes have, with
    each class's l. Of the l a class takes the one with the least estimated
    cost against partners of its size: the rows that it meets on the l-prefix's
    tokens, and ``VERIFY`` for each candidate, which number about as many as the l-th longest list has
    (documents on one long list tend to be those on the next)."""
    rows = sets.select("id", "n", F.posexplode("prefix").alias("pos", "token"))
    often = rows.groupBy("token").agg(F.count("*").alias("times")).filter("times > 1")
    rows = written(rows.join(often, "token"), "mm-tokens")
    each = rows.groupBy("id", "n").agg(F.collect_list(F.struct("pos", (F.col("times") - 1).alias("others"))).alias("t"))
    own = _need(F.col("n"), F.col("n"), percent)
    costs = []
    for l in range(1, MOST + 1):
        lists = F.transform(F.filter("t", lambda x: x["pos"] < F.col("n") - own + l), lambda x: x["others"])
        met = F.aggregate(lists, F.lit(0).cast("bigint"), lambda a, x: a + x)
        kth = F.coalesce(F.get(F.sort_array(lists, asc=False), l - 1), F.lit(0))
        costs.append(F.struct((met + VERIFY * kth).alias("cost"), F.lit(l).alias("l")))
    best = each.select("id", "n", F.least(*costs)["l"].alias("l"))
    return rows.join(best, ["id", "n"]).select("token", "pos", "n", "id", "l")


def linked(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90) -> DataFrame:
    """``(key, n_shingles, component_id)`` for every row: documents link when the
    Jaccard similarity of their ``k``-word sets is ``percent`` / 100 or more, and ``component_id`` is the
    smallest key that links reach."""
    spark = df.sparkSession
    ship(spark)
    src = keep_columns(df, [key, text]).toDF("doc_id", "text")
    levels = spark.sparkContext.broadcast(frequency_levels(src.select("text"), k))
    sets = written(make_sets(src, levels, k, percent), "mm-sets")
    digest = ["n", "h1", "h2"]
    classes = written(sets.filter("n > 0").groupBy(*digest).agg(
        F.min("doc_id").alias("id"), F.min_by("prefix", F.struct("doc_id")).alias("prefix")), "mm-classes")
    rows = written(shared_tokens(classes.select("id", "n", "prefix"), percent), "mm-shared")

    def sets_of(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        return written(wanted_sets(src, levels, ids, k).join(ids, "id", "left_semi"), "mm-whole")

    # each class and the leaders of its tokens
    single = rows.withColumn("comp", F.col("id")).withColumn("probe", F.lit(False))
    lead = rows.groupBy("token").agg(F.min(F.struct("pos", "n", "id", "l")).alias("y")).select("token", "y.*")
    lead = lead.withColumn("comp", F.col("id")).withColumn("probe", F.lit(False))
    stars = written(_matches(single, lead, percent), "mm-stars")
    links = written(verified(stars, sets_of(stars), percent), "mm-links")
    so_far = written(components(links), "mm-so-far")

    # classes of different components on one token
    rows = rows.join(so_far, rows["id"] == so_far["vertex"], "left").select(
        "token", "pos", "n", "id", "l", F.coalesce("component", "id").alias("comp"))
    several = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                        F.min_by("comp", F.struct("pos", "n", "id")).alias("main"))
    rows = rows.join(several.filter("lo <> hi").select("token", "main"), "token")
    rows = written(rows.withColumn("probe", F.col("comp") != F.col("main")).drop("main"), "mm-open")
    pairs = written(_matches(rows.filter("probe"), rows, percent).join(stars, ["a", "b"], "left_anti"), "mm-pairs")
    links = written(links.union(verified(pairs, sets_of(pairs), percent)), "mm-all-links")

    named = components(links)
    classes = classes.join(named, classes["id"] == named["vertex"], "left").select(
        *digest, F.coalesce("component", "id").alias("component_id"))
    out = sets.join(classes, digest, "left")
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id"))
