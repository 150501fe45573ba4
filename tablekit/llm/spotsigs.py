"""Document fingerprints by SpotSigs.

A spot signature is a common word (the anchor) with the chain of the next
``chain`` content words, ``distance`` apart, that follow it, hashed to 40 bits. A text's
fingerprint is the set of its signatures as a string: its length partition, its
length and the sorted hashes; two fingerprints are as alike as the
Jaccard similarity of their sets (``likeness`` reads it from the strings). Sets of
partitions that are not neighbours differ too much in length to reach ``PARTITION``
alike. ``near_copies`` uses both: fingerprints meet on rare signatures within their own
and the next partition, and each pair is compared with an early end where the lengths, or
the signatures left to see, rule the bound out. ``fingerprints`` wants exact values of
two comparisons a document and never ends early.

The edited text of a document needs the next document by id: rows go to ranges
of ids, each range with the first document of the range after it, and a task
walks its ranges in order, holding a slice of rows at a time.

Words are runs of bytes other than ASCII white space and punctuation, A-Z in
lower case. A text with words but no whole chain has its word sequence as one
signature; an empty or null text has the empty set. Two empty sets are alike
(1), an empty and another not (0). Null ids come first; rows of one id follow
each other in the order of their texts. With one row the next is the row
itself. An empty table gives an empty one; extra columns are left out.
"""

from __future__ import annotations

from base64 import b64decode, b64encode
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_range_bucket
from . import textops
from .components import components
from .runtime import keep_columns, ship, slices, utf8_bytes, written

U = np.uint64
PARTITION = 0.8
#: Keeps a bound's exact multiples on its near side.
EDGE = 1e-9
# The anchors, common words of English, German, French and Spanish.
ANCHORS = ("a an the of to in is it on or be as at by for from that this was with and are not have has "
           "der die das den dem des ein eine und ist zu von im mit für auf nicht als auch sich "
           "le la les un une de du et est en que qui dans pour par sur pas au avec ce "
           "el los las una y del se no con su lo al como más por para").split()

_APART = textops._SPACE.copy()
for _c in range(0x21, 0x80):
    if not chr(_c).isalnum():
        _APART[_c] = True


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    buf, offs = utf8_bytes(texts)
    buf = textops.lower_ascii(buf)
    s, e, first = textops.word_spans(buf, offs, _APART)
    return textops.span_hashes(buf, s, e), first


def _anchor_hashes() -> np.ndarray:
    return np.unique(_hashes(pa.array(ANCHORS))[0])


def signatures(texts: pa.Array, distance: int = 1, chain: int = 2) -> list[np.ndarray]:
    """Each text's distinct spot signatures, sorted, as 40-bit hashes."""
    words, first = _hashes(texts)
    common = _anchor_hashes()
    at = np.minimum(np.searchsorted(common, words), len(common) - 1)
    anchor = common[at] == words
    content = np.flatnonzero(~anchor)
    spots = np.flatnonzero(anchor)
    text = np.searchsorted(first, spots, "right") - 1
    after = np.searchsorted(content, spots)  # the first content word behind each anchor
    ends = np.searchsorted(content, first[1:])  # content words up to each text's end
    h = words[spots].copy()
    last = after + (chain - 1) * distance
    whole = last < ends[text]
    for k in range(chain):
        step = np.minimum(after + k * distance, max(0, len(content) - 1))
        h = textops.mix(h * U(0x9FB21C651E98DF25) + (words[content[step]] if len(content) else h))
    h, text = h[whole], text[whole]
    cuts = np.searchsorted(text, np.arange(len(first)))
    out = []
    for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        if b > a:
            out.append(np.unique(h[a:b] >> U(24)))
        elif first[i + 1] > first[i]:
            out.append(np.array([textops.sequence_hash(words[first[i]:first[i + 1]]) >> 24], U))
        else:
            out.append(np.zeros(0, U))
    return out


def length_partition(n: int) -> int:
    """Sets alike by ``PARTITION`` or more lie in one partition or in two that touch."""
    return int(np.log(n) / np.log(1 / PARTITION) + EDGE) + 1 if n else 0


def fingerprint(sigs: np.ndarray) -> str:
    """Length partition, length and the sorted set, five bytes a signature."""
    raw = sigs.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()
    return f"{length_partition(len(sigs)):03x}-{len(sigs):x}-{b64encode(raw).decode()}"


def signature_set(print_: str) -> np.ndarray:
    """The set that a fingerprint spells."""
    raw = np.frombuffer(b64decode(print_.split("-", 2)[2]), np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 3:] = raw
    return out.reshape(-1).view(">u8").astype(U)


def likeness(a: str, b: str, least: float = 0.0) -> float:
    """Jaccard similarity of two fingerprints, from the strings alone."""
    return jaccard(signature_set(a), signature_set(b), least)


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0, step: int = 256) -> float:
    """Jaccard similarity of two sorted sets, or 0.0 as soon as it cannot reach ``least``."""
    m, n = len(a), len(b)
    if not m or not n:
        return float(m == n)
    if min(m, n) < least * max(m, n) - EDGE:
        return 0.0
    need = least / (1 + least) * (m + n) - EDGE
    if not least:
        common = int((b[np.minimum(np.searchsorted(b, a), n - 1)] == a).sum())
        return common / (m + n - common)
    common = 0
    for i in range(0, m, step):
        part = a[i:i + step]
        common += int((b[np.minimum(np.searchsorted(b, part), n - 1)] == part).sum())
        if common + m - i - len(part) < need:
            return 0.0
    return common / (m + n - common)


def edited_text(text: str, following: str) -> str:
    """The last half replaced by as much of the following text's beginning."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _ranges(src: DataFrame) -> DataFrame:
    """``(chunk, tail, id, text)``: rows by ranges of ids, and behind each range
    (``tail`` 1) the first document of the next range, the first one behind the
    last. The ranges' firsts, one row a range, go through the driver."""
    spark = src.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = with_range_bucket(src.select("id"), ["id"], n, name="chunk")
    firsts = sorted((r["chunk"], r["id"]) for r in ids.groupBy("chunk").agg(
        F.min(F.struct(F.col("id").isNotNull().alias("some"), "id")).alias("x")).select("chunk", "x.id").collect())
    rows = with_range_bucket(src, ["id"], n, name="chunk").select("chunk", F.lit(0).alias("tail"), "id", "text")
    if not firsts:
        return rows
    before = [(firsts[i - 1][0], v) for i, (_, v) in enumerate(firsts)]
    small = spark.createDataFrame(before, f"chunk int, first {src.schema['id'].dataType.simpleString()}")
    tails = src.join(F.broadcast(small), src["id"].eqNullSafe(small["first"]))
    return rows.union(tails.select("chunk", F.lit(1), "id", "text"))


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", distance: int = 1, chain: int = 2) -> DataFrame:
    """``(key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)`` for every row."""
    ship(df.sparkSession)
    src = keep_columns(df, [key, text]).toDF("id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    kind = src.schema["id"].dataType.simpleString()
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _ranges(src).repartition(n, "chunk").sortWithinPartitions("chunk", "tail", "id", "text")
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        held = None
        for batch in batches:
            for part in slices(batch, "text"):
                if held is not None:
                    part = pa.concat_batches([held, part])
                held = part.slice(part.num_rows - 1)
                chunk, tail = part.column("chunk").to_pylist(), part.column("tail").to_pylist()
                use = [i for i in range(part.num_rows - 1) if not tail[i] and chunk[i] == chunk[i + 1]]
                if not use:
                    continue
                texts = part.column("text").to_pylist()
                sets = signatures(part.column("text"), distance, chain)
                edits = [edited_text(texts[i], texts[i + 1]) for i in use]
                others = signatures(pa.array(edits, pa.string()), distance, chain)
                yield pa.RecordBatch.from_arrays([
                    part.column("id").take(pa.array(use)),
                    pa.array([len(texts[i]) for i in use], pa.int64()),
                    pa.array([sha256(t.encode()).hexdigest() for t in edits]),
                    pa.array([fingerprint(sets[i]) for i in use]),
                    pa.array([fingerprint(s) for s in others]),
                    pa.array([jaccard(sets[i], s) for i, s in zip(use, others)], pa.float64()),
                    pa.array([jaccard(sets[i], sets[i + 1]) for i in use], pa.float64())], names)

    out = rows.mapInArrow(run, f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
                               "edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("id", key)


# ---- near copies ---------------------------------------------------------

def _sets(batches):
    """Distinct fingerprints as rows of their signatures."""
    for batch in batches:
        sets = [signature_set(x) for x in batch.column("fingerprint").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([length_partition(len(s)) for s in sets], pa.int32()), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))], ["id", "part", "n", "sigs"])


def _alike(least: float):
    def run(batches):
        for batch in batches:
            one, two = batch.column("one").to_pylist(), batch.column("two").to_pylist()
            near = [jaccard(np.array(a, U), np.array(b, U), least) >= least for a, b in zip(one, two)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))
    return run


def near_copies(prints: DataFrame, key: str = "doc_id", least: float = PARTITION) -> DataFrame:
    """``(key, class_id)`` of every row of ``(key, fingerprint)``: the smallest key that
    likenesses of ``least`` (``PARTITION`` or more) reach. Equal fingerprints are one class from the
    start. A pair so alike shares one of the n - least n + 1 rarest signatures of either
    side and lies in one length partition or two that touch, so sets meet on (partition,
    rare signature), the shorter partition's also as their next one's. On each such meeting only the
    sets that the first one is not alike to meet one another as well, so a large group of near copies
    costs a comparison each. An empty set is alike to empty ones only."""
    if least < PARTITION:
        raise ValueError(f"partitions are made for a likeness of {PARTITION} or more")
    ship(prints.sparkSession)
    rows = prints.select(prints[f"`{key}`"].alias("key"), prints["fingerprint"])
    own = written(rows.groupBy("fingerprint").agg(F.min("key").alias("id")).filter("id is not null"), "spots-classes")
    kind = own.schema["id"].dataType.simpleString()
    sets = written(own.mapInArrow(_sets, f"id {kind}, part int, n bigint, sigs array<bigint>").filter("n > 0"), "spots-sets")
    each = sets.select("id", "part", "n", F.explode("sigs").alias("sig"))
    rank = written(each.groupBy("sig").agg(F.count("*").alias("times")), "spots-times")
    rare = each.join(rank.filter("times > 1"), "sig", "left").select("id", "part", "n", "sig", F.coalesce("times", F.lit(1)).alias("times"))
    rare = rare.groupBy("id", "part", "n").agg(F.collect_list(F.struct("times", "sig")).alias("l")).select(
        "id", "part", "n", F.slice(F.array_sort("l"), 1, (F.col("n") - F.ceil(F.lit(least) * F.col("n") - EDGE) + 1).cast("int")).alias("l"))
    rare = rare.select("id", "part", "n", F.explode("l").alias("x")).filter("x.times > 1")
    # a set meets its own partition and the one above
    at = F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("at")
    meet = written(rare.select("id", "n", F.col("x.sig").alias("sig"), at), "spots-meet")
    lead = meet.groupBy("sig", "at").agg(F.min(F.struct("n", "id")).alias("lead")).select("sig", "at", "lead.id")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "spots-pairs")
        one, two = sets.select(F.col("id").alias("a"), F.col("sigs").alias("one")), sets.select(F.col("id").alias("b"), F.col("sigs").alias("two"))
        both = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
        return written(both.mapInArrow(_alike(least), f"a {kind}, b {kind}"), "spots-alike")

    first = meet.join(lead.withColumnRenamed("id", "lead"), ["sig", "at"])
    links = verified(first.select(F.col("id").alias("a"), F.col("lead").alias("b")))
    so_far = written(components(links), "spots-so-far")
    named = first.join(so_far.toDF("id", "comp"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    named = named.join(so_far.toDF("lead", "main"), "lead", "left").withColumn("main", F.coalesce("main", "lead"))
    named = written(named.select("sig", "at", "id", "n", "comp", (F.col("comp") != F.col("main")).alias("apart")), "spots-named")
    x, y = named.filter("apart").alias("x"), named.alias("y")
    long = F.greatest("x.n", "y.n") * least - EDGE <= F.least("x.n", "y.n")
    again = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.at") == F.col("y.at"))).filter((F.col("x.comp") != F.col("y.comp")) & long)
    links = links.union(verified(again.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))))
    found = components(written(links, "spots-links"))
    classes = own.join(found, own["id"] == found["vertex"], "left").select("fingerprint", F.coalesce("component", "id").alias("class_id"))
    return rows.join(classes, "fingerprint", "left").select(F.col("key").alias(key), "class_id")
