"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a keyed pseudo-random order, are laid end to end (each
takes its characters and one more) and cut into blocks; a document belongs to the
block it begins in. In the ideal mix all sources run at once, each at a rate of its
weight's share among those that still have something left; after V units of weighted
time a source of weight w and n blocks has had min(w V, n) blocks, and all together as many
slots as those add up to. Block j is released at the slot in which the ideal mix
begins it, and due by the end of the slot in which the ideal mix ends it; both are
sums over the sources that end earlier and a product, in whole numbers. In each slot
the released block with the earliest deadline runs, which meets every
deadline: after any number of slots every source is less than one block from the ideal
mix, whatever its weight and the number of sources.

The schedule is a table of a row a block, joined to the documents on source and block.
Blocks have ``block_chars`` characters, or more where the corpus would have over
``BLOCKS`` of them, so the schedule is made by one task from one row a source. Nothing
depends on the session's number of partitions: parts of a source are ranges of its
documents' hashes, ``PARTS`` of them. No document is dropped or repeated.

All this is decided on rows without texts. ``rows_in_order`` moves the whole rows once:
the slots are cut to ranges, of which a source has a run of its documents each, and the
documents that begin these runs tell any row its range without its slot.

A null source is a source of its own; null and empty texts take one character and
stay. Rows of one id keep one place each (ties fall by text); an empty table
gives an empty one. Extra columns are carried.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import ship, written

#: Blocks of a schedule, beside one a source.
BLOCKS = 1 << 18
PARTS_BITS = 12
#: Weights are whole numbers that add up to about this.
TOTAL_WEIGHT = 1 << 40
#: Rows of a schedule that are sent to every task; more are joined by shuffle.
BROADCAST_ROWS = 1 << 20
#: Cells of a source's hashes, in which a row looks up its range of slots.
CELL_BITS = 8


def whole_weights(weights: list[float]) -> list[int]:
    """Whole numbers in proportion to the weights, 1 at least."""
    total = sum(weights) or 1.0
    return [max(1, round(w / total * TOTAL_WEIGHT)) for w in weights]


def windows(blocks: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(source, block, release, due)`` of every block, in slots."""
    end = blocks / weights  # weighted time at which the ideal mix is through with a source
    order = np.argsort(end, kind="stable")
    gone = np.concatenate(([0], np.cumsum(blocks[order])))  # blocks of the sources that end first
    live = weights.sum() - np.concatenate(([0], np.cumsum(weights[order])))
    source = np.repeat(np.arange(len(blocks)), blocks)
    j = np.arange(len(source)) - np.repeat(np.cumsum(blocks) - blocks, blocks)

    def slot(k):
        """The ideal mix's slots, as a whole part and a fraction's terms, when it ends block k - 1."""
        w = weights[source]
        at = np.searchsorted(end[order], k / w, "left")
        at = np.minimum(at, len(blocks) - 1)
        return gone[at], live[at] * k, w

    whole, up, down = slot(j)
    release = whole + up // down
    whole, up, down = slot(j + 1)
    return source, j, release, whole - (-up // down)


def earliest_deadline_first(release: np.ndarray, due: np.ndarray) -> np.ndarray:
    """The slot of each block: of those released the one due first runs."""
    order = np.argsort(release, kind="stable").tolist()
    release, due = release.tolist(), due.tolist()
    ready: list[tuple[int, int]] = []
    slots, at = np.empty(len(order), np.int64), 0
    for slot in range(len(order)):
        while at < len(order) and (release[order[at]] <= slot or not ready):
            heappush(ready, (due[order[at]], order[at]))
            at += 1
        slots[heappop(ready)[1]] = slot
    return slots


def schedule(blocks: list[int], weights: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(source, block, slot)`` of all blocks."""
    source, j, release, due = windows(np.array(blocks, np.int64), np.array(whole_weights(weights), np.int64))
    return source, j, earliest_deadline_first(release, due)


def _named(source):
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _schedule_task(block_chars: int):
    def run(batches):
        rows = sorted(((r["size"], r["name"], r["weight"]) for b in batches for r in b.to_pylist()), key=lambda r: (-r[0], r[1]))
        if not rows:
            return
        size = max(block_chars, -(-sum(r[0] for r in rows) // BLOCKS))
        source, block, slot = schedule([-(-r[0] // size) for r in rows], [r[2] for r in rows])
        names = pa.array([r[1] for r in rows], pa.string())
        for a in range(0, len(slot), 65_536):
            b = min(a + 65_536, len(slot))
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(source[a:b])), pa.array(source[a:b].astype(np.int32)), pa.array(block[a:b]), pa.array(slot[a:b]),
                 pa.array(np.full(b - a, size, np.int64))], ["name", "stream", "block", "slot", "block_size"])
    return run


def mixed(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", carry: list[str] | None = None,
          weights: dict | None = None, exponent: float = 0.7, block_chars: int = 1 << 14, seed: int = 17) -> DataFrame:
    """The input columns ``carry`` (default: all) in ``row``, and ``stream, block, slot, offset, size``:
    the training order is (slot, offset). Without ``weights`` (source to weight)
    a source's weight is its characters to the power ``exponent``; with them, sources that they leave out come last."""
    row = F.struct(*[df[f"`{c}`"] for c in carry or df.columns]).alias("row")
    docs = df.select(row, *_measures(df, key, source, text, seed))
    by_part, plan, small = _planned(docs, weights, exponent, block_chars)
    placed = _placed(docs, by_part).withColumns(_blocks(plan)).join(F.broadcast(plan) if small else plan, ["name", "block"])
    return placed.select("row", "stream", "block", "slot", "offset", "size", "order", "tie")


def _measures(df: DataFrame, key: str, source: str, text: str, seed: int) -> list:
    """``name, order, tie, size, part`` of a row: its place among its source's is by part, order, tie."""
    order = F.xxhash64(df[f"`{key}`"], F.lit(seed))
    return [
        # a source's name that is never null: joins and windows on it share one shuffle
        _named(df[f"`{source}`"].cast("string")).alias("name"), order.alias("order"), F.xxhash64(df[f"`{text}`"]).alias("tie"),
        (F.coalesce(F.length(df[f"`{text}`"]), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.shiftrightunsigned(order, 64 - PARTS_BITS).cast("int").alias("part")]


def _planned(docs: DataFrame, weights: dict | None, exponent: float, block_chars: int) -> tuple[DataFrame, DataFrame, bool]:
    """Characters by source and part, the schedule, and whether the schedule is small."""
    spark = docs.sparkSession
    ship(spark)
    by_part = written(docs.groupBy("name", "part").agg(F.sum("size").alias("size")), "mix-parts")
    totals = by_part.groupBy("name").agg(F.sum("size").alias("size"))
    if weights is None:
        totals = totals.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(exponent)))
    else:
        given = spark.createDataFrame([(k, float(w)) for k, w in weights.items()], "source string, weight double")
        totals = totals.join(given.select(_named(F.col("source")).alias("name"), "weight"), "name", "left").select("name", "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    plan = totals.repartition(1).mapInArrow(_schedule_task(block_chars), "name string, stream int, block bigint, slot bigint, block_size bigint")
    plan = written(plan, "mix-schedule")
    return by_part, plan, _is_small(plan)


def _is_small(table: DataFrame) -> bool:
    return table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _placed(docs: DataFrame, by_part: DataFrame) -> DataFrame:
    """``docs`` with ``at``, where each begins among its source's characters."""
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = by_part.select("name", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("name", "part").orderBy("order", "tie").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("here", F.coalesce(F.sum("size").over(within), F.lit(0))).join(begins, ["name", "part"])
    return docs.withColumn("at", F.col("begin") + F.col("here"))


def _blocks(plan: DataFrame) -> dict:
    size = plan.agg(F.max("block_size")).scalar()
    return {"block": F.floor(F.col("at") / size), "offset": F.col("at") % size}


def rows_in_order(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: dict | None = None,
                  exponent: float = 0.7, block_chars: int = 1 << 14, seed: int = 17, ranges: int | None = None) -> DataFrame:
    """``in_order(mixed(df))``'s ``row`` in the same order, with the whole rows shuffled once.
    ``ranges``: of slots, four for each of the session's partitions if not given."""
    row = F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")
    docs = df.select(row, *_measures(df, key, source, text, seed))
    by_part, plan, small = _planned(docs.drop("row"), weights, exponent, block_chars)
    ranges = ranges or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = F.shiftright("part", PARTS_BITS - CELL_BITS)
    rank = ["part", "order", "tie", "copy"]  # of a document in its source

    # rows alike in id and text take places of their own, by their other columns
    alike = ["name", "part", "order", "tie"]
    same = Window.partitionBy(*alike)
    thin = docs.drop("row")
    often = written(thin.groupBy(*alike).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "mix-alike")

    # the first document of each source in each range of slots
    slots = plan.select("name", "block", "slot")
    slots = F.broadcast(slots) if small else slots
    placed = _placed(thin, by_part).withColumns(_blocks(plan)).join(slots, ["name", "block"])
    which = F.floor(F.col("slot") * ranges / (plan.agg(F.max("slot")).scalar() + 1)).cast("int").alias("range")
    placed = placed.withColumn("copy", F.row_number().over(same.orderBy("at")))
    cuts = placed.groupBy("name", which).agg(F.min(F.struct(*rank, "at")).alias("first"))
    cuts = written(cuts.select("name", "first.part", F.struct(*[f"first.{c}" for c in rank], "range", "first.at").alias("cut")), "mix-cuts")

    # by source and cell of hashes: the cut that holds where the cell begins, and those in it
    inside = cuts.groupBy("name", cell.alias("cell")).agg(F.collect_list("cut").alias("own"), F.max("cut").alias("last"))
    cells = by_part.select("name", cell.alias("cell")).distinct().join(inside, ["name", "cell"], "left")
    held = F.max("last").over(Window.partitionBy("name").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("name", "cell", F.array_compact(F.concat(F.array(held), F.coalesce("own", F.array()))).alias("cuts"))
    cells = written(cells, "mix-cells")
    if not (small and _is_small(cells)):  # sources without number
        return in_order(mixed(df, key, source, text, None, weights, exponent, block_chars, seed)).select("row")

    if often.isEmpty():
        docs = docs.withColumn("copy", F.lit(1))
    else:
        few = F.broadcast(often) if _is_small(often) else often
        several = docs.join(few, alike, "left_semi").withColumn("copy", F.row_number().over(same.orderBy(F.xxhash64("row"))))
        docs = docs.join(few, alike, "left_anti").withColumn("copy", F.lit(1)).unionByName(several)
    docs = docs.withColumn("rank", F.struct(*rank)).withColumn("cell", cell).join(F.broadcast(cells), ["name", "cell"])
    passed = F.filter("cuts", lambda c: F.struct(*[c[x].alias(x) for x in rank]) <= F.col("rank"))
    docs = docs.withColumn("cut", F.array_max(passed)).select("row", "name", "size", *rank, "cut.range", F.col("cut.at").alias("begin"))
    docs = docs.repartitionByRange("range")  # a source's rows of a range are together, and their places in a running sum
    so_far = Window.partitionBy("range", "name").orderBy(*rank).rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("at", F.col("begin") + F.coalesce(F.sum("size").over(so_far), F.lit(0))).withColumns(_blocks(plan))
    return docs.join(slots, ["name", "block"]).sortWithinPartitions("slot", "offset").select("row")


def in_order(placed: DataFrame) -> DataFrame:
    """The rows in training order: ranges of slots, sorted."""
    by = ["slot", "offset", "order", "tie"]
    return placed.repartitionByRange(*by).sortWithinPartitions(*by)
