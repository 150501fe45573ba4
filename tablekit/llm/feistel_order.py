"""Training-order materialisation by a keyed Feistel permutation.

Documents fall to parts by a hash, and a part's documents, in the order of their
keys and each closed by an end mark, are one run of token ids that is cut to
sequences of ``length`` ids; only a part's last one is padded. Sequences are numbered
without gaps: a part's first number is the sum of the parts before it. The parts' sequences
are written once, as their number has to be known before slots are. A balanced
Feistel network over the numbers, walked on while it leaves [0, N), maps each number
to its slot in the training order: a bijection known from the key and N alone, so a
slot can be found, and a read resumed, without a table. Slots are dealt to shards by
ranges; tasks get ranges of shards and write each as a file of ``shard_rows`` sequences
of a fixed stride in the order of their slots. The number of parts is a parameter:
neither slots nor files depend on the session's partitions.

Null ids count as no ids: the document is its end mark. Repeated rows stand
as often as they occur (ties fall by their ids). An empty table gives no sequence.
Extra columns are left out.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe_bitmap, textops
from .runtime import joined, keep_columns, shared_dir, ship, shuffles_dropped, slices, text_column

U = np.uint64
ROUNDS = 6
PARTS = 4096
#: Sequences that a task hands on at once.
BATCH = 1024
#: Text bytes whose pre-tokens share a queue.
QUEUE_BYTES = 12 << 20
#: Shards are written in so many passes, each of which shuffles its own sequences only.
PASSES = 3


class Feistel:
    """A keyed permutation of [0, n)."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = [int(textops.mix(np.array([key * 0x9E3779B97F4A7C15 + r & (1 << 64) - 1], U))[0]) for r in range(ROUNDS)]

    def _pass(self, x: np.ndarray, keys) -> np.ndarray:
        half, mask = U(self.half), U((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (textops.mix(right + U(k)) & mask)
        return right << half | left

    def _walk(self, x, keys) -> np.ndarray:
        x = np.asarray(x).astype(U)
        out = self._pass(x, keys)
        while (far := out >= U(self.n)).any():
            out[far] = self._pass(out[far], keys)
        return out.astype(np.int64)

    def slots(self, numbers) -> np.ndarray:
        return self._walk(numbers, self.keys)

    def numbers(self, slots) -> np.ndarray:
        """The inverse: which sequence has a slot."""
        return self._walk(slots, self.keys[::-1])


def _cut(length: int, width: int, end: bytes, pad: bytes, kind: pa.DataType):
    """Runs of ids, part by part, to sequences numbered within their part."""
    stride = length * width

    def run(batches):
        part, number, held, keys, out = None, 0, bytearray(), [], []

        def done():
            nonlocal number, held, keys
            n_ids = len(held) // width
            out.append((part, number, n_ids, keys, bytes(held) + pad * (length - n_ids)))
            number, held, keys = number + 1, bytearray(), []

        def batch_of():
            kinds = pa.int32(), pa.int64(), pa.int64(), pa.list_(kind), pa.binary()
            cols = [pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, ["part", "number", "n_ids", "keys", "ids"])

        for batch in batches:
            for own, key, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "ids"))):
                if own != part:
                    if held:
                        done()
                    part, number = own, 0
                ids, at = (ids or b"") + end, 0
                while at < len(ids):
                    take = ids[at:at + stride - len(held)]
                    held += take
                    at += len(take)
                    keys.append(key)
                    if len(held) == stride:
                        done()
                if len(out) >= BATCH:
                    yield batch_of()
        if held:
            done()
        if out:
            yield batch_of()

    return run


def _slot_of(begin: dict[int, int], order: Feistel):
    """The slot of a part's sequence by its number. As it isn't called deterministic, a filter on slots asks for it once."""
    first = np.zeros(max(begin, default=-1) + 1, np.int64)
    first[list(begin)] = list(begin.values())

    def slot(part: pa.Array, number: pa.Array) -> pa.Array:
        return pa.array(order.slots(first[part.to_numpy(zero_copy_only=False)] + number.to_numpy(zero_copy_only=False)))

    return F.arrow_udf(slot, "bigint").asNondeterministic()


def sequences(df: DataFrame, key: str, ids: str, width: int, length: int, end: bytes, pad: bytes, seed: int,
              shard_rows: int, parts: int = PARTS) -> DataFrame:
    """``(slot, shard, place, n_ids, keys, ids)``, tasks with ranges of shards, sorted by
    slot: ``ids`` is binary of ``length * width`` bytes, ``keys`` names the documents that it
    has ids of. The input's ``ids`` are binary, ``width`` bytes an id."""
    spark = df.sparkSession
    ship(spark)
    name, raw = df[f"`{key}`"], df[f"`{ids}`"]
    part = F.pmod(F.xxhash64("key", "ids"), F.lit(parts)).cast("int").alias("part")
    src = df.select(name.alias("key"), raw.alias("ids")).select(part, "key", "ids")
    kind = src.schema["key"].dataType
    run = _cut(length, width, end, pad, pa.int64() if kind.typeName() == "long" else pa.string())
    cut = src.repartition("part").sortWithinPartitions("part", "key", "ids").mapInArrow(
        run, f"part int, number bigint, n_ids bigint, keys array<{kind.simpleString()}>, ids binary")
    path = f"{shared_dir(spark)}/training-sequences-{uuid.uuid4().hex[:12]}"
    with shuffles_dropped(spark):
        cut.write.option("compression", "zstd").parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)
    sizes = {r["part"]: r["n"] for r in cut.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    begin, total = {}, 0
    for p in sorted(sizes):
        begin[p] = total
        total += sizes[p]
    shards = max(1, -(-total // shard_rows))
    tasks = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = cut.select(_slot_of(begin, Feistel(total, seed))("part", "number").alias("slot"), "n_ids", "keys", "ids")
    shard = F.expr(f"slot div {shard_rows}").alias("shard")
    placed = placed.select("slot", shard, (F.col("slot") % shard_rows).alias("place"), "n_ids", "keys", "ids")
    return placed.repartitionById(tasks, (F.col("shard") * tasks / shards).cast("int")).sortWithinPartitions("slot")


def byte_sequences(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 2048, seed: int = 20, shard_rows: int = 4096) -> DataFrame:
    """Sequences of the texts' UTF-8 bytes as ids of one byte; 255 and 254, which
    UTF-8 never has, are the end mark and the padding."""
    src = df.select(df[f"`{key}`"].alias(key), F.encode(df[f"`{text}`"], "UTF-8").alias("ids"))
    return sequences(src, key, "ids", 1, length, b"\xff", b"\xfe", seed, shard_rows)


#: End mark and padding of 16-bit ids; vocabularies stay below them.
END, PAD = 65535, 65534


def token_sequences(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 512, seed: int = 20, shard_rows: int = 4096,
                    path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Sequences of byte-level BPE ids (``bpe_bitmap``), little-endian unsigned 16-bit
    integers; the vocabulary has at most 65,534 ids."""
    import public_tokenizers
    path, pattern = path or bpe_bitmap.tokenizer_file(), pattern or public_tokenizers.PATTERN
    ship(df.sparkSession)
    src = keep_columns(df, [key, text]).toDF("key", "text")

    def encode(batches):
        coder = bpe_bitmap.Coder.of(path, pattern)
        for batch in joined(batches, "text", QUEUE_BYTES):
            for part in slices(batch, "text", QUEUE_BYTES):
                ids, at = coder.encode_at_once(text_column(part, "text"))
                if len(ids) and ids.max() >= PAD:
                    raise ValueError("the vocabulary needs more than 16 bits")
                ids = ids.astype("<u2")
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([ids[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())],
                                                 ["key", "ids"])

    coded = src.mapInArrow(encode, f"key {src.schema['key'].dataType.simpleString()}, ids binary")
    return sequences(coded, "key", "ids", 2, length, np.array([END], "<u2").tobytes(), np.array([PAD], "<u2").tobytes(), seed, shard_rows)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _uri(path: str) -> str:
    return path if "://" in path else "file://" + path if path.startswith("/") else path.replace("file:/", "file:///", 1)


def write_shards(seqs: DataFrame, path: str) -> DataFrame:
    """Write the sequences' ids as files of a fixed stride, one a shard, to a
    folder that all executors share (any place that Arrow's file systems reach).
    A shard is written under a name of its own and then moved, so a repeated
    task puts the same file. Returns the sequences without their ids, the shards' index:
    ``(slot, shard, place, n_ids, keys)``."""
    path = _uri(path)
    names = ["slot", "shard", "place", "n_ids", "keys"]

    def run(batches):
        from pyarrow import fs
        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        shard, temp, out = None, None, None

        def close():
            out.close()
            store.move(temp, f"{base}/{shard_name(shard)}")

        for batch in batches:
            for own, ids in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist()):
                if own != shard:
                    if out:
                        close()
                    shard, temp = own, f"{base}/.{shard_name(own)}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(temp)
                out.write(ids)
            yield batch.select(names)
        if out:
            close()

    kinds = {f.name: f.dataType.simpleString() for f in seqs.schema}
    return seqs.mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n in names))


def materialise(seqs: DataFrame, path: str, stride: int, shard_rows: int) -> DataFrame:
    """Write the shards and read them again: ``(slot, shard, place, n_ids, keys, sha256)``, the
    digest of each slot's ids as they stand in the files. A pass's shuffle is gone
    before the next one, so that a third of the sequences is on disk besides their table and the files."""
    spark = seqs.sparkSession
    table = f"{path}-index"
    for k in range(PASSES):
        index = write_shards(seqs.filter(F.col("shard") % PASSES == k), path)
        with shuffles_dropped(spark):
            index.write.mode("append").parquet(table)
    index = spark.read.schema(index.schema).parquet(table)
    files = spark.read.format("binaryFile").load(path, pathGlobFilter="shard-*.bin")
    places = F.sequence(F.lit(0), (F.col("length") / stride).cast("int") - 1)
    # the one-element array binds a file's bytes, which a column would copy for every slot
    digests = F.transform(F.array("content"), lambda c: F.transform(places, lambda p: F.sha2(F.substring(c, p * stride + 1, F.lit(stride)), 256)))[0]
    shard = F.regexp_extract("path", r"shard-([0-9]+)\.bin$", 1).cast("bigint")
    read = files.filter("length > 0").select(shard.alias("shard"), F.posexplode(digests).alias("place", "sha256"))
    read = read.select((F.col("shard") * shard_rows + F.col("place")).alias("slot"), "sha256")
    return index.join(read, "slot").select("slot", "shard", "place", "n_ids", "keys", "sha256")


def read_slots(path: str, first: int, count: int, stride: int, shard_rows: int) -> list[bytes]:
    """Sequences of slots ``first`` and after, by seeking: a read resumes anywhere."""
    from pyarrow import fs
    store, base = fs.FileSystem.from_uri(_uri(path))
    out = []
    while count > 0:
        shard, place = divmod(first, shard_rows)
        with store.open_input_file(f"{base}/{shard_name(shard)}") as f:
            f.seek(place * stride)
            raw = f.read(min(count, shard_rows - place) * stride)
        out += [raw[i:i + stride] for i in range(0, len(raw), stride)]
        if not raw:
            break
        first, count = first + len(raw) // stride, count - len(raw) // stride
    return out
