"""Token ids as bit-packed binary shards.

Every id takes the fewest bits that hold the vocabulary. A shard file holds
consecutive documents in the order of their ids:

    head      ``<4sBBHIQQ``: b"TIDS", version, bits, 0, ids per block, ids, documents
    documents doc_id (int64), a byte that is 1 where doc_id is null, and the
              place of the first id of each document and of the end (uint64)
    blocks    byte offset of every block and of the end (uint64)
    payload   blocks of ``BLOCK_IDS`` ids, each packed from its lowest bit on
    tail      one line feed, added by Spark's writer

Blocks start at known bytes and unpack as whole numpy arrays, so any id range
can be read without the rest. Spark's text writer stores the bytes unchanged
through its commit protocol: a lost executor leaves no half-written shard, and
any file system that Spark writes to will do.

Null texts count as empty and still get their end id; null doc_ids come first;
equal doc_ids are ordered by a hash of their text. An empty table gives no shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrylog.llm.common import text_of
from ferrylog.llm.token_count import worker_encoder
from ferrylog.session import scratch_path, written

HEAD = "<4sBBHIQQ"
HEAD_BYTES = struct.calcsize(HEAD)
BLOCK_IDS = 65_536
#: Ids after which a shard ends with the document.
SHARD_IDS = 4_000_000
#: Bytes of text that are encoded together; a longer Arrow batch stays as it is.
TOGETHER = 2_000_000
END_ID = 0

SHARDS = "part int, seq int, shard binary"
DOCS = "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other, ``bits`` bits each, lowest bit first."""
    each = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return each[:, : bits // 8].tobytes()
    flat = np.unpackbits(each, axis=1, bitorder="little")[:, :bits]
    return np.packbits(flat.reshape(-1), bitorder="little").tobytes()


def unpack(raw: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    packed = np.frombuffer(raw, np.uint8)
    if bits % 8 == 0:
        out[:, : bits // 8] = packed.reshape(n, bits // 8)
    else:
        flat = np.unpackbits(packed, count=n * bits, bitorder="little").reshape(n, bits)
        some = np.packbits(flat, axis=1, bitorder="little")
        out[:, : some.shape[1]] = some
    return out.view("<u4").reshape(n)


def build_shard(doc_ids: list[int | None], ids: list[np.ndarray], bits: int) -> bytes:
    starts = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype="<u8")))
    every = np.concatenate(ids) if ids else np.zeros(0, "<u4")
    blocks = [
        pack(every[k : k + BLOCK_IDS], bits) for k in range(0, len(every), BLOCK_IDS)
    ]
    nulls = np.array([x is None for x in doc_ids], np.uint8)
    keys = np.array([0 if x is None else x for x in doc_ids], "<i8")
    at = HEAD_BYTES + 9 * len(ids) + 8 * len(starts) + 8 * (len(blocks) + 1)
    offsets = at + np.concatenate(([0], np.cumsum([len(b) for b in blocks], dtype="<u8")))
    head = struct.pack(HEAD, b"TIDS", 1, bits, 0, BLOCK_IDS, len(every), len(ids))
    index = [keys, nulls, starts.astype("<u8"), offsets.astype("<u8")]
    return b"".join([head, *(x.tobytes() for x in index), *blocks])


class Shard:
    """Random access to the bytes of one shard."""

    def __init__(self, raw: bytes) -> None:
        magic, version, self.bits, _, self.block, self.n_ids, n = struct.unpack_from(HEAD, raw)
        if magic != b"TIDS" or version != 1:
            raise ValueError("not a token shard")
        self.raw, at = memoryview(raw), HEAD_BYTES
        keys = np.frombuffer(raw, "<i8", n, at)
        nulls = np.frombuffer(raw, np.uint8, n, at + 8 * n)
        self.doc_ids = [None if z else k for k, z in zip(keys.tolist(), nulls, strict=True)]
        self.starts = np.frombuffer(raw, "<u8", n + 1, at + 9 * n).astype(np.int64)
        n_blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(raw, "<u8", n_blocks + 1, at + 9 * n + 8 * (n + 1))

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; other blocks are not touched."""
        if start >= stop:
            return np.zeros(0, "<u4")
        first, last, out = start // self.block, (stop - 1) // self.block, []
        for k in range(first, last + 1):
            n = min(self.block, self.n_ids - k * self.block)
            out.append(unpack(self.raw[int(self.offsets[k]) : int(self.offsets[k + 1])], n, self.bits))
        return np.concatenate(out)[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.starts[k]), int(self.starts[k + 1]))


def joined(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one, up to ``limit`` bytes; a larger one stands alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if held and size + batch.nbytes > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def write_shards(
    docs: DataFrame, folder: str, tokenizer: str, shard_ids: int = SHARD_IDS
) -> None:
    """Encode every text, append the end id, and write shards in doc_id order.

    Shards are ``part=P/seq=S`` below ``folder``; (P, S) ascends with doc_id.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(tokenizer)
        bits, part, seq = bits_for(enc.size), TaskContext.get().partitionId(), 0
        keys: list = []
        ids: list = []
        end = np.array([END_ID], "<u4")

        def full() -> pa.RecordBatch:
            raw = build_shard(keys, ids, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([raw], pa.binary())],
                names=["part", "seq", "shard"],
            )

        n = 0
        for batch in joined(batches, TOGETHER):
            found = enc.ids(batch.column(1))
            for key, each in zip(batch.column(0).to_pylist(), found, strict=True):
                keys.append(key)
                ids.append(np.concatenate((each, end)))
                n += len(ids[-1])
                if n >= shard_ids:
                    yield full()
                    keys, ids, seq, n = [], [], seq + 1, 0
        if keys:
            yield full()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    (
        ordered.mapInArrow(shards, SHARDS)
        .select("part", "seq", F.col("shard").cast("string").alias("value"))
        .write.partitionBy("part", "seq")
        .text(folder)
    )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document, from the shards: place, length and checksum."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = Shard(raw)
                n = len(shard.doc_ids)
                every = shard.read(0, shard.n_ids)
                edges = shard.starts.tolist()
                sums = [
                    zlib.crc32(every[a:b].tobytes())
                    for a, b in zip(edges, edges[1:], strict=False)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * n, pa.int32()),
                        pa.array([seq] * n, pa.int32()),
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(edges[:-1], pa.int64()),
                        pa.array(np.diff(shard.starts), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    files = (
        spark.read.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary, part int, seq int")
        .load(folder)
    )
    return files.select("part", "seq", "content").mapInArrow(decode, DOCS)


def token_table(docs: DataFrame, tokenizer: str, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write ``docs`` as shards, read them back, and place every document.

    Returns doc_id, start (ids of all documents before), n_tokens, ids_crc32.
    """
    spark, folder = docs.sparkSession, scratch_path(docs.sparkSession, "token-ids")
    write_shards(docs, folder, tokenizer, shard_ids)
    if not _has_shards(spark, folder):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    stored = written(read_documents(spark, folder), "token-docs")
    shards = stored.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    parts = shards.groupBy("part").agg(F.sum("n").alias("n"))
    # one row per range partition, a number that the session sets
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("part", "seq", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("off"))
    first = placed.join(base, "part").select("part", "seq", (F.col("base") + F.col("off")).alias("first"))
    return stored.join(first, ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def _has_shards(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return any(f.isDirectory() for f in found)
