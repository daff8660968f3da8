"""Bytes of texts that also occur elsewhere, by a logarithmic family of suffix indexes.

A byte goes when a string of ``LENGTH`` bytes covers it that starts at another
place too, in any text. Every such string holds a place that its own content
selects: of the ``GRAM``-byte grams in it the one with the least hash. Only the
suffixes at selected places, about one in seventy, are indexed, sorted by the hash
of their gram; equal strings select the same place, so no match is missed.

New batches get a sorted index each: rows in buckets by the hash, in its order within a
bucket, so that scans and merges of levels move no rows between tasks. The new index is
merge-joined with every level that exists, and suffixes that share a gram with another
one are kept as candidates, on both sides. Levels of equal size are merged before
the next batch, so there are logarithmically many and every suffix is rewritten
as often. A table that is there as a whole comes in ``BATCHES`` parts: batches of a
fixed size would scan the levels once for each, which grows with the square of the input.

A candidate stands for a run of neighbouring strings. If the stretch of text that
the run covers also occurs elsewhere as a whole, all its strings do. Otherwise the
strings are compared one by one with those of the other candidates of the gram:
groups of up to ``SMALL`` in memory, larger ones by counting digests of blocks of
strings. The blocks left are short, so groups of up to ``SMALL_BLOCKS`` of them are compared
in memory too; larger ones by counting digests of strings, so that no group has to fit
anywhere. Digests and text keys are 128 bits.

Matches never cross texts. Null texts count as empty; texts under ``LENGTH``
bytes lose nothing; equal texts lose everything from ``LENGTH`` bytes on, and are
indexed once. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import text_of
from ferrylog.session import scratch_path, written

LENGTH = 200
GRAM = 32
SMALL = 64
#: Neighbouring strings that large groups compare at once.
BLOCK = 16
#: Blocks of a group that are compared in memory, at most BLOCK strings each.
SMALL_BLOCKS = 8192
#: The third batch finds two levels of equal size, which merge.
BATCHES = 3

_U64 = np.uint64
_BYTES = np.random.default_rng(5).integers(0, 2**63, 256, dtype=np.uint64) * _U64(2) + _U64(1)
_A, _B = _U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F)

ANCHORS = "h long, z long, dk binary, pos int"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on, by doubling."""
    h, size = _BYTES[data], 1
    while size < GRAM:
        h = h[:-size] * _A + h[size:] * _B
        h ^= h >> _U64(29)
        size *= 2
    return h


def selected(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(gram hash, place, first string, last string) of the selected places.

    Strings ``first`` to ``last`` are those, by their start, that select the place:
    the leftmost of their least gram hashes.
    """
    if len(raw) < length:
        empty = np.zeros(0, np.int64)
        return empty.astype(_U64), empty, empty, empty
    h = gram_hashes(np.frombuffer(raw, np.uint8))
    least, place = h, np.arange(len(h))
    size, wanted = 1, length - GRAM + 1
    while size < wanted:
        step = min(size, wanted - size)
        left = least[:-step] <= least[step:]
        place = np.where(left, place[:-step], place[step:])
        least = np.where(left, least[:-step], least[step:])
        size += step
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    last = np.append(first[1:] - 1, len(place) - 1)
    at = place[first]
    return h[at], at, first, last


def _zone(raw: bytes, at: int, first: int, last: int, length: int = LENGTH) -> int:
    """Digest of all that the strings of a place cover, and of where the place is in it."""
    seed = at - first
    return xxhash.xxh3_64_intdigest(raw[first : last + length], seed) - (1 << 63)


def _signed(h: np.ndarray) -> list[int]:
    return h.view(np.int64).tolist()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
        names=[n for n, _ in fields],
    )


def _bucketed(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """``rows`` stored in buckets by ``key``; joins and groupings by it move nothing."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"buckets_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(*order or (key,))
    writer.option("path", scratch_path(spark, "buckets")).saveAsTable(name)
    stored = spark.table(name)
    stored.schema  # resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return stored


def _key() -> Column:
    return F.unhex(F.md5(text_of()))


def _packed(docs: DataFrame) -> DataFrame:
    """(dk, copies, raw): distinct texts, compressed, stored by their key."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=6)
        for batch in batches:
            raws = [coder.compress(t.encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raws, pa.binary())], names=["dk", "raw"]
            )

    rows = docs.select(_key().alias("dk"), text_of().alias("text"))
    distinct = (
        rows.mapInArrow(pack, "dk binary, raw binary")
        .groupBy("dk")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw"))
    )
    return _bucketed(distinct, "dk")


def anchors(texts: DataFrame) -> DataFrame:
    """The selected suffixes of packed texts: gram hash, zone digest, text key, place."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for dk, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = coder.decompress(packed)
                h, at, first, last = selected(raw)
                for x, p, a, b in zip(_signed(h), at.tolist(), first.tolist(), last.tolist(), strict=True):
                    rows.append((x, _zone(raw, p, a, b), dk, p))
            yield _batch(rows, ANCHORS)

    return texts.select("dk", "raw").mapInArrow(find, ANCHORS)


class SuffixIndex:
    """Sorted indexes of all batches so far; their sizes are powers of two of a batch."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Index a batch; returns the suffixes, old and new, that it gives a partner."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * n, self._stored(a.union(b))))
        new = self._stored(suffixes)
        own = new.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        met = new.join(own.filter("n > 1").select("h", F.lit(True).alias("own")), "h", "left")
        hits, old = F.col("own"), []
        for k, (_, level) in enumerate(self.levels):
            theirs = level.select("h").distinct().withColumn(f"level{k}", F.lit(True))
            met, hits = met.join(theirs, "h", "left"), hits | F.col(f"level{k}")
            old.append(level.join(own.select("h"), "h", "left_semi"))
        self.levels.append((1, new))
        found = met.filter(hits).select(new.columns)
        for rows in old:
            found = found.union(rows.select(new.columns))
        return found

    @staticmethod
    def _stored(suffixes: DataFrame) -> DataFrame:
        return _bucketed(suffixes, "h", "h", "z")


FINE = "h long, z long, dk binary, pos int, first int, size long, stretch binary"
RUNS = "dk binary, pos int, first int, last int"


def _stretches(texts: DataFrame, open_: DataFrame) -> DataFrame:
    """The candidates to compare string by string, with the text that their strings cover."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for dk, packed, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = coder.decompress(packed)
                sizes = {w["pos"]: w["size"] for w in wanted}
                h, at, first, last = selected(raw)
                for x, p, a, b in zip(_signed(h), at.tolist(), first.tolist(), last.tolist(), strict=True):
                    if p in sizes:
                        stretch = raw[a : b + LENGTH]
                        rows.append((x, _zone(raw, p, a, b), dk, p, a, sizes[p], stretch))
            yield _batch(rows, FINE)

    by_text = open_.groupBy("dk").agg(F.collect_list(F.struct("pos", "size")).alias("wanted"))
    return texts.select("dk", "raw").join(by_text, "dk").mapInArrow(cut, FINE)


def _runs(starts: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in starts:
        if out and out[-1][1] == s - 1:
            out[-1] = (out[-1][0], s)
        else:
            out.append((s, s))
    return out


def _small_groups(rows: DataFrame) -> DataFrame:
    """Strings that two candidates of a group share; groups come one after the other."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []

        def settled() -> list[tuple]:
            if len(group) < 2:
                return []
            seen: Counter[tuple[int, bytes]] = Counter()
            for _, _, _, pos, first, _, text in group:
                for k in range(len(text) - LENGTH + 1):
                    seen[first + k - pos, text[k : k + LENGTH]] += 1
            out = []
            for _, _, dk, pos, first, _, text in group:
                starts = [
                    first + k
                    for k in range(len(text) - LENGTH + 1)
                    if seen[first + k - pos, text[k : k + LENGTH]] > 1
                ]
                out += [(dk, pos, a, b) for a, b in _runs(starts)]
            return out

        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and group[0][0] != row[0]:
                    rows += settled()
                    group.clear()
                group.append(row)
            yield _batch(rows, RUNS)
        yield _batch(settled(), RUNS)

    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(compare, RUNS)


def _blocks(rows: DataFrame) -> DataFrame:
    """Large groups split by ``BLOCK`` neighbouring strings: the bytes that all of them share.

    Equal strings have equal shared bytes, so they stay in one group; a candidate's
    strings of a block are a stretch of their own.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, _, dk, pos, first, _, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, at = len(text) - LENGTH + 1, first - pos
                for block in range(at // BLOCK, (at + n - 1) // BLOCK + 1):
                    begin = max(block * BLOCK, at) - at
                    end = min((block + 1) * BLOCK, at + n) - at
                    core = text[max(0, (block + 1) * BLOCK - 1 - at) : block * BLOCK - at + LENGTH]
                    own = text[begin : end - 1 + LENGTH]
                    key = xxhash.xxh3_64_intdigest(core, (h ^ block) & (2**64 - 1)) - (1 << 63)
                    zone = xxhash.xxh3_64_intdigest(own, begin + at - block * BLOCK) - (1 << 63)
                    out.append((key, zone, dk, pos, first + begin, 0, own))
            yield _batch(out, FINE)

    return rows.mapInArrow(split, FINE)


def _counted_strings(rows: DataFrame) -> DataFrame:
    """Strings that two candidates of a group of any size share, by counting digests."""
    schema = "w binary, dk binary, pos int, start int"

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, _, dk, pos, first, _, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k in range(len(text) - LENGTH + 1):
                    seed = (h ^ (first + k - pos)) & (2**64 - 1)
                    out.append((xxhash.xxh3_128_digest(text[k : k + LENGTH], seed), dk, pos, first + k))
            yield _batch(out, schema)

    every = rows.mapInArrow(strings, schema)
    shared = every.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w")
    found = every.join(shared, "w")
    return found.select("dk", "pos", F.col("start").alias("first"), F.col("start").alias("last"))


def _large_groups(rows: DataFrame) -> DataFrame:
    """Strings that candidates of large groups share: whole blocks, then single strings."""
    blocks = written(_blocks(rows), "blocks")
    last = F.col("first") + F.octet_length("stretch") - LENGTH
    zones = blocks.groupBy("h", "z").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("dk", "pos", "first")).alias("one")
    )
    zones = written(zones, "zones")
    whole = blocks.select("h", "z", "dk", "pos", "first", last.cast("int").alias("last")).join(
        zones.filter("n > 1").select("h", "z"), ["h", "z"]
    )
    alone = zones.groupBy("h").agg(
        F.count(F.lit(1)).alias("size"), F.min("n").alias("least")
    ).filter("size > 1 AND least = 1")
    open_ = zones.join(alone.select("h", "size"), "h").select("one.dk", "one.pos", "one.first", "size")
    left = blocks.drop("size").join(open_, ["dk", "pos", "first"])
    left = written(left.select("h", "z", "dk", "pos", "first", "size", "stretch"), "stretches")
    return (
        whole.select("dk", "pos", "first", "last")
        .union(_small_groups(left.filter(F.col("size") <= SMALL_BLOCKS)))
        .union(_counted_strings(left.filter(F.col("size") > SMALL_BLOCKS)))
    )


def repeated_runs(texts: DataFrame, batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """(dk, pos, z) of places all of whose strings repeat, and (dk, pos, first, last) of others."""
    index, found = SuffixIndex(), None
    for k in range(batches):
        part = texts if batches == 1 else texts.filter(F.pmod(F.xxhash64("dk"), F.lit(batches)) == k)
        hits = written(index.add(anchors(part)), "hits")
        found = hits if found is None else found.union(hits)
    if batches > 1:
        found = written(found.distinct(), "hits")
    zones = found.groupBy("h", "z").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("dk", "pos")).alias("one")
    )
    zones = written(zones, "zones")
    whole = found.join(zones.filter("n > 1").select("h", "z"), ["h", "z"]).select("dk", "pos", "z")
    alone = zones.groupBy("h").agg(
        F.count(F.lit(1)).alias("size"), F.min("n").alias("least")
    ).filter("size > 1 AND least = 1")
    open_ = zones.join(alone.select("h", "size"), "h").select("one.dk", "one.pos", "size")
    rows = written(_stretches(texts, open_), "stretches")
    runs = _small_groups(rows.filter(F.col("size") <= SMALL)).union(
        _large_groups(rows.filter(F.col("size") > SMALL))
    )
    return whole, runs


CUT = "dk binary, n_bytes long, n_removed long, n_spans long, kept binary"


def cut_texts(texts: DataFrame, whole: DataFrame, runs: DataFrame) -> DataFrame:
    """(dk, n_bytes, n_removed, n_spans, kept): what is left of every packed text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for dk, copies, packed, places, some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = coder.decompress(packed)
                edge = np.zeros(len(raw) + 1, np.int64)
                if copies > 1 and len(raw) >= LENGTH:
                    edge[0] = 1
                elif places or some:
                    known = {p["pos"]: p["z"] for p in places or ()}
                    _, at, first, last = selected(raw)
                    for p, a, b in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
                        if p in known and known[p] == _zone(raw, p, a, b):
                            edge[a] += 1
                            edge[b + LENGTH] -= 1
                    for r in some or ():
                        edge[r["first"]] += 1
                        edge[r["last"] + LENGTH] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(gone[:1].sum() + np.count_nonzero(gone[1:] & ~gone[:-1]))
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if spans else raw
                rows.append((dk, len(raw), int(gone.sum()), spans, kept))
            yield _batch(rows, CUT)

    places = whole.groupBy("dk").agg(F.collect_list(F.struct("pos", "z")).alias("places"))
    some = runs.groupBy("dk").agg(F.collect_list(F.struct("first", "last")).alias("some"))
    rows = (
        texts.select("dk", "copies", "raw")
        .join(places, "dk", "left")
        .join(some, "dk", "left")
        .select("dk", "copies", "raw", "places", "some")
    )
    return rows.mapInArrow(cut, CUT)


def removal_table(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the sha256 of what is kept."""
    texts = _packed(docs)
    left = cut_texts(texts, *repeated_runs(texts, batches))
    digests = left.select("dk", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    rows = docs.select("doc_id", _key().alias("dk"))
    return rows.join(written(digests, "digests"), "dk").drop("dk")
