"""Fingerprints of texts by locally consistent parsing.

A text is a sequence of names, code points to begin with. On every level equal
neighbours are named as a block; then deterministic coin tossing gives every name a
small label from the lowest bit in which it differs from the one before, three times,
until labels are below 8. Places whose label is a local maximum begin phrases of 2 to
about 15 names, and a phrase is named by a hash of the names in it. So a phrase depends
on what it holds and a few names around it, and equal substrings have equal
phrases but at their ends, wherever they stand. Levels go on until one name is left.

The fingerprint keeps, of the names of all phrases from the second level on and of
the last name, the ``KEPT`` least ones as hexadecimal digits. Likeness of two fingerprints
is 2J / (1 + J), where J is the share of common names among the least of both: about
the share of phrases that the texts have in common.

Null texts count as empty; an empty text has an empty fingerprint, which is like (1)
other empty ones and unlike (0) all others. Equal texts have equal fingerprints. Rows are
kept, equal ones and null ids too; other columns are left out.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import bounded, text_of

#: Names of a fingerprint.
KEPT = 64
#: Characters whose phrases are found together.
BATCH_CHARS = 1 << 18
#: Bits, and hexadecimal digits, of a kept name.
BITS, DIGITS = 48, 12

_U64 = np.uint64
#: Longest phrase, and a factor for each place in it.
LONGEST = 32
_FACTORS = np.random.default_rng(13).integers(0, 2**63, LONGEST, dtype=_U64) * _U64(2) + _U64(1)
_M = _U64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(31))) * _M
    x ^= x >> _U64(29)
    x *= _M
    return x ^ (x >> _U64(32))


def _tossed(names: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Twice the lowest bit's place in which a name differs from the one before, plus that bit."""
    one = names.dtype.type(1)
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[head] = names[head] ^ one
    differs = names ^ before
    at = np.bitwise_count((differs & -differs) - one)
    bit = (names >> at.astype(names.dtype)) & one
    return (2 * at + bit.astype(np.uint8)).astype(np.uint8)


def _phrase_starts(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a phrase begins: at a text's first name and at inner local maxima."""
    head = np.flatnonzero(first)
    labels = names
    for _ in range(3):
        labels = _tossed(labels, head)
    starts = first.copy()
    top = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    starts[1:-1] |= top & ~first[2:]
    return starts


def _spans(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(starts)
    return at, np.diff(at, append=len(starts))


def phrase_names(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, name) of all phrases from the second level on and of last names."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    sizes = np.array([len(t) for t in texts], np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    level = 0
    while len(names):
        first = np.ones(len(names), bool)
        first[1:] = text[1:] != text[:-1]
        repeated = ~first[1:] & (names[1:] == names[:-1])
        hashed = names.astype(_U64)
        if repeated.any():
            at, size = _spans(np.concatenate(([True], ~repeated)))
            text, first, hashed = text[at], first[at], hashed[at]
            many = size > 1
            hashed[many] = _mixed(hashed[many] * _FACTORS[0] + size[many].astype(_U64))
            names = hashed
        alone = first & np.append(first[1:], True)
        if alone.any():
            found.append((text[alone], _mixed(hashed[alone])))
            names, text, first, hashed = (z[~alone] for z in (names, text, first, hashed))
            if not len(names):
                break
        at, size = _spans(_phrase_starts(names, first))
        offset = np.arange(len(names)) - np.repeat(at, size)
        sums = np.add.reduceat(_mixed(hashed) * _FACTORS[offset], at)
        single = size == 1
        sums[single] = hashed[at[single]]
        sums[~single] = _mixed(sums[~single])
        names, text = sums, text[at]
        level += 1
        if level >= 2:
            found.append((text[~single], _mixed(names[~single])))
    if not found:
        return np.empty(0, np.int64), np.empty(0, _U64)
    every, hashes = (np.concatenate(z) for z in zip(*found, strict=True))
    return every, hashes


def least_names(texts: list[str]) -> list[np.ndarray]:
    """The least ``KEPT`` kept names of every text, sorted."""
    out: list[np.ndarray] = []
    for begin in range(0, len(texts), 1 << 16):
        part = texts[begin : begin + (1 << 16)]
        text, names = phrase_names(part)
        keys = np.sort(text.astype(_U64) << _U64(BITS) | names >> _U64(64 - BITS))
        keys = keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys
        ends = np.searchsorted(keys, np.arange(len(part) + 1).astype(_U64) << _U64(BITS)).tolist()
        kept = keys & _U64((1 << BITS) - 1)
        out += [kept[a : min(a + KEPT, b)] for a, b in zip(ends, ends[1:], strict=False)]
    return out


def written_out(kept: np.ndarray) -> str:
    raw = kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return raw.tobytes().hex()


def read_in(fingerprint: str) -> list[int]:
    return [int(fingerprint[k : k + DIGITS], 16) for k in range(0, len(fingerprint), DIGITS)]


def like(a: list[int], b: list[int]) -> float:
    """Likeness, 0 to 1, of the kept names of two fingerprints."""
    if not a and not b:
        return 1.0
    one, both = set(a), set(a).intersection(b)
    union = sorted(one.union(b))
    if len(a) == KEPT or len(b) == KEPT:
        union = union[:KEPT]
    share = sum(x in both for x in union) / len(union)
    return 2 * share / (1 + share)


def fingerprint_all(texts: list[str]) -> list[np.ndarray]:
    parts = bounded([len(t) for t in texts], BATCH_CHARS)
    return [kept for begin, end in parts for kept in least_names(texts[begin:end])]


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns; null where one is null."""

    @F.pandas_udf("double")
    def compare(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if p is None or q is None else like(read_in(p), read_in(q))
                for p, q in zip(x, y, strict=True)
            ],
            dtype="float64",
        )

    return compare(a, b)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_chars and fingerprint of every text; nothing is shuffled."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            prints = [written_out(kept) for kept in fingerprint_all(texts)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0), sizes, pa.array(prints, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "fingerprint"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", text_of(text).alias("text"))
    return rows.mapInArrow(find, f"doc_id {kind}, n_chars long, fingerprint string")


def in_descending_order(docs: DataFrame) -> DataFrame:
    """(slice, last, doc_id, text): slices of the texts by descending id, each in one task.

    Behind the rows of a slice stands a copy of the first row of the next one (of the
    first one, behind the last), marked ``last``. Equal ids go by a hash of their texts,
    so even a third of all rows with one id, or with none, spreads over slices. A first job
    finds where slices begin; only that place, one per slice, reaches the driver.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    wanted = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    down = F.col("doc_id").desc_nulls_last()
    keys = rows.select("doc_id", "h").repartitionByRange(wanted, down, "h")
    first = F.max(F.struct(F.isnotnull("doc_id"), "doc_id", F.bitwise_not("h").alias("least")))
    begins = keys.groupBy(F.spark_partition_id().alias("k")).agg(first.alias("b")).collect()

    def rank(doc_id, least):
        return (doc_id is not None, doc_id if doc_id is not None else 0, least)

    order = sorted(rank(r.b.doc_id, r.b.least) for r in begins)
    count = len(order)

    @F.pandas_udf("array<int>")
    def slices(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        """The slice of a row; below it that of its copy, as the negative of one more."""
        out = []
        known = [None if pd.isna(x) else x for x in ids]
        for doc_id, h in zip(known, hashes, strict=True):
            key = rank(doc_id, ~h)
            at = bisect_left(order, key)
            place = count - at - 1
            begins_it = at < count and order[at] == key
            out.append([place, -((place - 1) % count) - 1] if begins_it else [place])
        return pd.Series(out)

    places = rows.withColumn("place", F.explode(slices("doc_id", "h")))
    dealt = places.select(
        F.when(F.col("place") < 0, -F.col("place") - 1).otherwise(F.col("place")).alias("slice"),
        (F.col("place") < 0).alias("last"),
        "doc_id",
        "h",
        "text",
    )
    return (
        dealt.repartitionById(max(count, 1), "slice")
        .sortWithinPartitions("slice", "last", down, "h", "text")
        .select("slice", "last", "doc_id", "text")
    )


FIELDS = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_table(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts, of edited ones, and their likeness: the query's rows.

    The last half of a text (rounded down, in characters) gives way to as many characters
    from the beginning of the next text, by descending id; the first follows the last.
    """
    kind = dict(docs.dtypes)["doc_id"]
    names = ["doc_id", *(f.split()[0] for f in FIELDS.split(", "))]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def settled() -> pa.RecordBatch:
            """Results of all held rows but the last; that one, or a copy, only follows."""
            texts = [row[3] for row in held]
            pairs = list(zip(held, texts[1:], strict=False))
            asked = [row[0] == after[0] and not row[1] for row, after in zip(held, held[1:], strict=False)]
            edited = [
                row[3][: len(row[3]) - len(row[3]) // 2] + after[: len(row[3]) // 2] if ask else ""
                for (row, after), ask in zip(pairs, asked, strict=True)
            ]
            prints = fingerprint_all(texts)
            whole = [p.tolist() for p in prints]
            changed = fingerprint_all(edited)
            rows = []
            for k, ask in enumerate(asked):
                if ask:
                    rows.append(
                        (
                            held[k][2],
                            len(texts[k]),
                            hashlib.sha256(edited[k].encode()).hexdigest(),
                            written_out(prints[k]),
                            written_out(changed[k]),
                            like(whole[k], changed[k].tolist()),
                            like(whole[k], whole[k + 1]),
                        )
                    )
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

        kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2
        size = 0
        for batch in batches:
            kinds[0] = batch.schema.field(2).type
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[3])
                if len(held) > 1 and size > BATCH_CHARS:
                    yield settled()
                    del held[:-1]
                    size = len(row[3])
        if len(held) > 1:
            yield settled()

    return in_descending_order(docs).mapInArrow(compare, f"doc_id {kind}, {FIELDS}")
