"""Groups of spelling variants, by Bloom-guided neighbourhoods.

The vocabulary is what occurs often enough. Its words fill a Bloom filter that has one
shard per word length, made of blocks of 64 bits: a word sets bits of one block. Every
word then generates its neighbours as hashes, without making strings: each letter
replaced by every later one of the alphabet, and each letter deleted (so every pair of
near words is generated once, by its lesser or longer word). Hashes are asked in the
shard of their length. What the filter knows, some percent of false positives among it, is
shuffled to an exact join with the vocabulary, by hash and then by the words themselves.

A filter is broadcast, so its size is bounded: one round uses ``FILTER_BLOCKS`` blocks of all
shards (32 MiB, 16 million words). A larger vocabulary takes more rounds, each with
those words only whose neighbours' lengths it holds.

A word's form is its near word that occurs most (ties: the least by code points) if it
occurs at least ``RATIO`` times as often; the root is the end of the chain of forms. Counts
grow along a chain by that ratio, so few doublings of its steps reach all roots.

Null and empty texts have no words. A null id is no obstacle. Equal rows count again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import text_of
from ferrylog.session import written

LETTERS = "A-Za-zÀ-ÿ"
#: What a letter may be replaced by, in order.
ALPHABET = np.array([*range(97, 123), *range(0xC0, 0x100)], np.uint64)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
#: Blocks of 64 bits that one round broadcasts, and words per block.
FILTER_BLOCKS = 1 << 22
WORDS_PER_BLOCK = 4
#: Bits that a word sets in its block.
WORD_BITS = 5
#: Neighbours generated together.
PROBES = 1 << 20

_U64 = np.uint64
_M = _U64(0x9E3779B97F4A7C15)

Change = Callable[[Column, Column], Column]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(32))) * _M
    x = (x ^ (x >> _U64(29))) * _M
    return x ^ (x >> _U64(32))


def _factors(length: int) -> np.ndarray:
    """An odd factor for every place of a word."""
    return _mixed(np.arange(1, length + 1, dtype=_U64)) | _U64(1)


def word_hashes(letters: np.ndarray) -> np.ndarray:
    """Hash of every row of letters: a sum over places, so that changes are sums, too."""
    return (letters * _factors(letters.shape[1])).sum(axis=1, dtype=_U64)


def _places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number within a shard of ``blocks``, and the bits of the block."""
    mixed = _mixed(hashes)
    block = ((mixed >> _U64(32)) * _U64(blocks)) >> _U64(32)
    bits = np.zeros_like(mixed)
    for k in range(WORD_BITS):
        bits |= _U64(1) << ((mixed >> _U64(6 * k)) & _U64(63))
    return block.astype(np.int64), bits


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``words``, letters) of all words of a length."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        joined = "".join([words[k] for k in at.tolist()]).encode("utf-32-le")
        yield at, np.frombuffer(joined, "<u4").reshape(len(at), size).astype(_U64)


def _cut(rows: int, columns: int, each: int) -> Iterator[tuple[slice, slice]]:
    """Rows and columns in parts of about ``PROBES // each`` cells."""
    cells = max(1, PROBES // each)
    wide = min(columns, cells)
    high = max(1, cells // wide)
    for a in range(0, rows, high):
        for b in range(0, columns, wide):
            yield slice(a, min(rows, a + high)), slice(b, min(columns, b + wide))


def replaced(letters: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, hash) of all words with one letter replaced by a later one."""
    factors = _factors(letters.shape[1])
    for rows, places in _cut(*letters.shape, len(ALPHABET)):
        old = letters[rows, places, None]
        new = hashes[rows, None, None] + (ALPHABET - old) * factors[places, None]
        word, place, letter = np.nonzero(ALPHABET > old)
        yield word + rows.start, new[word, place, letter]


def shortened(letters: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, hash) of all words with one letter less; equal neighbours go once."""
    size = letters.shape[1]
    factors = _factors(size)
    for a in range(0, len(letters), max(1, PROBES // size)):
        part = letters[a : a + max(1, PROBES // size)]
        before = np.cumsum(part * factors, axis=1, dtype=_U64) - part * factors
        moved = part[:, 1:] * factors[: size - 1]
        after = np.zeros_like(part)
        after[:, :-1] = moved[:, ::-1].cumsum(axis=1, dtype=_U64)[:, ::-1]
        last = np.ones(part.shape, bool)
        last[:, :-1] = part[:, 1:] != part[:, :-1]
        word, place = np.nonzero(last)
        yield word + a, (before + after)[word, place]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def vocabulary(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """(word, n) of all words with enough letters and occurrences.

    A word is a run of letters, A to Z in lower case; ``change`` may shorten it, given
    the word and the id.
    """
    runs = F.filter(
        F.split(text_of(), f"[^{LETTERS}]+"), lambda w: F.char_length(w) >= LEAST_LETTERS
    )
    rows = docs.select("doc_id", F.explode(runs).alias("word"))
    low = F.when(F.col("word").rlike("[A-Z]"), F.translate("word", UPPER, LOWER))
    rows = rows.select("doc_id", F.coalesce(low, "word").alias("word"))
    if change:
        rows = rows.select(change(F.col("word"), F.col("doc_id")).alias("word")).filter(
            F.char_length("word") >= LEAST_LETTERS
        )
    counts = rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


def _hashed(words: DataFrame) -> DataFrame:
    """The vocabulary with each word's length and hash."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            hashes, size = np.zeros(len(texts), _U64), np.zeros(len(texts), np.int32)
            for at, letters in _by_length(texts):
                hashes[at], size[at] = word_hashes(letters), letters.shape[1]
            columns = [*batch.columns, pa.array(size), _signed(hashes)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "size", "h"])

    return words.select("word", "n").mapInArrow(add, "word string, n long, size int, h long")


class Shards:
    """Where the blocks of every word length lie in the row of all blocks."""

    def __init__(self, sizes: dict[int, int]) -> None:
        self.blocks = {s: -(-n // WORDS_PER_BLOCK) for s, n in sorted(sizes.items())}
        self.begin, self.total = {}, 0
        for size, blocks in self.blocks.items():
            self.begin[size] = self.total
            self.total += blocks

    def places(self, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block, bits = _places(hashes, self.blocks[size])
        return block + self.begin[size], bits

    def within(self, low: int, high: int) -> list[int]:
        """Lengths with blocks from ``low`` up to ``high``."""
        return [
            s for s, b in self.begin.items() if b < high and b + self.blocks[s] > low
        ]


def _filter(words: DataFrame, shards: Shards, low: int, high: int) -> np.ndarray:
    """Blocks ``low`` to ``high`` of the filter; at most ``high - low`` rows reach the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(0).to_numpy()
            hashes = batch.column(1).to_numpy().view(_U64)
            for size in np.unique(sizes).tolist():
                block, bits = shards.places(size, hashes[sizes == size])
                here = (block >= low) & (block < high)
                columns = [pa.array(block[here] - low), _signed(bits[here])]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "bits"])

    rows = words.filter(F.col("size").isin(shards.within(low, high))).select("size", "h")
    blocks = rows.mapInArrow(places, "block long, bits long").groupBy("block")
    found = blocks.agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(high - low, _U64)
    out[found["block"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(_U64)
    return out


def _known_neighbours(words: DataFrame, shards: Shards, low: int, high: int) -> DataFrame:
    """(src, h): hash of a word, and of a neighbour of it that the filter part knows."""
    spark = words.sparkSession
    sent = spark.sparkContext.broadcast(_filter(words, shards, low, high))
    sizes = set(shards.within(low, high))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_of = sent.value
        for batch in batches:
            for _, letters in _by_length(batch.column(0).to_pylist()):
                size, hashes = letters.shape[1], word_hashes(letters)
                kinds = [(size, replaced), (size - 1, shortened)]
                for into, generated in kinds:
                    if into not in sizes:
                        continue
                    for word, h in generated(letters, hashes):
                        block, bits = shards.places(into, h)
                        at = np.flatnonzero((block >= low) & (block < high))
                        bits = bits[at]
                        at = at[bits_of[block[at] - low] & bits == bits]
                        columns = [_signed(hashes[word[at]]), _signed(h[at])]
                        yield pa.RecordBatch.from_arrays(columns, names=["src", "h"])

    wanted = sorted(sizes | {s + 1 for s in sizes})
    rows = words.filter(F.col("size").isin(wanted)).select("word")
    return rows.mapInArrow(probe, "src long, h long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of near words of a stored, hashed vocabulary, each once."""
    sizes = {r["size"]: r["count"] for r in words.groupBy("size").count().collect()}
    shards, found = Shards(sizes), None
    for low in range(0, max(shards.total, 1), FILTER_BLOCKS):
        high = min(shards.total, low + FILTER_BLOCKS)
        known = written(_known_neighbours(words, shards, low, high), "known")
        found = known if found is None else found.union(known)
    other = words.select("h", F.col("word").alias("b"), F.col("n").alias("n_b"))
    own = words.select(F.col("h").alias("src"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    pairs = found.join(other, "h").join(own, "src")
    # of equal hashes, only words that are near indeed
    pairs = pairs.filter(F.levenshtein("a", "b", 1) == 1)
    return pairs.select("a", "n_a", "b", "n_b")


def roots_of(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of (word, form): the ends of chains of at most ``steps`` steps."""
    roots = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(max(steps, 1)))):
        ahead = roots.select(F.col("word").alias("via"), F.col("root").alias("end"))
        further = roots.join(ahead, F.col("root") == F.col("via"), "left")
        roots = written(further.select("word", F.coalesce("end", "root").alias("root")), "roots")
    return roots


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of a vocabulary (word, n)."""
    words = written(_hashed(words), "vocabulary")
    pairs = written(near_pairs(words), "pairs")
    ends = (
        pairs.selectExpr("a AS word", "n_a AS n", "b AS other", "n_b AS other_n")
        .union(pairs.selectExpr("b", "n_b", "a", "n_a"))
        .union(words.selectExpr("word", "n", "CAST(NULL AS string)", "CAST(NULL AS long)"))
    )
    best = F.when(F.isnotnull("other"), F.struct((-F.col("other_n")).alias("less"), "other"))
    near = ends.groupBy("word").agg(
        F.max("n").alias("n"), F.count("other").alias("n_near"), F.min(best).alias("best")
    )
    often = -F.col("best.less") >= RATIO * F.col("n")
    near = near.select(
        "word",
        "n",
        "n_near",
        F.when(often, F.col("best.other")).alias("form"),
        F.when(often, -F.col("best.less")).alias("form_n"),
    )
    near = written(near, "near")
    most = near.agg(F.max("n")).first()[0] or LEAST_COUNT
    steps = 1 + int(math.log(max(most, 1), RATIO))
    roots = roots_of(near.filter(F.isnotnull("form")), steps)
    rows = near.join(roots, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def dropped_letter(word: Column, doc_id: Column) -> Column:
    """One in 199 (id, word) pairs loses a letter, by its checksum."""
    key = F.concat(doc_id.cast("string"), F.lit(":"), word)
    h = F.crc32(key.cast("binary"))
    at = (h % F.char_length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))
    return F.when(h % 199 == 0, shorter).otherwise(word)


def variant_table(docs: DataFrame) -> DataFrame:
    """Variants of the words of all documents, some with a letter dropped: the query's rows."""
    return variants(vocabulary(docs, dropped_letter))


#: The same in DuckDB, the checksum with a table made by its rule.
SQL = f"""
WITH RECURSIVE steps AS (
  SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) AS r(i)
), checksums AS (SELECT list(v ORDER BY i) AS tbl FROM steps),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents
), low AS (
  SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS c
  FROM runs WHERE length(run) >= {LEAST_LETTERS} GROUP BY ALL
), bytes AS (
  SELECT run, c, flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
         ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END)) AS b
  FROM low
), hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda s, x: xor(s >> 8, tbl[(xor(s, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, checksums
), changed AS (
  SELECT CASE WHEN h % 199 = 0
    THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
    ELSE run END AS word, c
  FROM hashed
), words AS (
  SELECT word, sum(c)::BIGINT AS n FROM changed WHERE length(word) >= {LEAST_LETTERS}
  GROUP BY word HAVING sum(c) >= {LEAST_COUNT}
), cuts AS (
  SELECT word, n, k, left(word, (k - 1)::INT) AS head, substr(word, (k + 1)::INT) AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n
  FROM cuts a JOIN cuts b ON a.k = b.k AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON w.word = c.head || c.tail
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON w.word = c.head || c.tail
), best AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r
  FROM pairs
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= {RATIO} * w.n THEN other END AS form,
    CASE WHEN other_n >= {RATIO} * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND r = 1
), chain AS (
  SELECT word, word AS root, form AS ahead FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.ahead
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.ahead IS NULL
"""
