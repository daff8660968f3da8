"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Texts are sequences of lower-case words; their k-mers are ``SHINGLE`` words long
and labelled with their occurrence number. A sketch takes the few labelled k-mers
with the least hashes and keeps them in text order, so equal sketches need equal
content in equal order. Texts that share a sketch are candidates. A pair is a link
when its edit similarity, 1 - word edits / words of the longer text, is
``SIMILARITY`` or more. The chain of common k-mers that ascends in both texts gives
an alignment and so a bound for the edits; where the bounds leave a pair open, a
banded alignment decides. A document's class is its connected component of links.

Equal texts are one node of that graph. In a bucket every text is first compared with one
pivot, the text whose sketches are the most common, which a family of near copies has at
its centre. Texts of buckets that still hold several components are dealt again by a second family of
sketches, with a few other pivots a bucket. That joins most of a family with few pairs. What is
left is done in full: all texts that share a bucket of either family and are in different
components by then meet, in parts of a bounded size, so no link between candidates is lost.
Counts of hashed words bound the edits from below and leave out what can't be a link, as
do lengths; all other pairs are verified. Only texts that are unlike, yet so alike in
words that the bound leaves them open, make pairs that grow with the square of a bucket.

Two k-mers a sketch are the fewest that have an order. With one word in five edited, the most
that a link allows, one sketch in 26 agrees, so 56 of them miss one pair in nine; at 15 % one
in a hundred.

Texts without words (null, empty) are in a class of their own each. Shorter texts
than a shingle count as one shingle. Rows with equal doc_id are told apart by
their text. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import fresh, text_of
from ferrylog.llm.components import components
from ferrylog.session import written

SHINGLE = 5
SIMILARITY = 0.8
#: K-mers of a sketch, and sketches.
KEPT = 2
SKETCHES = 56
#: The second family, for buckets that still hold several components.
KEPT_AGAIN = 3
SKETCHES_AGAIN = 16
#: Times that a bucket of the second family draws four pivots.
DRAWS = 3
#: Texts of a part of a bucket, of which two meet at once.
PART = 1024
#: Numbers that a text's words are hashed to and counted under, and how many of them the first
#: bound takes together; pairs bounded at once.
BINS = 1024
FOLD = 4
AT_ONCE = 20_000

WORD = re.compile(r"\w+")
_U64 = np.uint64
_M1, _M2, _P = _U64(0xFF51AFD7ED558CCD), _U64(0xC4CEB9FE1A85EC53), _U64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, elementwise."""
    x = (x ^ (x >> _U64(33))) * _M1
    x = (x ^ (x >> _U64(33))) * _M2
    return x ^ (x >> _U64(33))


class WordHashes(dict):
    """64-bit hashes of words, remembered within a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def hashed(found: list[str], hashes: WordHashes) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, found), _U64, len(found))


def bag(w: np.ndarray) -> bytes:
    """How many of the word hashes fall to each of ``BINS`` numbers, 255 at most.

    An edit changes two counts by one, or one; the limit makes differences smaller, never larger.
    """
    counts = np.bincount((w % _U64(BINS)).astype(np.int64), minlength=BINS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def labelled(found: list[str], hashes: WordHashes) -> np.ndarray:
    """Hashes of the k-mers in text order, each with its occurrence number."""
    return kmer_hashes(hashed(found, hashes))


def kmer_hashes(w: np.ndarray) -> np.ndarray:
    if not len(w):
        return np.zeros(0, _U64)
    k = min(SHINGLE, len(w))
    h = np.zeros(len(w) - k + 1, _U64)
    for i in range(k):
        h = mix(h * _P + w[i : len(w) - k + 1 + i])
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = np.concatenate(([False], s[1:] == s[:-1]))
    if same.any():
        run = np.maximum.accumulate(np.where(same, 0, np.arange(len(s))))
        nth = np.empty(len(s), _U64)
        nth[order] = (np.arange(len(s)) - run).astype(_U64)
        h = np.where(nth > 0, mix(h + nth * _P), h)
    return h


_SEEDS = mix(np.arange(1, SKETCHES + SKETCHES_AGAIN + 1, dtype=_U64) * _P)


def sketches(h: np.ndarray, seeds: np.ndarray, kept: int) -> np.ndarray:
    """One hash for each seed: the ``kept`` least k-mers, in text order."""
    out = np.zeros(len(seeds), _U64)
    kept = min(kept, len(h))
    rows = max(1, 100_000 // len(h))
    for a in range(0, len(seeds), rows):
        some = seeds[a : a + rows]
        x = (h[None, :] ^ some[:, None]) * _M1
        x ^= x >> _U64(32)
        at = np.empty((len(some), kept), np.int64)
        line = np.arange(len(some))
        for j in range(kept):
            at[:, j] = x.argmin(axis=1)
            x[line, at[:, j]] = ~_U64(0)
        at.sort(axis=1)
        key = some.copy()
        for j in range(kept):
            key = mix(key * _P + h[at[:, j]])
        out[a : a + rows] = key
    return out


def _kmers(w: list[str]) -> list[tuple]:
    k = min(SHINGLE, len(w))
    seen: dict[tuple, int] = {}
    out = []
    for t in zip(*(w[i:] for i in range(k)), strict=False):
        n = seen[t] = seen.get(t, -1) + 1
        out.append((t, n))
    return out


def _chain(steps: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of ``steps`` (j ascending) in which i ascends as well."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(steps)
    for s, (i, _) in enumerate(steps):
        at = bisect_left(tails, i)
        back[s] = ends[at - 1] if at else -1
        if at == len(tails):
            tails.append(i)
            ends.append(s)
        else:
            tails[at], ends[at] = i, s
    out, s = [], ends[-1] if ends else -1
    while s >= 0:
        out.append(steps[s])
        s = back[s]
    return out[::-1]


def _chained_edits(a: list[str], b: list[str], band: int) -> int:
    """Word edits of the alignment that the chain of common k-mers gives."""
    k = min(SHINGLE, len(a), len(b))
    place = {t: i for i, t in enumerate(_kmers(a))}
    steps = [
        (i, j)
        for j, t in enumerate(_kmers(b))
        if (i := place.get(t)) is not None and abs(i - j) <= band
    ]
    edits, i, j = 0, 0, 0
    for x, y in _chain(steps):
        skip = max(i - x, j - y, 0)
        if skip >= k:
            continue
        edits += max(x + skip - i, y + skip - j)
        i, j = x + k, y + k
    return edits + max(len(a) - i, len(b) - j)


def _banded_edits(a: list[str], b: list[str], band: int) -> int:
    """Least word edits, or more than ``band`` if they are more."""
    known: dict[str, int] = {}
    x, y = (np.array([known.setdefault(w, len(known)) for w in t]) for t in (a, b))
    far = band + 1
    row = np.where(np.arange(2 * band + 1) < band, far, np.arange(2 * band + 1) - band)
    ramp = np.arange(2 * band + 1)
    padded = np.concatenate((np.full(band + 1, -1), y, np.full(2 * band + 2, -1)))
    for i in range(1, len(x) + 1):
        # cell c stands for column i - band + c
        same = padded[i : i + 2 * band + 1] == x[i - 1]
        step = np.minimum(row + ~same, np.append(row[1:], far) + 1)
        column = i - band + ramp
        step[column < 0] = far
        step[column == 0] = min(i, far)
        step[column > len(y)] = far
        row = np.minimum(np.minimum.accumulate(step - ramp) + ramp, far)
        if row.min() >= far:
            return far
    at = len(y) - len(x) + band
    return int(row[at]) if 0 <= at <= 2 * band else far


def similar(a: list[str], b: list[str], least: float = SIMILARITY) -> bool:
    """Whether 1 - edits / words of the longer text is ``least`` or more."""
    longer = max(len(a), len(b))
    band = int((1 - least) * longer + 1e-9)
    if not a or not b or longer - min(len(a), len(b)) > band:
        return False
    if a == b:
        return True
    if longer - sum((Counter(a) & Counter(b)).values()) > band:
        return False
    return _chained_edits(a, b, band) <= band or _banded_edits(a, b, band) <= band


def _sketched(docs: DataFrame) -> DataFrame:
    """(dk, n, keys, again, bag) of every text with words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            dk, n, keys, again, bags = [], [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = hashed(words(text), hashes)
                h = kmer_hashes(w)
                if len(h):
                    dk.append(key)
                    n.append(len(h))
                    keys.append(sketches(h, _SEEDS[:SKETCHES], KEPT).view(np.int64))
                    again.append(sketches(h, _SEEDS[SKETCHES:], KEPT_AGAIN).view(np.int64))
                    bags.append(bag(w))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (keys, again)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(dk, pa.binary()), pa.array(n, pa.int64()), *lists, pa.array(bags, pa.binary())],
                names=["dk", "n", "keys", "again", "bag"],
            )

    return docs.mapInArrow(
        sketch, "dk binary, n long, keys array<long>, again array<long>, bag binary"
    )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            good = [
                similar(words(s), words(t))
                for s, t in zip(x, y, strict=True)
            ]
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"]
            )

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    rows = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(verify, "a long, b long")


def _may_be_similar(n: str, m: str) -> str:
    """Whether numbers of k-mers leave room for a link; one k-mer stands for 1 to 5 words."""
    few = int(1 / (1 - SIMILARITY) + 0.5)
    return f"({n} = 1 OR {m} = 1 OR {few} * abs({n} - {m}) <= greatest({n}, {m}) + {SHINGLE - 1})"


def _dealt_again(
    buckets: DataFrame, nodes: DataFrame, roots: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) for the nodes of buckets that hold several components, and the new buckets.

    Such nodes are dealt by the second family of sketches alone, so each makes as many
    rows as that family has sketches, however many mixed buckets it is in. Every new
    bucket has ``4 * DRAWS`` pivots, drawn by hash, half of them by component, so that
    small components are drawn as likely as large ones.
    """
    comp = F.coalesce("root", "node").alias("comp")
    several = F.min("comp") < F.max("comp")
    members = buckets.join(roots, "node", "left").select("key", "node", comp)
    mixed = members.groupBy("key").agg(several.alias("several")).filter("several").select("key")
    open_ = members.join(mixed, "key").select("node", "comp").distinct()
    dealt = nodes.select("node", "n", F.explode("again").alias("key")).join(open_, "node")
    dealt = written(dealt, "open")
    ends = []
    for draw in range(DRAWS):
        by_node = F.xxhash64("key", "node", F.lit(draw))
        by_comp = F.xxhash64("key", "comp", F.lit(draw))
        for first in (by_node, by_comp):
            drawn = F.struct(first.alias("h"), by_node.alias("g"), "node", "comp", "n")
            ends += [F.min(drawn), F.max(drawn)]
    pivots = dealt.groupBy("key").agg(several.alias("several"), F.array(*ends).alias("pivots"))
    rows = dealt.join(pivots.filter("several").drop("several"), "key")
    near = f"p.comp != comp AND {_may_be_similar('p.n', 'n')}"
    others = F.expr(f"array_distinct(transform(filter(pivots, p -> {near}), p -> p.node))")
    pairs = rows.select("node", F.explode(others).alias("pivot"))
    pairs = pairs.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    return pairs.distinct(), dealt.select("key", "node")


def open_pairs(
    group: np.ndarray,
    two: np.ndarray,
    part: np.ndarray,
    comp: np.ndarray,
    n: np.ndarray,
    bags: np.ndarray,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of rows of one group that may be a link, as arrays of bounded length.

    ``group`` ascends. Where ``two`` parts of a bucket meet, only rows of different parts are
    paired, as each part meets itself elsewhere. Rows of one component, and those too far
    apart by length or counts, are left out.
    """
    place = np.arange(len(group))
    total = bags.sum(axis=1, dtype=np.int64)
    folded = bags.reshape(len(bags), FOLD, -1).sum(axis=1, dtype=np.uint16)
    counts = np.searchsorted(group, group, side="right") - place - 1
    upto = np.cumsum(counts)
    begin = 0
    while begin < len(group):
        before = upto[begin] - counts[begin]
        stop = max(begin + 1, int(np.searchsorted(upto, before + AT_ONCE, side="right")))
        some = counts[begin:stop]
        i = np.repeat(place[begin:stop], some)
        j = i + 1 + np.arange(len(i)) - np.repeat(upto[begin:stop] - some - before, some)
        begin = stop
        keep = (comp[i] != comp[j]) & (~two[i] | (part[i] != part[j]))
        i, j = i[keep], j[keep]
        # a text of n k-mers has n + SHINGLE - 1 words, or fewer if n is 1
        band = ((1 - SIMILARITY) * (np.maximum(n[i], n[j]) + SHINGLE - 1) + 1e-9).astype(np.int64)
        keep = np.abs(total[i] - total[j]) <= band
        for counted in (folded, bags):
            i, j, band = i[keep], j[keep], band[keep]
            common = np.minimum(counted[i], counted[j]).sum(axis=1, dtype=np.int64)
            keep = np.maximum(total[i], total[j]) - common <= band
        if keep.any():
            yield i[keep], j[keep]


def _rest(buckets: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """All pairs (a, b) of a bucket that lie in different components and may be links.

    Buckets are split into parts of about ``PART`` texts, and every two parts meet in a group.
    Of the buckets that two texts share, the one of the first sketch gives the pair.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def settled(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, part, node, comp, n, bags, keys = rows
            begins = np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))
            two = key[:, 1] != key[:, 2]
            for i, j in open_pairs(np.cumsum(begins), two, part, comp, n, bags):
                first = (keys[i] == keys[j]).argmax(axis=1)
                here = keys[i, first] == key[i, 0]
                i, j = i[here], j[here]
                a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, i, j, part, node, comp, n = (batch.column(c).to_numpy() for c in range(7))
            raw = np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint8)
            keys = batch.column(8).flatten().to_numpy().reshape(-1, SKETCHES + SKETCHES_AGAIN)
            rows = [np.stack((key, i, j), axis=1), part, node, comp, n, raw.reshape(-1, BINS), keys]
            if held:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            # the last group may go on in the next batch
            other = np.flatnonzero((rows[0] != rows[0][-1]).any(axis=1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from settled([x[:cut] for x in rows])
            held = [x[cut:] for x in rows]
        if held:
            yield from settled(held)

    comp = F.coalesce("root", "node").alias("comp")
    members = buckets.join(roots, "node", "left").select("key", "node", comp)
    sizes = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), (F.min("comp") < F.max("comp")).alias("several")
    )
    # two texts alone have met as a text and its pivot
    open_ = sizes.filter("several AND size > 2")
    parts = open_.select("key", F.ceil(F.col("size") / PART).alias("parts"))
    own = F.pmod(F.xxhash64("key", "node"), F.col("parts")).alias("part")
    rows = members.join(parts, "key").select("key", "node", "comp", "parts", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    wide = nodes.select("node", "n", "bag", F.concat("keys", "again").alias("keys"))
    rows = rows.join(wide, "node").select(
        "key",
        F.least("part", "other").alias("i"),
        F.greatest("part", "other").alias("j"),
        "part",
        "node",
        "comp",
        "n",
        "bag",
        "keys",
    )
    group = ["key", "i", "j"]
    met = rows.repartition(*group).sortWithinPartitions(*group)
    return met.mapInArrow(compare, "a long, b long")


def near_classes(docs: DataFrame) -> DataFrame:
    """(dk, grp): text digest and component for every text with words.

    ``docs`` has dk, the binary md5 of the text, and text.
    """
    some = _sketched(docs.select("dk", "text")).dropDuplicates(["dk"])
    nodes = written(some.withColumn("node", F.monotonically_increasing_id()), "sketches")
    keyed = nodes.select(F.explode("keys").alias("key"), "node", "n")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = written(keyed.join(shared, "key"), "buckets")
    scores = buckets.groupBy("node").agg(F.sum("size").alias("score"))
    pivots = buckets.join(scores, "node").groupBy("key").agg(
        F.max(F.struct("score", "node", "n")).alias("pivot")
    )
    near = f"node != pivot.node AND {_may_be_similar('n', 'pivot.n')}"
    star = buckets.join(pivots, "key").filter(near).select(
        F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")
    )
    star = written(star.distinct(), "pairs")
    wanted = buckets.select("node").distinct()
    named = nodes.select("node", "dk").join(wanted, "node")
    # one text of all exact copies, before texts meet
    texts = written(docs.dropDuplicates(["dk"]).join(named, "dk").select("node", "text"), "texts")
    links = written(_verified(star, texts), "links")
    roots = components(links)
    more, dealt = _dealt_again(buckets.select("key", "node"), nodes, roots)
    more = written(more.join(star, ["a", "b"], "left_anti"), "pairs")
    found = written(_verified(more, texts), "links")
    if not found.isEmpty():
        links = links.union(found)
        roots = components(links)
    rest = _rest(buckets.select("key", "node").union(dealt), nodes, roots)
    rest = written(rest.join(star.union(more), ["a", "b"], "left_anti"), "pairs")
    found = written(_verified(rest, texts), "links")
    if not found.isEmpty():
        roots = components(links.union(found))
    return nodes.join(roots, "node", "left").select("dk", F.coalesce("root", "node").alias("grp"))


def _keyed(docs: DataFrame, dk: str) -> DataFrame:
    return docs.withColumn(dk, F.unhex(F.md5(text_of())))


def dedup_table(docs: DataFrame) -> DataFrame:
    """doc_id and class_id, the least doc_id of the document's class."""
    rows = _keyed(docs.select("doc_id", "text"), "dk").select("doc_id", "dk", text_of().alias("text"))
    groups = written(near_classes(rows), "classes")
    ids = rows.select("doc_id", "dk").join(groups, "dk", "left")
    least = ids.filter("grp IS NOT NULL").groupBy("grp").agg(F.min("doc_id").alias("class_id"))
    return ids.join(least, "grp", "left").select(
        "doc_id", F.when(F.col("grp").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    )


def dedup_documents(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the least doc_id, all columns as they were.

    Among rows with that doc_id the least row hash decides; of equal rows one stays.
    Documents without words all stay.
    """
    dk, row, grp = fresh(docs, "_dk", "_row", "_grp")
    rows = _keyed(docs, dk).withColumn(row, F.xxhash64(*docs.columns))
    light = rows.select(F.col(dk).alias("dk"), "doc_id", F.col(row).alias("row"))
    texts = rows.select(F.col(dk).alias("dk"), text_of().alias("text"))
    groups = written(near_classes(texts), "classes")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "dk")
    best = light.join(groups, "dk").groupBy("grp").agg(F.min(first).alias("first"))
    winner = best.select("grp", "first.doc_id", "first.row", "first.dk")
    same = light.join(
        winner,
        (light.dk == winner.dk) & (light.row == winner.row) & light.doc_id.eqNullSafe(winner.doc_id),
        "left_semi",
    )
    counted = same.groupBy("dk", "row").agg(F.count(F.lit(1)).alias("n"))
    known = groups.select("dk").distinct()
    verdicts = written(
        known.join(counted, "dk", "left").select(
            F.col("dk").alias("_k"), F.col("row").alias("_r"), F.coalesce("n", F.lit(0)).alias("_n")
        ),
        "winners",
    )
    judged = rows.join(verdicts, F.col(dk) == F.col("_k"), "left")
    kept = judged.filter(F.col("_k").isNull() | (F.col("_n") > 0) & (F.col(row) == F.col("_r")))
    once = kept.filter(F.coalesce("_n", F.lit(0)) < 2)
    again = kept.filter("_n > 1").dropDuplicates([dk])
    return once.union(again).select(*docs.columns)
