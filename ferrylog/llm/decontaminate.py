"""Benchmark items inside documents, found by CGK embedding and bit-sampling LSH.

Texts and items are sequences of lower-case words. The CGK embedding walks over a
sequence: each step writes the current word and a random bit of that word and
step says whether to move on. Few edits leave most of the walk as it was, so edit
distance becomes Hamming distance. Walks begin at spaced offsets of an item, so that
edits at one place leave the others, and at every word of a document. A repetition
samples a few steps of a walk; an item and the window of a document that starts at
a word are candidates when all samples of some repetition agree. The number of
repetitions is set by simulated edits at the threshold, all over the item, at either
end, in one run and evenly spaced, for the recall that is asked for. Where ``MAX_REPEATS`` do not reach it,
items are cut into one piece more than there may be edits: a match has one of them
intact, so windows that begin with a piece are all candidates that there can be.
Candidates are verified exactly: the least edit distance, in words, between the item
and any part of the text around the window.

A window is embedded only if it can match at all: d word edits leave all but 2 d
of an item's word pairs intact, so windows with fewer of the items' word pairs are
passed over without loss.

An item matches at ``SIMILARITY`` = 1 - distance / words or more. Items of fewer
than ``MIN_WORDS`` words are no evidence and match nothing, null items neither;
null documents count as empty. Items are handled in blocks of bounded size, each
sent to the executors; the documents never leave their partitions.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import text_of

SIMILARITY = 0.8
RECALL = 0.99
MIN_WORDS = 5
#: Steps of the walk that a repetition samples.
SAMPLED = 3
#: Steps of a walk, some 32 words.
STEPS = 64
#: Walks that begin in the words that all items of a class have.
WALKS = 8
#: Words of the items that are edited to find the number of repetitions.
TRIED_WORDS = 8_000
#: All over, at the front, at the back, in one run, evenly spaced.
KINDS_OF_EDITS = 5
MAX_REPEATS = 256
#: Items and characters of one block, on average.
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 4_000_000
SEED = 7

WORD = re.compile(r"\w+")
_U64 = np.uint64


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


class _Words(dict):
    """Word numbers; words that no item has are 0."""

    def __missing__(self, word: str) -> int:
        return 0


def allowed(n: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n + 1e-9)


class _Class:
    """Items of similar length: those of ``least`` words up to twice as many."""

    def __init__(self, least: int, index: ItemIndex) -> None:
        self.steps = min(STEPS, 2 * least)
        self.gap = max(1, least // WALKS)
        rng = np.random.default_rng((SEED, least))
        self.samples = np.sort(
            np.stack([rng.permutation(self.steps)[:SAMPLED] for _ in range(MAX_REPEATS)]), axis=1
        )
        self.bits = [_mix(index.hashes ^ _U64(int(s))) for s in rng.integers(1, 2**62, MAX_REPEATS)]
        self.salt = rng.integers(1, 2**62, MAX_REPEATS).astype(_U64)

    def key(self, x: np.ndarray, at: np.ndarray, r: int, hashes: np.ndarray) -> np.ndarray:
        """Keys of repetition ``r`` for the windows that start at ``at``; 0 for none."""
        place, bits = at.copy(), self.bits[r]
        start = None
        key = np.full(len(at), self.salt[r])
        good = np.ones(len(at), bool)
        want, last = set(self.samples[r].tolist()), int(self.samples[r][-1])
        for step in range(last + 1):
            w = x[place]
            if step in want:
                key = _mix(key ^ hashes[w])
                good &= w > 0
                start = place.copy() if start is None else start
            if step == last:
                # one word is no evidence
                good &= place > start
            place += ((bits[w] >> _U64(step)) & _U64(1)).astype(np.int64)
        return np.where(good, key, _U64(0))


class ItemIndex:
    """The keys of a block of items, and what verification needs."""

    def __init__(self, items: list[tuple[int | None, str | None]], similarity: float, recall: float) -> None:
        self.similarity = similarity
        found = [(k, words(t)) for k, t in items]
        found = [(k, w) for k, w in found if len(w) >= MIN_WORDS]
        self.ids = [k for k, _ in found]
        self.number = _Words()
        for _, w in found:
            for word in w:
                if word not in self.number:
                    self.number[word] = len(self.number) + 1
        self.hashes = np.array(
            [0, *(xxhash.xxh3_64_intdigest(w) for w in self.number)], dtype=_U64
        )
        self.items = [np.array([self.number[x] for x in w], np.int64) for _, w in found]
        self.sets = [frozenset(x.tolist()) for x in self.items]
        self.pad = max((2 * len(x) for x in self.items), default=0) + STEPS
        self.pairs = self._pair_table()
        self.classes: dict[int, _Class] = {}
        members = defaultdict(list)
        for k, x in enumerate(self.items):
            members[2 ** int(math.log2(len(x)))].append(k)
        self.members = dict(members)
        self.least_pairs, self.reach, self.before = {}, {}, {}
        for least, own in members.items():
            self.classes[least] = _Class(least, self)
            sizes = [len(self.items[k]) for k in own]
            self.least_pairs[least] = min(n - 1 - 2 * allowed(n, similarity) for n in sizes)
            self.reach[least] = max(n + allowed(n, similarity) for n in sizes)
            self.before[least] = self.reach[least]
        #: Repetitions of each class; 0 where pieces take their place.
        self.repeats = {c: self._repeats(c, recall) for c in self.classes}
        self.lengths = {c: self._lengths(c) if not r else [] for c, r in self.repeats.items()}
        self._keys()

    def _pair_table(self) -> np.ndarray:
        pairs = [self._pair(x[:-1], x[1:]) for x in self.items]
        every = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.bits = max(16, int(math.log2(len(every) + 1)) + 8)
        table = np.zeros(1 << self.bits, bool)
        table[self._slot(every)] = True
        return table

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where((a > 0) & (b > 0), a * (len(self.number) + 1) + b, 0)

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return (_mix(pair.astype(_U64)) >> _U64(64 - self.bits)).astype(np.int64)

    def _repeats(self, least: int, recall: float) -> int:
        """Repetitions after which the asked share of the items edited up to the threshold is found.

        Edits lie as in ``_edited``; each kind has to reach the recall. 0 if ``MAX_REPEATS`` do not.
        """
        rng, cls, own = np.random.default_rng(SEED), self.classes[least], self.members[least]
        own = [own[k] for k in rng.permutation(len(own))[: max(1, min(100, TRIED_WORDS // least))]]
        trials = [(w, k) for k in own for w in range(KINDS_OF_EDITS) for _ in range(max(1, 100 // len(own)))]
        gap = np.zeros(self.pad, np.int64)
        parts, starts, trial, sides, at = [], [], [], [], 0
        for t, (where, k) in enumerate(trials):
            item = self.items[k]
            edited = self._edited(item, rng, where)
            for side, x, places in (
                (0, item, self._offsets(least, len(item))),
                (1, edited, np.arange(len(edited))),
            ):
                parts += [x, gap]
                starts.append(at + places)
                trial.append(np.full(len(places), t))
                sides.append(np.full(len(places), side, bool))
                at += len(x) + len(gap)
        x, start, trial, side = map(np.concatenate, (parts, starts, trial, sides))
        where = np.array([w for w, _ in trials])
        found = np.zeros(len(trials), bool)
        for r in range(MAX_REPEATS):
            key = _mix(cls.key(x, start, r, self.hashes)) ^ trial.astype(_U64)
            none = _mix(np.zeros(1, _U64))[0] ^ trial.astype(_U64)
            good = key != none
            common = np.intersect1d(key[good & ~side], key[good & side])
            found[trial[good & side][np.isin(key[good & side], common)]] = True
            if all(found[where == w].mean() >= recall for w in range(KINDS_OF_EDITS)):
                # the trials are a sample
                return min(MAX_REPEATS, 2 * (r + 1) + 2)
        return 0

    def _edited(self, item: np.ndarray, rng, where: int = 0) -> np.ndarray:
        """Edits up to the threshold, of one of the kinds."""
        n, d = len(item), allowed(len(item), self.similarity)
        if where == 4:
            out = item.copy()
            out[np.linspace(0, n - 1, d + 2).astype(int)[1:-1]] = 0
            return out
        if where:
            a = (0, n - d, int(rng.integers(n - d + 1)))[where - 1]
            other = rng.integers(0, len(self.number) + 1, d if rng.integers(2) else 0)
            return np.concatenate((item[:a], other, item[a + d :]))
        out = item.tolist()
        for _ in range(d):
            at = int(rng.integers(len(out)))
            word = int(rng.integers(0, len(self.number) + 1))
            kind = int(rng.integers(3))
            out[at : at + (kind != 2)] = [word] if kind else []
        return np.array(out, np.int64)

    def _offsets(self, least: int, n: int) -> np.ndarray:
        """Where the walks of an item of ``n`` words begin."""
        return np.arange(0, n - 1, self.classes[least].gap)

    def _pieces(self, k: int) -> list[tuple[int, int]]:
        """(offset, words) of the pieces of an item, one more than it may have edits."""
        n = len(self.items[k])
        cuts = np.linspace(0, n, allowed(n, self.similarity) + 2).astype(int).tolist()
        return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]

    def _lengths(self, least: int) -> list[int]:
        return sorted({n for k in self.members[least] for _, n in self._pieces(k)})

    def _runs(self, least: int, x: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Keys of the ``n`` words from each place on; 0 if one of them is in no item."""
        key, good = np.full(len(at), _U64(least * 1_000_003 + n)), np.ones(len(at), bool)
        for j in range(n):
            w = x[at + j]
            key, good = _mix(key ^ self.hashes[w]) + _U64(j), good & (w > 0)
        return np.where(good, key, _U64(0))

    def _keys(self) -> None:
        """Sorted keys, and for each a range of owners: items and offsets in them."""
        every: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for least, own in self.members.items():
            size = [len(self.items[k]) + self.pad for k in own]
            base = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
            x = np.concatenate([np.append(self.items[k], np.zeros(self.pad, np.int64)) for k in own])
            offsets = [self._offsets(least, len(self.items[k])) for k in own]
            owner = np.repeat(np.array(own), [len(o) for o in offsets])
            offset = np.concatenate(offsets)
            at = np.repeat(base, [len(o) for o in offsets]) + offset
            every += [
                (self.classes[least].key(x, at, r, self.hashes), owner, offset)
                for r in range(self.repeats[least])
            ]
            for n in self.lengths[least]:
                some = [(k, b, a) for k, b in zip(own, base.tolist(), strict=True) for a, m in self._pieces(k) if m == n]
                owner, first, offset = (np.array(c, np.int64) for c in zip(*some, strict=True))
                every.append((self._runs(least, x, first + offset, n), owner, offset))
        zero = np.zeros(0, np.int64)
        keys, owner, offset = map(np.concatenate, zip((zero.astype(_U64), zero, zero), *every, strict=True))
        order = np.argsort(keys, kind="stable")
        order = order[keys[order] > 0]
        self.keys, first = np.unique(keys[order], return_index=True)
        self.first = np.append(first, len(order))
        self.owner, self.offset = owner[order].astype(np.int32), offset[order].astype(np.int32)

    def candidates(self, x: np.ndarray) -> list[tuple[int, int, int]]:
        """(place, item, offset) of windows that share a key with an item from that offset on."""
        found = set()
        if not len(self.keys):
            return []
        near = self.pairs[self._slot(self._pair(x[:-1], x[1:]))] & (x[:-1] > 0) & (x[1:] > 0)
        total = np.concatenate(([0], np.cumsum(near)))
        starts = np.arange(len(x) - self.pad)
        for least, cls in self.classes.items():
            ends = np.minimum(starts + self.reach[least] - 1, len(near))
            full = total[ends] - total[starts] >= max(1, self.least_pairs[least])
            # a window may start anywhere in a passage
            count = np.concatenate(([0], np.cumsum(full)))
            at = starts[count[1:] > count[np.maximum(0, starts - self.before[least])]]
            if not len(at):
                continue
            keys = [cls.key(x, at, r, self.hashes) for r in range(self.repeats[least])]
            keys += [self._runs(least, x, at, n) for n in self.lengths[least]]
            for key in keys:
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                for j in np.flatnonzero((self.keys[place] == key) & (key > 0)).tolist():
                    a, b = self.first[place[j] : place[j] + 2].tolist()
                    found.update(
                        (int(at[j]), k, o)
                        for k, o in zip(self.owner[a:b].tolist(), self.offset[a:b].tolist(), strict=True)
                    )
        return sorted(found)

    def matches(self, x: np.ndarray, candidates: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """(item, begin, end, distance) in words, without overlaps of one item."""
        out, done, tried = [], defaultdict(list), set()
        for place, k, offset in candidates:
            start = place - offset
            if (start, k) in tried or any(a <= place < b for a, b in done[k]):
                continue
            tried.add((start, k))
            item = self.items[k]
            d = allowed(len(item), self.similarity)
            low, high = max(0, start - d), min(len(x), start + len(item) + 2 * d)
            # d edits take away at most d of the item's different words
            if len(self.sets[k].intersection(x[low:high].tolist())) < len(self.sets[k]) - d:
                continue
            distance, end = _best_end(item, x[low:high])
            if distance > d:
                continue
            _, back = _best_end(item[::-1], x[low : low + end][::-1], free_start=False)
            a, b = low + end - back, low + end
            if all(b <= c or e <= a for c, e in done[k]):
                out.append((k, a, b, distance))
                done[k].append((a, b))
        return out


def _best_end(item: np.ndarray, part: np.ndarray, free_start: bool = True) -> tuple[int, int]:
    """Least edit distance of ``item`` to a stretch of ``part``, and where that ends."""
    ramp = np.arange(len(part) + 1)
    row = np.zeros_like(ramp) if free_start else ramp.copy()
    for i, word in enumerate(item, 1):
        step = np.minimum(row[1:] + 1, row[:-1] + ((part != word) | (part == 0)))
        step = np.concatenate(([i], step))
        row = np.minimum.accumulate(step - ramp) + ramp
    end = int(np.argmin(row))
    return int(row[end]), end


class _Found:
    """Searches whole texts, many at a time."""

    def __init__(self, index: ItemIndex) -> None:
        self.index = index

    def __call__(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        ix = self.index
        every = [
            np.fromiter(map(ix.number.__getitem__, w), np.int64, len(w))
            for w in map(words, texts)
        ]
        out: list[list] = [[] for _ in texts]
        gap = np.zeros(ix.pad, np.int64)
        for a in range(0, len(every), 64):
            some = every[a : a + 64]
            x = np.concatenate([p for e in some for p in (e, gap)])
            bases = np.cumsum([0] + [len(e) + ix.pad for e in some])
            by = defaultdict(list)
            for place, k, offset in ix.candidates(x):
                doc = int(np.searchsorted(bases, place, "right")) - 1
                by[doc].append((place - int(bases[doc]), k, offset))
            for doc, own in by.items():
                out[a + doc] = ix.matches(some[doc], own)
        return out


def _blocks(items: DataFrame, similarity: float, recall: float) -> Iterator:
    """Broadcast item indexes, block by block."""
    spark = items.sparkSession
    rows, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    n = max(1, math.ceil(rows / BLOCK_ITEMS), math.ceil(chars / BLOCK_CHARS))
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        block = items.filter(own == k).select(F.col("item_id").cast("long"), "text").distinct()
        pairs = sorted(((r[0], r[1]) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        yield spark.sparkContext.broadcast(ItemIndex(pairs, similarity, recall))


MATCHES = "doc_id long, item_id long, begin long, end long, distance long, similarity double"


def leaks(
    docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """doc_id, item_id, code points of the passage, word distance and similarity of matches."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    out = None
    for index in _blocks(items, similarity, recall):

        def search(batches, index=index):
            find = _Found(index.value)
            for batch in batches:
                texts = batch.column(1).to_pylist()
                got = []
                for key, text, hits in zip(batch.column(0).to_pylist(), texts, find(texts), strict=True):
                    if hits:
                        low = text.lower()
                        spans = [m.span() for m in WORD.finditer(low)]
                    for k, a, b, d in hits:
                        n = len(find.index.items[k])
                        got.append((key, find.index.ids[k], spans[a][0], spans[b - 1][1], d, 1 - d / n))
                columns = list(zip(*got, strict=True)) if got else [[]] * 6
                kinds = [pa.int64()] * 5 + [pa.float64()]
                names = ["doc_id", "item_id", "begin", "end", "distance", "similarity"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
                )

        found = rows.mapInArrow(search, MATCHES)
        out = found if out is None else out.union(found)
    return out


def without_leaks(
    docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """The documents in which no item is found, all columns as they were."""
    at = docs.columns.index("text")
    for index in _blocks(items, similarity, recall):

        def keep(batches, index=index):
            find = _Found(index.value)
            for batch in batches:
                clean = [not hits for hits in find(batch.column(at).to_pylist())]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
