"""Runs of repeated words, by recompression.

The words of a batch of texts, a boundary mark between any two, are compressed in
turns: *block* steps name every maximal run of one symbol, *pair* steps split the
symbols in two halves and name the neighbours whose left one is in the first and whose
right one is in the second half, until every text is one symbol. The names form a
run-length grammar; equal stretches are parsed alike but for their ends.

A run of period ``q`` holds a place of the grid of multiples of ``length - q``, for the
least length a run of that period may have, and words ``q`` apart there are equal. For
all such places of all periods (harmonically many) the grammar answers how far the
words go on being equal in both directions, level by level and many questions at once.
A stretch found with several periods belongs to the least of them.

Words are what lies between blanks and U+0009 to U+000D. Null and empty texts have no
words and no runs. Rows are kept, equal ones and null ids too. A text is never split, so
a worker holds some 60 bytes per word of a text.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import bounded, text_of

#: A run has at least this many words, and this many of its periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Bytes of text whose words are compressed together.
BATCH_BYTES = 1 << 21
#: Grid places looked at together.
PLACES = 1 << 20


Edit = Callable[[object, list[bytes]], list[bytes]]


class Level(NamedTuple):
    """Symbols of a level, and of what it is made: ``first`` child and ``pairs`` or blocks."""

    symbols: np.ndarray
    first: np.ndarray | None
    parent: np.ndarray | None
    pairs: bool


class Grammar:
    """A run-length grammar of word numbers; negative numbers are marks, each used once."""

    def __init__(self, words: np.ndarray) -> None:
        self.levels = [Level(words, None, None, False)]
        names = int(words.max(initial=0)) + 1
        texts = int((words < 0).sum()) - 1
        turn = 0
        while len(self.levels[-1].symbols) > 2 * texts + 1:
            symbols = self.levels[-1].symbols
            if (symbols[1:] == symbols[:-1]).any():
                names = self._blocks(symbols, names)
            else:
                names = self._pairs(symbols, names, turn)
                turn += 1

    def _raise(self, starts: np.ndarray, symbols: np.ndarray, pairs: bool) -> None:
        below = self.levels[-1]
        self.levels[-1] = below._replace(parent=np.cumsum(starts) - 1)
        self.levels.append(Level(symbols, np.flatnonzero(starts), None, pairs))

    def _blocks(self, symbols: np.ndarray, names: int) -> int:
        starts = np.concatenate(([True], symbols[1:] != symbols[:-1]))
        first = np.flatnonzero(starts)
        size = np.diff(first, append=len(symbols))
        raised, many = symbols[first], size > 1
        rules, _ = pd.factorize(raised[many] * np.int64(len(symbols) + 1) + size[many])
        raised[many] = names + rules
        self._raise(starts, raised, pairs=False)
        return names + int(rules.max(initial=-1)) + 1

    def _pairs(self, symbols: np.ndarray, names: int, turn: int) -> int:
        mixed = (symbols + turn) * np.int64(0x5851F42D4C957F2D)
        left = (mixed >> np.int64(40 - turn % 16) & 1).astype(bool)
        mark = symbols < 0
        both = ~(mark[:-1] | mark[1:])
        ahead = left[:-1] & ~left[1:] & both
        back = ~left[:-1] & left[1:] & both
        joined = ahead if ahead.sum() >= back.sum() else back
        starts = np.concatenate(([True], ~joined))
        at = np.flatnonzero(joined)
        rules, _ = pd.factorize(symbols[at] * np.int64(names) + symbols[at + 1])
        raised = symbols.copy()
        raised[at] = names + rules
        self._raise(starts, raised[starts], pairs=True)
        return names + int(rules.max(initial=-1)) + 1

    def _last(self, level: int, of: np.ndarray) -> np.ndarray:
        first = self.levels[level].first
        ends = np.append(first[1:], len(self.levels[level - 1].symbols))
        return ends[of] - 1

    def unequal(self, x: np.ndarray, y: np.ndarray, way: int) -> np.ndarray:
        """Where the words from ``x`` on first differ from those from ``y`` on.

        ``way`` is 1 for ahead, -1 for back. ``x`` and ``y`` are places of one text and
        differ, so a mark ends every comparison.
        """
        left: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        who = np.arange(len(x))
        for level, (symbols, _, parent, _) in enumerate(self.levels):
            same = symbols[x] == symbols[y]
            left.append((who[~same], x[~same], y[~same]))
            who, x, y = who[same], x[same], y[same]
            if not len(who):
                break
            if self.levels[level + 1].pairs:
                x, y = self._rise_pairs(level, parent, x, y, way)
            else:
                who, x, y, stuck = self._rise_blocks(level, parent, who, x, y, way)
                left[-1] = tuple(np.concatenate(z) for z in zip(left[-1], stuck, strict=True))
        out = np.empty(sum(len(w) for w, _, _ in left), np.int64)
        who = x = y = np.empty(0, np.int64)
        for level in range(len(left) - 1, -1, -1):
            more = left[level]
            who, x, y = (np.concatenate(z) for z in zip((who, x, y), more, strict=True))
            if level:
                x, y = self._fall(level, x, y, way)
        out[who] = x
        return out

    def _edge(self, level: int, of: np.ndarray, way: int) -> np.ndarray:
        """The child at which a symbol of ``level`` begins, seen in the direction of ``way``."""
        return self.levels[level].first[of] if way > 0 else self._last(level, of)

    def _rise_pairs(self, level, parent, x, y, way):
        begun = (self._edge(level + 1, parent[x], way) == x) & (
            self._edge(level + 1, parent[y], way) == y
        )
        step = np.where(begun, 0, way)
        return parent[x + step], parent[y + step]

    def _rise_blocks(self, level, parent, who, x, y, way):
        px, py = parent[x], parent[y]
        rest_x = np.abs(self._edge(level + 1, px, -way) - x)
        rest_y = np.abs(self._edge(level + 1, py, -way) - y)
        begun = (self._edge(level + 1, px, way) == x) & (self._edge(level + 1, py, way) == y)
        up = begun | (rest_x == rest_y)
        step = np.where(begun, 0, way)
        over = (np.minimum(rest_x, rest_y) + 1) * way
        stuck = (who[~up], (x + over)[~up], (y + over)[~up])
        return who[up], (px + step)[up], (py + step)[up], stuck

    def _fall(self, level, x, y, way):
        """To the children of two unequal symbols, past the children that are equal."""
        below = self.levels[level - 1].symbols
        cx, cy = self._edge(level, x, way), self._edge(level, y, way)
        same = below[cx] == below[cy]
        if self.levels[level].pairs:
            step = np.where(same, way, 0)
        else:
            size_x = np.abs(self._edge(level, x, -way) - cx) + 1
            size_y = np.abs(self._edge(level, y, -way) - cy) + 1
            step = np.where(same, np.minimum(size_x, size_y) * way, 0)
        return cx + step, cy + step


def _grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of all grid places, at most about ``PLACES`` at a time."""
    periods = np.where(sizes >= LEAST_WORDS, sizes // LEAST_PERIODS, 0)
    ends = np.cumsum(periods)
    done, every = 0, int(ends[-1]) if len(ends) else 0
    while done < every:
        # (text, period) pairs are numbered; a slice of them is unfolded at a time
        number = np.arange(done, min(every, done + PLACES // 16))
        text = np.searchsorted(ends, number, side="right")
        q = number - (ends[text] - periods[text]) + 1
        step = np.maximum(LEAST_WORDS, LEAST_PERIODS * q) - q
        places = (sizes[text] - q - 1) // step + 1
        total = np.cumsum(places)
        upto = max(1, int(np.searchsorted(total, PLACES, side="right")))
        text, q, step, places, total = (z[:upto] for z in (text, q, step, places, total))
        nth = np.arange(total[-1]) - np.repeat(total - places, places)
        yield np.repeat(text, places), nth * np.repeat(step, places), np.repeat(q, places)
        done += upto


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """All runs (start, length, period) of every sequence of word numbers, sorted."""
    sizes = np.array([len(t) for t in texts], np.int64)
    marks = -np.arange(1, len(texts) + 2)
    begin = np.cumsum(sizes + 1) - sizes
    words = np.empty(int(sizes.sum()) + len(marks), np.int64)
    words[np.append(begin - 1, len(words) - 1)] = marks
    for a, t in zip(begin.tolist(), texts, strict=True):
        words[a : a + len(t)] = t
    grammar, found = None, []
    for text, place, q in _grid(sizes):
        at = begin[text] + place
        hit = words[at] == words[at + q]
        at, q = at[hit], q[hit]
        if not len(at):
            continue
        grammar = grammar or Grammar(words)
        ahead = grammar.unequal(at, at + q, 1)
        back = grammar.unequal(at - 1, at + q - 1, -1) + 1
        length = ahead + q - back
        whole = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found.append(np.stack([back[whole], length[whole], q[whole]]))
    if not found:
        return [np.empty((0, 3), np.int64)] * len(texts)
    start, length, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[new], length[new], q[new]
    text = np.searchsorted(begin, start, side="right") - 1
    order = np.lexsort((q, start, text))
    rows = np.stack([start - begin[text], length, q], axis=1)[order]
    return np.split(rows, np.searchsorted(text[order], np.arange(1, len(texts))))


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, without those behind the first period of a run."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


def _numbers(texts: list[list[bytes]]) -> list[np.ndarray]:
    known: dict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    return [np.fromiter(map(known.__getitem__, t), np.int64, len(t)) for t in texts]


OUT = ["doc_id", "n_words", "runs", "collapsed"]
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period) and the collapsed text.

    Runs are sorted by start, then period; starts and lengths count words. ``edit`` may
    change a text's words first; it is given the id and the words.
    """

    def columns(ids: pa.Array, raws: list[bytes]) -> list[pa.Array]:
        texts = [raw.split() for raw in raws]
        if edit:
            texts = [edit(k, t) for k, t in zip(ids.to_pylist(), texts, strict=True)]
        runs = runs_of(_numbers(texts))
        every = np.concatenate(runs)
        ends = np.cumsum([0, *map(len, runs)])
        structs = pa.StructArray.from_arrays(list(map(pa.array, every.T)), fields=list(RUN))
        left = [collapsed(t, r) for t, r in zip(texts, runs, strict=True)]
        return [
            ids,
            pa.array(list(map(len, texts)), pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
            pa.array(left, pa.binary()).cast(pa.string()),
        ]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column(1).to_pylist()
            for begin, end in bounded(list(map(len, raws)), BATCH_BYTES):
                ids = batch.column(0).slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(columns(ids, raws[begin:end]), names=OUT)

    rows = docs.select("doc_id", text_of().cast("binary").alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(
        find,
        f"doc_id {kind}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )


def planted(doc_id, words: list[bytes]) -> list[bytes]:
    """The words; every tenth id's, by its checksum, go on periodically from some word on."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def run_table(docs: DataFrame) -> DataFrame:
    """Digest of the runs of every document with planted periods: the query's rows."""
    rows = periodic_runs(docs, planted)
    best = F.expr(
        "array_max(transform(runs, r -> struct(r.length, -r.start AS s, -r.period AS p)))"
    )
    lines = F.expr(
        "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    )
    top = rows.withColumn("top", best)
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
