"""Token counts of whole documents; huge ones in overlapping chunks.

A huge document is encoded chunk by chunk, each chunk overlapping the one before.
Two chunks are spliced at a token boundary that both have and that is proven
stable: the vocabulary holds no piece with the two characters around it, so the
encoding of the whole text has a boundary there as well and the two sides don't
influence each other. If the overlap holds no such place, it is widened.

Null texts count as empty, empty texts have no tokens. Rows are kept as they
are, repeated ones included; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import fresh, text_of
from ferrylog.llm.encode import PieceBpe, encoder

#: Characters of a chunk, and of the overlap to begin with.
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256


@cache
def worker_encoder(path: str):
    return encoder(path)


class _Encoded:
    """A chunk's token borders that are proven stable, and its token count."""

    def __init__(self, enc: PieceBpe, text: str) -> None:
        at = enc.offsets(text)
        self.known = at is not None
        self.before: dict[int, int] = {}
        if not self.known:
            return
        self.tokens = len(at) - 1
        raw = text.encode()
        if len(raw) == len(text):
            chars = at
        else:
            first = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
            chars = np.append(np.where(first, np.cumsum(first) - 1, -1), len(text))[at]
        for tokens, char in enumerate(chars.tolist()):
            if 0 < char < len(text) and enc.stable(text[char - 1], text[char]):
                self.before[char] = tokens


def _splice(here: _Encoded, after: _Encoded, shift: int, least: int) -> int | None:
    """The last stable border of both beyond ``least``; ``after`` begins at ``shift``."""
    common = [c for c in after.before if c + shift in here.before and c + shift > least]
    return max(common) + shift if common else None


def count_chunked(
    enc: PieceBpe, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> int:
    """Tokens of a text of any length, by resynchronised chunks.

    ``cut`` is the border up to which tokens are counted, ``begin`` where the
    current chunk starts; what a chunk has before its first common border may
    differ from the whole text's encoding and is never used.
    """
    begin = cut = total = 0
    size = chunk
    here = _Encoded(enc, text[:size])
    while begin + size < len(text):
        width, place = min(overlap, size // 2), None
        while here.known and place is None and width < size:
            ahead = begin + size - width
            after = _Encoded(enc, text[ahead : ahead + chunk])
            if after.known:
                place = _splice(here, after, ahead - begin, cut - begin)
            width *= 2
        if place is None:
            size *= 2
            here = _Encoded(enc, text[begin : begin + size])
            continue
        total += here.before[place] - here.before.get(cut - begin, 0)
        begin, cut, here, size = ahead, begin + place, after, chunk
    if not here.known:
        return len(enc.library([text])[0])
    return total + here.tokens - here.before.get(cut - begin, 0)


def token_counts(
    docs: DataFrame,
    path: str,
    text: str = "text",
    out: str = "n_tokens",
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """``docs`` with the number of tokens that the file at ``path`` gives each text."""

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = worker_encoder(path)
        for part in parts:
            texts = part.tolist()
            huge = [isinstance(enc, PieceBpe) and len(t) > chunk for t in texts]
            short = iter(enc.counts([t for t, h in zip(texts, huge, strict=True) if not h]))
            yield pd.Series(
                [
                    count_chunked(enc, t, chunk, overlap) if h else next(short)
                    for t, h in zip(texts, huge, strict=True)
                ],
                dtype="int64",
            )

    return docs.withColumn(out, count(text_of(text)))


def counted(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """Per document: bytes, tokens, and whether it has more than ``limit`` tokens."""
    (tokens,) = fresh(docs, "n_tokens")
    rows = token_counts(docs, path, out=tokens)
    return rows.select(
        "doc_id",
        F.octet_length(text_of()).cast("long").alias("n_bytes"),
        F.col(tokens).alias("n_tokens"),
        (F.col(tokens) > limit).alias("over_limit"),
    )
