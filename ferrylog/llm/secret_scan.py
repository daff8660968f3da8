"""Secrets in texts: fixed patterns, and strings that compress badly where they stand.

The patterns report what follows a telling name, access keys and long hex runs.
Beyond those, strings of 16 or more key characters are measured that hold a
sensitive word, have one near before or behind them, or follow line by line on such
a string: the bytes that zstandard needs for the string once it knows the text
around it and common code identifiers. Words, paths and identifiers are cheap
then; random keys cost nearly all their bytes, as far as the symbols they are
written in need them, and are reported as ``novel``.

Places are code points, ends exclusive. Null texts count as empty; texts without
finds have empty spans. Rows and repeated rows stay as they are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.llm.common import text_of

KINDS = ("assign", "access", "hex", "novel")

ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: A digit has to be near for any of the patterns but the first two.
SENSITIVE = re.compile(
    r"passw|passphrase|secret|token|api.?key|credential|auth|bearer|private.?key|access.?key|signature",
    re.IGNORECASE | re.ASCII,
)

#: Characters around a candidate that prime the compressor.
AROUND = 1_024
#: Characters between a candidate and a sensitive word before or behind it.
NEAR = 64
#: Compressed bytes per character from which a candidate is reported.
NOVELTY = 0.6
#: Share of its alphabet's bits from which a string of few symbols is reported.
OWN_NOVELTY = 0.95
#: What may stand between two lines of one key, as in a PEM file or a string literal.
LINE_END = re.compile(r"""[ \t"'+,]*(?:(?:\\r)?\\(?=n)|\r?\n)[ \t"'+,]*""")
#: The last line of a key may be short.
LAST_LINE = re.compile(rf"""({LINE_END.pattern})([A-Za-z0-9+/_=-]{{2,15}})(?=["'\\]|\s|$)""")

#: Identifiers that source code repeats, the compressor's fixed dictionary.
IDENTIFIERS = " ".join(
    """
    abstract argument array assert async attribute authentication authorization await boolean
    buffer cache callback certificate channel character class client collection column command
    component config configuration connection constant container content context controller
    count create credentials current database datetime debug decode default delete description
    destination dictionary directory document element encode endpoint environment error event
    exception execute export expression extends factory false field filename filter final find
    format function generate getattr global handler hash header height host identifier image
    implements import include index initialize input insert instance integer interface iterator
    javascript key label lambda length library listener local location logger manager message
    method middleware model module namespace network null number object offset operator option
    output package parameter parent parser password path pattern payload pointer prefix private
    process property protected protocol provider public query queue random register remove
    render repository request resource response result return router schema secret select
    self sequence server service session setattr settings signature size source static status
    storage stream string struct struct subscribe success system table target template this
    thread timeout timestamp token transaction transform true type undefined update upload
    user username uuid validate value variable version virtual width window write
    abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789
    """.split()
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern finds."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def marginal_bytes(string: str, before: str, after: str) -> int:
    """Bytes that the string adds once its surroundings and identifiers are known."""
    primer = f"{IDENTIFIERS}\n{after}\n{before}".encode()
    known = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    params = zstandard.ZstdCompressionParameters.from_level(
        19, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    coder = zstandard.ZstdCompressor(dict_data=known, compression_params=params)
    return max(0, len(coder.compress(string.encode())) - _EMPTY)


#: Bytes of a frame without content.
_EMPTY = len(
    zstandard.ZstdCompressor(
        compression_params=zstandard.ZstdCompressionParameters.from_level(
            19, write_content_size=0, write_checksum=0, write_dict_id=0
        )
    ).compress(b"")
)


def novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Incompressible strings near a sensitive word, apart from the pattern finds."""
    found = []
    words = [m.span() for m in SENSITIVE.finditer(text)]
    if not words:
        return found
    at, last = 0, None
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        # words are in order: those before the first that may be near are done with
        while at < len(words) and words[at][1] + NEAR < a:
            at += 1
        near = at < len(words) and words[at][0] <= b + NEAR
        follows = last is not None and LINE_END.fullmatch(text, last, a) is not None
        if not (near or follows):
            continue
        if not novel(text, a, b):
            continue
        last = b
        if not any(a < end and start < b for start, _, end in base):
            found.append((a, 3, b))
        tail = LAST_LINE.match(text, b) if follows else None
        if tail and (tail[2].endswith("=") or re.match(r"(?:\s|\\n)*-----END", text[tail.end() :])):
            c, d = tail.span(2)
            if not any(c < end and start < d for start, _, end in base):
                found.append((c, 3, d))
    return found


def novel(text: str, a: int, b: int) -> bool:
    """Whether the string, or what follows on the sensitive words it begins with, is incompressible."""
    inner = [m.end() for m in SENSITIVE.finditer(text, a, b)]
    for start in (a, *inner[-1:]):
        string = text[start:b]
        if len(string) < 16 or not (re.search("[0-9]", string) and re.search("[A-Za-z]", string)):
            continue
        cost = marginal_bytes(string, text[max(0, start - AROUND) : start], text[b : b + AROUND])
        if cost >= _least(string):
            return True
    return False


def _least(string: str) -> float:
    """Bytes from which a string is reported; its own symbols count once it shows them all."""
    symbols = len(set(string))
    share = NOVELTY
    if len(string) >= 4 * symbols:
        share = min(share, OWN_NOVELTY * math.log2(symbols) / 8)
    return share * len(string)


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCAN = "n_assign long, n_access long, n_hex long, base string, spans string"


def secrets_found(docs: DataFrame, text: str = "text", out: str = "found") -> DataFrame:
    """``docs`` with a struct of counts and spans of the secrets in each text."""

    @F.pandas_udf(SCAN)
    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for t in part.tolist():
                base = base_spans(t)
                every = sorted(base + novel_spans(t, base))
                kinds = [k for _, k, _ in base]
                rows.append((*(kinds.count(k) for k in range(3)), _join(base), _join(every)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])

    return docs.withColumn(out, scan(text_of(text)))


def scanned(docs: DataFrame) -> DataFrame:
    """Per document the counts by kind, a digest of the pattern finds, and all spans."""
    found = secrets_found(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        "found.n_assign",
        "found.n_access",
        "found.n_hex",
        F.sha2(F.col("found.base"), 256).alias("base_sha256"),
        "found.spans",
    )
