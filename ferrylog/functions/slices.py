"""Fields of a JSON object as slices of its text, nothing rewritten.

For the bodies that no parser gives back as they were written: numbers beyond a double
or with zeros at their end, white space, escapes, nested keys in their own order, and
objects nested to any depth. One pass over the tokens, with a stack instead of recursion.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strings, brackets, and everything else between separators.
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]]|[^\s"{}\[\],:]+', re.DOTALL)

#: ``own`` tells a field of the body itself from a leaf of its structured data.
FIELD_SLICES = "array<struct<key:string,value:string,own:boolean>>"
_ARROW = pa.list_(
    pa.struct([("key", pa.string()), ("value", pa.string()), ("own", pa.bool_())])
)
Slice = tuple[str, str, bool]


def named(raw: str) -> str:
    """A key as its reader sees it."""
    return json.loads(f'"{raw}"', strict=False) if "\\" in raw else raw


class _Frame:
    """An open container: where it begins, the key it waits a value for, what it gave."""

    def __init__(self, begin: int, is_object: bool, walked: bool) -> None:
        self.begin = begin
        self.is_object = is_object
        self.walked = walked
        self.key: str | None = None
        self.given: dict[str, tuple[int, int]] = {}
        self.mark = 0


def _walked(text: str, flat: str | None, whole: bool = False) -> list[Slice]:
    """(key, value, own) slices of an object's fields, those below ``flat`` leaf by leaf.

    With ``whole`` the object itself is walked for leaves. Of equal keys in one nested
    object only the last one gives leaves.
    """
    out: list[Slice | None] = []
    open_: list[_Frame] = []
    for token in _TOKEN.finditer(text):
        at, end = token.span()
        first = text[at]
        frame = open_[-1] if open_ else None
        if first in "{[":
            if frame is None:
                open_.append(_Frame(at, True, True))
                continue
            below = len(open_) > 1 or whole or (frame.key is not None and frame.key == flat)
            frame.mark = len(out)
            open_.append(_Frame(at, first == "{", first == "{" and frame.walked and below))
            continue
        if first in "}]":
            closed = open_.pop()
            if not open_:
                break
            frame, at = open_[-1], closed.begin
            is_leaf = not closed.is_object
        elif frame.is_object and frame.key is None:
            frame.key = text[at + 1 : end - 1]
            continue
        else:
            closed, is_leaf = None, True
            frame.mark = len(out)
        if not frame.is_object:
            continue
        key, frame.key = frame.key, None
        if not frame.walked:
            continue
        if len(open_) == 1 and not whole:
            if key != flat:
                out.append((key, text[at:end], True))
            continue
        if is_leaf:
            out.append((key, text[at:end], False))
        name = named(key)
        for k in range(*frame.given.get(name, (0, 0))):
            out[k] = None
        frame.given[name] = (frame.mark, len(out))
    return [x for x in out if x is not None]


def body_slices(text: str) -> list[Slice]:
    """Fields of a payload line from a body: structured data leaf by leaf, equal keys once.

    A line feed can stand between tokens only; it would end the line and becomes a blank.
    """
    fields = _walked(text, "structured_data")
    return last_of_each([(k, v.replace("\n", " "), o) for k, v, o in fields if named(k) != "raw"])


def top_slices(text: str) -> list[Slice]:
    """An object's own fields, with their keys as a reader sees them."""
    return [(named(k), v, o) for k, v, o in _walked(text, None)]


def leaf_slices(text: str) -> list[Slice]:
    """Leaf fields, at any depth, of the structured data in a body."""
    found = [v for k, v, _ in _walked(text, None) if k == "structured_data"]
    if not found or found[-1][0] != "{":
        return []
    return [(named(k), v, o) for k, v, o in _walked(found[-1], None, whole=True)]


def last_of_each(fields: list[Slice]) -> list[Slice]:
    """Of fields with equal names the last one."""
    out: dict[str, Slice] = {}
    for field in fields:
        name = named(field[0])
        out.pop(name, None)
        out[name] = field
    return list(out.values())


def slices_of(text: Column, scan: Callable[[str], list[Slice]]) -> Column:
    """What ``scan`` finds in a JSON object; null for a null text."""

    @F.arrow_udf(FIELD_SLICES)
    def scanned(texts: pa.Array) -> pa.Array:
        rows = [
            None if t is None else [{"key": k, "value": v, "own": o} for k, v, o in scan(t)]
            for t in texts.to_pylist()
        ]
        return pa.array(rows, _ARROW)

    return scanned(text)
