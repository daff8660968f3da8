"""Random bodies against a plain model of the payload rules."""

import json
import random

from ferrylog.operators.shape import build_payload
from ferrylog.schema import SEVERITY_NAMES

KEYS = ["a", "b", "c", "raw", "severity", "structured_data", "é\"k"]


class Pairs(list):
    """Fields of one JSON object in order, repeated keys included."""


def scalar(rng):
    return rng.choice([0, 3, 7, 8, -1, 10**15, "3", "", "x\ty\"\\\n", "日本", True, False, None])


def value(rng, depth):
    kind = rng.random()
    if depth and kind < 0.35:
        return Pairs((rng.choice(KEYS), value(rng, depth - 1)) for _ in range(rng.randrange(4)))
    if kind < 0.45:
        return [scalar(rng) for _ in range(rng.randrange(3))]
    return scalar(rng)


def text(v):
    if isinstance(v, Pairs):
        return "{" + ", ".join(f"{json.dumps(k)} : {text(x)}" for k, x in v) + "}"
    if isinstance(v, list):
        return "[" + ",".join(text(x) for x in v) + "]"
    return json.dumps(v)


def plain(v):
    """As a usual JSON reader sees it, a repeated key at its last place."""
    if isinstance(v, Pairs):
        out = {}
        for k, x in v:
            out.pop(k, None)
            out[k] = plain(x)
        return out
    return [plain(x) for x in v] if isinstance(v, list) else v


def leaves(obj):
    for k, v in obj.items():
        if isinstance(v, dict):
            yield from leaves(v)
        else:
            yield k, v


def model(body, raw):
    out = {}
    for key, v in body:
        if key == "structured_data":
            out.update(leaves(plain(v)) if isinstance(v, Pairs) else {})
        elif key == "severity":
            known = isinstance(v, int) and not isinstance(v, bool) and 0 <= v <= 7
            out[key] = SEVERITY_NAMES[v] if known else "INFO"
        else:
            out[key] = plain(v)
    out["raw"] = raw or "-"
    return out


def test_random_bodies(entries_of):
    rng = random.Random(42)
    bodies = [
        Pairs((rng.choice(KEYS), value(rng, 4)) for _ in range(rng.randrange(7))) for _ in range(1500)
    ]
    raws = [rng.choice(["", "r", "<1>1 \x01\ttext\n"]) for _ in bodies]
    rows = [(f"{n}-0", "s", text(b), r) for n, (b, r) in enumerate(zip(bodies, raws))]
    got = build_payload(entries_of(rows)).select("id", "line").collect()
    assert len(got) == len(bodies)
    for row in got:
        n = int(row.id.split("-")[0])
        body = row.line.split("\t", 2)[2]
        seen = json.loads(body, object_pairs_hook=lambda p: p)
        names = [k for k, _ in seen]
        assert len(names) == len(set(names)) and names[-1] == "raw"
        assert json.loads(body) == model(bodies[n], raws[n]), rows[n]
