"""Periodic runs, spelling variants and fingerprints against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrylog.llm import fingerprints as fp
from ferrylog.llm import periodic_runs as pr
from ferrylog.llm import spelling as sp

from .conftest import SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, q, n) for (s, n), q in found.items())


@given(
    st.lists(
        st.tuples(st.lists(st.integers(0, 2), max_size=50), st.integers(0, 30), st.integers(1, 9)),
        max_size=4,
    )
)
@settings(max_examples=150, deadline=None)
def test_runs_equal_plain_ones(parts):
    texts = [w[:a] + [w[a + k % p] if a + k % p < len(w) else 7 for k in range(60)] for w, a, p in parts]
    found = [sorted((s, q, n) for s, n, q in r.tolist()) for r in pr.runs_of([np.array(t, np.int64) for t in texts])]
    assert found == [plain_runs(t) for t in texts]


def test_runs_of_few_places_at_a_time(monkeypatch):
    monkeypatch.setattr(pr, "PLACES", 32)
    rng = random.Random(3)
    text = [rng.randrange(2) for _ in range(300)] + [1, 0, 0] * 40 + [0] * 9
    (found,) = pr.runs_of([np.array(text)])
    assert sorted((s, q, n) for s, n, q in found.tolist()) == plain_runs(text)


def test_grammar_comparisons():
    rng = np.random.default_rng(5)
    words = np.concatenate(([-1], rng.integers(0, 2, 40), [-2], np.repeat(3, 30), [-3], [-4]))
    grammar = pr.Grammar(words)
    assert len(grammar.levels[-1].symbols) <= 2 * 3 + 1
    x, y = np.triu_indices(31, 1)
    for begin in (1, 42):
        for way in (1, -1):
            for a, b, end in zip(x + begin, y + begin, grammar.unequal(x + begin, y + begin, way), strict=True):
                n = 0
                while words[a + way * n] == words[b + way * n]:
                    n += 1
                assert end == a + way * n


def expected_runs(key, text):
    words = WORD.findall(text or "")
    n = len(words)
    if key is not None and n and zlib.crc32(str(key).encode()) % 10 == 0:
        g = zlib.crc32(str(key).encode()) // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]
    runs = plain_runs(words)
    gone = {i for s, q, m in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[2], -r[0], -r[1]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, q, m in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    top = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (key, len(runs), *top, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, left)))


def in_order(rows):
    return sorted(rows, key=str)


def test_run_table(spark, odd, odd_rows):
    short = [r for r in odd_rows if len(r[1] or "") < 100_000]
    short += [(k, f"w{k} a b c a b c a b c a b c\x0bd\x1ce f " * 3, "en", "a", 1) for k in range(200, 260)]
    docs = spark.createDataFrame(short, SCHEMA).withColumn("n_runs", F.lit(1)).withColumn("runs", F.lit("x"))
    found = [tuple(r) for r in pr.run_table(docs).collect()]
    assert in_order(found) == in_order(expected_runs(r[0], r[1]) for r in short)
    assert sum(r[1] > 0 for r in found) > 10
    assert pr.run_table(odd).count() == len(odd_rows)


def test_run_operator_gives_texts(spark, empty):
    docs = spark.createDataFrame([("k", " x  y z z z z z z\n"), (None, None)], "doc_id string, text string")
    rows = {r.doc_id: r for r in pr.periodic_runs(docs).collect()}
    assert rows["k"].collapsed == "x y z" and rows["k"].runs == [(2, 6, 1)]
    assert (rows[None].n_words, rows[None].runs, rows[None].collapsed) == (0, [], "")
    assert pr.run_table(empty).count() == 0


def plain_variants(rows):
    counts = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if key is not None:
                h = zlib.crc32(f"{key}:{run}".encode())
                if h % 199 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def one_off(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [v for v in words if one_off(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def spelled(rng, n):
    """Words with few letters, so that many are near, and counts that differ much."""
    rows = []
    for k in range(n):
        words = []
        for _ in range(120):
            word = "".join(rng.choice("aÀÿb×Z") for _ in range(rng.choice([5, 6, 6, 7])))
            words += [word] * rng.choice([1, 1, 1, 9])
        words += ["Common", "common"] * 30 + ["comon", "commonn", "cömmon"] * 2 + ["q" * 900, "q" * 901] * 3
        rows.append((k if k % 7 else None, " ".join(words) + "\x00-", "en", "a", 1))
    return rows


@pytest.mark.parametrize("blocks", [1 << 22, 16])
def test_variants_equal_plain_ones(spark, blocks, monkeypatch):
    monkeypatch.setattr(sp, "FILTER_BLOCKS", blocks)
    monkeypatch.setattr(sp, "PROBES", 5_000)
    rows = [*spelled(random.Random(2), 12), (3, None, None, None, None), (4, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    found = sorted((tuple(r) for r in sp.variant_table(docs).collect()), key=lambda r: r[0])
    want = plain_variants(rows)
    assert found == want
    assert any(r[1] and r[1] != r[2] for r in want) or any(r[1] for r in want)


def test_chains_of_forms(spark):
    links = [(f"w{k}", f"w{k + 1}") for k in range(9)]
    forms = spark.createDataFrame(links, "word string, form string")
    assert {r.root for r in sp.roots_of(forms, 9).collect()} == {"w9"}


def test_variants_equal_sql_and_empty(spark, odd, odd_rows, empty):
    con = duckdb.connect()
    con.register("documents", odd.toPandas().astype({"doc_id": "Int64"}))
    want = sorted(con.execute(sp.SQL).fetchall())
    assert sorted(tuple(r) for r in sp.variant_table(odd).collect()) == want == plain_variants(odd_rows)
    assert sp.variant_table(empty).count() == 0


def expected_prints(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for row, after in zip(order, order[1:] + order[:1], strict=True):
        text, ahead = row[1] or "", after[1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + ahead[:half]
        a, b, c = fp.fingerprint_all([text, edited, ahead])
        sha = hashlib.sha256(edited.encode()).hexdigest()
        near = [fp.like(a.tolist(), x.tolist()) for x in (b, c)]
        out.append((row[0], len(text), sha, fp.written_out(a), fp.written_out(b), *near))
    return out


def test_edited_table(spark, odd_rows):
    rows = [r for r in odd_rows if r[0] != 8]  # ids without ties have one order
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("slice", F.lit(0)).withColumn("h", F.lit("x"))
    found = [tuple(r) for r in fp.edited_table(docs).collect()]
    assert in_order(found) == in_order(expected_prints(rows))


def test_edited_table_with_equal_and_no_ids(spark, odd, odd_rows, empty):
    found = fp.edited_table(odd).collect()
    assert sorted(r.n_chars for r in found) == sorted(len(r[1] or "") for r in odd_rows)
    many = [(None, f"text {k}", "en", "a", 1) for k in range(300)] + [(5, "same text", "en", "a", 1)] * 300
    rows = fp.edited_table(spark.createDataFrame(many, SCHEMA)).collect()
    assert len(rows) == 600 and sum(r.near_next == 1.0 for r in rows) >= 299
    spread = fp.in_descending_order(spark.createDataFrame(many, SCHEMA)).groupBy("slice").count()
    assert spread.count() > 2
    one = fp.edited_table(spark.createDataFrame(many[-1:], SCHEMA)).collect()
    assert [(r.n_chars, r.near_edited > 0, r.near_next) for r in one] == [(9, True, 1.0)]
    assert fp.edited_table(empty).count() == 0


def test_prints_of_equal_substrings_are_alike():
    rng = random.Random(8)
    text, other = ("".join(rng.choice("abcde fgh.") for _ in range(6_000)) for _ in range(2))

    def alike(a, b):
        x, y = fp.fingerprint_all([a, b])
        return fp.like(x.tolist(), y.tolist())

    assert alike(text, text) == 1 and alike(text, "#" + text) > 0.9
    assert alike(text, text[:3_000] + "x" + text[3_001:]) > 0.9
    assert 0.35 < alike(text, text[:3_000] + other[:3_000]) < 0.65
    assert alike(text, other) < 0.1
    assert alike("", "") == 1 and alike("", "a") == 0 and alike("a" * 500, "a" * 501) == 0


def test_phrases_do_not_depend_on_the_batch():
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 90))) for _ in range(80)]
    texts += ["", "a", "aa", "x" * 5_000, "漢字😀" * 200]
    alone = [fp.written_out(fp.least_names([t])[0]) for t in texts]
    assert [fp.written_out(x) for x in fp.least_names(texts)] == alone
    assert all(fp.read_in(w) == x.tolist() for w, x in zip(alone, fp.least_names(texts), strict=True))


def test_fingerprint_operator_and_likeness(spark, odd, odd_rows, empty):
    prints = fp.fingerprints(odd.withColumn("fingerprint", F.lit(1)))
    by_text = {len(r[1] or ""): fp.written_out(fp.fingerprint_all([r[1] or ""])[0]) for r in odd_rows}
    rows = prints.collect()
    assert all(by_text[r.n_chars] == r.fingerprint for r in rows if r.n_chars > 20_000 or not r.n_chars)
    pairs = prints.select("fingerprint", F.lit(None).cast("string").alias("none"))
    scores = pairs.select(fp.likeness(F.col("fingerprint"), F.col("fingerprint")).alias("s"),
                          fp.likeness(F.col("fingerprint"), F.col("none")).alias("n")).collect()
    assert {(r.s, r.n) for r in scores} == {(1.0, None)}
    assert fp.fingerprints(empty).count() == 0
