"""Near duplicates, repeated bytes, page texts and the pipeline."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
from ferrylog.llm import html_extract as hx
from ferrylog.llm import near_dedup as nd
from ferrylog.llm import suffix_dedup as sd
from ferrylog.llm.components import components
from tests.llm.conftest import SCHEMA, sentence


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_similar():
    rng = random.Random(1)
    for t in range(400):
        signs = "abcdefgh" if t % 2 else [str(k) for k in range(60)]
        a = [rng.choice(signs) for _ in range(rng.randint(1, 40))]
        b = list(a)
        for _ in range(rng.randint(0, len(a) // 2)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [rng.choice(signs)] * rng.randrange(2)
        far = int(0.2 * max(len(a), len(b)) + 1e-9)
        d = levenshtein(a, b)
        assert nd.similar(a, b) == (bool(b) and d <= far)
        assert min(nd._banded_edits(a, b, far), far + 1) == min(d, far + 1)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    root = {}
    for a, b in edges:
        x, y = root.setdefault(a, {a}), root.setdefault(b, {b})
        if x is not y:
            x |= y
            for k in y:
                root[k] = x
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {k: min(v) for k, v in root.items() if len(v) > 1}


def family(rng):
    """Near copies of each other, exact copies, a shared passage, and others."""
    base, passage = sentence(rng, 220).split(" "), sentence(rng, 60)
    rows = []
    for k in range(40):
        words = list(base)
        for _ in range(k % 5):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        rows.append((k, " ".join(words), "en", "a", 0))
    rows += [(100 + k, passage + " " + sentence(rng, 90), "en", "a", 0) for k in range(40)]
    return rows


def test_near_classes(spark, odd_rows, empty):
    rows = [r for r in odd_rows if len(r[1] or "") < 20_000] + family(random.Random(3))[:40]
    rows += [(200 + r[0], *r[1:]) for r in family(random.Random(4))[40:]]
    docs = spark.createDataFrame(rows, SCHEMA)
    words = [nd.words(r[1] or "") for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and (words[i] == words[j] and words[i] or nd.similar(words[i], words[j])):
                group = [group[j] if g == group[i] else g for g in group]
    want = Counter()
    for g in set(group):
        members = [rows[k][0] for k in range(len(rows)) if group[k] == g]
        want[min((m for m in members if m is not None), default=None)] += len(members)
    found = nd.dedup_table(docs).collect()
    assert Counter(r.class_id for r in found) == want
    kept = nd.dedup_documents(docs.withColumnRenamed("lang", "_dk"))
    assert kept.columns == ["doc_id", "text", "_dk", "source", "n_chars"]
    assert kept.count() == len(set(group))
    assert nd.dedup_table(empty).count() == 0 and nd.dedup_documents(empty).count() == 0


def test_pairs_that_miss_the_pivots(spark, monkeypatch):
    rng = random.Random(11)
    passage = sentence(rng, 300).split(" ")
    rows = []
    for k in range(80):
        own = [f"own{rng.randrange(10**9)}" for _ in range(150)]
        near = list(own)
        for at in rng.sample(range(150), 75):
            near[at] = f"near{rng.randrange(10**9)}"
        for j, part in enumerate((own, near)):
            rows.append((2 * k + j, " ".join(passage + part), "en", "a", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    for part, at_once in ((nd.PART, nd.AT_ONCE), (32, 10)):
        monkeypatch.setattr(nd, "PART", part)
        monkeypatch.setattr(nd, "AT_ONCE", at_once)
        found = {r.doc_id: r.class_id for r in nd.dedup_table(docs).collect()}
        assert found == {k: k - k % 2 for k in range(160)}


def test_counts_bound_edits():
    rng, hashes = random.Random(12), nd.WordHashes()
    for signs, most in ((3, 600), (400, 60)):
        texts = [[str(rng.randrange(signs)) for _ in range(rng.randint(1, most))] for _ in range(30)]
        for t in list(texts):
            near = list(t)
            for _ in range(rng.randint(0, len(t) // 4)):
                at = rng.randrange(len(near) + 1)
                near[at : at + rng.randrange(2)] = [str(rng.randrange(signs))] * rng.randrange(2)
            texts.append(near)
        raw = [nd.bag(nd.hashed(t, hashes)) for t in texts]
        bags = nd.np.frombuffer(b"".join(raw), nd.np.uint8).reshape(-1, nd.BINS)
        one, every = nd.np.zeros(len(texts), int), nd.np.arange(len(texts))
        n = nd.np.array([max(len(t) - nd.SHINGLE + 1, 1) for t in texts])
        found = {(i, j) for a, b in nd.open_pairs(one, one > 0, one, every, n, bags) for i, j in zip(a, b, strict=True)}
        links = {(i, j) for j in range(len(texts)) for i in range(j) if nd.similar(texts[i], texts[j])}
        assert links <= found and len(links) >= 10


def plain_removal(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[k : k + 200] for r in raws for k in range(len(r) - 199))
    out = []
    for raw in raws:
        gone = [False] * len(raw)
        for k in range(len(raw) - 199):
            if seen[raw[k : k + 200]] > 1:
                gone[k : k + 200] = [True] * 200
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_removal(spark, monkeypatch, empty):
    rng = random.Random(7)
    base = sentence(rng, 400)
    texts = [base, base, None, "", "short", "é" * 300, "ab" * 400]
    for k in range(60):
        a = rng.randrange(len(base) - 300)
        texts.append(sentence(rng, 20) + base[a : a + rng.choice((150, 199, 200, 230, 500))] + sentence(rng, 20))
    passage = base[500:740]
    texts += [f"{k} {passage[: 200 + k % 41]} {k}" for k in range(80)]
    docs = spark.createDataFrame([(k, t, "", "", 0) for k, t in enumerate(texts)], SCHEMA)
    want = plain_removal(texts)
    for small, batches in ((64, sd.BATCHES), (64, 2), (2, 1), (4, 5)):
        monkeypatch.setattr(sd, "SMALL", small)
        found = sd.removal_table(docs, batches).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in found] == want
    assert sd.removal_table(empty).count() == 0


def test_blocks_of_a_large_group_stay_in_memory(spark, monkeypatch):
    rng, texts = random.Random(13), []
    passage = sentence(rng, 80)
    for k in range(60):
        near = list(passage[:320])
        near[rng.randrange(320)] = "#"
        texts.append(f"{k} {''.join(near)} {k}")
    docs = spark.createDataFrame([(k, t, "", "", 0) for k, t in enumerate(texts)], SCHEMA)
    want, counted, rows = plain_removal(texts), sd._counted_strings, []
    monkeypatch.setattr(sd, "_counted_strings", lambda x: rows.append(x.count()) or counted(x))
    monkeypatch.setattr(sd, "SMALL", 4)
    for limit in (getattr(sd, "SMALL_BLOCKS", 4), 2):
        monkeypatch.setattr(sd, "SMALL_BLOCKS", limit, raising=False)
        found = sd.removal_table(docs).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in found] == want
    assert rows[0] == 0 < rows[1]


def test_levels_merge_geometrically(spark):
    index = sd.SuffixIndex()
    for k in range(6):
        rows = [(h, h * 7, bytes([k] * 16), h) for h in range(k * 3, k * 3 + 5)]
        hits = index.add(spark.createDataFrame(rows, sd.ANCHORS))
        assert {r.h for r in hits.collect()} == ({k * 3, k * 3 + 1} if k else set())
        assert sum(n for n, _ in index.levels) == k + 1
    assert [n for n, _ in index.levels] == [4, 1, 1]


PAGE = """<!doctype html><html><head><title>T</title></head><body><header>Site</header>
<nav><a href=1>Home</a></nav>{body}<aside>side</aside><section id="comments"><p>Great</p></section>
<form>f<input></form><script>if(a<b){{"</p>"}}</script><footer>foot</footer>"""


def test_content():
    body = '<article><h1>T&amp;itle</h1><p>One <b>two<br>three<p>Four &lt;x&gt;<div class="share-bar">Share</div></article>'
    assert hx.content(PAGE.format(body=body), None, set()) == "T&itle\n\nOne two three\n\nFour <x>"
    for html in ("", "<", "<p", "<p class='x", "<script>var a", "<!-- x"):
        assert hx.content(html, None, set()) in ("", "<")
    assert hx.content("plain &amp text", None, set()) == "plain & text"


def test_template(spark):
    """Without an article the slot is where the text changes; repeated blocks go."""
    rng = random.Random(8)
    rows, want = [], {}
    for k in range(12):
        text = sentence(rng, 40)
        body = f"<div><div>All rights and all wrongs of this site</div><div><div><p>{text}</p><p>Read on every page</p></div></div></div>"
        rows.append((k, "http://Host.example/a", PAGE.format(body=body)))
        want[k] = text
    rows += [(20, None, None), (21, "http://host.example/b", ""), (22, "x", "<p>alone</p>"), (0, *rows[0][1:])]
    want |= {20: "", 21: "", 22: "alone"}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = hx.page_texts(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)
    assert hx.page_texts(pages.limit(0)).count() == 0


def template_pages(rng):
    """Two hosts: notices in articles, equal rows, shuffled passages, a part with its own template."""
    rows = []
    for k in range(16):
        parts = [f"<h1>{sentence(rng, 3)}</h1>", f"<p>{sentence(rng, 20)}</p>"]
        if k % 4:
            parts.insert(1, "<div><p>Prices may change at any time</p></div>")
        mixed = ["<p>first shared</p>", "<p>second shared</p>"]
        parts += mixed[:: rng.choice((1, -1))] if k > 1 else [mixed[0], mixed[1]] if k else mixed[::-1]
        if k < 5:
            parts.append("<section><p>Only in the series</p></section>")
        if k == 7:
            parts.append("<p>Prices may change at any time</p>")
        rows.append((k, "http://a.example/x", "<body><article>" + "".join(parts) + "</article>"))
    rows += [(20 + k, f"http://b.example/{k}", "<article><p>one text</p></article>") for k in range(6)]
    return rows + rows[:5]


def test_classes_against_plain(spark):
    rng = random.Random(21)
    rows = template_pages(rng)
    pages = spark.createDataFrame([(u[7:16], hash((u, h)), h) for _, u, h in rows], "host string, page long, html string")
    found = {(r.host, r.token): r for r in hx.classes(pages).collect()}
    seen, order = {}, {}
    for host, page, html in {tuple(r) for r in pages.collect()}:
        for token, _, _, depth, n, first, _ in hx._page_tokens(html):
            seen.setdefault((host, token), {})[page] = n
            order[host, token, page] = (first, depth, token)
    size = {h: len({p for (g, _), v in seen.items() if g == h for p in v}) for h in ("a.example", "b.example")}
    common = {k: v for k, v in seen.items() if 8 * len(v) >= size[k[0]]}
    assert set(found) == set(common) and all(found[k].support == len(v) for k, v in common.items())
    groups = {}
    for key, vector in common.items():
        groups.setdefault((key[0], frozenset(vector.items())), []).append(key)
    assert len({(r.host, r.vector) for r in found.values()}) == len(groups)
    for (host, vector), keys in groups.items():
        orders = {tuple(sorted((t for _, t in keys), key=lambda t: order[host, t, p])) for p, _ in vector}
        assert {found[k].valid for k in keys} == {len(orders) == 1}
        assert len({found[k].vector for k in keys}) == 1


def test_template_inside_articles(spark):
    rows = template_pages(random.Random(21))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = hx.page_texts(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.page_id < 20:
            # the same words in another element are content, and so is what comes in no fixed order
            assert ("Prices may change" in r.text) == (r.page_id == 7)
            assert "Only in the series" not in r.text
            assert "first shared" in r.text and "second shared" in r.text
        else:
            assert r.text == "one text"


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "<p>deep</p>"
    assert hx.content(deep, None, set()) == "deep" and len(hx._page_tokens(deep)) == 20_003
    text = "word " * 400_000
    assert hx.content(f"<article><p>{text}</p></article>", None, set()) == text.strip()


def test_pipeline(spark, odd, odd_rows, empty):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "decontamination", "source_mix", "token_ids",
    ]
    docs, sf = odd, "/root/testdata/sf0.001"
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = {str(r.doc_id): r.text for r in docs.collect()}
        docs = stage(spark, docs, sf)
        assert docs.columns == odd.columns
        assert all(before[str(r.doc_id)] == r.text for r in docs.collect())
    n = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == n > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_sketch_collisions_follow_similarity():
    rng = random.Random(9)
    hashes = nd.WordHashes()
    a = sentence(rng, 300).split(" ")
    b = list(a)
    for k in range(0, 300, 50):
        b[k] = "other"
    x, y = (nd.sketches(nd.labelled(w, hashes), nd._SEEDS, 3) for w in (a, b))
    assert (x == y).mean() > 0.3
    assert (x == nd.sketches(nd.labelled(sentence(rng, 300).split(" "), hashes), nd._SEEDS, 3)).sum() == 0
    moved = nd.sketches(nd.labelled(a[150:] + a[:150], hashes), nd._SEEDS, 3)
    assert 0 < (x == moved).mean() < 0.6


def edited_words(rng, found, share):
    out = list(found)
    for k in rng.sample(range(len(out)), int(share * len(out))):
        out[k] = f"e{rng.randrange(10**9)}"
    return out


def test_recall_of_near_duplicates(spark):
    """Against all planted pairs, which are links by construction, up to the threshold."""
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(4000)]
    rows, pairs, chains = [], {}, []

    def add(found):
        rows.append((len(rows), " ".join(found)))
        return len(rows) - 1

    hot = [rng.choice(vocabulary) for _ in range(60)]
    for share, ahead in ((0.1, []), (0.15, []), (0.195, []), ("hot", hot)):
        for _ in range(100):
            text = [rng.choice(vocabulary) for _ in range(200)]
            other = edited_words(rng, text, 0.1 if share == "hot" else share)
            pairs.setdefault(share, []).append((add(ahead + text), add(ahead + other)))
    for _ in range(10):
        versions = [[rng.choice(vocabulary) for _ in range(200)]]
        for _ in range(9):
            versions.append(edited_words(rng, versions[-1], 0.08))
        chains.append([add(v) for v in versions])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = {r.doc_id: r.class_id for r in nd.dedup_table(docs).collect()}
    recall = {k: sum(found[a] == found[b] for a, b in v) / len(v) for k, v in pairs.items()}
    assert recall[0.1] >= 0.98 and recall[0.15] >= 0.95 and recall[0.195] >= 0.85 and recall["hot"] >= 0.98
    assert [len({found[k] for k in c}) for c in chains] == [1] * 10
    # nothing else is joined: classes are the planted ones
    assert len(set(found.values())) >= 400 + 10
