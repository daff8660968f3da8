"""Token shards and token counts against the libraries."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ferrylog.llm import token_binary as tb
from ferrylog.llm import token_count as tc
from ferrylog.llm.encode import ByteBpe, PieceBpe
from ferrylog.llm.queries import BYTE_BPE, PIECE_BPE

PIECES = PieceBpe(PIECE_BPE)
BYTES = ByteBpe(BYTE_BPE)
SIGNS = "ab ▁ \n\té漢😀<s>|endoftext<|endoftext|> .,'ll\x00"


@given(st.lists(st.integers(0, 2**20), max_size=300), st.integers(0, 12))
@settings(max_examples=60, deadline=None)
def test_pack_round_trip(ids, more):
    bits = max([1, *(x.bit_length() for x in ids)]) + more
    raw = tb.pack(np.array(ids, "<u4"), bits)
    assert len(raw) == -(-len(ids) * bits // 8)
    assert tb.unpack(raw, len(ids), bits).tolist() == ids


@pytest.mark.parametrize("bits", [16, 17])
def test_shard_random_access(bits, monkeypatch):
    monkeypatch.setattr(tb, "BLOCK_IDS", 50)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 2**16, n).astype("<u4") for n in (1, 0, 49, 50, 51, 400)]
    shard = tb.Shard(tb.build_shard([3, None, 5, 5, 6, 7], docs, bits))
    assert shard.doc_ids == [3, None, 5, 5, 6, 7]
    for k, ids in enumerate(docs):
        assert shard.document(k).tolist() == ids.tolist()
    every = np.concatenate(docs)
    for a, b in ((0, 1), (49, 51), (100, 551), (550, 551), (7, 7)):
        assert shard.read(a, b).tolist() == every[a:b].tolist()


def test_encoders_equal_the_libraries():
    rng = random.Random(2)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    lib = Tokenizer.from_file(BYTE_BPE)
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in BYTES.ids(texts)] == want
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    counts = [len(x) for x in pieces.encode(texts)]
    assert PIECES.counts(texts) == counts
    for chunk, overlap in ((32, 4), (200, 16)):
        assert [tc.count_chunked(PIECES, t, chunk, overlap) for t in texts[:400]] == counts[:400]


def test_parts_of_words_are_asked_for_once(monkeypatch):
    enc, asked = ByteBpe(BYTE_BPE), []

    def library(texts, ask=enc.library):
        asked.extend(texts)
        return ask(texts)

    for owner in [enc, *vars(enc).values()]:
        if hasattr(owner, "library"):
            monkeypatch.setattr(owner, "library", library)
    lib = Tokenizer.from_file(BYTE_BPE)
    for text in ("a zorbleth mirn", "a zorbleth, mirn### mirn.\nzorbleth zorbleth?!\nMirn; mirn)"):
        assert enc.ids([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids
    assert sum(x.count(" zorbleth") for x in asked) == 1
    assert sum(x.count(" mirn") for x in asked) == 1


@pytest.mark.parametrize("memory", [3, 1000])
def test_words_from_parts_equal_the_library(memory, monkeypatch):
    monkeypatch.setattr("ferrylog.llm.encode.MEMORY_IDS", memory)
    enc, lib, rng = ByteBpe(BYTE_BPE), Tokenizer.from_file(BYTE_BPE), random.Random(6)
    parts = ["It", "'s", "'", "don't", "été", "Ж", "Ω", "漢", "ª", "²", "\u02bc", "***", ".", "_", "7"]
    parts += [" "] * 12 + ["\n"] * 3 + ["\n\n", " \n", "\t", "\xa0", "\x1c", "\u2003", "▁", "x" * 120]
    parts += ["<|endoftext|>", "<|", "|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    found = [x.tolist() for k in range(0, 3000, 100) for x in enc.ids(texts[k : k + 100])]
    assert found == want
    assert enc.ids([]) == []


def test_batches_are_joined_up_to_a_limit():
    batches = [pa.RecordBatch.from_pydict({"t": ["x" * n]}) for n in (10, 10, 500, 10, 10, 10)]
    found = [b.column(0).to_pylist() for b in tb.joined(iter(batches), 2 * batches[0].nbytes)]
    assert [[len(t) for t in b] for b in found] == [[10, 10], [500], [10, 10], [10]]
    assert list(tb.joined(iter([]), 9)) == []


def expected(rows):
    lib = Tokenizer.from_file(BYTE_BPE)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for key, text, *_ in order:
        ids = lib.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_table(odd, odd_rows):
    found = [tuple(r) for r in tb.token_table(odd, BYTE_BPE, shard_ids=2_000).collect()]
    want = expected(odd_rows)
    assert sorted(r[2:] for r in found) == sorted(r[2:] for r in want)
    assert sorted((str(r[0]), r[2], r[3]) for r in found) == sorted((str(r[0]), r[2], r[3]) for r in want)
    ends = sorted((r[1], r[1] + r[2]) for r in found)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    ids = [r[0] for r in sorted(found, key=lambda r: r[1])]
    assert ids == [r[0] for r in want]


def test_token_table_empty(empty):
    assert tb.token_table(empty, BYTE_BPE).count() == 0


def test_counts(odd, odd_rows, empty):
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    want = sorted((len((r[1] or "").encode()), len(pieces.encode(r[1] or ""))) for r in odd_rows)
    found = tc.counted(odd.withColumnRenamed("lang", "n_tokens"), PIECE_BPE).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in found) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in found)
    assert tc.counted(empty, PIECE_BPE).count() == 0
