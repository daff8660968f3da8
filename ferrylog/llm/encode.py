"""Exact tokenizer calls with a memory of pieces that cannot influence each other.

Corpora repeat their words, tokenizer libraries do not profit from it. Where the
vocabulary proves that no token crosses a place in the text, the parts on both
sides can be encoded apart. Both encoders cut texts at blanks that have such a
proof, ask the library for pieces they have not seen, many at a time, and
remember the answer within a bound. Everything else goes to the library as it is.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces of a generation of a worker's memory; one batch may come on top.
MEMORY_PIECES = 200_000
#: The same for pieces whose ids are remembered.
MEMORY_IDS = 100_000
#: Longer pieces are not remembered.
PIECE_CHARS = 100
#: New pieces handed to the library as one text.
GROUP = 50
#: What is known of a piece that has to go to the library each time.
ASK = False
#: White space of any of the libraries, and the word-start mark.
BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680])) + (
    "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000▁"
)

#: Latin, Greek and Cyrillic letters, the same in all versions of Unicode; signs of ASCII.
LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ʯΑ-ΡΣ-ώЀ-ҁҊ-ԧ", r"!-/:-@\[-`{-~"
#: Words whose parts get their tokens apart: letters, signs, and the same once more on a new line.
PARTS = (
    f"^(?P<stem>[{LETTERS}]+)(?P<signs>[{SIGNS}]*)"
    f"(?:\n(?P<line>[{LETTERS}]+)(?P<more>[{SIGNS}]*))?$"
)
#: All that can be found inside such words.
INSIDE = f"[{LETTERS}]*[{SIGNS}]*(\n[{LETTERS}]*[{SIGNS}]*)?"


def _blank(char: str) -> bool:
    """Space for any of the libraries; the word-start mark counts as one."""
    return char.isspace() or char == "▁" or "\x1c" <= char <= "\x1f"


def regular(piece: str) -> bool:
    """Whether the blanks around this piece are places to cut at."""
    return piece != "" and piece.strip(BLANKS) == piece


def chunks(text: str) -> list[str]:
    """Cut before every blank that has a non-space on either side.

    All chunks but the first lose the blank they begin with.
    """
    out: list[str] = []
    for k, piece in enumerate(text.split(" ")):
        cut = k and piece and not _blank(piece[0]) and out[-1] and not _blank(out[-1][-1])
        if k == 0 or cut:
            out.append(piece)
        else:
            out[-1] += " " + piece
    return out


class _Memory:
    """Answers for pieces that stand behind a cut blank, in two generations.

    When the newer one is full it becomes the older one, so what is used often stays.
    """

    def __init__(self) -> None:
        self.known: dict = {}
        self.old: dict = {}

    def look_up(self, parts: list[list[str]]) -> list[list]:
        """What is known of all pieces; new ones are learned first."""
        if len(self.known) > MEMORY_PIECES:
            self.known, self.old = {}, self.known
        get = self.known.get
        found = [list(map(get, part)) for part in parts]
        gaps = [
            (answers, [k for k, x in enumerate(answers) if x is None], part)
            for answers, part in zip(found, parts, strict=True)
            if None in answers
        ]
        self.learn({part[k] for _, at, part in gaps for k in at})
        for answers, at, part in gaps:
            for k in at:
                answers[k] = self.known[part[k]]
        return found

    def learn(self, new: set[str]) -> None:
        """Take over what the older generation knows, and ask the library for the rest."""
        back = {p: self.old[p] for p in new if p in self.old} if self.old else {}
        self.known |= back
        plain = []
        for piece in new.difference(back) if back else new:
            if len(piece) <= PIECE_CHARS and piece and piece.strip(BLANKS) == piece:
                plain.append(piece)
            else:
                self.known[piece] = ASK
        for k in range(0, len(plain), GROUP * 200):
            self.ask(plain[k : k + GROUP * 200])

    def ask(self, pieces: list[str]) -> None:
        groups = [pieces[i : i + GROUP] for i in range(0, len(pieces), GROUP)]
        for group, ids in zip(groups, self.encode_groups(groups), strict=True):
            at = np.flatnonzero(self.starts[ids])
            if len(at) == len(group) and (not len(at) or at[0] == 0):
                self.remember(group, ids, at)
            else:
                for piece in group:
                    self.remember([piece], self.encode_groups([[piece]])[0], np.zeros(1, int))


def strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def runs(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all runs, one run after the other."""
    ends = np.cumsum(sizes)
    out = np.repeat(begins - ends + sizes, sizes)
    out += np.arange(len(out))
    return out


class _Ids:
    """Ids end to end, and which of them a piece has; number 0 has none."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, "<u4")
        self.ends = np.zeros(1, np.int64)

    def add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.ends)
        self.number.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        self.ids = np.concatenate((self.ids, ids))
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of these numbers begin, and how many they are."""
        begins = self.ends[np.maximum(numbers, 1) - 1]
        return begins, np.where(numbers > 0, self.ends[numbers] - begins, 0)


class _Pieces:
    """Ids of pieces behind ``lead``, a character at which their first token begins.

    Kept in two generations as in ``_Memory``. Number 0 stands for ``ASK``.
    """

    def __init__(self, lead: str, starts: np.ndarray, library: Callable) -> None:
        self.lead, self.starts, self.library = lead, starts, library
        self.known, self.old = _Ids(), _Ids()

    def turn(self) -> None:
        self.known, self.old = _Ids(), self.known

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """Numbers of different pieces in ``known``; new ones are learned first."""
        found = np.fromiter(map(self.known.number.get, pieces, repeat(-1)), np.int64, len(pieces))
        gaps = np.flatnonzero(found < 0).tolist()
        if gaps:
            self.learn([pieces[k] for k in gaps])
            found[gaps] = [self.known.number.get(pieces[k], 0) for k in gaps]
        return found

    def learn(self, new: list[str]) -> None:
        """Take over what the older generation knows, and ask the library for the rest."""
        if self.old.number:
            before = list(map(self.old.number.get, new, repeat(0)))
            back = [p for p, n in zip(new, before, strict=True) if n]
            begins, sizes = self.old.places(np.array([n for n in before if n], np.int64))
            self.known.add(back, self.old.ids[runs(begins, sizes)], sizes)
            new = [p for p, n in zip(new, before, strict=True) if not n]
        plain = []
        for piece in new:
            if len(piece) <= PIECE_CHARS:
                if piece and piece.strip(BLANKS) == piece:
                    plain.append(piece)
                else:
                    self.known.number[piece] = 0
        for k in range(0, len(plain), GROUP * 200):
            self.ask(plain[k : k + GROUP * 200])

    def ask(self, pieces: list[str]) -> None:
        groups = [pieces[i : i + GROUP] for i in range(0, len(pieces), GROUP)]
        ids, sizes = [], []
        asked = self.library([self.lead + self.lead.join(g) for g in groups])
        for group, found in zip(groups, asked, strict=True):
            at = np.flatnonzero(self.starts[found])
            if len(at) == len(group) and at[0] == 0:
                ids.append(found)
                sizes.append(np.diff(at, append=len(found)))
            else:
                alone = self.library([self.lead + p for p in group])
                ids.extend(alone)
                sizes.append(np.array([len(x) for x in alone]))
        self.known.add(pieces, np.concatenate(ids), np.concatenate(sizes))


class ByteBpe:
    """Ids of a byte-level BPE file of the tokenizers library.

    The different words of a batch are looked at once. The split pattern ends a token between
    letters and signs and on both sides of a line feed between words, so words of that form
    are put together: signs are asked for in every batch, the other parts are remembered.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.size = self.lib.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        #: The split pattern starts a piece at a blank before a non-space, no added token lies
        #: in a word that is put together.
        self.cuts = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not spec.get("normalizer")
            and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in added)
            and not any(re.fullmatch(INSIDE, t["content"]) for t in added)
        )
        vocab = self.lib.get_vocab(with_added_tokens=False)
        starts = {c: np.zeros(self.size, bool) for c in "ĠĊ"}
        for token, k in vocab.items():
            if token[:1] in starts:
                starts[token[0]][k] = True
        self.words = _Pieces(" ", starts["Ġ"], self.library)
        self.lines = _Pieces("\n", starts["Ċ"], self.library)

    def library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.lib.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different words, each behind a blank, end to end; their sizes; what is ``ASK``."""
        if len(self.words.known.number) + len(self.lines.known.number) > MEMORY_IDS:
            self.words.turn()
            self.lines.turn()
        found = pc.extract_regex(words, PARTS)
        stem, signs, line, more = (
            pc.struct_field(found, name) for name in ("stem", "signs", "line", "more")
        )
        stems = pc.coalesce(stem, words).dictionary_encode()
        lines = pc.fill_null(line, "").dictionary_encode()
        both = pc.fill_null(pa.concat_arrays([signs, more]), "").dictionary_encode()
        first = self.words.look_up(strings(stems.dictionary))[stems.indices.to_numpy()]
        below = self.lines.look_up(strings(lines.dictionary))[lines.indices.to_numpy()]
        said = self.library(strings(both.dictionary))
        ends = np.cumsum([len(x) for x in said])
        every = np.concatenate([self.words.known.ids, self.lines.known.ids, *said])
        n_words, n_lines = len(self.words.known.ids), len(self.lines.known.ids)
        sizes = np.diff(ends, prepend=0)
        at = both.indices.to_numpy().reshape(2, -1)
        begins = (ends - sizes)[at] + n_words + n_lines
        first_at, first_n = self.words.known.places(first)
        below_at, below_n = self.lines.known.places(below)
        each = np.stack((first_n, sizes[at[0]], below_n, sizes[at[1]]), axis=1)
        where = np.stack((first_at, begins[0], below_at + n_words, begins[1]), axis=1)
        ask = (first == 0) | (below == 0) & pc.not_equal(pc.fill_null(line, ""), "").to_numpy(False)
        return every[runs(where.ravel(), each.ravel())], each.sum(axis=1), ask

    def ids(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Ids of every text, exactly as the library gives them for the whole text."""
        if not self.cuts:
            return self.library(texts if isinstance(texts, list) else texts.to_pylist())
        if len(texts) == 0:
            return []
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        cut = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(cut).to_numpy()
        heads = np.cumsum(counts, dtype=np.int64) - counts
        pieces = cut.flatten()
        coded = pieces.dictionary_encode()
        ids, sizes, ask = self.of_words(coded.dictionary)
        begun = self.library(strings(pieces.take(pa.array(heads))))
        # the first piece of a text has no blank in front and gets a number of its own
        at = coded.indices.to_numpy().astype(np.int64)
        at[heads] = len(sizes) + np.arange(len(heads))
        every = np.concatenate([ids, *begun])
        each = np.concatenate((sizes, [len(x) for x in begun]))
        ends = np.cumsum(each)
        asked = np.logical_or.reduceat(np.append(ask, np.zeros(len(heads), bool))[at], heads)
        totals = np.add.reduceat(each[at], heads)
        whole = every[runs((ends - each)[at], each[at])]
        out = np.split(whole, np.cumsum(totals)[:-1])
        if asked.any():
            places = zip(ends[: len(sizes)].tolist(), sizes.tolist(), ask.tolist(), strict=True)
            known = {
                word: ids[end - n : end]
                for word, (end, n, odd) in zip(strings(coded.dictionary), places, strict=True)
                if not odd
            }
            for k in np.flatnonzero(asked).tolist():
                out[k] = self.by_chunks(texts[k].as_py(), known)
        return out

    def by_chunks(self, text: str, known: dict[str, np.ndarray]) -> np.ndarray:
        parts = chunks(text)
        have = [None] + [known.get(p) for p in parts[1:]]
        asked = [k for k, x in enumerate(have) if x is None]
        found = self.library([(" " if k else "") + parts[k] for k in asked])
        for k, ids in zip(asked, found, strict=True):
            have[k] = ids
        return np.concatenate(have)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.ids(texts)]


class PieceBpe(_Memory):
    """Token counts of a sentencepiece BPE model."""

    def __init__(self, path: str) -> None:
        super().__init__()
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            model = spec.ModelProto.FromString(file.read())
        norm, pieces = model.normalizer_spec, [p.piece for p in model.pieces]
        #: Merges of neighbouring symbols only, on the text as it is.
        self.proves = (
            model.trainer_spec.model_type == 2
            and norm.name == "identity"
            and norm.escape_whitespaces
            and norm.add_dummy_prefix
            and not norm.remove_extra_whitespaces
            and not model.trainer_spec.treat_whitespace_as_suffix
            and not any(p.type == 4 for p in model.pieces)
        )
        #: Neighbours inside some piece; no merge joins any other two characters.
        self.inside = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.cuts = self.proves and not any(x[1] == "▁" != x[0] for x in self.inside)
        self.starts = np.array([p.startswith("▁") for p in pieces])
        #: UTF-8 bytes of text that a piece stands for.
        self.width = np.array(
            [
                1 if m.type == 6 else len(m.piece.replace("▁", " ").encode())
                for m in model.pieces
            ]
        )
        self.complete = bool(model.trainer_spec.byte_fallback)

    def library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.lib.encode(texts, num_threads=1)]

    def encode_groups(self, groups: list[list[str]]) -> list[np.ndarray]:
        return self.library([" ".join(g) for g in groups])

    def remember(self, group: list[str], ids: np.ndarray, at: np.ndarray) -> None:
        for piece, n in zip(group, np.diff(np.append(at, len(ids))).tolist(), strict=True):
            self.known[piece] = n

    def stable(self, left: str, right: str) -> bool:
        """No piece holds these neighbours, so no token crosses between them."""
        pair = (left + right).replace(" ", "▁")
        return self.proves and pair not in self.inside

    def offsets(self, text: str) -> np.ndarray | None:
        """UTF-8 offsets at which the tokens of ``text`` begin, and its end.

        The first token also stands for the blank that the model puts in front.
        None if a token's place can't be told.
        """
        if not (self.proves and self.complete):
            return None
        ends = np.cumsum(self.width[self.library([text])[0]]) - 1
        if len(ends) == 0 or ends[-1] != len(text.encode()):
            return None
        return np.concatenate(([0], ends))

    def counts(self, texts: list[str]) -> list[int]:
        if not self.cuts:
            return [len(x) for x in self.library(texts)]
        parts = [t.split(" ") for t in texts]
        return [
            self.by_chunks(text) if 0 in found else sum(found)
            for text, found in zip(texts, self.look_up(parts), strict=True)
        ]

    def by_chunks(self, text: str) -> int:
        if not text:
            return 0
        parts = chunks(text)
        have = [self.known.get(p) for p in parts]
        rest = [p for p, n in zip(parts, have, strict=True) if not n]
        return sum(n for n in have if n) + sum(len(x) for x in self.library(rest))


def block_starts(sizes: list[int]) -> list[int]:
    """Running totals with a leading zero."""
    return list(accumulate(sizes, initial=0))


def encoder(path: str) -> ByteBpe | PieceBpe:
    """The encoder for a tokenizer file, by its ending."""
    return PieceBpe(path) if path.endswith(".model") else ByteBpe(path)
