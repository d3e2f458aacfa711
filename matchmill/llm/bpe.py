"""Byte-level BPE: a backtracking encoder with exact merges in linear time, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary finds the longest token at every place of a piece. The encoder takes the longest
token that is compatible with the one before it, shorter ones next, and steps back if none is left; a place from which no
encoding goes on is never tried again. Two tokens are compatible if merging their texts by rank gives exactly these two.

Short pieces that are new to a task are merged by rank side by side in arrays, which gives the same tokens: in each round every piece merges its
pair of the lowest rank.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from itertools import accumulate

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from matchmill.llm.text import AT_TASK_END, add_columns

#: The short forms that the pattern of pieces takes as one,
#: 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
SHORT_FORMS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Pieces and pairs of tokens whose results are kept at a time.
REMEMBERED = 150_000
#: Pieces of at most so many bytes are merged side by side; texts of about so many characters are looked at for new pieces at once.
SHORT, TOGETHER = 64, 1 << 20
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: printable ones for themselves, others from 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def character_classes() -> np.ndarray:
    """The class of every code point: white space, letter, number or other."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]))
    for kind, pattern in ((SPACE, r"\s+"), (LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.finditer(pattern, every):
            out[[ord(c) for c in run.group()]] = kind
    return out


def pieces(text: str, classes: np.ndarray) -> list[str]:
    """A text cut as the pattern of pieces does, from the borders between runs of one class.

    A space (U+0020) before a run of letters, numbers or others goes with it; any other last white space before such a run stands
    alone; the white space before that, or at the end of the text, is one piece.
    """
    if not text:
        return []
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = classes[code]
    cut = np.empty(len(code) + 1, np.bool_)
    cut[0] = cut[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:-1])
    runs = np.flatnonzero(cut[:-1])
    runs = runs[(kind[runs] != SPACE) & (runs > 0)]
    after_space = runs[kind[runs - 1] == SPACE]
    cut[after_space - 1] = True
    cut[after_space[code[after_space - 1] == 32]] = False
    marks = np.flatnonzero(code == 39)
    if len(marks):
        before = np.where(marks > 0, code[marks - 1], 0)
        starts = marks[cut[marks] & (before != 32) & cut[marks + 1]]
        for at in starts.tolist():
            form = next((f for f in SHORT_FORMS if text.startswith(f, at + 1)), None)
            if form:
                cut[at + 1] = False
                cut[at + 1 + len(form)] = True
    places = np.flatnonzero(cut).tolist()
    return [text[a:b] for a, b in zip(places, places[1:], strict=False)]


class _Recent(dict):
    """Results of ``make`` for recent keys: two generations, each of at most ``REMEMBERED`` keys."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        return self.keep(key, value)

    def keep(self, key, value):
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Vocabulary:
    """What a vocabulary file says, in a form that can be sent to the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        raw = {word: bytes(letters[c] for c in word) for word in model["vocab"] if all(c in letters for c in word)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {raw[w]: i for w, i in model["vocab"].items() if w in raw and w not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = [(raw[a], raw[b]) for a, b in pairs]
        self.key = hashlib.sha256(repr((sorted(self.ids.items()), self.merges)).encode()).hexdigest()


class Codec:
    """Encoder and decoder of one vocabulary. Tokens are numbered by rank inside: the bytes, then the merges in order."""

    def __init__(self, vocabulary: Vocabulary):
        names = [bytes([b]) for b in range(256)] + [a + b for a, b in vocabulary.merges]
        rank = {name: k for k, name in enumerate(names)}
        self.size = [len(n) for n in names]
        self.left, self.right = list(range(256)), list(range(256))
        self.merged: dict[tuple[int, int], int] = {}
        for k, (a, b) in enumerate(vocabulary.merges, 256):
            self.left.append(rank[a])
            self.right.append(rank[b])
            self.merged[rank[a], rank[b]] = k
        self.shorter = [next((rank[n[:k]] for k in range(len(n) - 1, 0, -1) if n[:k] in rank), -1) for n in names]
        self.automaton = ahocorasick.Automaton()
        for name, k in rank.items():
            self.automaton.add_word(name.decode("latin-1"), k)
        self.automaton.make_automaton()
        self.id = [vocabulary.ids[n] for n in names]
        pairs = sorted((a << 32 | b, k, rank[names[k]]) for (a, b), k in self.merged.items())
        self.pair_keys, self.pair_ranks, self.pair_tokens = (np.array([p[c] for p in pairs], np.int64) for c in range(3))
        self.id_of = np.array(self.id, "<u4")
        self.special = dict(vocabulary.special)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        classes = character_classes()
        self.find = lambda part: pieces(part, classes)
        self.compatible = _Recent(self._compatible)
        self.pieces = _Recent(self._encode_piece)
        by_id = {i: n for n, i in zip(names, self.id, strict=True)} | {i: s.encode() for s, i in self.special.items()}
        self.offsets = np.array(list(accumulate((len(by_id.get(i, b"")) for i in range(max(by_id) + 1)), initial=0)), np.int64)
        self.pool = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(max(by_id) + 1)), np.uint8)

    def forget(self) -> None:
        """Drop the results kept so far."""
        for kept in (self.compatible, self.pieces):
            kept.clear()
            kept.old = {}

    def _compatible(self, pair: int) -> bool:
        """Whether merging by rank never joins anything across the border of the two tokens, given as one number.

        The tokens are taken apart from the border outwards, the later merge first: a merge over the border spoils the pair
        if it comes before the merge that covers one of its sides.
        """
        one, two = divmod(pair, 1 << 32)
        before = 1 << 60
        while True:
            across = self.merged.get((one, two))
            if across is not None and across < before:
                return False
            if one > two:
                before, one, stuck = one, self.right[one], one < 256
                if stuck:
                    before, two, stuck = two + 1, self.left[two], two < 256
            else:
                before, two, stuck = two + 1, self.left[two], two < 256
                if stuck:
                    before, one, stuck = one, self.right[one], one < 256
            if stuck:
                return True

    def _longest(self, piece: bytes) -> list[int]:
        best = [-1] * len(piece)
        size = self.size
        for end, k in self.automaton.iter(piece.decode("latin-1")):
            start = end + 1 - size[k]
            if best[start] < 0 or size[k] > size[best[start]]:
                best[start] = k
        return best

    def ranks(self, piece: bytes) -> list[int]:
        """The tokens of a piece, by rank."""
        longest, size, shorter, compatible = self._longest(piece), self.size, self.shorter, self.compatible
        alive = bytearray(b"\x01") * (len(piece) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            last = out[-1] if out else -1
            while token >= 0 and not (alive[at + size[token]] and (last < 0 or compatible[last << 32 | token])):
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                if at == len(piece):
                    return out
                token = longest[at]
            else:
                alive[at] = 0
                token = out.pop()
                at -= size[token]

    def _rank_of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The places of pairs of tokens among all pairs that merge; -1 for others."""
        key = one << 32 | two
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, at, -1)

    def merge_side_by_side(self, pieces: Sequence[bytes]) -> list[np.ndarray]:
        """The tokens of pieces of a byte or more, by rank: each round merges the first pair by rank of every piece, from the left where it repeats."""
        never = np.iinfo(np.int64).max
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(pieces)
        token = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        place, rank = np.full(len(token), -1), np.full(len(token), never)

        def look(at: np.ndarray) -> None:
            # Pairs that begin at some places; none begins at a piece's last token.
            at = at[at + 1 < len(token)]
            at = at[owner[at] == owner[at + 1]]
            place[at] = self._rank_of(token[at], token[at + 1])
            rank[at] = np.where(place[at] >= 0, self.pair_ranks[place[at]], never)

        if len(self.pair_keys):
            look(np.arange(len(token)))
        while len(token):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(starts, len(token)))
            least = np.minimum.reduceat(rank, starts)
            ended = least == never
            if ended.any():
                for start, size in zip(starts[ended].tolist(), sizes[ended].tolist(), strict=True):
                    out[owner[start]] = token[start : start + size]
                on = np.repeat(~ended, sizes)
                token, owner, place, rank = token[on], owner[on], place[on], rank[on]
                least, sizes = least[~ended], sizes[~ended]
                if not len(token):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            # In a row of places of one pair, as in a run of one byte, every second one merges.
            first = np.concatenate([[True], np.diff(hit) > 1])
            begin = np.maximum.accumulate(np.where(first, hit, 0))
            hit = hit[(hit - begin) % 2 == 0]
            token[hit] = self.pair_tokens[place[hit]]
            stay = np.ones(len(token), np.bool_)
            stay[hit + 1] = False
            now = np.cumsum(stay)[hit] - 1
            token, owner, place, rank = token[stay], owner[stay], place[stay], rank[stay]
            rank[now] = never
            look(now)
            before = now[now > 0] - 1
            before = before[owner[before] == owner[before + 1]]
            rank[before] = never
            look(before)
        return out

    def learn(self, texts: Sequence[str]) -> list[list[str]]:
        """The pieces of texts, cut; short ones that are not remembered are encoded together."""
        parts = [self.find(text) for text in texts]
        recent, old = self.pieces, self.pieces.old
        coded = {p: raw for p in set().union(*parts) if p not in recent and p not in old and len(raw := p.encode()) <= SHORT}
        for piece, tokens in zip(coded, self.merge_side_by_side(list(coded.values())), strict=True):
            self.pieces.keep(piece, self.id_of[tokens].tobytes())
        return parts

    def _encode_piece(self, piece: str) -> bytes:
        return np.array([self.id[k] for k in self.ranks(piece.encode())], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit numbers; special tokens' texts give their ids."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: Sequence[str]) -> list[bytes]:
        """``encode`` of several texts, whose new pieces are encoded together."""
        get, out, k = self.pieces.__getitem__, [], 0
        while k < len(texts):
            size, some = 0, []
            while k < len(texts) and (not some or size + len(texts[k]) <= TOGETHER):
                some.append(self.split.split(texts[k]) if self.split else [texts[k]])
                size, k = size + len(texts[k]), k + 1
            cut = iter(self.learn([part for parts in some for part in parts[::2]]))
            out += [b"".join([np.array([self.special[part]], "<u4").tobytes() if n % 2 else b"".join(map(get, next(cut))) for n, part in enumerate(parts)]) for parts in some]
        return out

    def decode(self, ids: bytes) -> bytes:
        """The text of ids in UTF-8: the ranges of all tokens are looked up and copied at once; broken sequences are replaced."""
        tokens = np.frombuffer(ids, "<u4")
        starts = self.offsets[tokens]
        sizes = self.offsets[tokens.astype(np.int64) + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)].tobytes()
        return raw.decode("utf-8", "replace").encode()


_CODECS: dict[str, Codec] = {}


def codec(vocabulary: Vocabulary) -> Codec:
    """The codec of a vocabulary, built once per process; results kept for recent pieces go once a task ends."""
    if vocabulary.key not in _CODECS:
        _CODECS[vocabulary.key] = made = Codec(vocabulary)
        AT_TASK_END.append(made.forget)
    return _CODECS[vocabulary.key]


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` of every document with ids (binary, little-endian unsigned 32-bit), n_tokens and decoded (binary, UTF-8).

    Whole texts are encoded, and decoded again from the ids. A null text is as an empty one: no ids and an empty text.
    Broken UTF-8 is replaced before encoding. Nothing is shuffled; the vocabulary, of fixed size, is sent to the tasks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        code = codec(sent.value)

        def score(texts):
            ids = code.encode_all([t.decode("utf-8", "replace") if t else "" for t in texts])
            return {"ids": ids, "n_tokens": [len(i) // 4 for i in ids], "decoded": [code.decode(i) for i in ids]}

        return score

    return add_columns(docs, make, "ids binary, n_tokens bigint, decoded binary", keep, text)
