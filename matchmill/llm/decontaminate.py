"""Benchmark decontamination: a Wu-Manber search for windows of benchmark words in whole texts.

Texts are brought to words with one space around each, so that a window of words is a byte string. For patterns of a
class of lengths, a table holds for every block of bytes how far the search may move on; where it may not move, the
block selects the bucket of patterns that end their common prefix with it, and these are compared directly. The search
runs over many stretches of text side by side in numpy, each with its own place and its own jumps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmill.llm.text import ALNUM, add_columns, as_bytes, mix, words

WINDOW = 10
SPAN = "struct<first:int,past:int>"
#: Bytes of benchmark text whose patterns one pass holds; a larger benchmark takes several passes over the texts.
PASS_BYTES = 16_000_000
#: Patterns are searched in classes by length, as the shortest of a class bounds its jumps.
CLASSES = (8, 24)
BLOCK, BITS, STRETCH, CHUNK = 8, 18, 512, 2_000_000


def item_windows(text: bytes | None, size: int = WINDOW) -> list[bytes]:
    """All runs of ``size`` words of an item, each with spaces around its words; of a shorter item, all its words."""
    found = words(text, ALNUM)
    return [b" " + b" ".join(found[k : k + size]) + b" " for k in range(max(1, len(found) - size + 1))] if found else []


class _Class:
    """Shift table and buckets of the patterns of one class of lengths."""

    def __init__(self, patterns: Sequence[tuple[int, bytes]]):
        self.m = min(len(p) for _, p in patterns)
        self.b = min(BLOCK, self.m)
        self.shift = np.full(1 << BITS, self.m - self.b + 1, np.int32)
        heads = np.array([np.frombuffer(p[: self.m], np.uint8) for _, p in patterns])
        for j in range(self.m - self.b + 1):
            keys = self.slots(self.blocks(heads, np.full(len(heads), j)))
            np.minimum.at(self.shift, keys, self.m - self.b - j)
        self.buckets: dict[int, list[tuple[int, bytes]]] = {}
        ends = self.blocks(heads, np.full(len(heads), self.m - self.b)) ^ mix(self.blocks(heads, np.zeros(len(heads), np.int64)))
        for key, pattern in zip(ends.tolist(), patterns, strict=True):
            self.buckets.setdefault(key, []).append(pattern)
        self.keys = np.array(sorted(self.buckets), np.uint64)

    def blocks(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The block of each row (or of one long text) that starts at ``at``, as a number."""
        place = at[:, None] + np.arange(self.b)
        raw = rows[place] if rows.ndim == 1 else np.take_along_axis(rows, place, 1)
        wide = np.zeros((len(at), 8), np.uint8)
        wide[:, : self.b] = raw
        return wide.view(np.uint64)[:, 0]

    @staticmethod
    def slots(blocks: np.ndarray) -> np.ndarray:
        return (mix(blocks) >> np.uint64(64 - BITS)).astype(np.int64)

    def places(self, text: np.ndarray) -> np.ndarray:
        """Where a pattern's prefix may start: no shift there, and first and last block belong to one bucket."""
        last = len(text) - self.m
        if last < 0:
            return np.empty(0, np.int64)
        at = np.arange(0, last + 1, STRETCH)
        end = np.minimum(at + STRETCH, last + 1)
        found = []
        while len(at):
            tail = self.blocks(text, at + (self.m - self.b))
            jump = self.shift[self.slots(tail)]
            stop = np.flatnonzero(jump == 0)
            if len(stop):
                key = tail[stop] ^ mix(self.blocks(text, at[stop]))
                near = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                stop = stop[self.keys[near] == key]
                found.append(at[stop])
            at = at + np.maximum(jump, 1)
            live = at < end
            at, end = at[live], end[live]
        return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)

    def matches(self, text: np.ndarray, raw: bytes) -> Iterator[tuple[int, int]]:
        """(place, pattern number) of every occurrence."""
        at = self.places(text)
        if not len(at):
            return
        keys = self.blocks(text, at + (self.m - self.b)) ^ mix(self.blocks(text, at))
        for place, key in zip(at.tolist(), keys.tolist(), strict=True):
            for number, pattern in self.buckets[key]:
                if raw.startswith(pattern, place):
                    yield place, number


class WindowSearch:
    """All windows of some benchmark items, ready to be found."""

    def __init__(self, items: Sequence[tuple[str | None, bytes | None]], size: int = WINDOW):
        numbers: dict[bytes, int] = {}
        self.items: list[set[str]] = []
        self.length: list[int] = []
        for item, text in items:
            for pattern in item_windows(text, size):
                number = numbers.setdefault(pattern, len(numbers))
                if number == len(self.items):
                    self.items.append(set())
                    self.length.append(pattern.count(b" ") - 1)
                self.items[number] |= {item} - {None}
        bounds = [0, *CLASSES, 1 << 62]
        groups = [[(n, p) for p, n in numbers.items() if low <= len(p) < high] for low, high in zip(bounds, bounds[1:], strict=False)]
        self.classes = [_Class(g) for g in groups if g]

    def search(self, texts: list[bytes | None]) -> tuple[list[int], list[list[tuple[int, int]]], list[set[str]]]:
        """Per text: number of words, hit spans (first word, word after the last; merged), items with an occurring window."""
        counts, spans, items = [], [], []
        for first, last in _chunks(texts):
            found = [words(t, ALNUM) for t in texts[first:last]]
            # A line feed starts every text, so that no pattern reaches over two.
            raw = b"".join(b"\n " + b" ".join(w) + b" " for w in found)
            starts = np.cumsum([0] + [max(1, len(w)) + 1 for w in found])  # the first space of each text, among all spaces
            text = np.frombuffer(raw, np.uint8)
            spaces = np.flatnonzero(text == 32)
            hits: list[list[tuple[int, int]]] = [[] for _ in found]
            seen: list[set[str]] = [set() for _ in found]
            for kind in self.classes:
                matches = list(kind.matches(text, raw))
                ranks = np.searchsorted(spaces, [p for p, _ in matches])
                owners = np.searchsorted(starts, ranks, side="right") - 1
                for rank, owner, (_, number) in zip(ranks.tolist(), owners.tolist(), matches, strict=True):
                    word = rank - int(starts[owner])
                    hits[owner].append((word, word + self.length[number]))
                    seen[owner] |= self.items[number]
            counts += [len(w) for w in found]
            spans += [merged(h) for h in hits]
            items += seen
        return counts, spans, items


def _chunks(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with some two million bytes each; a longer text makes a range of its own."""
    first = size = 0
    for k, text in enumerate(texts):
        size += len(text or b"")
        if size >= CHUNK:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, overlapping and touching ones made one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _passes(benchmark: DataFrame, item: str, text: str) -> Iterator[tuple[list[tuple[str | None, bytes | None]], bool]]:
    """The items in parts of bounded size, each with whether it is the last; at least one part, though it may be empty."""
    part, size = [], 0
    for row in benchmark.select(F.col(f"`{item}`").cast("string").alias("i"), as_bytes(text).alias("t")).toLocalIterator():
        if size >= PASS_BYTES:
            yield part, False
            part, size = [], 0
        part.append((row["i"], bytes(row["t"]) if row["t"] is not None else None))
        size += len(row["t"] or b"")
    yield part, True


def find_windows(
    docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", item: str = "item_id",
    item_text: str = "text", size: int = WINDOW,
) -> DataFrame:
    """``keep`` of every document with n_words, n_hit, spans (word ranges of hits) and items (sorted ids, as strings).

    A word is hit if it lies inside an occurrence of a window of ``size`` words of any item; an item with fewer words, but not
    none, is one window. Nulls and texts without words have no words, windows or hits; an item without an id still hits
    but is not listed, and repeated items count once. Empty tables give an empty result or one without hits. Nothing is
    shuffled: each pass sends the patterns of at most ``PASS_BYTES`` of benchmark text to the tasks and reads whole texts.
    """
    keep, made = list(keep), f"n_words bigint, n_hit bigint, spans array<{SPAN}>, items array<string>"
    found = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_body"),
        F.lit(None).cast(f"array<{SPAN}>").alias("spans"), F.lit(None).cast("array<string>").alias("items"),
    )
    for part, last in _passes(benchmark, item, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(part)
        found = add_columns(found, _scorer(sent, size), made, keep if last else [*keep, "_body"], "_body", ["spans", "items"])
    return found


def _scorer(sent, size: int):
    def make():
        search = WindowSearch(sent.value, size)

        def score(texts, old_spans, old_items):
            counts, spans, items = search.search(texts)
            spans = [merged(new + [(x["first"], x["past"]) for x in old]) if old else new for new, old in zip(spans, old_spans, strict=True)]
            return {
                "n_words": counts, "n_hit": [sum(past - first for first, past in each) for each in spans],
                "spans": [[{"first": first, "past": past} for first, past in each] for each in spans],
                "items": [sorted(new | set(old or ())) for new, old in zip(items, old_items, strict=True)],
            }

        return score

    return make
