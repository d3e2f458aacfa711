"""License scan: Aho-Corasick finds identifier tags and notice phrases, a shunting-yard parser evaluates tagged expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from matchmill.llm.text import ALNUM, add_columns, joined

#: Base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Further notice phrases and their labels, in the words of the lower-cased text.
NOTICE_PHRASES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "isc license": "isc",
    "cc by 4 0": "cc-by",
    "cc by sa 4 0": "cc-by-sa",
    "cc by nc 4 0": "cc-by-nc",
    "cc by nd 4 0": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "all rights reserved": "proprietary",
}

TAG = "spdx-license-identifier:"

#: How free the use of a text under a license is, 0 to 1, by the start of its identifier; the longest start that fits holds.
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "0bsd": 1.0, "cc0": 1.0, "unlicense": 1.0, "cc-by": 0.9, "mpl": 0.7,
    "lgpl": 0.6, "cc-by-sa": 0.6, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "proprietary": 0.0,
}
UNKNOWN = 0.5

_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
_SKIP = re.compile(r"[ \t]+")
_BINDS = {"or": 1, "and": 2, "with": 3}


def freedom(identifier: str) -> float:
    """The freedom of one license; 0.5 if it is not known."""
    fits = [k for k in FREEDOM if identifier.startswith(k)]
    return FREEDOM[max(fits, key=len)] if fits else UNKNOWN


def tokens_after(text: str, at: int) -> list[str]:
    """The tokens of the expression that starts at ``at``; it ends with the line or at what can't belong to one."""
    found: list[str] = []
    depth, operand = 0, True
    while True:
        if space := _SKIP.match(text, at):
            at = space.end()
        token = _TOKEN.match(text, at)
        if not token:
            return found
        word = token.group()
        if operand:
            if word in _BINDS or word == ")":
                return found
            depth += word == "("
            operand = word == "("
        elif word == ")" and depth:
            depth -= 1
        elif word in _BINDS:
            operand = True
        else:
            return found
        found.append(word)
        at = token.end()


def evaluate(tokens: Sequence[str]) -> tuple[set[str], float] | None:
    """Licenses and freedom of an expression: or takes the freer side, and the stricter, with keeps its left side's value.

    Operators are brought into postfix order on a stack: with binds tighter than and, and than or; equal ones from the left.
    None if the tokens are no whole expression.
    """
    values: list[tuple[set[str], float]] = []
    stack: list[str] = []

    def apply(op: str) -> bool:
        if len(values) < 2:
            return False
        right, left = values.pop(), values.pop()
        if op == "with":
            values.append(left)
        else:
            pick = max if op == "or" else min
            values.append((left[0] | right[0], pick(left[1], right[1])))
        return True

    for token in tokens:
        if token == "(":
            stack.append(token)
        elif token == ")":
            while stack and stack[-1] != "(":
                if not apply(stack.pop()):
                    return None
            if not stack:
                return None
            stack.pop()
        elif token in _BINDS:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[token]:
                if not apply(stack.pop()):
                    return None
            stack.append(token)
        else:
            name = token.rstrip(".,:;-")
            values.append(({name}, freedom(name)))
    while stack:
        if not apply(stack.pop()):
            return None
    return values[0] if len(values) == 1 else None


class LicenseScan:
    """Automata over notice phrases (in words) and over tags (in the text)."""

    def __init__(self, base: Mapping[str, str] = BASE_PHRASES, notices: Mapping[str, str] = NOTICE_PHRASES, tag: str = TAG):
        self.words = ahocorasick.Automaton()
        for phrase, label in {**notices, **base}.items():
            raw = joined(phrase.encode(), ALNUM).decode("latin-1")
            self.words.add_word(raw, (len(raw), label, phrase in base))
        self.words.make_automaton()
        self.tags = ahocorasick.Automaton()
        self.tags.add_word(tag, len(tag))
        self.tags.make_automaton()

    def scan(self, text: bytes | None) -> dict:
        """What one text shows. A null text is as an empty one."""
        flat = joined(text, ALNUM)
        out = {"n_words": max(0, flat.count(b" ") - 1), "n_base": 0, "first_word": None, "last_word": None, "expressions": []}
        starts, base, labels, values = [], set(), set(), []
        if flat:
            for end, (size, label, is_base) in self.words.iter(flat.decode("latin-1")):
                labels.add(label)
                values.append(freedom(label))
                if is_base:
                    base.add(label)
                    starts.append(end - size + 1)
        if starts:
            spaces = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
            ranks = np.searchsorted(spaces, [min(starts), max(starts)])
            out |= {"n_base": len(starts), "first_word": int(ranks[0]), "last_word": int(ranks[1])}
        if text and b":" in text:
            plain = text.lower()  # of bytes: A-Z only
            if b"spdx" in plain:
                plain = plain.decode("latin-1")
                for end, _ in self.tags.iter(plain):
                    tokens = tokens_after(plain, end + 1)
                    if tokens and (found := evaluate(tokens)):
                        labels |= found[0]
                        values.append(found[1])
                        out["expressions"].append(" ".join(tokens))
        out |= {"base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": min(values) if values else UNKNOWN}
        return out


FIELDS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "expressions array<string>"
)


def scan_licenses(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", base: Mapping[str, str] = BASE_PHRASES,
    notices: Mapping[str, str] = NOTICE_PHRASES,
) -> DataFrame:
    """``keep`` of every document with the columns ``FIELDS``; whole texts are read and nothing is shuffled.

    n_words: words of the text; n_base: places where a base phrase's words stand one after the other; first_word and
    last_word: the smallest and largest word such a place starts at, from 0, null without one; base_labels and labels:
    distinct labels, sorted, comma-joined, those of tagged expressions among the latter; score: the freedom of the strictest
    finding, 0.5 without one; expressions: tagged expressions as read. Null and empty texts have no words and findings.
    A broken expression is passed over. Repeated rows are scanned alike.
    """

    def make():
        scan = LicenseScan(base, notices)

        def score(texts):
            found = [scan.scan(t) for t in texts]
            return {k: [f[k] for f in found] for k in found[0]} if found else {n: [] for n in (
                "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions")}

        return score

    return add_columns(docs, make, FIELDS, keep, text)
