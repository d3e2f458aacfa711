"""How filters of a corpus interact: what each removes in every order, and its Shapley share.

1. Every document gets a mask of the filters that it fails, and masks are counted per part of the corpus.
2. Coalitions: for each of the 2^n sets of filters, how many documents it removes together. One row per part and coalition.
3. What a filter removes at a step is the difference of two coalitions. Its Shapley value is the solution of the weighted least squares
   problem over all coalitions whose values add up to what all filters remove, solved in rationals and hence exact.

Only masks and copies are shuffled: a digest, an id and a mask per document, and counts that are combined before they move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmill.llm.text import SPACED, add_columns, flat_map, pieces
from matchmill.session import stage

#: Filters of texts in the order of the bits of a mask; the last one looks at the whole table.
TEXT_FILTERS = ("A", "B", "C", "D")
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
MARKS = b"#$%&*|"

_SPACES = bytes(32 if b in b" \t\n\x0b\x0c\r" else b for b in range(256))
_CAPITALS = bytes(range(65, 91))
_INNER = bytes(range(0x80, 0xC0))


def text_mask(text: bytes | None) -> int:
    """The filters that a text fails, as bits: few words, few distinct words (percent), many capitals (percent of code points), marks.

    Very long texts are read in pieces: memory follows the piece and the distinct words. A null text is as an empty one.
    """
    words, distinct, capitals, points, marked = 0, set(), 0, 0, False
    for piece in pieces(text, SPACED):
        found = [w for w in piece.translate(_SPACES).split(b" ") if w]
        words += len(found)
        distinct.update(found)
        capitals += len(piece) - len(piece.translate(None, _CAPITALS))
        points += len(piece.translate(None, _INNER))
        marked = marked or len(piece.translate(None, MARKS)) < len(piece)
    fails = (
        words < LEAST_WORDS, 100 * len(distinct) < LEAST_DISTINCT * words, 100 * capitals > MOST_CAPITALS * points, marked,
    )
    return sum(1 << k for k, failed in enumerate(fails) if failed)


def _describe():
    def describe(texts):
        return {"mask": [text_mask(t) for t in texts], "digest": [hashlib.sha256(t or b"").digest() for t in texts]}

    return describe


def failed_filters(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, mask) of every document: bits 0 to 3 as ``text_mask``, bit 4 if a smaller doc_id has the identical text.

    A null text is as an empty one, also in comparison with others; a null part is the empty string. Rows with a null id are never
    copies, nor are rows that repeat the smallest id of a text.
    """
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{text}`").alias("text"))
    seen = stage(add_columns(plain, _describe, "mask int, digest binary", ["doc_id", "part"]), "filters")
    # A third of all rows may share a text: the copies are counted before they move, and written, so that Spark can split such a key.
    first = seen.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    first = stage(first.select("digest", "first"), "copies")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * (1 << len(TEXT_FILTERS))
    return seen.join(first, "digest", "left").select("doc_id", "part", (F.col("mask") + copy).alias("mask"))


def solve(rows: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The solutions of a regular system for several right sides (a row of ``right`` per equation), by elimination in rationals."""
    n = len(rows)
    work = [[*map(Fraction, a), *map(Fraction, b)] for a, b in zip(rows, right, strict=True)]
    for k in range(n):
        pivot = next(i for i in range(k, n) if work[i][k])
        work[k], work[pivot] = work[pivot], work[k]
        work[k] = [v / work[k][k] for v in work[k]]
        for i in range(n):
            if i != k and work[i][k]:
                work[i] = [v - work[i][k] * w for v, w in zip(work[i], work[k], strict=True)]
    return [row[n:] for row in work]


def shapley_values(values: Sequence[Sequence[int]], n: int) -> list[list[Fraction]]:
    """Shapley values of several games of ``n`` players, each given by its value for every coalition (a set of bits) in order.

    Minimises the sum over coalitions of weight * (value - sum of the members' shares)^2, where the shares of all players add up to
    the value of all. The weight of a coalition of s players is (n - 1) / (C(n, s) * s * (n - s)); the multiplier of the
    constraint is the last unknown of the normal equations.
    """
    full = (1 << n) - 1
    if n == 1:
        return [[Fraction(v[full] - v[0])] for v in values]
    inner = range(1, full)
    weight = {s: Fraction(n - 1, comb(n, s.bit_count()) * s.bit_count() * (n - s.bit_count())) for s in inner}
    normal = [[sum(weight[s] for s in inner if s >> i & 1 and s >> j & 1) for j in range(n)] + [Fraction(1)] for i in range(n)]
    normal.append([Fraction(1)] * n + [Fraction(0)])
    right = [[sum(weight[s] * (v[s] - v[0]) for s in inner if s >> i & 1) for v in values] for i in range(n)]
    right.append([Fraction(v[full] - v[0]) for v in values])
    shares = solve(normal, right)[:n]
    return [[shares[i][k] for i in range(n)] for k in range(len(values))]


def coalition_table(flagged: DataFrame, n: int, measures: Sequence[str], part: str = "part", mask: str = "mask") -> DataFrame:
    """(part, coalition, total, removed, one column per measure): documents, and sums of measures, that each coalition removes."""
    counts = flagged.groupBy(part, mask).agg(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in measures])
    spread = counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))))
    hit = F.col(mask).bitwiseAND(F.col("coalition")) != 0
    return spread.groupBy(part, "coalition").agg(
        F.sum("n").alias("total"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("removed"),
        *[F.sum(F.when(hit, F.col(m)).otherwise(0)).alias(m) for m in measures],
    )


def _orders(filters: Sequence[str], measures: Mapping[str, str]):
    n = len(filters)
    full = (1 << n) - 1

    def make():
        def orders(parts, totals, tables):
            out = {c: [] for c in ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *measures.values(), "shapley")}
            games = [[row["removed"] for row in table] for table in tables]
            shares = shapley_values(games, n) if games else []
            for part, total, table, removed, share in zip(parts, totals, tables, games, shares, strict=True):
                for order in permutations(range(n)):
                    before, name = 0, "".join(filters[f] for f in order)
                    for step, f in enumerate(order, 1):
                        after, alone = before | 1 << f, full ^ 1 << f
                        here = removed[after] - removed[before]
                        row = (part, name, step, total - removed[after], here, removed[1 << f] - here, removed[full] - removed[alone])
                        lost = [table[after][m] - table[before][m] for m in measures]
                        for column, value in zip(out, (*row, *lost, int(share[f] * factorial(n))), strict=True):
                            out[column].append(value)
                        before = after
            return out

        return orders

    return make


def audit_filters(flagged: DataFrame, filters: Sequence[str], measures: Mapping[str, str], part: str = "part", mask: str = "mask") -> DataFrame:
    """A row per part, order of the filters and step: what the step keeps and removes, and the filter's Shapley value times n!.

    ``mask`` has bit k set where the document fails ``filters[k]``; ``measures`` maps columns to sum over removed documents to names
    of result columns. Columns: part, filter_order, step, kept, removed, redundant (failing, but removed earlier), unique_fails
    (failing this filter only), the measures, shapley. No documents, no parts and no rows. With n filters a part has n! * n rows; one row of 2^n
    coalitions per part goes to Python.
    """
    names = [f"m{k}" for k in range(len(measures))]
    plain = flagged.select(F.col(f"`{part}`").alias("part"), F.col(f"`{mask}`").alias("mask"), *[F.col(f"`{m}`").cast("long").alias(k) for m, k in zip(measures, names)])
    table = coalition_table(plain, len(filters), names)
    rows = table.groupBy("part").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("coalition", "removed", *names))).alias("rows"))
    columns = ", ".join(f"`{c}` long" for c in ("kept", "removed", "redundant", "unique_fails", *measures.values(), "shapley"))
    return flat_map(rows, _orders(filters, dict(zip(names, measures.values()))), f"part string, filter_order string, step int, {columns}")


def with_labels(flagged: DataFrame, labels: DataFrame, marks: Mapping[str, str], doc_id: str = "doc_id") -> DataFrame:
    """``flagged`` with a column 0 or 1 for each of ``marks`` (new column: label column): 1 if a label of the document is 1."""
    own = labels.groupBy(F.col(f"`{doc_id}`").alias("doc_id")).agg(*[F.max((F.col(f"`{c}`") == 1).cast("int")).alias(name) for name, c in marks.items()])
    own = own.filter(" or ".join(f"{name} = 1" for name in marks))
    joined = flagged.join(own, "doc_id", "left")
    return joined.select(*flagged.columns, *[F.coalesce(name, F.lit(0)).alias(name) for name in marks])
