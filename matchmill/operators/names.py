"""Names that differ in spelling: folding of case, blanks and accents, and joins within an edit distance.

Two names within k edits have a text in common that k deletions make of each. The deletions of distinct names are an equi-join, so that
no name is compared with all others, and the distance itself decides. A hot name is one row, however many rows bear it.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmill.operators.dedup import top_rows
from matchmill.session import stage

# Letters that no decomposition turns into plain ones.
SPECIAL_LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "ł": "l", "þ": "th", "ı": "i", "ħ": "h"}
#: Blocks of Latin letters with marks.
LETTERS = (0x00C0, 0x0250)


@cache
def _plain_letters() -> tuple[str, str]:
    """Letters with marks, in lower case, and the letters that they decompose into."""
    pairs = {}
    for code in range(*LETTERS):
        letter = chr(code).lower()
        base = unicodedata.normalize("NFKD", letter)[0]
        if len(letter) == 1 and base != letter and base.isascii():
            pairs[letter] = base
    return "".join(pairs), "".join(pairs.values())


def folded_name(column: Column) -> Column:
    """A name in lower case, without accents and marks, with single blanks inside and none outside."""
    marked, plain = _plain_letters()
    out = F.translate(F.lower(column), marked, plain)
    # Marks that stand on their own, after their letter.
    out = F.regexp_replace(out, "[̀-ͯ]", "")
    for letter, letters in SPECIAL_LETTERS.items():
        out = F.replace(out, F.lit(letter), F.lit(letters))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def _deletions(texts: Column) -> Column:
    """Texts and what one deletion makes of each."""
    one = F.transform(texts, lambda t: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))), lambda i: F.concat(F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1))))
    return F.array_distinct(F.concat(texts, F.flatten(one)))


def fuzzy_names(left: DataFrame, right: DataFrame, name: str, other: str, edits: int = 1) -> DataFrame:
    """(name, other, edits) for each distinct name of ``left``: the nearest name of ``right`` within ``edits``, or NULL.

    Names are compared folded. Of several at one distance the first in order of folded names counts, and of spellings that fold alike
    the first spelling. A NULL or blank name matches nothing. ``edits`` is small: a name of n letters has about n ** edits deletions.
    """
    def folded(df: DataFrame, column: str, prefix: str) -> DataFrame:
        rows = df.select(F.col(column).alias(prefix)).filter(F.col(column).isNotNull()).distinct()
        return stage(rows.select(prefix, folded_name(F.col(prefix)).alias(f"{prefix}_key")), "names")

    mine, theirs = folded(left, name, "l"), folded(right, other, "r")
    first = theirs.filter("r_key <> ''").groupBy("r_key").agg(F.min("r").alias("r"))
    keys = mine.filter("l_key <> ''").select("l_key").distinct()

    def spread(df: DataFrame, key: str) -> DataFrame:
        made = F.array(key)
        for _ in range(edits):
            made = _deletions(made)
        return df.select(key, F.explode(made).alias("variant"))

    met = spread(keys, "l_key").join(spread(first, "r_key"), "variant").select("l_key", "r_key").distinct()
    near = met.withColumn("edits", F.levenshtein("l_key", "r_key")).filter(F.col("edits") <= edits)
    best = top_rows(near, ["l_key"], [F.col("edits").asc(), F.col("r_key").asc()])
    named = mine.join(best.join(first, "r_key").select("l_key", "r", "edits"), "l_key", "left")
    return named.select(F.col("l").alias(name), F.col("r").alias(other), "edits")


def fuzzy_join(left: DataFrame, right: DataFrame, name: str, other: str, edits: int = 1) -> DataFrame:
    """All rows of ``left`` with the matching name of ``right`` and the distance; NULL where there is none."""
    found = fuzzy_names(left, right, name, other, edits).withColumnRenamed(name, "_name")
    return left.join(found, F.col(name) == F.col("_name"), "left").drop("_name")


def unmatched(joined: DataFrame, name: str, other: str) -> DataFrame:
    """(name, rows): the names without a match, and how many rows bear each."""
    return joined.filter(F.col(other).isNull()).groupBy(name).agg(F.count(F.lit(1)).alias("rows"))
