"""Text and cast helpers, all native column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Texts worth casting. A failed try_cast costs an exception per row, a look at the text does not.
_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def whole_or_null(text: Column, kind: str = "int") -> Column:
    """Integer of a text; NULL for anything else."""
    return F.when(text.rlike(_WHOLE), text.try_cast(kind))


def safe_int(column: Column, default: int = 0) -> Column:
    """Integer of a text; NULL, blank or unreadable text gives ``default``."""
    return F.coalesce(whole_or_null(column.cast("string")), F.lit(default))


def null_tokens(column: Column, tokens: Sequence[str]) -> Column:
    """NULL for sentinel texts."""
    return F.when(~column.isin(*tokens), column)


def clean_sentinels(df: DataFrame, tokens: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumns({c: null_tokens(F.col(c), t) for c, t in tokens.items()})


def is_true(column: Column) -> Column:
    """TRUE for the text "true" in any case and with blanks around; all else, NULL too, is FALSE."""
    return F.coalesce(F.lower(F.trim(column.cast("string"))) == "true", F.lit(False))


def number_or_null(column: Column) -> Column:
    """A finite number, or NULL."""
    text = column.cast("string")
    value = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def coerce_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Re-type an all-text result: column -> "boolean", "number" or a Spark type name."""
    casts = {}
    for name, kind in types.items():
        column = F.col(name)
        if kind == "boolean":
            casts[name] = is_true(column)
        elif kind == "number":
            casts[name] = number_or_null(column)
        elif kind in ("int", "bigint"):
            casts[name] = whole_or_null(column, kind)
        else:
            casts[name] = column.try_cast(kind)
    return df.withColumns(casts)


def name_key(column: Column) -> Column:
    """The form in which names are compared."""
    return F.lower(F.trim(column))


def lookup(column: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Replace by a small fixed mapping; texts that are not in it give ``default`` (NULL if none)."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), column)
    return found if default is None else F.coalesce(found, default)


def canonical_name(column: Column, aliases: Mapping[str, str]) -> Column:
    """Map alias spellings, compared without case and outer blanks, to the canonical name."""
    folded = {k.strip().lower(): v for k, v in aliases.items()}
    if not folded:
        return column
    # A name in ASCII keeps its length in lower case; folding costs more than the look at the length.
    other = (F.octet_length(column) == F.length(column)) & ~F.length(F.trim(column)).isin(*sorted({len(k) for k in folded}))
    return F.when(other, column).otherwise(lookup(name_key(column), folded, column))


def label_source(column: Column) -> Column:
    """The match id in a label such as ``Winner Match 74``; NULL for other texts."""
    return F.nullif(F.regexp_extract(column, r"Winner Match\s*(\d+)", 1), F.lit(""))


def suffix_number(column: Column) -> Column:
    """3 for ``R16-3``; 0 where there is no number."""
    return F.coalesce(whole_or_null(F.regexp_extract(column, r"-(\d+)", 1), "long"), F.lit(0).cast("long"))


def search_filter(df: DataFrame, columns: Sequence[str], query: str) -> DataFrame:
    """Rows in which any of the columns contains ``query``, ignoring case."""
    needle = F.lower(F.lit(query))
    hit = F.lit(False)
    for column in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(column)), needle), F.lit(False))
    return df.filter(hit)
