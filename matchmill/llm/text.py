"""Texts as UTF-8 bytes: words, word hashes, shingles, and a way to add columns that Python computes from whole texts."""

from __future__ import annotations

import ctypes
import importlib
import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

#: Rows of one Arrow batch. Texts can be very long, so that batches are kept small.
BATCH_ROWS = 256
BATCH_BYTES = "4m"
#: Rows that a task hands back at once of those it gathered.
FOLDED_ROWS = 1 << 15


def _table(separators: bytes) -> bytes:
    """A byte table that lower-cases A-Z and turns separators into spaces."""
    return bytes(32 if b in separators else b + 32 if 65 <= b <= 90 else b for b in range(256))


#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased text: digits, a-z and everything beyond ASCII.
ALNUM = _table(bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)))
#: Words ``[^\x20\x09-\x0D]+`` of the lower-cased text: what white space separates.
SPACED = _table(b" \t\n\x0b\x0c\r")


def words(text: bytes | None, table: bytes) -> list[bytes]:
    """The words of a text in order; none for null."""
    # Only spaces separate here: split() alone would also cut at control characters that belong to a word.
    return [w for w in text.translate(table).split(b" ") if w] if text else []


def joined(text: bytes | None, table: bytes) -> bytes:
    """The words of a text with one space around each; empty without words."""
    if not text:
        return b""
    found = words(text, table)
    return b" " + b" ".join(found) + b" " if found else b""


#: Very long texts are handled in pieces of about so many bytes, so that memory follows the piece and not the text.
PIECE = 1 << 20


def pieces(text: bytes | None, table: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A text in consecutive pieces that end between words; a word is never cut, so a piece may be longer than ``size``."""
    at, n = 0, len(text or b"")
    while at < n:
        end = min(n, at + size)
        while end < n:
            # The next separator, looked for in steps.
            gap = text[end : end + size].translate(table).find(b" ")
            end = end + gap if gap >= 0 else min(n, end + size)
            if gap >= 0:
                break
        yield text[at:end]
        at = end


_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 3)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_PLACE = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int, seen: dict = {}) -> np.ndarray:  # noqa: B006 - a table that grows once per process
    have = seen.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]))
        seen[base] = have
    return have[:n]


def word_hashes(text: bytes | None, table: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end (bytes) of each word of a text, the same in every process.

    Words are polynomials over the bytes modulo 2^64, taken as differences of running sums, so that no loop runs per word. Long texts
    are hashed piece by piece: what a text needs beside its own bytes is 24 bytes a word.
    """
    if not text:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none
    if len(text) > 2 * PIECE:
        parts, at = [], 0
        for piece in pieces(text, table):
            hashes, starts, ends = _piece_hashes(piece, table)
            parts.append((hashes, starts + at, ends + at))
            at += len(piece)
        return tuple(np.concatenate(part) for part in zip(*parts, strict=True))
    return _piece_hashes(text, table)


def _piece_hashes(text: bytes, table: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.translate(table), np.uint8)
    inside = np.empty(len(raw) + 2, np.bool_)
    inside[0] = inside[-1] = False
    np.not_equal(raw, 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[raw] * _powers(_STEP, len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_BACK, len(raw))[starts]), starts, ends


def shingle_hashes(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """A hash of each run of ``size`` words; with fewer words, of all of them; none without words."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out += hashes[k : k + n] * _PLACE[k]
    return mix(out)


def bounded_batches(df: DataFrame) -> None:
    """Set how many rows and bytes Spark hands to Python at once, and let local Python workers find this package.

    On a cluster the package is shipped as all Python code is, with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = df.sparkSession.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def as_bytes(name: str = "text"):
    """A text column as UTF-8 bytes, which Python then need not decode."""
    return F.col(f"`{name}`").cast("binary")


def add_columns(
    df: DataFrame, make: Callable[[], Callable[[list], dict]], new: str, keep: Sequence[str], text: str = "text", also: Sequence[str] = ()
) -> DataFrame:
    """The columns ``keep`` of ``df`` and new ones made from whole texts, a row for a row, without a shuffle.

    ``make`` is called once per task and gives the function that turns a list of texts (bytes or None, and a list for each
    column of ``also``) into a list or array for each new column. A lost task is simply run again.
    """
    bounded_batches(df)
    taken = df.select(*[F.col(f"`{c}`") for c in keep], as_bytes(text).alias("_text"), *[F.col(f"`{c}`") for c in also])
    added = _parse_datatype_string(new)
    schema = StructType(taken.schema.fields[: len(keep)] + added.fields)
    # Under names of their own, as a kept column may have any.
    taken = taken.toDF(*[f"c{k}" for k in range(len(taken.columns))])
    return taken.mapInArrow(give_back(_adder(make, list(keep), added)), schema)


def _adder(make, keep: list[str], added: StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [(f.name, to_arrow_type(f.dataType)) for f in added.fields]
        score = make()
        for batch in batches:
            made = score(*[column.to_pylist() for column in batch.columns[len(keep):]])
            arrays = [pa.array(made[name], kind) for name, kind in types]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *arrays], names=[*keep, *(n for n, _ in types)])

    return run


#: What a process calls whenever one of its tasks ends, to drop what it kept for that task.
AT_TASK_END: list[Callable[[], None]] = []


def give_back(run):
    """``run`` for ``mapInArrow``; once a task ends, what it freed goes back to the system, as its process waits for tasks of other steps."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        # Taken from the module when the task runs, as this function may have come with it.
        for drop in importlib.import_module("matchmill.llm.text").AT_TASK_END:
            drop()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
        if trim is not None:
            trim(0)

    return wrapped


def flat_map(df: DataFrame, make: Callable[[], Callable[[list], dict]], schema: str) -> DataFrame:
    """New rows from batches: ``make`` gives, once per task, a function from a list per column to a list or array per new column."""
    bounded_batches(df)
    fields = _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [(f.name, to_arrow_type(f.dataType)) for f in fields.fields]
        score = make()
        for batch in batches:
            made = score(*[column.to_pylist() for column in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(made[n], t) for n, t in types], names=[n for n, _ in types])

    return df.mapInArrow(give_back(run), fields)


def fold_tasks(df: DataFrame, make: Callable[[], tuple], schema: str) -> DataFrame:
    """New rows from what a task gathers: ``make`` gives, once per task, two functions, ``add`` and ``rest``.

    ``add`` takes a list per column of a batch and gives rows (a list or array per new column) or None; ``rest`` gives those left
    at the end of the task.
    """
    bounded_batches(df)
    fields = _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [(f.name, to_arrow_type(f.dataType)) for f in fields.fields]

        def shaped(made: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(made[n], t) for n, t in types], names=[n for n, _ in types])

        def sliced(made: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            # Many rows at once would stand in the executor's memory twice more.
            for k in range(0, max(1, made.num_rows), FOLDED_ROWS):
                yield made.slice(k, FOLDED_ROWS)

        add, rest = make()
        for batch in batches:
            made = add(*[column.to_pylist() for column in batch.columns])
            if made is not None:
                yield from sliced(shaped(made))
        yield from sliced(shaped(rest()))

    return df.mapInArrow(give_back(run), fields)
