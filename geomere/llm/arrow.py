"""Helpers for the Arrow functions of this package."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space at which a text may be cut: no tokenizer rule here spans it.
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


def text_bytes(column: str | Column = "text") -> Column:
    """The UTF-8 bytes of a text column; a null text is an empty one."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col, F.lit("")).cast("binary")


def row_key(text: str | Column = "text") -> Column:
    """A hash of the text that, with doc_id, names a row; equal rows share it."""
    col = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(col, F.lit("")))


def slices(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut before white space only; together they are all of it."""
    start = 0
    while len(data) - start > size and (cut := _BREAK.search(data, start + size)):
        yield data[start : cut.start()]
        start = cut.start()
    yield data[start:] if start else data


def folded(data: bytes) -> bytes:
    """``data`` with A-Z in lower case, where a tokenizer that lower-cases cannot tell the difference.

    It could where a special string may appear, or where a combining mark (lead bytes
    0xCC and 0xCD) may compose with one case of a letter only.
    """
    return data if b"<|" in data or b"\xcc" in data or b"\xcd" in data else data.lower()


def small(batches: Iterator[pa.RecordBatch], rows: int = 250) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that few rows at a time are Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def keyed(docs: DataFrame, key: str) -> tuple[Column, Column]:
    """A key column without nulls, and whether it was null: to be joined and grouped by like any other."""
    kind = docs.schema[key].dataType
    return F.coalesce(F.col(key), F.lit("" if kind.simpleString() == "string" else 0).cast(kind)), F.col(key).isNull()


def least_hashed(rows: DataFrame, column: str, bound: int) -> DataFrame:
    """The at most ``bound`` rows with the least values of a hash column, of which the last ones may be missing.

    A first bound on the hash, from the number of rows, leaves few more than that to be sorted in one place.
    """
    share = 1.25 * bound / max(rows.count(), 1)
    if share < 1:
        rows = rows.where(F.col(column) < int(-(2**63) + share * 2**64))
    return rows.orderBy(column).limit(bound)


def fresh(columns: list[str], name: str) -> str:
    """``name``, or a like one that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, rows: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that ``rows`` names by ``key`` and _row.

    Spark broadcasts ``rows`` only if it is a table known to be below its threshold.
    """
    mark = fresh(docs.columns, "_mark")
    named = rows.select(F.col(key).alias(fresh(docs.columns, "_gone_key")), F.col("_row").alias(fresh(docs.columns, "_gone_row")))
    marked = docs.withColumn(mark, row_key(text))
    same = marked[key].eqNullSafe(named[named.columns[0]]) & (marked[mark] == named[named.columns[1]])
    return marked.join(named, same, "left_anti").select(docs.columns)
