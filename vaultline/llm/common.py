"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a word is a run of characters other than these six; ``bytes.split()`` splits on the same set
SPACES = b" \t\n\r\x0b\f"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text as long; null counts as no words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))


def fold_bucket(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's decimal text modulo ``folds`` (null id: the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def by_size(batches: Iterator[pa.RecordBatch], name: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one holds about ``most`` bytes of column
    ``name`` (a single longer text stays whole): bounds the working memory of
    what follows, whatever the length of the texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(name))
        sizes = np.cumsum(pc.fill_null(pc.binary_length(col.cast(pa.binary())), 0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            used = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, used + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with its columns named by place (``in_0``, ``in_1``, ...), so
    that no name of its own can clash with an operator's, and what each name
    has become."""
    names = [f"in_{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names, strict=True))
