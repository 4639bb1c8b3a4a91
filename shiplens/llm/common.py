"""What several corpus operators share: row keys, staged tables, batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.lineage import cut_lineage

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

stage = cut_lineage


def text_or_empty(name: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(name), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells rows apart that share an id but not the text; equal rows share it."""
    return F.xxhash64(F.col(doc_id), F.col(text).isNull(), F.col(text))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def columns_of(df: DataFrame, *but: str) -> list[Column]:
    """All columns of ``df`` except some, whatever characters their names hold."""
    left_out = {b.lower() for b in but}
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c.lower() not in left_out]


def drop_rows(docs: DataFrame, dropped: DataFrame, key: Column) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is not in ``dropped._key``.

    What a filter takes out is far less than what it keeps, so it is the smaller side.
    """
    (name,) = fresh(docs, "_key")
    held = docs.withColumn(name, key).join(dropped.withColumnRenamed("_key", name), name, "left_anti")
    return held.select(*columns_of(docs))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that ``column`` holds about ``most`` bytes in each.

    A single longer text makes a slice of its own.
    """
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)
