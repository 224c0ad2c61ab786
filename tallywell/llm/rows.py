"""Shared plumbing: run a function over the texts of a table in bounded Arrow slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows handed to the function at a time.
SLICE = 256
ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "boolean": pa.bool_(),
         "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
         "array<int>": pa.list_(pa.int32())}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(name: str, columns: list[str]) -> str:
    """The name, with underscores before it until no column begins with it."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name = "_" + name
    return name


def map_texts(df: DataFrame, work: Callable[[list[str]], list[list]], out: list[tuple[str, str]],
              id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, *keep`` and the columns ``out`` that ``work`` makes of a list of texts, row by row.

    A null text is handed on as an empty one. Rows are taken in slices, so a
    task holds a slice and not a partition. Only the named columns are read.
    """
    kept = [id_col, *keep]
    types = [ARROW.get(kind) or pa.type_for_alias(kind) for _, kind in out]
    source = df.select(*[F.col(quoted(c)) for c in kept], F.col(quoted(text_col)).cast("string"))
    ddl = ", ".join([f"{quoted(c)} {source.schema[c].dataType.simpleString()}" for c in kept]
                    + [f"{quoted(n)} {kind}" for n, kind in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                columns = work([t or "" for t in part.column(len(kept)).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in range(len(kept))],
                     *[pa.array(c, kind) for c, kind in zip(columns, types)]],
                    names=[*kept, *[n for n, _ in out]])

    return source.mapInArrow(run, ddl)
