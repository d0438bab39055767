"""Arrow batches in and out of Python functions that see one row at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: rows of a batch that Python holds as objects at a time, so that very long texts stay few
ROWS_AT_ONCE = 256
#: rows after which unused memory of Arrow is given back
RELEASED_AFTER = 1024


#: functions whose results Python workers keep between tasks
_keeping: list[Callable] = []


def kept_by_worker(make: Callable) -> Callable:
    """``make`` with its last result kept in a Python worker, until the worker reads for something else."""
    cached = lru_cache(maxsize=1)(make)
    _keeping.append(cached)
    return cached


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE, keep: Callable | None = None) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``rows``. Of what the worker keeps, only the result of ``keep`` stays.

    Arrow holds on to memory that is free again; it is given back now and then, as other tasks share the machine.
    """
    for cached in _keeping:
        if cached is not keep:
            cached.cache_clear()
    since = 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
            since += rows
            if since >= RELEASED_AFTER:
                pa.default_memory_pool().release_unused()
                since = 0
    pa.default_memory_pool().release_unused()


def with_columns(
    df: DataFrame, text_col: str, made: T.StructType, start: Callable[[], Callable[[str], tuple]], keep: list[str]
) -> DataFrame:
    """``keep`` columns of ``df`` as they are, and for each row the values of ``made`` from its text.

    ``start`` runs once per task and gives the function from text to values; a null text is "".
    """
    schema = T.StructType([df.schema[name] for name in keep] + made.fields)
    width, kept = len(made), len(keep)
    shared = text_col in keep and df.schema[text_col].dataType == T.StringType()
    at = keep.index(text_col) if shared else kept

    def run(batches):
        out = to_arrow_schema(schema)
        fn = start()
        for batch in pieces(batches):
            rows = [fn(text or "") for text in batch.column(at).to_pylist()]
            columns = [batch.column(i).cast(out.field(i).type) for i in range(kept)]
            columns += [pa.array([row[i] for row in rows], out.field(kept + i).type) for i in range(width)]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    read = [F.col(f"`{name}`") for name in keep]
    if not shared:
        read.append(F.col(f"`{text_col}`").cast("string").alias("__text"))
    return df.select(*read).mapInArrow(run, schema)
