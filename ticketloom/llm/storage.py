"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ticketloom.session import new_work_dir


ROWS_AT_ONCE = 500
# Each task holds the batch it hands to Python several times over, in the JVM and in Python.
# Spark's 10,000 rows are as large as their texts; by bytes, a batch does not grow with them.
BATCH_BYTES = "2m"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage, so later steps and retries after a lost executor start from files
    that every executor sees. The columns come back under the schema they were written
    with, an empty frame included.
    """
    path = new_work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame, columns: list[str], schema: str, start: Callable[[], Callable], rows_at_once: int = ROWS_AT_ONCE
) -> DataFrame:
    """Map Arrow batches of some columns to batches of another schema.

    `start` is called once per task and returns the function for its batches: one list
    per column goes in, one dict of output columns comes out. Other columns never leave
    the JVM, so clashing names do not matter.
    """
    out = df.sparkSession.createDataFrame([], schema).schema
    arrow = pa.schema([pa.field(f.name, _arrow(f.dataType.simpleString())) for f in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = start()
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                some = batch.slice(at, rows_at_once)
                got = convert(*(column.to_pylist() for column in some.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return in_small_batches(df).select(*columns).mapInArrow(run, out)


def filter_batches(df: DataFrame, column: str, start: Callable[[], Callable]) -> DataFrame:
    """Keep the rows whose value in one column the function of a task accepts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accept = start()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                values = some.column(some.schema.get_field_index(column)).to_pylist()
                yield some.filter(pa.array(accept(values), type=pa.bool_()))

    return in_small_batches(df).mapInArrow(run, df.schema)


def in_small_batches(df: DataFrame) -> DataFrame:
    """Spark reads the setting when the frame runs, so it stays on the session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "float": pa.float32(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
    }[kind]
