"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# rows whose texts are Python objects at one time
SLICE_ROWS = 500


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table, file or folder of part files, by any path Spark can open."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_key(doc_id: Column, text: Column) -> Column:
    """What a row is spread by: its id, or its text where the id is null.

    A row without either gets one fixed key; such rows are equal in all that matters here.
    """
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), F.md5(text)), F.lit("null"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name the table doesn't have yet, so that users' extra columns survive."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def beside(docs: DataFrame, added: Iterable[str], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``keep(docs)`` in the columns of ``docs``, whose own values of the names ``added`` come out as they went in."""
    taken = {name.lower() for name in added}
    own = {c: free_name(docs, f"_own_{c}") for c in docs.columns if c.lower() in taken}
    return keep(docs.withColumnsRenamed(own)).select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def append_columns(df: DataFrame, inputs: list[str], added: StructType, make: Callable[..., Iterator[tuple]]) -> DataFrame:
    """``df`` with the columns ``added``, made from ``inputs`` in Arrow batches inside the tasks.

    ``make`` gets one list per input column and yields one tuple per row. Other columns pass through
    untouched; a column with the name of an added one is replaced. Work and memory go by slices of
    rows, so a batch of long texts isn't held in Python as a whole.
    """
    kept = [c for c in df.columns if c.lower() not in {f.name.lower() for f in added}]
    sources = [free_name(df, f"_in{i}") for i in range(len(inputs))]
    given = df.select(*kept, *[F.col(c).alias(s) for c, s in zip(inputs, sources)])
    schema = StructType([f for f in df.schema.fields if f.name in kept] + added.fields)
    types = to_arrow_schema(added)
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                rows = list(make(*[part.column(n + i).to_pylist() for i in range(len(sources))]))
                new = [pa.array(list(col), f.type) for col, f in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(n)] + new, names=kept + types.names)

    return given.mapInArrow(run, schema)


class Powers:
    """1, base, base**2, ... modulo 2**64; the table grows with the longest text a task meets."""

    def __init__(self, base: int):
        self.base, self.held = base, np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if n > len(self.held):
            grown = np.full(max(n, 2 * len(self.held)), self.base, np.uint64)
            grown[0] = 1
            self.held = np.cumprod(grown, dtype=np.uint64)
        return self.held[:n]

    def __reduce__(self):
        return Powers, (self.base,)  # tasks build their own tables


def running(values: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of the first 0, 1, 2, ... values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=out[1:])
    return out
