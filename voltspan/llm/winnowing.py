"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points is hashed with a rolling polynomial; in every window of ``WINDOW``
successive hashes the smallest is chosen, the rightmost of equal ones, and chosen hashes are kept with
their positions. Two texts that share ``GRAM + WINDOW - 1`` code points in a row share a chosen hash.

Defined results: a text shorter than a gram is one gram; null is empty, and an empty text has the
empty fingerprint, which is like itself (1) and unlike any other (0); repeated rows have equal
fingerprints. Rows are ordered by doc_id (null first), then by text hash; the last one's next row is
the first one; a single row is its own next row.

Scale: texts are shuffled once, by ranges of ids with equal shares of the rows. The first row of each
range goes to the range before it as well, so each task reads its rows as a stream, one text behind,
and no group is gathered. Ids repeated across a third of the rows would fall into one range, which is
still read as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType
from pyspark.sql.window import Window

from voltspan.llm.common import SLICE_ROWS, Powers, append_columns, running

GRAM, WINDOW = 24, 64
_BASE = 0x9E3779B97F4A7C15
RANGES = 4  # ranges per shuffle partition


_FORTH, _BACK = Powers(_BASE), Powers(pow(_BASE, -1, 2**64))


def gram_hashes(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hashes of all runs of ``gram`` code points, from one running sum (arithmetic modulo 2**64)."""
    gram = min(gram, len(points))
    upto = running(points * _BACK(len(points)))
    out = (upto[gram:] - upto[:-gram]) * _FORTH(len(points) - gram + 1)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def winnow(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) chosen from the whole text, in order of position."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = gram_hashes(np.frombuffer(text.encode("utf-32-le"), np.uint32), gram)
    best, width, window = np.arange(len(hashes)), 1, min(window, len(hashes))
    while width < window:  # windows twice as wide, or as wide as wanted, from two overlapping ones
        step = min(width, window - width)
        left, right = best[:-step], best[step:]
        best, width = np.where(hashes[right] <= hashes[left], right, left), width + step
    chosen = best[np.flatnonzero(np.diff(best, prepend=-1))]  # the rightmost minimum never moves back
    return chosen, hashes[chosen]


def as_string(positions: np.ndarray, hashes: np.ndarray) -> str:
    return " ".join(f"{p}:{h:x}" for p, h in zip(positions.tolist(), hashes.tolist()))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of the chosen hashes, without their positions."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as much of the beginning of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_CHOSEN = StructType([StructField("positions", ArrayType(LongType())), StructField("hashes", ArrayType(LongType()))])


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` with the chosen ``positions`` and ``hashes`` of every whole text."""

    def choose(texts):
        for text in texts:
            positions, hashes = winnow(text, gram, window)
            yield positions.tolist(), hashes.view(np.int64).tolist()

    return append_columns(docs, ["text"], _CHOSEN, choose)


def with_next(docs: DataFrame) -> DataFrame:
    """(range, closing, doc_id, text), sorted in each task so that a row's next row comes after it.

    A range ends in its closing row, the first row of the range after it. Borders are quantiles of
    the ids; one border and one first id per range is all that is looked at besides the rows.
    """
    ranges = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id")
    found = ids.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 1 / ranges)
    borders = np.unique(np.array(found, np.int64))

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(borders, ids.fillna(0).astype("int64"), side="right")))

    in_range = number(F.col("doc_id")).alias("range")
    order = Window.orderBy("range")
    first = (
        ids.select("doc_id", in_range)
        .groupBy("range")
        .agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id"))["doc_id"].alias("first_id"))
        .withColumn("before", F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy())))
    )
    here, there = F.struct("range", F.lit(False).alias("closing")), F.struct(F.col("before").alias("range"), F.lit(True).alias("closing"))
    return (
        docs.select("doc_id", "text", in_range)
        .join(F.broadcast(first).withColumnRenamed("range", "of"), (F.col("range") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left")
        .withColumn("at", F.explode(F.when(F.col("of").isNull(), F.array(here)).otherwise(F.array(here, there))))
        .select("at.range", "at.closing", "doc_id", "text")
        .repartition("range")
        .sortWithinPartitions("range", "closing", "doc_id", F.xxhash64("text"))
    )


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def against_next(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and their likeness to these and the next text's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        waiting, out = None, []

        def flush():
            done = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)
            out.clear()
            return done

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                columns = [c.to_pylist() for c in batch.slice(start, SLICE_ROWS).columns]
                for at, closing, doc_id, text in zip(*columns):
                    text = text or ""
                    row = (at, doc_id, text, *winnow(text, gram, window))
                    if waiting and waiting[0] == at:
                        _, known, before, positions, hashes = waiting
                        changed = edited(before, text)
                        p, h = winnow(changed, gram, window)
                        digest = hashlib.sha256(changed.encode()).hexdigest()
                        out.append((known, len(before), digest, as_string(positions, hashes), as_string(p, h), likeness(hashes, h), likeness(hashes, row[4])))
                    waiting = None if closing else row
                    if len(out) >= SLICE_ROWS:
                        yield flush()
        if out:
            yield flush()

    return with_next(docs.select("doc_id", "text")).mapInArrow(run, _RESULT)
