"""Substring deduplication by content-defined chunks.

A gear hash rolls over the code points of a text; where it meets a mask at the end of a word a chunk may
end, so insertions move the borders of the chunks around them only. Any white space of Unicode ends a
word; in text without any, as in Chinese or Thai, a chunk may end at every code point. Where ``QUIET``
code points hold no such place, as in a phrase said over and over, the smallest hash at the end of a word
among the last ``QUIET`` code points ends one, or that at any of them if no word ends there. Chunks are
told apart by 128-bit digests. A passage is a run of neighbouring chunks that other documents hold too, ``PASSAGE`` code points
long at least; it stays in the document with the smallest doc_id and is cut out of the others.

Defined results: null text is empty; shorter runs, such as a common line, stay everywhere; what a
document repeats within itself stays; rows with the same id are one document; a null id is larger than
all others, and where only null ids hold a passage all keep it; an empty table stays empty.

Scale: each document sends every different chunk once. Counts and smallest ids are combined per task
before the shuffle, so a chunk that a third of all documents hold is one row per task. Chunks that no other
document holds aren't sent a second time: a bitmap of a fixed ``BITS`` bits, in which each shared digest sets one,
goes to all tasks, and only chunks on a set bit are joined, which decides exactly; joining is left to the skew
join. A text gets the list of its own repeated chunks under its id and digest, so rows that share an id, or have
none, share a list only if their texts are equal too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from voltspan.llm.common import SLICE_ROWS, Powers, append_columns, free_name, running
from voltspan.session import stage

WINDOW = 16  # code points that the rolling hash sees: four bits of shift each
LEAST, MOST = 16, 400
QUIET = 96
FAR = 12  # code points without white space after which a chunk may end at any of them
PASSAGE = 100
BITS = 1 << 27  # of the bitmap, 16 MB whatever the corpus; a power of two
# what Unicode calls white space parts words
_SPACES = np.array([chr(c).isspace() for c in range(0x3002)])
_B1, _B2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_BASES = [(Powers(b), Powers(pow(b, -1, 2**64))) for b in (_B1, _B2)]


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), np.uint32).astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _quiet_ends(rolled: np.ndarray, space: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places in long gaps between ``ends`` whose hash no other of the last ``QUIET`` places undercuts, ends of words first."""
    edges = np.concatenate([[0], ends, [len(rolled)]])
    out = [ends]
    for gap in np.flatnonzero(np.diff(edges) > QUIET).tolist():
        start, stop = edges[gap], edges[gap + 1]
        # any end of a word undercuts all other places
        hashes = rolled[start:stop] >> np.uint64(1) | (~space[start:stop]).astype(np.uint64) << np.uint64(63)
        least, width = hashes, 1
        while width < QUIET:
            step = min(width, QUIET - width)
            least, width = np.minimum(least[:-step], least[step:]), width + step
        at = np.arange(QUIET - 1, stop - start)
        out.append(start + at[hashes[at] == least] + 1)
    return np.sort(np.concatenate(out))


def _near_space(space: np.ndarray) -> np.ndarray:
    """Places with white space among the last ``FAR``."""
    upto = np.cumsum(space, dtype=np.int32)
    upto[FAR:] -= upto[:-FAR].copy()
    return upto > 0


def borders(points: np.ndarray) -> np.ndarray:
    """Where chunks begin and end: 0, ..., the length of the text."""
    n = len(points)
    if not n:
        return np.zeros(1, np.int64)
    gear = _mix((points + np.uint64(1)) * np.uint64(_B1))
    rolled = gear.copy()
    for i in range(1, min(WINDOW, n)):
        rolled[i:] += gear[:-i] << np.uint64(4 * i)
    rolled = _mix(rolled)
    space = _SPACES[np.minimum(points, np.uint64(len(_SPACES) - 1)).astype(np.int64)]
    inner = (rolled % np.uint64(256) == 1) | (rolled % np.uint64(16) == 1) & ~_near_space(space)
    ends = np.flatnonzero(space & (rolled % np.uint64(4) == 0) | inner) + 1
    out, last = [0], 0
    for end in _quiet_ends(rolled, space, ends).tolist():
        while end - last > MOST:
            last += MOST
            out.append(last)
        if end - last >= LEAST:
            last = end
            out.append(last)
    while n - last > MOST:
        last += MOST
        out.append(last)
    return np.array(out + [n] if n > last else out)


def digests(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Two independent 64-bit digests of every chunk, as rows of signed numbers."""
    out = []
    for forth, back in _BASES:
        upto = running((points + np.uint64(1)) * forth(len(points)))
        out.append(_mix((upto[cuts[1:]] - upto[cuts[:-1]]) * back(len(points))[cuts[:-1]]).view(np.int64))
    return np.stack(out, axis=1)


def chunk_marks(docs: DataFrame, key: str, kept=None) -> DataFrame:
    """(high, low, ``key``) of every different chunk of every document, or of those whose ``high`` passes ``kept``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                found = []
                for text in part.column(1).to_pylist():
                    points = code_points(text)
                    own = digests(points, borders(points)) if len(points) else np.zeros((0, 2), np.int64)
                    own = own if kept is None else own[kept(own[:, 0])]
                    found.append(np.unique(own, axis=0))
                row = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
                both = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), part.column(0).take(row)], names=["high", "low", key])

    return docs.select(F.col(key).cast("long"), "text").mapInArrow(mark, f"high long, low long, {key} long")


def shared_bits(shared: DataFrame, bits: int = BITS):
    """A test that all digests of ``shared`` pass, and few others while these are fewer than ``bits``."""
    at = F.pmod("high", F.lit(bits)) + 1
    rows = shared.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("held"))
    bitmap = bytearray(bits // 8)
    # bits / 32768 rows of 4096 bytes at most
    for bucket, held in rows.collect():
        part = bytes(held)[: max(1, min(4096, bits // 8))]
        bitmap[(bucket - 1) * 4096 : (bucket - 1) * 4096 + len(part)] = part
    sent = shared.sparkSession.sparkContext.broadcast(bytes(bitmap))

    def kept(high: np.ndarray) -> np.ndarray:
        place = high.view(np.uint64) % np.uint64(bits)
        return np.frombuffer(sent.value, np.uint8)[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1 == 1

    return kept


_ADDED = StructType(
    [
        StructField("n_chars", LongType()),
        StructField("n_chunks", LongType()),
        StructField("repeated_chars", LongType()),
        StructField("removed_chars", LongType()),
        StructField("removed_starts", ArrayType(LongType())),
        StructField("removed_ends", ArrayType(LongType())),
        StructField("kept_in", ArrayType(LongType())),
        StructField("kept_text", StringType()),
    ]
)


def passages(cuts: np.ndarray, shared: np.ndarray, least: int = PASSAGE) -> np.ndarray:
    """Which chunks stand in a run of shared chunks that is long enough."""
    edge = np.flatnonzero(np.diff(shared.astype(np.int8), prepend=0, append=0))
    out = np.zeros(len(shared), bool)
    for start, stop in zip(edge[::2], edge[1::2]):
        out[start:stop] = cuts[stop] - cuts[start] >= least
    return out


def dedup_substrings(docs: DataFrame, least: int = PASSAGE) -> DataFrame:
    """``docs`` with the text that stays, and where and how much of it other documents hold.

    repeated_chars counts passages that stand elsewhere too, removed_chars those cut out here;
    kept_in are the documents in which these stay.
    """
    marks = chunk_marks(docs, "doc_id")
    shared = stage(
        marks.groupBy("high", "low")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"), F.count("doc_id").alias("named"))
        .filter("n > 1 and (named = 0 or named < n or first <> last)")
        .select("high", "low", "first"),
        "shared-chunks",
    )
    found, own, key = free_name(docs, "_found"), free_name(docs, "_own"), free_name(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    # rows of one id and text send the same chunks; one list of them is enough
    hits = (
        chunk_marks(keyed, key, shared_bits(shared))
        .join(shared, ["high", "low"])
        .groupBy(F.col(key).alias(own))
        .agg(F.collect_set(F.array("high", "low", "first")).alias(found))
    )

    def settle(ids, texts, founds):
        for doc_id, text, found in zip(ids, texts, founds):
            points = code_points(text)
            cuts = borders(points)
            if not found:
                yield len(points), len(cuts) - 1, 0, 0, [], [], [], text or ""
                continue
            first = {(high, low): lead for high, low, lead in found}
            own = [tuple(x) for x in digests(points, cuts).tolist()]
            inside = passages(cuts, np.array([x in first for x in own]), least)
            gone = np.array([bool(i) and first[x] != doc_id for i, x in zip(inside, own)])
            edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
            starts, ends = cuts[edge[::2]].tolist(), cuts[edge[1::2]].tolist()
            kept, at = [], 0
            for start, end in zip(starts, ends):
                kept.append(text[at:start])
                at = end
            holders = sorted({first[x] for x, g in zip(own, gone) if g and first[x] is not None})
            size = np.diff(cuts)
            yield len(points), len(own), int(size[inside].sum()), int(size[gone].sum()), starts, ends, holders, "".join([*kept, text[at:]])

    rows = keyed.join(hits, F.col(key) == F.col(own), "left").drop(own, key)
    out = append_columns(rows, ["doc_id", "text", found], _ADDED, settle)
    return out.drop(found)


def deduplicated(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs.select("doc_id", "text")).drop("text")
