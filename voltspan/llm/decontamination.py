"""Benchmark decontamination: a broadcast hash set of benchmark windows, scanned over whole documents.

Words are runs of ASCII digits, letters (A-Z lowered) and non-ASCII characters. A window is ten
consecutive words of an item, or all words of a shorter item. Each task maps words to the ids of the
benchmark's vocabulary, hashes all windows of a document at once, looks the hashes up, and verifies
every hit on the words themselves. Documents are dropped, or the hit words are cut out.

Defined results: null and wordless texts have no words and no hits; wordless items have no windows;
items with equal texts are all reported; a null item id is reported as ``null``; repeated rows are
judged alike; without a benchmark nothing is hit.

Scale: documents are never shuffled. The windows are counted first; up to ``BLOCK_WINDOWS`` of them are
broadcast. A larger benchmark is cut into such blocks by hash, and the documents are scanned once per
block, written to the shared folder in between, so memory per task stays the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from voltspan.llm.common import append_columns, beside
from voltspan.session import stage

WINDOW = 10
# windows of one broadcast block; about 100 bytes each, and as much again as Python objects
BLOCK_WINDOWS = 200_000
# every byte that belongs to no word becomes a space, A-Z become a-z
_PLAIN = bytes(
    b if chr(b).isdigit() or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_PLAIN).split()


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (text of the window, item)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(text)
                spans = {b" ".join(found[i : i + window]) for i in range(max(1, len(found) - window + 1))} if found else set()
                yield pa.RecordBatch.from_arrays([pa.array(list(spans), pa.binary()), pa.array([item] * len(spans), pa.string())], names=["window", "item"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    return items.mapInArrow(cut, "window binary, item string").distinct()


class Matcher:
    """One block of windows, ready to be looked up."""

    def __init__(self, rows: list[tuple[bytes, str]]):
        self.items: dict[bytes, list[str]] = {}
        for text, item in rows:
            self.items.setdefault(bytes(text), []).append(item)
        self.ids: dict[bytes, int] = {}
        by_length: dict[int, list[list[int]]] = {}
        for text in self.items:
            found = text.split(b" ")
            by_length.setdefault(len(found), []).append([self.ids.setdefault(w, len(self.ids) + 1) for w in found])
        self.hashes = {n: np.unique(self._hash(np.array(x, np.uint64).T)) for n, x in by_length.items()}

    @staticmethod
    def _hash(columns) -> np.ndarray:
        out = np.zeros(len(columns[0]), np.uint64)
        for column in columns:
            out = (out + column) * _BASE
            out ^= out >> np.uint64(29)
        return out

    def find(self, found: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, word after the last, items) of every occurrence."""
        ids = np.fromiter((self.ids.get(w, 0) for w in found), np.uint64, len(found))
        for n, known in self.hashes.items():
            if len(found) < n:
                continue
            hashes = self._hash([ids[i : len(found) - n + 1 + i] for i in range(n)])
            at = np.searchsorted(known, hashes)
            at[at == len(known)] = 0
            for start in np.flatnonzero(known[at] == hashes).tolist():
                items = self.items.get(b" ".join(found[start : start + n]))
                if items:
                    yield start, start + n, items


_SCAN = StructType(
    [
        StructField("n_words", LongType()),
        StructField("hit_starts", ArrayType(IntegerType())),
        StructField("hit_ends", ArrayType(IntegerType())),
        StructField("items", ArrayType(StringType())),
    ]
)


ADDED = (*_SCAN.names, "n_hit", "contaminated")


def _merge(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_starts and hit_ends (merged spans of words), items, contaminated."""
    spark = docs.sparkSession
    windows = stage(benchmark_windows(benchmark, window), "benchmark-windows")
    blocks = max(1, math.ceil(windows.count() / block_windows))
    out = docs
    for block in range(blocks):
        rows = windows.filter(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast([(bytes(w), i) for w, i in rows])
        held: list[Matcher] = []

        def judge(texts, starts=None, ends=None, items=None, shared=shared, held=held):
            if not held:
                held.append(Matcher(shared.value))
            for i, text in enumerate(texts):
                found = words(text)
                spans = set(zip(starts[i], ends[i])) if starts else set()
                seen = set(items[i]) if items else set()
                for start, end, hit in held[0].find(found):
                    spans.add((start, end))
                    seen.update(hit)
                merged = _merge(spans)
                yield len(found), [s for s, _ in merged], [e for _, e in merged], sorted(seen)

        out = append_columns(out, ["text"] + (["hit_starts", "hit_ends", "items"] if block else []), _SCAN, judge)
        if block + 1 < blocks:
            out = stage(out, "scanned-block")
    hit = F.aggregate(F.zip_with("hit_starts", "hit_ends", lambda s, e: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.withColumn("n_hit", hit).withColumn("contaminated", F.col("n_hit") > 0)


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, in the columns of ``docs``."""
    return beside(docs, ADDED, lambda rows: scan(rows, benchmark, **options).filter("not contaminated"))


def cut_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All documents, with hit words and what stands between them taken out of ``text``."""

    def cut(texts, starts, ends):
        for text, first, after in zip(texts, starts, ends):
            if not first:
                yield (text,)
                continue
            raw, plain = text.encode(), text.encode().translate(_PLAIN)
            places, at = [], 0
            for w in plain.split():
                at = plain.index(w, at)
                places.append((at, at + len(w)))
                at += len(w)
            pieces, at = [], 0
            for s, e in zip(first, after):
                pieces.append(raw[at : places[s][0]])
                at = places[e - 1][1]
            yield (b"".join([*pieces, raw[at:]]).decode(),)

    out = StructType([StructField("text", StringType())])
    return beside(docs, ADDED, lambda rows: append_columns(scan(rows, benchmark, **options), ["text", "hit_starts", "hit_ends"], out, cut))


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, hit words, and a digest of the items that occur."""
    return scan(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE = r"""
with cut as (
  select key, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select row_number() over () as key, cast(doc_id as varchar) as id, coalesce(text, '') as text from documents
        union all
        select -row_number() over (), coalesce(cast(item_id as varchar), 'null'), coalesce(text, '') from benchmark)),
lens as (select distinct least(len(w), 10) as n from cut where key < 0 and len(w) > 0),
items as (select distinct id as item, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') as win
          from (select id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
                from cut where key < 0 and len(w) > 0)),
wins as (select key, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') as win
         from (select key, w, n, unnest(range(1, len(w) - n + 2)) as i from cut, lens where key > 0 and len(w) >= n)),
hits as (select key, wins.n, i, item from wins join items using (n, win)),
hit as (select key, count(distinct p) as n_hit from (select key, unnest(range(i, i + n)) as p from hits) group by key),
seen as (select key, count(*) as n_items, string_agg(item, ',' order by item) as list
         from (select distinct key, item from hits) group by key)
select cast(c.id as bigint) as doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from cut c left join hit using (key) left join seen using (key) where key > 0
"""
