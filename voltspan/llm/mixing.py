"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every source's documents are put in a fixed random order and may be repeated. A copy's virtual
finish time is the source's words up to and with it, divided by the source's target. All copies
are ordered by that time over the whole corpus and the mix ends before the total would pass its
budget, so every source has come equally far when it ends.

Defined results: null text has size 0; documents of size 0 are never taken (they add no words);
a null source is a source like any other and comes last; repeated rows are separate documents;
copies with the same finish time are taken together or not at all; an empty table stays empty.

Scale: a source's running total is taken within (source, slice of the hash) after the slices'
totals are summed, so a source with a third of all rows spreads over 4096 groups. The cut is found
by counting words per range of finish times, twice, and sorting one such range.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltspan.llm.common import beside, row_key
from voltspan.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
RANGES = 4096
ADDED = ("size", "source_size", "target", "copies", "taken", "_src", "_size", "_place", "_slice", "_offset", "_upto")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def sized(docs: DataFrame) -> DataFrame:
    """The four columns mixing works on: source key, size, place in the shuffle, slice of it."""
    return docs.withColumns(
        {
            "_src": _source_key(F.col("source")),
            "_size": word_count(F.col("text")),
            "_place": F.md5(row_key(F.col("doc_id"), F.col("text"))),
        }
    ).withColumn("_slice", F.substring("_place", 1, 3))


def targets(rows: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Words per source: shares of all words by weight, none above ``max_copies`` times its size.

    Sources are ordered by name, null last, and weigh as ``weights`` repeats. In order of size per
    weight, a source is held at its ceiling when its share of what the earlier ones left is above
    it; the others share the rest. One row per source, so the windows see the list of sources.
    """
    order = Window.orderBy(F.col("_src") == "", "_src")
    by_room = Window.orderBy(F.col("ceiling") / F.col("weight"), "_src")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    return (
        rows.groupBy("_src")
        .agg(F.sum("_size").alias("source_size"))
        .withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("ceiling", F.col("source_size") * max_copies)
        .withColumn("all_words", F.sum("source_size").over(every))
        .withColumn("rest", F.col("all_words") - F.coalesce(F.sum("ceiling").over(before), F.lit(0)))
        .withColumn("weights_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("held", F.col("rest") * F.col("weight") > F.col("ceiling") * F.col("weights_left"))
        .withColumn("shared", F.col("all_words") - F.sum(F.when(F.col("held"), F.col("ceiling")).otherwise(0)).over(every))
        .withColumn("sharing", F.sum(F.when(F.col("held"), 0).otherwise(F.col("weight"))).over(every))
        .select(
            "_src",
            "source_size",
            F.when(F.col("held"), F.col("ceiling").cast("double"))
            .otherwise((F.col("shared") * F.col("weight")).cast("double") / F.col("sharing"))
            .alias("target"),
        )
    )


def placed(rows: DataFrame, light: DataFrame, goals: DataFrame) -> DataFrame:
    """Each row with its source's size and target and ``_upto``, the source's words up to it."""
    earlier = Window.partitionBy("_src").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        light.groupBy("_src", "_slice")
        .agg(F.sum("_size").alias("_sum"))
        .withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .drop("_sum")
        .join(goals, "_src")
    )
    inside = Window.partitionBy("_src", "_slice").orderBy("_place", "_size").rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(slices, ["_src", "_slice"]).withColumn("_upto", F.col("_offset") + F.sum("_size").over(inside))


def _finish(epoch: Column | int) -> Column:
    """Virtual finish time of a copy; null in a source without words, which takes nothing."""
    return F.try_divide((F.col("source_size") * epoch + F.col("_upto")).cast("double"), F.col("target"))


def cut_off(rows: DataFrame, max_copies: int = MAX_COPIES, share: float = 1.0) -> float:
    """The first finish time at which the words taken would exceed ``share`` of all words."""
    copies = (
        rows.filter(F.col("_size") > 0)
        .withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(max_copies - 1))))
        .select("_size", _finish(F.col("_epoch")).alias("finish"))
    )
    ends = copies.agg(F.max("finish").alias("last"), F.sum("_size").alias("words")).first()
    if not ends["words"]:
        return float("inf")
    budget = ends["words"] / max_copies * share
    low, width, below, inside = 0.0, ends["last"] / RANGES, 0, F.lit(True)
    for _ in range(2):
        cell = F.floor((F.col("finish") - low) / width)
        # at most one row per range
        sums = sorted(copies.filter(inside).groupBy(cell.alias("cell")).agg(F.sum("_size").alias("words")).collect())
        for n, words in sums:
            if below + words > budget:
                break
            below += words
        else:
            return float("inf")
        inside, low, width = inside & (cell == n), low + n * width, width / RANGES
    running = F.sum("words").over(Window.orderBy("finish").rowsBetween(Window.unboundedPreceding, 0))
    return (
        copies.filter(inside)
        .groupBy("finish")
        .agg(F.sum("_size").alias("words"))
        .withColumn("running", running + below)
        .filter(F.col("running") > budget)
        .agg(F.min("finish"))
        .first()[0]
    )


def mix(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, share: float = 1.0, lean: bool = False) -> DataFrame:
    """All documents with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``docs`` needs doc_id, text and source. With ``lean`` only doc_id is carried besides, and the
    texts are read once. The shuffle of documents depends on doc_id alone, so reruns agree.
    """
    light = stage(sized(docs).select("doc_id", "_src", "_size", "_place", "_slice"), "mix-sizes")
    goals = targets(light, weights, max_copies)
    cut = cut_off(placed(light, light, goals), max_copies, share)
    rows = placed(light if lean else sized(docs), light, goals)
    copies = reduce(add, [F.coalesce((_finish(e) < cut).cast("int"), F.lit(0)) for e in range(max_copies)])
    copies = F.when(F.col("_size") > 0, copies).otherwise(0)
    names = ["doc_id"] if lean else [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    return rows.withColumn("copies", copies).select(
        *names,
        F.col("_size").alias("size"),
        "source_size",
        "target",
        "copies",
        (F.col("_size") * F.col("copies")).alias("taken"),
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, in the columns of ``docs``."""

    def taken(rows: DataFrame) -> DataFrame:
        out = mix(rows, **options).filter("copies > 0")
        return out.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))

    return beside(docs, ADDED, taken)


ORACLE = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
         md5(coalesce(cast(doc_id as varchar), 't' || md5(text), 'null')) as place
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size,
             1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
      from d group by source),
r as (select *, 3 * source_size as ceiling,
             sum(source_size) over () as total,
             sum(source_size) over () - coalesce(sum(3 * source_size) over w, 0) as rest,
             sum(weight) over () - coalesce(sum(weight) over w, 0) as weights_left
      from s window w as (order by 3 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
h as (select *, rest * weight > ceiling * weights_left as held from r),
t as (select source, source_size,
             case when held then cast(ceiling as double)
                  else cast((total - sum(case when held then ceiling else 0 end) over ()) * weight as double)
                       / sum(case when held then 0 else weight end) over () end as target
      from h),
p as (select d.doc_id, d.size, t.source_size, t.target,
             sum(d.size) over (partition by d.source order by d.place, d.size rows unbounded preceding) as upto
      from d join t on d.source is not distinct from t.source),
c as (select size, cast(e * source_size + upto as double) / target as finish
      from p, (select unnest([0, 1, 2]) as e) where size > 0),
b as (select min(finish) as cut
      from (select finish, sum(size) over (order by finish) as running from c)
      where running > (select sum(size) from d))
select doc_id, size, cast(source_size as bigint) as source_size, target,
       cast(case when size = 0 then 0 else size * (
         cast(cast(upto as double) / target < cut as int) +
         cast(cast(source_size + upto as double) / target < cut as int) +
         cast(cast(2 * source_size + upto as double) / target < cut as int)) end as bigint) as taken
from p, b
"""
