"""Filter interaction audit: what each of five filters removes, alone, in every order, and as a Shapley value.

A filter only removes, so a set of filters (a coalition) removes exactly the documents that fail at least
one of them. Documents are therefore counted once by the set of filters they fail, and the removals of all
32 coalitions are tabulated from those counts. Every step of every order is then a difference of two
coalitions: what the filters so far remove with and without the step's own.

The Shapley values are the exact solution of a constrained least-squares problem: weights that sum to what
all filters remove together (efficiency) and come nearest to all other coalitions' removals under the kernel
weight (n - 1) / (C(n, s) * s * (n - s)). Its normal equations depend on the number of filters alone, so they
are solved once, in rationals, for all right-hand sides together; the solution is a matrix that turns the
tabulated removals of any part into n! times the Shapley values, with whole numbers only.

Filters (words are runs of characters other than U+0020 and U+0009 to U+000D, case matters), failed by:
A under 50 words; B 100 * distinct words < 65 * words; C 100 * capitals A-Z > 5 * code points;
D any of # $ % & * |; E the same text under a smaller doc_id anywhere in the table.

Defined results: a null text is the empty one (it fails A, and E after a smaller id with none); a null
source is the part ''; a null doc_id is neither smaller than another nor has a smaller one, and has no label;
rows that repeat id and text fail E together or not at all; several labels of an id count if any says 1;
without documents there are no parts. Extra columns are ignored.

Scale: texts never leave the task that reads them; digests, ids and sets of failed filters are
written once and shuffled. Copies are
counted before they are joined, the smallest id of a text is combined per task, and it meets its rows by
(digest, id), so a text that fills a third of the table is spread over its ids. Null ids are spread by digest.
What follows the count has 32 rows a part.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltspan.session import stage

WORDS_LEAST = 50
DISTINCT_PERCENT = 65
CAPITALS_PERCENT = 5
SIGNS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"
# null ids match nothing; they are dealt out over this many values of the join key
NULL_SPREAD = 4096


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions of A to D, which a text decides alone."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < WORDS_LEAST,
        "B": F.size(F.array_distinct(words)) * F.lit(100).cast("long") < F.size(words) * F.lit(DISTINCT_PERCENT).cast("long"),
        "C": capitals * F.lit(100).cast("long") > F.length(text) * F.lit(CAPITALS_PERCENT).cast("long"),
        "D": text.rlike(SIGNS),
    }


def failure_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents by the set of filters A to E they fail, bit i for the i-th."""
    text = F.coalesce(F.col("text"), F.lit(""))
    fails = [F.when(cond, 1 << i).otherwise(0) for i, cond in enumerate(text_filters(text).values())]
    # read twice below, so the texts are read once
    rows = stage(
        docs.select(
            F.coalesce(F.col("source"), F.lit("")).alias("part"),
            F.col("doc_id").alias("id"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            sum(fails[1:], fails[0]).alias("alone"),
        )
        .groupBy("digest", "id", "part", "alone")
        .agg(F.count("*").alias("n"))
        .withColumn("spread", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(NULL_SPREAD))).otherwise(0)),
        "failed-filters",
    )
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id")).filter("id is not null")
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    first = firsts.select("digest", "id", F.lit(0).cast("long").alias("spread"), F.lit(True).alias("first"))
    mark = marks.withColumn("spread", F.lit(0).cast("long"))
    joined = rows.join(first, ["digest", "id", "spread"], "left").join(mark, ["id", "spread"], "left")
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 1 << 4).otherwise(0)
    return joined.groupBy("part", (F.col("alone") + copy).alias("failed")).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def shapley_operator(n: int) -> list[list[int]]:
    """Row i holds, for each coalition as a bit set, its factor in n! times the Shapley value of filter i.

    With w the kernel weights, Z the coalitions' membership and v their values, the values phi minimise
    sum(w * (v - Z phi)^2) subject to sum(phi) = v(all). The normal equations
    [Z'WZ 1; 1' 0] [phi; m] = [Z'W v; v(all)] are eliminated in rationals with one right-hand column per
    coalition, so the columns of the solution are the factors.
    """
    if n == 1:
        return [[0, 1]]
    full = (1 << n) - 1
    weight = {s: Fraction(n - 1, comb(n, k) * k * (n - k)) for s in range(1, full) for k in [s.bit_count()]}
    rows = []
    for i in range(n):
        left = [sum(w for s, w in weight.items() if s >> i & 1 and s >> j & 1) for j in range(n)]
        rows.append([*map(Fraction, left), Fraction(1), *(weight.get(s, Fraction(0)) * (s >> i & 1) for s in range(full + 1))])
    rows.append([*[Fraction(1)] * n, Fraction(0), *(Fraction(int(s == full)) for s in range(full + 1))])
    for at in range(n + 1):
        pivot = next(r for r in range(at, n + 1) if rows[r][at])
        rows[at], rows[pivot] = rows[pivot], rows[at]
        rows[at] = [x / rows[at][at] for x in rows[at]]
        for r in range(n + 1):
            if r != at and rows[r][at]:
                rows[r] = [x - rows[r][at] * y for x, y in zip(rows[r], rows[at])]
    factors = [[x * factorial(n) for x in row[n + 1 :]] for row in rows[:n]]
    assert all(x.denominator == 1 for row in factors for x in row)
    return [[int(x) for x in row] for row in factors]


def coalition_table(sets: DataFrame, n: int) -> DataFrame:
    """Per part, arrays over all 2^n coalitions of the documents (all, good, toxic) that each removes."""
    coalitions = F.sequence(F.lit(0), F.lit((1 << n) - 1))
    hit = F.col("failed").bitwiseAND(F.col("coalition")) != 0
    totals = sets.withColumn("coalition", F.explode(coalitions)).groupBy("part", "coalition").agg(
        *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")],
        F.sum("n").alias("all"),
    )
    # 2^n entries a part
    row = F.array_sort(F.collect_list(F.struct("coalition", "n", "good", "toxic")))
    return totals.groupBy("part").agg(row.alias("row"), F.max("all").alias("all")).select(
        "part", "all", *[F.col(f"row.{c}").alias(c) for c in ("n", "good", "toxic")]
    )


def audit(sets: DataFrame, names: str) -> DataFrame:
    """Every step of every order of the filters ``names`` (one letter each), from ``failure_sets``-like counts."""
    n = len(names)
    full = (1 << n) - 1
    factors = F.split(F.lit(";".join(",".join(map(str, row)) for row in shapley_operator(n))), ";")
    shapley = F.transform(
        factors,
        lambda row: F.aggregate(
            F.zip_with(F.split(row, ",").cast("array<bigint>"), "n", lambda a, b: a * b), F.lit(0).cast("long"), lambda a, x: a + x
        ),
    )
    orders = F.split(F.lit(",".join("".join(p) for p in permutations(names))), ",")
    steps = (
        coalition_table(sets, n)
        .withColumn("shapleys", shapley)
        .withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumn("at", F.expr(f"instr('{names}', substring(filter_order, step, 1)) - 1"))
        .withColumn("own", F.expr("shiftleft(1, at)"))
    )
    before = [F.when(F.expr(f"instr(substring(filter_order, 1, step - 1), '{c}') > 0"), 1 << i).otherwise(0) for i, c in enumerate(names)]
    steps = steps.withColumn("before", sum(before[1:], before[0])).withColumn("after", F.col("before") + F.col("own"))

    def removed(column: str) -> Column:
        return F.get(column, F.col("after")) - F.get(column, F.col("before"))

    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("all") - F.get("n", F.col("after"))).alias("kept"),
        removed("n").alias("removed"),
        (F.get("n", F.col("own")) - removed("n")).alias("redundant"),
        (F.get("n", F.lit(full)) - F.get("n", F.lit(full) - F.col("own"))).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        F.get("shapleys", F.col("at")).alias("shapley"),
    )


def failure_sets_of(rows: DataFrame, part: Column, conditions: Mapping[str, Column], good: Column, toxic: Column) -> DataFrame:
    """The same counts for any filters: ``conditions`` are true (not null) where a row fails."""
    bits = [F.when(cond, 1 << i).otherwise(0) for i, cond in enumerate(conditions.values())]
    return rows.groupBy(F.coalesce(part, F.lit("")).alias("part"), sum(bits[1:], bits[0]).alias("failed")).agg(
        F.count("*").alias("n"),
        F.sum(F.when(good, 1).otherwise(0)).alias("good"),
        F.sum(F.when(toxic, 1).otherwise(0)).alias("toxic"),
    )


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All orders of A to E over a table of documents."""
    return audit(failure_sets(docs, labels), "ABCDE")


ORACLE = r"""
with w as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         min(doc_id) over (partition by coalesce(text, '')) as first from documents),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
f as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
         map {'A': len(words) < 50,
              'B': 100 * len(list_distinct(words)) < 65 * len(words),
              'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
              'D': regexp_matches(t, '[#$%&*|]'),
              'E': coalesce(doc_id > first, false)} as fails
  from w left join l using (doc_id)),
g as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from f group by all),
o as (select a.c || b.c || c.c || d.c || e.c as filter_order
      from (values ('A'), ('B'), ('C'), ('D'), ('E')) a(c), (values ('A'), ('B'), ('C'), ('D'), ('E')) b(c),
           (values ('A'), ('B'), ('C'), ('D'), ('E')) c(c), (values ('A'), ('B'), ('C'), ('D'), ('E')) d(c),
           (values ('A'), ('B'), ('C'), ('D'), ('E')) e(c)
      where len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s as (select filter_order, cast(k as integer) as step, filter_order[k:k] as own, filter_order[1:k - 1] as earlier
      from o, range(1, 6) r(k)),
x as (
  select part, filter_order, step, own, n, good, toxic, fails[own] as hit,
         len([c for c in map_keys(fails) if fails[c] and contains(earlier, c)]) > 0 as gone,
         len([c for c in map_keys(fails) if fails[c] and c <> own]) = 0 as sole
  from g, s),
y as (
  select part, filter_order, step, own,
         coalesce(sum(n) filter (not gone and not hit), 0) as kept,
         coalesce(sum(n) filter (not gone and hit), 0) as removed,
         coalesce(sum(n) filter (gone and hit), 0) as redundant,
         coalesce(sum(n) filter (hit and sole), 0) as unique_fails,
         coalesce(sum(good) filter (not gone and hit), 0) as good_lost,
         coalesce(sum(toxic) filter (not gone and hit), 0) as toxic_lost
  from x group by all)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, own) as bigint) as shapley
from y
"""
