"""Source divergence audit: how far the sources of a language differ in their use of words.

A language keeps the terms that stand in at least ``DOCUMENTS_LEAST`` of its documents. Every group (a source
within a language) and the language itself give each kept term a smoothed share in billionths,
p = 1 + floor(10^9 * (count + 1) / (N + V)), and a difference f(p, q) = floor((p - q)^2 / q). The audit sums f
over all kept terms for each pair of sources, and lists the terms a group uses most above its language.

Most counts are zero, and rows of terms look alike, so the pair sums come from a frequent-pattern tree. A term's
row is its nonzero counts in the order of sources; equal rows are counted (their multiplicity), and rows are
inserted as paths. A pair's sum is then the value with all counts zero, times V; plus, for each count of one
source, the change it makes while the other is zero; plus, for each node and each of its ancestors, the change
their two counts make together, once per combination, times the node's multiplicity. All three are whole numbers.

The tree is spread by ranges of sorted rows, so paths with a common beginning meet in a task. In sorted order
only the current path is held: a node is complete when a row leaves it, and then meets its ancestors.

Defined results: null text, lang and source are the empty string; a language of '' is one like any other; a group
whose documents hold no kept term has counts of zero throughout; a language without kept terms has pairs of
value 0 and no terms; repeated rows are documents of their own, whatever their ids; an empty table has no rows.
A language with one source has no pairs. Extra columns are ignored.

Scale: documents are never shuffled; tasks combine counts per (language, source, term) and hand them on when they
hold ``HELD`` of them. A term's row and a path have at most one entry per source of the language; pairs of
sources are what the audit returns. Shares of groups are broadcast only behind a count. Top lists are cut
per task before the shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltspan.session import maybe_broadcast, stage

DOCUMENTS_LEAST = 3
TERMS_LISTED = 200
BILLION = 1_000_000_000
# distinct (language, source, term) a task holds before it hands them on
HELD = 800_000
# pair corrections a task collects before it adds them up
PAIRS = 1 << 20
# letters and what is not ASCII stay, A-Z become a-z, all else parts terms
_SHARE = (1 << 31) - 1
_PLAIN = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (occurs, holds) in groups.items():
                terms = list(occurs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(lang, pa.string()), len(terms)),
                        pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                        pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array(list(occurs.values()), pa.int64()),
                        pa.array(list(map(holds.__getitem__, terms)), pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (lang, source) not in groups:
                    groups[lang, source] = Counter(), Counter()
                occurs, holds = groups[lang, source]
                found = text.as_py().encode().translate(_PLAIN).split()
                size -= len(occurs)
                occurs.update(found)
                size += len(occurs)
                holds.update(set(found))
                if size >= held:
                    yield from rows()
                    groups, size = {}, 0
        yield from rows()

    named = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    schema = "lang string, source string, term string, n long, docs long"
    return named.mapInArrow(count, schema).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def term_rows(docs: DataFrame, least: int = DOCUMENTS_LEAST) -> DataFrame:
    """Kept terms: (lang, term, n, cells), with the nonzero counts of the sources in their order."""
    cells = F.array_sort(F.collect_list(F.struct("source", "n")))  # at most one per source of the language
    rows = term_counts(docs).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), cells.alias("cells"))
    return rows.filter(F.col("docs") >= least).drop("docs")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / (total + terms)), without overflow."""
    number, whole = F.lit(BILLION).cast("decimal(10,0)"), (count + 1).cast("decimal(20,0)")
    return F.call_function("div", number * whole, (total + terms).cast("decimal(20,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_table(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Every occurring (lang, source) with its total and zero-count share, and N and V of the language."""
    present = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    cells = rows.select("lang", F.explode("cells").alias("cell")).select("lang", "cell.source", "cell.n")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = rows.groupBy("lang").agg(F.sum("n").alias("all"), F.count("*").alias("terms"))
    found = present.join(totals, ["lang", "source"], "left").join(whole, "lang", "left").fillna(0, ["total", "all", "terms"])
    return found.withColumn("zero", F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))))


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def totals(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the exact sums of their values."""
    keys, where = np.unique(codes, return_inverse=True)
    # halves of 32 bits, whose sums are exact as doubles
    low = np.bincount(where, values & 0xFFFFFFFF, len(keys)).astype(np.int64)
    high = np.bincount(where, values >> 32, len(keys)).astype(np.int64)
    return keys, (high << 32) + low


class Tree:
    """The current path of a frequent-pattern tree that is fed with sorted rows, and its pairs so far.

    An item is a number, group << 31 | share; ``zeros`` holds each item's share of count zero beside it.
    """

    def __init__(self):
        self.items = self.zeros = np.zeros(0, np.int64)
        self.times: list[int] = []  # multiplicity of each node of the path, without its last child's
        self.pairs: list[tuple[np.ndarray, ...]] = []  # item, ancestor, their zeros, times
        self.waiting = 0
        self.places: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def insert(self, items: np.ndarray, zeros: np.ndarray, times: int) -> None:
        n = min(len(items), len(self.items))
        unlike = np.flatnonzero(items[:n] != self.items[:n])
        shared = int(unlike[0]) if len(unlike) else n
        self.leave(shared)
        self.items, self.zeros = items, zeros
        self.times += [0] * (len(items) - shared)
        self.times[-1] += times

    def leave(self, depth: int) -> None:
        """Complete the nodes below ``depth``: each meets its ancestors once and hands its multiplicity on."""
        n = len(self.times)
        if n <= depth:
            return
        times = np.cumsum(np.array(self.times[:depth - 1 if depth else None:-1], np.int64))[::-1]
        if depth:
            self.times[depth - 1] += int(times[0])
        if (depth, n) not in self.places:
            node, above = np.nonzero(np.arange(n) < np.arange(depth, n)[:, None])
            if n > 64:  # long paths are rare, and their places large
                self.places.clear()
            self.places[depth, n] = node + depth, above
        node, above = self.places[depth, n]
        self.pairs.append((self.items[node], self.items[above], self.zeros[node], self.zeros[above], times[node - depth]))
        self.waiting += len(node)
        del self.times[depth:]

    def sums(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the pairs so far add to f beyond what each count adds alone, by (group, other group); they start anew."""
        if not self.pairs:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        a, b, a0, b0, times = (np.concatenate(x) for x in zip(*self.pairs))
        self.pairs, self.waiting = [], 0
        p, q, own, other = a & _SHARE, b & _SHARE, a >> 31, b >> 31
        there = times * (gaps(p, q) - gaps(p, b0) - gaps(a0, q) + gaps(a0, b0))
        back = times * (gaps(q, p) - gaps(q, a0) - gaps(b0, p) + gaps(b0, a0))
        keys, values = totals(np.concatenate([own << 31 | other, other << 31 | own]), np.concatenate([there, back]))
        return keys >> 31, keys & _SHARE, values


PAIR_SCHEMA = "lang string, source string, item string, value long"


def tree_corrections(patterns: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(lang, source, item, value) from sorted rows (lang, path of (source, p, zero), times)."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, groups = Tree(), {}

        def rows() -> pa.RecordBatch:
            a, b, value = tree.sums()
            names = pa.array([source for _, source in groups], pa.string())
            langs = pa.array([lang for lang, _ in groups], pa.string())
            return pa.RecordBatch.from_arrays(
                [langs.take(pa.array(a)), names.take(pa.array(a)), names.take(pa.array(b)), pa.array(value)],
                names=["lang", "source", "item", "value"],
            )

        for batch in batches:
            path = batch.column(1)
            ends = path.offsets.to_numpy()
            cells = path.values
            named = cells.field("source").dictionary_encode()
            share, zero = (cells.field(c).to_numpy() for c in ("p", "zero"))
            langs = batch.column(0).to_pylist()
            # sources are numbered within their language
            code = named.indices.to_numpy().astype(np.int64)
            sources = named.dictionary.to_pylist()
            numbers = {lang: np.array([groups.setdefault((lang, x), len(groups)) for x in sources], np.int64) for lang in set(langs)}
            for i, (lang, times) in enumerate(zip(langs, batch.column(2).to_pylist())):
                at = slice(ends[i], ends[i + 1])
                tree.insert(numbers[lang][code[at]] << 31 | share[at], zero[at], times)
                if tree.waiting >= pairs:
                    yield rows()
        tree.leave(0)
        yield rows()

    return patterns.mapInArrow(grow, PAIR_SCHEMA)


def pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all pairs of a language's sources; ``cells`` hold nonzero shares."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("zero_item"))
    none = groups.join(other, "lang").filter("source <> item").select(
        "lang", "source", "item", F.coalesce(F.col("terms") * gap(F.col("zero"), F.col("zero_item")), F.lit(0)).alias("value")
    )
    # equal counts of a source are counted first, then meet the other sources
    counts = cells.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("times"))
    met = counts.join(maybe_broadcast(other), "lang").filter("source <> item")
    alone = met.select(
        "lang",
        F.explode(
            F.array(
                F.struct(
                    "source", "item",
                    (F.col("times") * (gap(F.col("p"), F.col("zero_item")) - gap(F.col("zero"), F.col("zero_item")))).alias("value"),
                ),
                F.struct(
                    F.col("item").alias("source"), F.col("source").alias("item"),
                    (F.col("times") * (gap(F.col("zero_item"), F.col("p")) - gap(F.col("zero_item"), F.col("zero")))).alias("value"),
                ),
            )
        ).alias("x"),
    ).select("lang", "x.*")
    path = F.array_sort(F.collect_list(F.struct("source", "p", "zero")))  # at most one per source of the language
    patterns = cells.groupBy("lang", "term").agg(path.alias("path")).filter(F.size("path") > 1).groupBy("lang", "path").agg(F.count("*").alias("times"))
    patterns = stage(patterns, "term-patterns")
    # the first cells are enough to bring common beginnings together, and keep what Spark samples for the ranges small
    ranges = patterns.repartitionByRange("lang", F.slice("path", 1, 3), F.xxhash64("path"))
    together = tree_corrections(ranges.sortWithinPartitions("lang", "path"))
    return none.unionByName(alone).unionByName(together).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audited(docs: DataFrame, least: int = DOCUMENTS_LEAST, listed: int = TERMS_LISTED) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    rows = stage(term_rows(docs, least), "term-rows")
    groups = stage(group_table(docs, rows), "source-groups")
    cells = stage(
        rows.select("lang", "term", F.col("n").alias("n_all"), F.explode("cells").alias("cell"))
        .select("lang", "term", "n_all", "cell.source", "cell.n")
        .join(maybe_broadcast(groups), ["lang", "source"])
        .select(
            "lang",
            "term",
            "source",
            share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            "zero",
            share(F.col("n_all"), F.col("all"), F.col("terms")).alias("q"),
        ),
        "term-shares",
    )
    group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = cells.filter("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(group)).filter(F.col("rank") <= listed)
    pairs = pair_sums(cells, groups).withColumn("rank", F.row_number().over(group))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))


ORACLE = rf"""
with d as (select row_number() over () as key, coalesce(lang, '') as lang, coalesce(source, '') as source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words from documents),
t as (select key, lang, source, unnest(words) as term from d),
kept as (select lang, term, count(*) as n_all from t group by lang, term having count(distinct key) >= {DOCUMENTS_LEAST}),
v as (select lang, count(*) as terms, sum(n_all) as n_lang from kept group by lang),
c as (select lang, source, term, count(*) as n from t join kept using (lang, term) group by all),
g as (select x.lang, x.source, coalesce(s.total, 0) as total, coalesce(terms, 0) as terms, coalesce(n_lang, 0) as n_lang
      from (select distinct lang, source from d) x
      left join (select lang, source, sum(n) as total from c group by all) s using (lang, source) left join v using (lang)),
p as (select g.lang, g.source, kept.term, coalesce(n, 0) as n,
             1 + cast(1000000000 as hugeint) * (coalesce(n, 0) + 1) // (total + terms) as p,
             1 + cast(1000000000 as hugeint) * (n_all + 1) // (n_lang + terms) as q
      from g join kept on kept.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term),
pairs as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
          from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
allpairs as (select a.lang, a.source, b.source as item, cast(coalesce(value, 0) as bigint) as value
             from g a join g b on a.lang = b.lang and a.source <> b.source
             left join pairs x on x.lang = a.lang and x.source = a.source and x.item = b.source),
terms as (select lang, source, term as item, cast((p - q) * (p - q) // q as bigint) as value from p where n > 0 and p > q)
select lang, source, 'pair' as part, item, value,
       cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from allpairs
union all
select * from (select lang, source, 'term' as part, item, value,
       cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from terms)
where rank <= {TERMS_LISTED}
"""
